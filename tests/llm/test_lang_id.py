from __future__ import annotations

import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from quartermaster.llm import lang_id

SF01 = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_accuracy_on_the_table(spark):
    docs = spark.read.parquet(SF01)
    out = lang_id.identify(docs).select("row.doc_id", "row.lang", "lang_pred", "score").collect()
    held = [r for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert len(out) == docs.count()
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out)


def test_held_out_flag(make_docs):
    docs = make_docs([(i, "x") for i in range(50)] + [(None, "x")])
    for r in docs.select("doc_id", lang_id.held_out().alias("h")).collect():
        assert r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


def test_prediction_ignores_lang_source_and_id(make_docs, spark):
    learn = spark.read.parquet(SF01)
    text = "the thing and that of the with"
    docs = make_docs([(1, text, "de", "x"), (10**12, text, None, None)])
    a, b = lang_id.identify(docs, learn_from=learn).collect()
    assert (a["lang_pred"], a["score"]) == (b["lang_pred"], b["score"]) == ("en", a["score"])


def plain_model(rows):
    """(counts per kind, language and token) of (text, lang) rows."""
    counts = {}
    for text, lang in rows:
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            for n in (0, 5, 4, 3, 2, 1):
                padded = w if n < 2 else f"^{w}$"
                for g in [w] if n == 0 else [padded[i:i + n] for i in range(len(padded) - n + 1)]:
                    per = counts.setdefault((n, g), Counter())
                    per[lang] += 1
    return {k: per for k, per in counts.items() if sum(per.values()) >= 2}


def plain_scores(text, counts, langs):
    sums, tokens = Counter(), Counter()
    for (n, _), per in counts.items():
        tokens[n] += 1
        for lang, c in per.items():
            sums[n, lang] += c
    log = lambda n, g, lang: math.log((counts[n, g][lang] + 0.1) / (sums[n, lang] + 0.1 * tokens[n] + 1))
    out = dict.fromkeys(langs, 0.0)
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        for n in (0, 5, 4, 3, 2, 1):
            padded = w if n < 2 else f"^{w}$"
            found = [g for g in ([w] if n == 0 else [padded[i:i + n] for i in range(len(padded) - n + 1)]) if (n, g) in counts]
            if found:
                for lang in langs:
                    out[lang] += sum(log(n, g, lang) for g in found) / len(found)
                break
    return out


def test_words_come_first_and_unseen_words_back_off(make_docs):
    # Every token twice, so that it is counted.
    model = lang_id.train(make_docs([(0, "hello hello who who", "aa"), (2, "hex hex", "bb")]))
    kinds, word, at, _ = lang_id.evidence(["hello", "hey", "oh", "zzz", "\u00bd"], model)
    # "^he" has three letters; "oh" has no known pair but known letters.
    assert kinds.tolist() == [0, 3, 1, -1, -1]
    assert {(int(w), int(a)) for w, a in zip(word, at)} >= {(0, 0), (1, 0), (1, 1), (2, 0)}


def test_scores_match_a_plain_version(spark):
    learn = spark.read.parquet(SF01).where(~lang_id.held_out()).where("doc_id % 4 = 0")
    docs = spark.read.parquet(SF01).where("doc_id % 25 = 1")
    counts = plain_model([(r["text"], r["lang"]) for r in learn.collect() if r["text"] and r["lang"]])
    model = lang_id.train(learn)
    n = 0
    for r in lang_id.predict(docs, model).collect():
        want = plain_scores(r["row"]["text"] or "", counts, model["langs"])
        best = max(want.values())
        if not re.search(r"[^\W\d_]", r["row"]["text"] or ""):
            assert r["lang_pred"] == "und"
            continue
        n += 1
        assert r["lang_pred"] == min(x for x in want if want[x] == best)
        assert abs(r["score"] - 1 / sum(math.exp(x - best) for x in want.values())) < 1e-4
    assert n > 30


def test_edge_cases(make_docs, clashes, spark):
    learn = spark.read.parquet(SF01)
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (4, "the of"), (5, "the " * 100_000), (6, "x", None),
            (None, "the", None), (4, "the of")]
    docs = make_docs(rows, clashes)
    out = {(r["row"]["doc_id"], r["row"]["text"] and r["row"]["text"][:6]): r for r in lang_id.identify(docs, learn_from=learn).collect()}
    assert all(out[k]["lang_pred"] == "und" and out[k]["score"] == 0 for k in ((1, None), (2, ""), (3, "12 34 ")))
    assert out[(5, "the th")]["lang_pred"] == "en"
    assert lang_id.identify(make_docs([])).count() == 0
    nothing = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in lang_id.identify(nothing).collect()} == {"und"}


def test_what_is_broadcast_does_not_change_the_result(spark, clashes):
    learn = spark.read.parquet(SF01).where(~lang_id.held_out()).limit(200)
    docs = spark.read.parquet(SF01).limit(150)
    more = spark.createDataFrame([(1, None), (2, ""), (3, "12 34"), (4, "zzqx qqz \u0416\u0416"), (4, "zzqx qqz \u0416\u0416"), (5, "\u00b2 \u00bd")],
                                 "doc_id long, text string")
    docs = docs.select("doc_id", "text").unionByName(more).selectExpr("*", *clashes)
    out = []
    for size in (1 << 30, 6400, 64):
        model = lang_id.train(learn, max_bytes=size)
        assert (model["table"] is None) == (size == 1 << 30)
        out.append(sorted(((r["row"]["doc_id"], r["row"]["text"] or "", r["lang_pred"], r["score"])
                           for r in lang_id.predict(docs, model).collect()), key=lambda x: x[:2]))
    assert len(out[0]) == 156
    for got in out[1:]:
        assert [x[:3] for x in got] == [x[:3] for x in out[0]]
        assert all(abs(a[3] - b[3]) < 1e-6 for a, b in zip(got, out[0]))


def test_no_language_is_left_out(make_docs):
    name = lambda k: "".join(chr(97 + int(d)) for d in f"{k:03d}")
    rows = [(3 * k + j, f"{name(k)}word {name(k)}text", f"l{k:03d}") for k in range(230) for j in range(3)]
    rows += [(10_000 + j, "aaaword aaatext", "l000") for j in range(20)]
    model = lang_id.train(make_docs(rows), max_bytes=36_800)
    assert len(model["langs"]) == 230
    out = {r["row"]["text"]: r["lang_pred"] for r in lang_id.predict(make_docs(rows), model).collect()}
    assert all(out[text] == lang for _, text, lang in rows)
