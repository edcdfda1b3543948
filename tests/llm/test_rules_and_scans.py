from __future__ import annotations

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from quartermaster.llm import (decontaminate, license_scan, line_dedup, quality_rules, secret_scan, warc_fixity)
from quartermaster.llm.common import Scratch

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


# ------------------------------------------------------------ line dedup

def test_line_dedup_drops_only_boilerplate_of_the_host(make_docs, clashes):
    rows = [(i, f"  Menu \nbody {i}\n\nbody {i}", "en", "a") for i in range(10)]
    rows += [(100 + i, "Menu\nother", "en", "b") for i in range(4)]
    rows += [(200, None, "en", "a"), (201, "", "en", None), (None, "Menu", None, None), (3, rows[3][1], "en", "a")]
    out = {(r["row"]["doc_id"], r["row"]["source"]): r for r in
           line_dedup.line_dedup(make_docs(rows, clashes), ratio=0.3, min_pages=5).collect()}
    assert out[(1, "a")]["kept_text"] == "body 1\n\nbody 1" and out[(1, "a")]["n_dropped"] == 1
    assert out[(100, "b")]["kept_text"] == "Menu\nother"  # too few pages
    assert out[(200, "a")]["kept_text"] is None and out[(201, None)]["kept_text"] == ""
    assert out[(None, None)]["kept_text"] == "Menu"
    assert line_dedup.line_dedup(make_docs([])).count() == 0


def test_line_dedup_can_empty_a_page_but_keeps_its_row(make_docs):
    docs = make_docs([(i, "x" * 100_000, "en", None) for i in range(6)])
    assert [r["kept_text"] for r in line_dedup.line_dedup(docs).collect()] == [""] * 6


# --------------------------------------------------------- decontamination

def brute_contamination(docs, items):
    win = {}
    for item, text in items:
        w = ALNUM.findall(lower(text))
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            win.setdefault(tuple(w[i:i + n]), set()).add("" if item is None else str(item))
    out = []
    for d, text in docs:
        w = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for n in {len(k) for k in win}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in win:
                    hit |= set(range(i, i + n))
                    found |= win[tuple(w[i:i + n])]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((str(d), len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


@pytest.mark.parametrize("block_words", [500_000, 15])
def test_decontamination_matches_brute_force(make_docs, spark, clashes, block_words):
    long = " ".join(f"w{i}" for i in range(30))
    docs = [(1, None), (2, ""), (3, "intro " + long + " end"), (4, "Short, ITEM!"), (5, "é short item short item"),
            (6, " ".join(f"w{i}" for i in range(5, 19)) + " x" * 400), (7, "w1 w2 w3"), (None, long), (8, long), (8, long),
            (9, "filler " * 30_000 + long)]
    items = [(1, long), (2, "short item"), (3, None), (4, "..."), (None, "w1 w2 w3"), (1, long), (10, "filler filler")]
    frame = make_docs(docs, clashes)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.report(frame, bench, block_words=block_words).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
                  for r in got) == brute_contamination(docs, items)
    clean = decontaminate.decontaminate(frame, bench)
    assert clean.columns == frame.columns
    assert {r["doc_id"] for r in clean.collect()} == {1, 2, 6} - {d for d, *_, bad in
                                                                  brute_contamination(docs, items) if bad}


def test_decontamination_of_empty_tables(make_docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(make_docs([]), none).count() == 0
    r = decontaminate.report(make_docs([(1, "a b")]), none).first()
    assert (r["n_hit"], r["n_items"], r["contaminated"]) == (0, 0, False)


def test_proximity_matches(make_docs, spark):
    words = [f"w{i}" for i in range(13)]
    near = words[:6] + ["new"] + words[6:]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    docs = make_docs([(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(words[:4]))])
    out = {r["k_id"]: r for r in decontaminate.phrase_matches(docs, bench, Scratch(spark, "t")).collect()}
    assert out[1]["items"] == ["1"] and out[1]["spans"][0]["end"] == 13
    assert out[2]["items"] == [] and out[2]["near_items"] == ["1"]
    assert out[3]["near_items"] == []


def brute_near(text, words, slop=2, share=0.8):
    """Whether any alignment of one window is a proximity match."""
    w = ALNUM.findall(lower(text))
    for start in range(-len(words) - slop, len(w) + slop):
        hits = sum(any(0 <= start + j + d < len(w) and w[start + j + d] == t for d in range(-slop, slop + 1))
                   for j, t in enumerate(words))
        same = sum(0 <= start + j < len(w) and w[start + j] == t for j, t in enumerate(words))
        if hits >= math.ceil(share * len(words)) and 1 <= same < len(words):
            return True
    return False


def test_a_near_copy_is_found_whichever_word_is_replaced(make_docs, spark):
    words = [f"w{i}" for i in range(13)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    # Other documents make every word as common as wanted; the replaced one may stand nowhere else.
    docs = [(i, " ".join(["a"] + words[:i] + ["other"] + words[i + 1:] + ["b"])) for i in range(13)]
    for rows in (docs, docs + [(100 + i, f"w{i} " * (i + 1)) for i in range(13)], [docs[5]]):
        out = {r["k_id"]: r for r in decontaminate.phrase_matches(make_docs(rows), bench, Scratch(spark, "t")).collect()}
        assert [out[d]["near_items"] for d, _ in rows if d < 13] == [["1"]] * len([d for d, _ in rows if d < 13])
        assert not any(out[d]["items"] for d, _ in rows)


@pytest.mark.parametrize("block_words", [500_000, 40])
def test_proximity_equals_brute_force(make_docs, spark, block_words):
    rng = random.Random(6)
    items = [(k, " ".join(rng.choices("abcdefghij", k=rng.choice([1, 2, 5, 13])))) for k in range(12)]
    docs = []
    for k in range(60):
        w = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(w) + 1)
            w[at:at + rng.randint(0, 1)] = rng.choices("abcdefghijz", k=rng.randint(0, 2))
        docs.append((k, " ".join(rng.choices("xyz", k=rng.randint(0, 3)) + w)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.phrase_matches(make_docs(docs), bench, Scratch(spark, "t"), block_words=block_words)
    got = {r["k_id"]: sorted(set(r["near_items"])) for r in found.collect()}
    want = {d: sorted(str(i) for i, t in items if brute_near(text, t.split())) for d, text in docs}
    assert got == want and sum(map(len, want.values())) > 30


# ------------------------------------------------------------ quality rules

def test_a_line_count_means_the_same_on_every_host(make_docs):
    rows = [(k, f"The same line stands here often.\nBut this one is {k} alone.", "en", host)
            for host, n in (("small", 20), ("big", 300)) for k in range(n)]
    # "big" has it in six documents only.
    rows = [(i, t if host == "small" or i < 6 else t.split("\n")[1], lang, host) for i, t, lang, host in rows]
    out = quality_rules.quality_rules(make_docs(rows), carry=("doc_id", "source")).collect()
    removed = {(r["row"]["source"], r["row"]["doc_id"]): r["n_removed_words"] for r in out}
    assert all(removed["small", k] == 6 for k in range(20))
    assert [removed["big", k] for k in range(8)] == [6] * 6 + [0] * 2


def test_few_documents_of_a_small_host(make_docs):
    rows = [(k, f"shared by three\n{k} own words", "en", "h") for k in range(3)] + [(k, f"{k} alone", "en", "h") for k in range(3, 12)]
    out = {r["row"]["doc_id"]: r["n_removed_words"] for r in quality_rules.quality_rules(make_docs(rows)).collect()}
    assert [out[k] for k in range(4)] == [3, 3, 3, 0]


def test_quality_rules(make_docs, clashes):
    body = " ".join(f"u{i}" for i in range(60))
    rows = [(i, f"{' '.join(f'b{k}' for k in range(70))}\n{body} {i}", "en", "a") for i in range(8)]
    rows += [(100, body, "en", "a"), (101, None, "en", None), (102, "", None, "a"), (103, "a b c a b c", "en", "a"),
             (None, "é è\né è\n\n#|", "en", None), (104, "w " * 100_000, "en", "big")]
    out = {r["row"]["doc_id"]: r for r in quality_rules.quality_rules(make_docs(rows, clashes)).collect()}
    assert not out[1]["base_failed"] and not out[1]["kept"] and out[1]["n_removed_words"] == 70
    assert out[100]["kept"]
    assert (out[103]["n_repeat_words"], out[103]["n_words"]) == (6, 6)
    assert (out[None]["word_chars"], out[None]["n_symbols"], out[None]["n_dup_lines"]) == (6, 2, 1)
    assert out[104]["n_repeat_words"] == 100_000 and out[104]["base_failed"]
    assert out[101]["n_words"] == 0 and out[101]["base_failed"]
    assert quality_rules.quality_rules(make_docs([])).count() == 0


# ------------------------------------------------------------- license scan

def test_license_places_and_labels(make_docs, clashes):
    mit = license_scan.TEMPLATES[0][1]
    edited = mit.replace("person obtaining", "person who is obtaining")
    rows = [(1, "Under the MIT License, under the mit license."), (2, None), (3, "cc"), (4, edited),
            (5, "CC BY-NC 4.0 CC BY NC"), (6, "licensed under the gnu general public license, version 3"),
            (7, "x " * 100_000 + "apache license version 2"), (None, "cc by nc"), (1, "Under the MIT License, under the mit license.")]
    out = {r["doc_id"]: r for r in license_scan.license_report(make_docs(rows, clashes)).collect()}
    assert (out[1]["n_base"], out[1]["first_word"], out[1]["last_word"], out[1]["labels"]) == (2, 0, 4, "mit")
    assert (out[2]["n_words"], out[2]["n_base"], out[2]["first_word"], out[2]["labels"]) == (0, 0, None, "")
    assert out[4]["base_labels"] == "" and out[4]["labels"] == "mit" and 0.6 <= out[4]["score"] < 1
    assert (out[5]["n_base"], out[5]["last_word"]) == (2, 5)
    assert out[6]["labels"] == "gpl-3" and out[6]["base_labels"] == ""
    assert out[7]["first_word"] == 100_000
    assert license_scan.license_report(make_docs([])).count() == 0


# -------------------------------------------------------------- secret scan

def test_secret_scan_finds_keys_and_leaves_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = secret_scan.scan(docs).collect()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    known = re.compile(r"AKIA[0-9A-Z]{16}|password=[0-9a-f]{18}|[0-9a-f]{40}")
    marked = 0
    for r in out:
        token = text[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert hashlib.sha256(token.encode()).hexdigest() == r["token_sha256"]
        assert r["is_secret"] == bool(known.match(token)), token
        marked += r["is_secret"]
    assert marked == sum(len(known.findall(t)) for t in text.values()) > 0


def test_secret_scan_edge_cases(make_docs, clashes):
    rows = [(1, None), (2, ""), (None, "AKIA" + "A1" * 8), (3, "word " * 50_000 + "keykeykeykey")]
    out = secret_scan.scan(make_docs(rows, clashes)).collect()
    assert {(r["doc_id"], r["start"]) for r in out} == {(None, 0), (3, 250_000)}
    assert secret_scan.scan(make_docs([])).count() == 0


def test_values_after_a_key_word_are_candidates_whole(make_docs):
    texts = {"password: hunter22": "hunter22", "api_key = a1b2c3d4e5": "a1b2c3d4e5",
             "password: P@ssw0rd!2024key then": "P@ssw0rd!2024key", 'pwd="x$9#k!"': "x$9#k!",
             "'secret': 'it\"s4me!'": 'it"s4me!', "db_passwd=q1w2e3r4t5@z!": "db_passwd=q1w2e3r4t5@z!",
             'aws_secret_access_key = "ab(1)*cd%"': "ab(1)*cd%", "Token => it's4me!": "it's4me!"}
    rows = secret_scan.candidates(make_docs(list(enumerate(texts)))).collect()
    found = {(r["doc_id"], r["start"], r["token"]) for r in rows}
    assert found >= {(k, text.index(token), token) for k, (text, token) in enumerate(texts.items())}
    assert secret_scan.candidates(make_docs([(1, "the secret of a token: is it"), (2, "hunter22")])).count() == 0
    learn = [(100 + k, f"password: {t}") for k in range(20) for t in (f"k{k}Z9q#x7", "nothing")]
    plain = [(200 + k, f"a wordlikethisone{'abcdefghij'[k]} here") for k in range(10)]
    out = secret_scan.scan(make_docs([(1, "password: hunter22"), *learn, *plain])).where("doc_id = 1").collect()
    assert [(r["start"], r["length"], r["is_secret"]) for r in out] == [(10, 8, True)]


def test_secret_candidates_of_a_text_full_of_them(make_docs):
    tokens = [f"candidate{i:06d}" for i in range(20_000)]
    text = "é" + " é ".join(tokens)
    rows = secret_scan.candidates(make_docs([(1, text, "en", "a"), (1, text, "en", "a")])).collect()
    assert len(rows) == 2 * len(tokens)
    for r in rows:
        assert text[r["start"]:r["start"] + 15] == r["token"]
        assert r["before"] == ("é" if r["start"] == 1 else " é ") and r["after"] in (" é ", "")


# --------------------------------------------------------------------- WARC

def test_fixity_audit_locates_every_difference(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    a = warc_fixity.archive_records(pages, per_archive=100)
    b = warc_fixity.aged_replica(a)
    left = {(r["archive"], r["offset"], r["page_id"]): bytes(r["record"]) for r in a.collect()}
    right = {(r["archive"], r["offset"], r["page_id"]): bytes(r["record"]) for r in b.collect()}
    want = {(*k, "missing" if k not in right else "extra" if k not in left else "changed")
            for k in left.keys() | right.keys() if left.get(k) != right.get(k)}
    for leaf, fan in ((1 << 16, 16), (1 << 12, 2)):
        got = warc_fixity.audit(a, b, leaf, fan).collect()
        assert {(r["archive"], r["offset"], r["record_id"], r["status"]) for r in got} == want
        assert len(got) == len(want)
    assert warc_fixity.audit(a, a).count() == 0


def test_fixity_edge_cases(spark):
    schema = "page_id long, url string, html string, archive string"
    pages = spark.createDataFrame([(None, None, None, "x"), (1, "u", "", "x"), (1, "u", "", "x"), (2, "u", "h" * 300_000, "x"),
                                   (5000, "far", "é", "x")], schema)
    a = warc_fixity.archive_records(pages)
    assert warc_fixity.audit(a, a).count() == 0
    gone = warc_fixity.audit(a, a.where("page_id <> 5000 or page_id is null")).collect()
    assert [(r["record_id"], r["status"]) for r in gone] == [(5000, "missing")]
    empty = a.limit(0)
    assert warc_fixity.audit(empty, empty).count() == 0
    assert warc_fixity.audit(empty, a).where("status = 'extra'").count() == 5
    first = a.where("page_id = 2").withColumn("record", F.lit(b"x").cast("binary"))
    changed = warc_fixity.audit(a, a.where("page_id <> 2 or page_id is null").unionByName(first)).collect()
    assert [(r["record_id"], r["status"]) for r in changed] == [(2, "changed")]
