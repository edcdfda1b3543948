"""The pipeline stage by stage: each stage's rows against a plain version fed
with the same input."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_mixing import brute_targets
from test_rules_and_scans import brute_contamination
from test_simhash import brute_components, brute_fingerprint

from quartermaster.llm import lang_id
from quartermaster.session import scratch_dir

SF001 = "/root/testdata/sf0.001"
COLS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """Input and the output of every stage on the whole small table."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = scratch_dir(spark, f"stage-{k}")
        stage(spark, out[-1], SF001).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def tuples(df):
    return Counter(tuple(r[c] for c in COLS) for r in df.select(*COLS).collect())


def test_stages_keep_the_columns_of_documents(steps):
    for df in steps[:-1]:
        assert df.columns == COLS and df.dtypes == steps[0].dtypes


def test_language_id_drops_only_what_it_cannot_name(steps):
    kept, all_docs = tuples(steps[1]), tuples(steps[0])
    assert not kept - all_docs
    gone = all_docs - kept
    model = lang_id.train(steps[0].where(~lang_id.held_out()))
    def best(text):
        total, (letter,) = lang_id.scores([text], model)
        p = np.exp(total[0] - total[0].max())
        return (p / p.sum()).max() if letter else 0.0

    for (_, text, *_), _n in gone.items():
        assert best(text) < corpus_pipeline.MIN_SCORE
    for (_, text, *_), _n in kept.items():
        assert best(text) >= corpus_pipeline.MIN_SCORE


def brute_lines(docs):
    blanks = " \t\x0b\x0c\r"
    hosts = Counter(d[3] for d in docs.elements())
    pages = Counter()
    for (_, text, _, host, _), n in docs.items():
        for line in {x.strip(blanks) for x in (text or "").split("\n")} - {""}:
            pages[(host, line)] += n
    bad = {k for k, n in pages.items() if n >= 5 and n > 0.1 * hosts[k[0]]}
    out = Counter()
    for (i, text, lang, host, n_chars), n in docs.items():
        if text is not None:
            lines = text.split("\n")
            kept = [x for x in lines if (host, x.strip(blanks)) not in bad]
            if len(kept) < len(lines):
                text = "\n".join(kept)
                n_chars = len(text)
        out[(i, text, lang, host, n_chars)] += n
    return out


def test_line_dedup_keeps_every_document(steps):
    assert tuples(steps[2]) == brute_lines(tuples(steps[1]))


def test_near_dedup_keeps_the_least_id_of_each_component(steps):
    rows = tuples(steps[2])
    prints = [(d[0], brute_fingerprint(d[1])) for d in rows]
    comp = brute_components(prints)
    want = {d for d, f in prints if comp[f] == d}
    assert tuples(steps[3]) == Counter({d: 1 for d in rows if d[0] in want})


def test_decontamination_keeps_clean_documents(steps, spark):
    rows = tuples(steps[3])
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {r[0] for r in brute_contamination([(d[0], d[1]) for d in rows], items) if r[-1]}
    assert tuples(steps[4]) == Counter({d: n for d, n in rows.items() if str(d[0]) not in bad})


def test_mix_comes_near_its_targets(steps):
    before = {r["doc_id"]: r for r in steps[4].collect()}
    rows = steps[5].collect()
    words = {d: len((r["text"] or "").split()) for d, r in before.items()}  # ASCII blanks in this table
    sizes, taken, longest = Counter(), Counter(), max(words.values())
    for d, r in before.items():
        sizes[r["source"]] += words[d]
    for r in rows:
        assert tuple(r[c] for c in COLS) == tuple(before[r["doc_id"]][c] for c in COLS)
        assert r["copies"] in (1, 2) and r["taken"] == r["copies"] * words[r["doc_id"]]
        taken[r["source"]] += r["taken"]
    for s, target in brute_targets(dict(sizes)).items():
        assert abs(taken[s] - target) <= longest + 1e-6


def test_run_gives_the_rows_of_the_last_stage(steps, spark):
    assert tuples(corpus_pipeline.run(spark, SF001)) == tuples(steps[5])


ROWS = [(1, None), (2, ""), (None, "the house and the garden", None, None), (3, "the house and the garden"),
        (3, "the house and the garden"), (4, "12 34"), (5, "the river of the city " * 30_000), (6, "x\n\n", None)]


@pytest.mark.parametrize("k", range(5))
@pytest.mark.parametrize("rows", [ROWS, []])
def test_stages_take_odd_rows_clashing_columns_and_empty_tables(make_docs, spark, clashes, k, rows):
    extra = [*clashes, "1 as lang_pred", "2 as SCORE", "'c' as copies", "'t' as taken", "3 as mix_size",
             "'w' as `two words`", "4 as `dotted.name`"]
    docs = make_docs(rows, extra)
    out = corpus_pipeline.STAGES[k][1](spark, docs, SF001)
    assert out.columns[:len(docs.columns)] == docs.columns
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    if k < 4:
        assert out.columns == docs.columns
    path = scratch_dir(spark, f"odd-{k}")
    out.write.parquet(path)
    assert spark.read.schema(out.schema).parquet(path).count() <= len(rows)


def test_empty_stage_inputs_follow_each_other(make_docs, spark):
    docs = make_docs([(1, "12 34")])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF001)
    assert docs.where(F.col("copies") > 0).count() == 0
