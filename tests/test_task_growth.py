"""Work that must spread over tasks as the input grows, not over a fixed few."""

from __future__ import annotations

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from quartermaster.operators import joins as J
from quartermaster.plans import catalog
from quartermaster.sources import files as SRC
from test_scale_plans import conf

MANY_TASKS = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def documents(spark, scratch):
    """Documents in three languages with null texts and ids."""
    d = scratch("docs")
    rows = [(None if i % 50 == 0 else i, None if i % 17 == 0 else f"text {i}\nof é {i * 7}", ["en", "de", "fr"][i % 3])
            for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).write.parquet(f"{d}/documents.parquet")
    return d, rows


def parts_of(spark, root, lang):
    return [f for f in SRC.file_inventory(spark, f"{root}/lang={lang}", exclude_names=["index.txt"]).collect()]


def test_files_of_the_text_tree_are_written_by_as_many_tasks_as_the_shuffle_has(spark, documents):
    d, rows = documents
    with conf(spark, MANY_TASKS):
        root = catalog._text_tree(spark, d)
        for at in (root, f"{root}/_old"):
            assert len(parts_of(spark, at, "en")) > 4
        got = {r["lang"]: r["bytes"] for r in catalog.QUERIES["s1_file_inventory"](spark, d).collect()}
    assert got == {g: sum(len((t or "").encode()) + 1 for _, t, h in rows if h == g) for g in ("en", "de", "fr")}


def test_digest_of_a_language_is_written_by_many_tasks(spark, documents, monkeypatch):
    d, rows = documents
    roots = []
    real = catalog.scratch_dir
    monkeypatch.setattr(catalog, "scratch_dir", lambda *a: roots.append(real(*a)) or roots[-1])
    with conf(spark, MANY_TASKS):
        got = {r["lang"]: (r["digest"], r["length"]) for r in catalog.QUERIES["h1_digest_files"](spark, d).collect()}
        assert all(len(parts_of(spark, roots[0], g)) > 1 for g in ("en", "de", "fr"))
    for g in ("en", "de", "fr"):
        # Rows without an id come first, in an order of their own; the rest by id.
        loose = [t for i, t, h in rows if h == g and i is None]
        body = "".join(f"{t or ''}\n" for _, t in sorted((i, t) for i, t, h in rows if h == g and i is not None)).encode()
        length = len(body) + sum(len((t or "").encode()) + 1 for t in loose)
        assert got[g][1] == length
        files = sorted(os.path.join(r, f) for r, _, fs in os.walk(f"{roots[0].removeprefix('file:')}/lang={g}") for f in fs if f.startswith("part-"))
        whole = b"".join(open(f, "rb").read() for f in files)
        assert got[g][0] == hashlib.sha256(whole).hexdigest() and whole.endswith(body)
        assert sorted(whole[:-len(body)].split(b"\n")) == sorted("".join(f"{t or ''}\n" for t in loose).encode().split(b"\n"))


def test_folder_digests_equal_hashlib(spark, scratch):
    root = scratch("parts").removeprefix("file:")
    data = {"a": [os.urandom(1_500_000), b"", b"x"], "é b": [b"one\n"]}
    for folder, parts in data.items():
        os.makedirs(f"{root}/{folder}")
        for k, body in enumerate(parts):
            with open(f"{root}/{folder}/part-{k:05d}", "wb") as fh:
                fh.write(body)
    for bits in (256, 512):
        got = {r["name"]: (r["length"], r["digest"]) for r in
               SRC.folder_digests(SRC.file_inventory_all(spark, root), bits).collect()}
        assert got == {f: (len(b"".join(p)), hashlib.new(f"sha{bits}", b"".join(p)).hexdigest()) for f, p in data.items()}


def test_bitmaps_of_many_small_groups_are_fixed_width_rows(spark):
    names = [f"m{i}" for i in range(130)]
    required = spark.range(4000).select((F.col("id") % 500).alias("g"), (F.col("id") * 37 % 130).alias("n"))
    present = required.where("(n + g) % 5 != 0").unionByName(
        spark.sql("select 7L g, 129L n union all select 9999L, 3L union all select null, 1L union all select 3L, null"))
    want = sorted(map(tuple, J.completeness(required, present, "g", "n").collect()))
    assert sorted(map(tuple, J.completeness_bitmap(required, present, "g", "n", small_groups=True).collect())) == want
    named = [df.select("g", F.concat(F.lit("m"), F.col("n")).alias("n")) for df in (required, present)]
    out = J.completeness_bitmap(*named, "g", "n", domain=names)
    assert sorted(map(tuple, out.collect())) == want and len(want) == 500
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" not in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
