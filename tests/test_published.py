"""K7 / T2 with a key index: what is read, retries, restarts, compaction."""

from __future__ import annotations

import pytest
from helpers import rows
from pyspark.sql import functions as F

from quartermaster.sinks import published as PB
from quartermaster.streaming import streams as T

KV = "k int, v string"


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), KV)


def published(spark, target, cols=("k", "v")):
    return sorted(map(tuple, PB.read_published(spark, target, frame(spark).schema).select(*cols).collect()), key=repr)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_new_keys_are_published_and_reruns_add_nothing(spark, scratch):
    target = scratch("pub")
    assert PB.publish_indexed(frame(spark, (1, "a"), (2, "b"), (None, "n")), target, "k", buckets=4) == 0
    for _ in range(2):
        PB.publish_indexed(frame(spark, (2, "changed"), (3, "c"), (None, "x")), target, "k", buckets=4)
    assert published(spark, target) == sorted([(1, "a"), (2, "b"), (None, "n"), (3, "c")], key=repr)


def test_least_row_of_a_key_wins_in_any_order(spark, scratch):
    some = [(1, "c"), (1, "a"), (1, None), (2, "z"), (2, "y")]
    for k, order in enumerate((some, some[::-1], some[2:] + some[:2])):
        target = scratch(f"win{k}")
        PB.publish_indexed(frame(spark, *order).repartition(3), target, "k", buckets=4)
        assert published(spark, target) == [(1, None), (2, "y")]
    with_map = spark.createDataFrame([(1, {"a": 2}), (1, {"a": 1})], "k int, m map<string,int>")
    assert PB.one_per_key(with_map, ["k"]).collect()[0]["m"] == {"a": 1}


def test_lookup_scans_no_target_file_and_shuffles_no_index(spark, scratch):
    target = scratch("plan")
    for lo in (0, 3000):
        PB.publish_indexed(spark.range(lo, lo + 5000).select(F.col("id").alias("k")), target, "k", buckets=8)
    batch = spark.range(7000, 9000).select(F.col("id").alias("k"))
    book = PB.KeyIndex(spark, f"{target}.keys", [batch.schema["k"]], 8)
    known = book.known(book.encode(batch, ["k"]))
    plan = final_plan(known).split("== Initial Plan ==")[0]
    assert known.count() == 1000
    assert "Bucketed: true" in plan and "SelectedBucketsCount: 8 out of 8" in plan
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan  # the batch's
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 1 and "key_index_" in scans[0]
    assert all("/segments/" in f for f in book.keys().inputFiles())  # nothing of the target


def test_a_publish_that_dies_before_its_commit_is_repeated_exactly(spark, scratch, monkeypatch):
    for step in ("add", "commit"):
        target = scratch(f"die-{step}")
        PB.publish_indexed(frame(spark, (1, "a")), target, "k", buckets=4)
        with monkeypatch.context() as m:
            m.setattr(PB.KeyIndex, step, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
            with pytest.raises(RuntimeError, match="killed"):
                PB.publish_indexed(frame(spark, (1, "x"), (2, "b"), (3, "c")), target, "k", buckets=4)
        assert published(spark, target) == [(1, "a")]  # nothing of it shows
        assert PB.publish_indexed(frame(spark, (1, "x"), (2, "b")), target, "k", buckets=4) == 1
        PB.publish_indexed(frame(spark, (3, "c2")), target, "k", buckets=4)
        assert published(spark, target) == [(1, "a"), (2, "b"), (3, "c2")]


def test_compaction_keeps_every_key(spark, scratch, monkeypatch):
    target = scratch("compact")
    for lo in range(0, 40, 10):
        PB.publish_indexed(spark.range(lo, lo + 15).select(F.col("id").cast("int").alias("k"), F.lit("v").alias("v")),
                           target, "k", buckets=4)
    book = PB.KeyIndex(spark, f"{target}.keys", [frame(spark).schema["k"]], 4)
    before = rows(book.keys())
    with monkeypatch.context() as m:  # one that dies before its log entry changes nothing
        m.setattr(PB, "_touch", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            book.compact()
    assert rows(book.keys()) == before
    assert book.compact() == 1 and rows(book.keys()) == before
    assert len(book.keys().inputFiles()) <= 4
    PB.publish_indexed(frame(spark, (0, "new"), (99, "n")), target, "k", buckets=4)
    assert book.compact() == 2
    assert len(published(spark, target)) == 46 and rows(book.keys())[-1][1] == 99
    with pytest.raises(ValueError, match="compacted"):
        book.keys(upto=1)


def test_wrong_buckets_and_key_types_are_refused(spark, scratch):
    target = scratch("refuse")
    PB.publish_indexed(frame(spark, (1, "a")), target, "k", buckets=4)
    with pytest.raises(ValueError, match="4 buckets, not 8"):
        PB.publish_indexed(frame(spark, (2, "a")), target, "k", buckets=8)
    nested = spark.createDataFrame([([1],)], "k array<int>")
    with pytest.raises(ValueError, match="array<int>"):
        PB.publish_indexed(nested, scratch("nested"), "k", buckets=4)


def test_several_and_typed_keys(spark, scratch):
    import datetime
    import decimal
    some = [(1, "a", datetime.date(2020, 1, 1), decimal.Decimal("1.10"), True), (1, None, None, None, None), (1, "", None, None, False)]
    df = spark.createDataFrame(some, "a long, b string, c date, d decimal(9,2), e boolean")
    target = scratch("typed")
    for _ in range(2):
        PB.publish_indexed(df, target, ["a", "b", "c", "d", "e"], buckets=4)
    assert PB.read_published(spark, target, df.schema).count() == 3


def _incoming(spark, root, *ranges):
    for lo, hi in ranges:
        spark.range(lo, hi).coalesce(1).write.mode("append").parquet(f"{root}/in")


def _run(spark, root, **more):
    stream = T.table_stream(spark, f"{root}/in", max_files_per_trigger=1)
    T.stream_publish_indexed(stream, f"{root}/target", "id", f"{root}/ck", buckets=4, **more).awaitTermination()


def _ids(spark, root):
    return sorted(r["id"] for r in PB.read_published(spark, f"{root}/target", spark.range(1).schema).collect())


@pytest.mark.parametrize("store", [T.ROCKSDB, None])
def test_stream_publishes_each_key_once_over_restarts(spark, scratch, store):
    root = scratch("stream")
    PB.publish_indexed(spark.range(5, 12), f"{root}/target", "id", buckets=4)  # before the stream's first start
    _incoming(spark, root, (0, 20), (10, 30))
    _run(spark, root, state_store=store)
    assert _ids(spark, root) == list(range(30))
    _incoming(spark, root, (25, 50), (0, 5))
    _run(spark, root, state_store=store)  # from the checkpoint
    assert _ids(spark, root) == list(range(50))


def test_replayed_micro_batch_is_skipped_or_overwritten(spark, scratch):
    root = scratch("replay")
    kw = dict(buckets=4, number=3, known_upto=-1, distinct_keys=True)
    args = (f"{root}/target", "id")
    assert PB.publish_indexed(spark.range(4), *args, writer="s1", **kw) == 3
    assert PB.publish_indexed(spark.range(9), *args, writer="s1", **kw) is None
    assert _ids(spark, root) == [0, 1, 2, 3]
    with pytest.raises(ValueError, match="committed by s1, not s2"):
        PB.publish_indexed(spark.range(9), *args, writer="s2", **kw)


def test_micro_batch_reads_no_earlier_publish_of_the_stream(spark, scratch, monkeypatch):
    root = scratch("reads")
    PB.publish_indexed(spark.range(3), f"{root}/target", "id", buckets=4)
    read = []
    keys = PB.KeyIndex.keys
    monkeypatch.setattr(PB.KeyIndex, "keys", lambda self, upto=None: read.append(upto) or keys(self, upto))
    _incoming(spark, root, (0, 5), (5, 9), (2, 12))
    _run(spark, root)
    assert _ids(spark, root) == list(range(12))
    assert len(read) >= 3 and set(read) == {0}  # only what was there before the stream
