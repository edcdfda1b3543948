"""Run by test_retries.py in its own process: a local session that retries
failed tasks (``local[4,4]``), with the first attempt of some tasks failing
on purpose. Prints one line per check; exits non-zero on a wrong result."""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import BooleanType  # noqa: E402

from quartermaster.operators import aggregates as A  # noqa: E402
from quartermaster.operators import closure as CL  # noqa: E402
from quartermaster.operators import joins as J  # noqa: E402
from quartermaster.session import BASE_CONF, ensure_checkpoint_dir, scratch_dir  # noqa: E402
from quartermaster.sinks.writers import publish_new  # noqa: E402


MARKERS = tempfile.mkdtemp(prefix="qm-retry-markers-")  # local mode: same file system


@F.udf(BooleanType())
def first_attempt_fails(x):
    """True for every row, but the first attempt of partitions 0 and 2
    raises, as if its executor had been lost."""
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() in (0, 2):
        marker = os.path.join(MARKERS, f"{ctx.stageId()}-{ctx.partitionId()}-{ctx.taskAttemptId()}")
        open(marker, "w").close()
        raise RuntimeError("injected task failure")
    return True


def flaky(df):
    return df.filter(first_attempt_fails(F.lit(1)))


def main() -> int:
    builder = SparkSession.builder.master("local[4,4]").appName("qm-retries")
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.config("spark.sql.shuffle.partitions", "4").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    ensure_checkpoint_dir(spark)
    ok = True

    base = spark.range(0, 40000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("seq"))
    got = A.ordinal(flaky(base), ["seq"], ["k"], num_partitions=8)
    want = base.withColumn("position", F.row_number().over(Window.partitionBy("k").orderBy("seq")))
    diff = got.select("k", "seq", "position").exceptAll(want.select("k", "seq", "position")).count()
    print("ordinal", got.count(), diff)
    ok &= diff == 0 and got.count() == 40000

    edges = spark.range(1, 3000, numPartitions=4).select(F.col("id").alias("node"),
                                                        F.expr("id div 2").alias("parent"))
    ref = CL.dependency_closure(edges)
    for strategy in ("doubling",):
        cl = CL.dependency_closure(flaky(edges))
        d = cl.exceptAll(ref).count() + ref.exceptAll(cl).count()
        print("closure", strategy, cl.count(), d)
        ok &= d == 0

    target = scratch_dir(spark, "retry-k7")
    batch = spark.range(0, 5000, numPartitions=4).select(F.col("id").alias("k"))
    publish_new(flaky(batch), target, "k")
    publish_new(flaky(spark.range(2500, 7500, numPartitions=4).select(F.col("id").alias("k"))), target, "k")
    back = spark.read.parquet(target)
    n, distinct = back.count(), back.distinct().count()
    print("publish_new", n, distinct)
    ok &= n == distinct == 7500

    req = spark.range(0, 30000, numPartitions=4).select(
        F.when(F.col("id") < 10000, F.lit(0)).otherwise(F.col("id")).alias("k"))
    have = spark.range(0, 30000, 2, numPartitions=4).select(F.col("id").alias("k"))
    missing = J.missing_work(req, flaky(have), "k").count()
    print("missing_work", missing)
    ok &= missing == 10000

    failures = len(os.listdir(MARKERS))
    print("injected_failures", failures)
    ok &= failures >= 8
    spark.stop()
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())
