"""Corpus pipeline: five stages over ``documents``.

Language ID, line dedup, SimHash near-dedup, benchmark decontamination,
mixing to target weights. Each stage is written as Parquet and read back as
the next one's input; all but the last return the columns of ``documents``.
SQL can't express the model, the fingerprints or the random rounding, so
``ORACLE_SQL`` is None and ``tests/llm`` holds each stage against a
brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.llm import decontaminate, lang_id, line_dedup, mixing, simhash
from quartermaster.session import scratch_dir, table

#: A document goes if no language has at least this probability.
MIN_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter, a text or a likely language."""
    found = lang_id.identify(docs)
    sure = (F.col("lang_pred") != lang_id.UNKNOWN) & (F.col("score") >= MIN_SCORE)
    return found.where(sure).select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the boilerplate lines of each source; every document stays.
    ``n_chars`` follows the new text."""
    out = line_dedup.line_dedup(docs)
    new = {"text": F.col("kept_text"),
           "n_chars": F.when(F.col("n_dropped") > 0, F.length("kept_text").cast("long"))
           .otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*[(new[c] if new.get(c) is not None else F.col(f"row.`{c}`")).alias(c)
                        for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each near-duplicate component."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the benchmark contaminates."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents taken at least once, with the number of copies. A
    column of the mix whose name the documents have already is called
    ``mix_<name>``."""
    taken = {c.lower() for c in docs.columns}
    names = {}
    for c in ("size", "source_size", "target", "copies", "taken"):
        names[c] = c
        while names[c].lower() in taken:
            names[c] = f"mix_{names[c]}"
    return (mixing.mix(docs).where("copies > 0")
            .select("row.*", *[F.col(c).alias(n) for c, n in names.items()]))


STAGES = [
    ("language ID", language_id),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate_benchmark),
    ("mixing sources to target weights", mix_sources),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_dir(spark, f"pipeline-{k}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
