"""Quality rules with cross-document line frequency.

Every line is normalised (A-Z lower-cased, blanks collapsed) and hashed, and
the documents of a host that hold it are counted. A line is above the limits
of its host when it stands in more than ``max_docs`` of its documents, whatever
the size of the host, or (for small hosts) in ``few_docs`` documents at least
and in more than ``share`` of the host's. Such lines are taken out of the
texts (``kept_text``), and a document that loses more than ``depleted`` of its
words is rejected. The base rules (length, repetition) reject on their own;
they and the base counts judge the text as it came.

Scale: a first pass reads the texts and leaves a thin table of line hashes;
only that table is counted and joined. Line counts are partial per task. The
lines above the limits are joined back to the (document, line) pairs by host
and line: a hot line is many pairs on one side and one row on the other, which
AQE splits. Hosts are few against lines; their sizes are joined to the counted
lines, not to pairs. What goes from a text is one list per (host, text hash),
at most the lines of that text, so copies share it. A second pass over the
texts takes the lists by that key, counts, and removes the lines; for it the
texts are shuffled once, at every size alike. Neither they nor the result are
written.

Defined results: null and empty texts have no words and fail the base rule;
documents without a host form one host; every row counts as a document,
repeated rows included; lines without a word are ignored and stay; a null text
stays null, one whose lines all go is empty; an empty table gives no rows;
texts are read whole, however long; the caller's columns travel in ``row``, so
their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import Scratch, pack

MAX_DOCS = 5
SHARE, FEW_DOCS = 0.1, 3
DEPLETED = 0.5
MIN_WORDS = 50
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"

FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeat_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that is found at least twice."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1]
    _, back, times = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
    again = times[back] > 1
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[k:n - 2 + k] |= again
    return int(hit.sum())


def line_hash(line: bytes) -> int:
    """Signed hash of a normalised line."""
    h = xxhash.xxh64_intdigest(b" ".join(line.lower().split()))
    return h - (1 << 64) if h >> 63 else h


def describe(text: bytes) -> list[int]:
    """Base counts of one text."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    word_chars = sum(map(len, words))
    if not text.isascii():  # bytes to code points
        word_chars -= int((np.frombuffer(text, np.int8) < -64).sum())
    return [len(words), word_chars, len(text) - len(text.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words)]


def remove_lines(text: bytes, gone: set[int]) -> tuple[bytes, int]:
    """The text without the lines whose hash is in ``gone``, and the words
    that went with them."""
    kept, n_removed = [], 0
    for line in text.split(b"\n"):
        n = len(line.split())
        if n and line_hash(line) in gone:
            n_removed += n
        else:
            kept.append(line)
    return b"\n".join(kept), n_removed


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct line hashes of each text."""
    for batch in batches:
        lines = [list({line_hash(x) for x in (text or b"").split(b"\n") if x.strip()})
                 for text in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(lines, pa.list_(pa.int64()))],
                                         names=["host", "text_hash", "lines"])


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base counts, remaining text and number of removed words."""
    for batch in batches:
        counts, kept, removed = [], [], []
        for text, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            counts.append(describe(text or b""))
            rest, n = remove_lines(text, set(gone)) if gone else (text, 0)
            kept.append(rest)
            removed.append(n)
        table = np.array(counts, np.int64).reshape(-1, len(FIELDS))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(table[:, k]) for k in range(len(FIELDS))],
             pa.array(kept, pa.binary()), pa.array(removed, pa.int64())],
            names=["row", *FIELDS, "kept_text", "n_removed_words"])


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source", share: float = SHARE,
                  max_docs: int = MAX_DOCS, few_docs: int = FEW_DOCS, depleted: float = DEPLETED,
                  carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: ``row`` (the columns of ``carry``), the base
    counts, ``kept_text``, ``n_removed_words``, ``base_failed`` and ``kept``."""
    scratch = Scratch(docs.sparkSession, "quality")
    rows = docs.select(pack(docs.select(*carry)).alias("row"), F.col(host).cast("string").alias("host"),
                       F.col(text).cast("binary").alias("body"), F.xxhash64(F.col(text)).alias("text_hash"))
    thin = scratch.table(rows.select("host", "text_hash", "body").mapInArrow(
        _lines, "host string, text_hash long, lines array<long>"), "thin")
    pairs = thin.select("host", "text_hash", F.explode("lines").alias("line"))
    per_line = (pairs.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
                .where(F.col("n") >= min(few_docs, max_docs + 1)))
    totals = thin.groupBy(F.col("host").alias("total_host")).agg(F.count(F.lit(1)).alias("n_docs"))
    above = (per_line.join(totals, F.col("host").eqNullSafe(F.col("total_host")))
             .where((F.col("n") > max_docs) | ((F.col("n") >= few_docs) & (
                 F.col("n").cast("double") > F.lit(float(share)) * F.col("n_docs"))))
             .select(F.col("host").alias("above_host"), F.col("line").alias("above_line")))
    above = scratch.table(above, "above")
    gone = scratch.result(
        pairs.join(above, (F.col("line") == F.col("above_line")) & F.col("host").eqNullSafe(F.col("above_host")))
        .groupBy(F.col("host").alias("gone_host"), F.col("text_hash").alias("gone_hash"))
        .agg(F.collect_set("line").alias("gone")))
    joined = rows.join(gone.hint("merge"), F.col("host").eqNullSafe(F.col("gone_host"))
                       & (F.col("text_hash") == F.col("gone_hash")), "left")
    schema = StructType([rows.schema["row"], *[StructField(c, LongType()) for c in FIELDS],
                         StructField("kept_text", BinaryType()), StructField("n_removed_words", LongType())])
    out = joined.select("row", "body", "gone").mapInArrow(_judge, schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depletes = F.col("n_removed_words").cast("double") > F.lit(float(depleted)) * F.col("n_words")
    return out.select("row", *FIELDS, F.col("kept_text").cast("string").alias("kept_text"), "n_removed_words",
                      failed.alias("base_failed"), (~failed & ~depletes).alias("kept"))
