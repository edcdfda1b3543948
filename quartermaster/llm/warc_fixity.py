"""Merkle fixity audit of WARC records held in two replicas.

Every record is hashed. A leaf covers one fixed range of byte offsets of an
archive and digests its records in offset order; ``FAN_OUT`` neighbouring
nodes make the node above, up to one root per archive. Two replicas are
compared root by root, and only below nodes that differ is the next level
looked at, down to the records of the leaves that differ.

Scale: a leaf holds records that start in one range of ``leaf_bytes``; a
record has a header, so their number is bounded by the range (equal records
at one offset are counted first, not collected). A node collects ``FAN_OUT``
digests. The hot archive of a third of all records is therefore spread over
all its ranges; offsets are prefix sums over sorted ranges of the records'
lengths and digests, which cut it as well. Each level is written; levels shrink by the fan-out, and a
descent joins the few differing nodes to one level at a time.

Defined results: a null payload is an empty payload, a null record header
field is empty; records repeated at one offset must be repeated in the
replica as well; an archive that one replica lacks is reported record by
record; equal replicas give no row; unequal records at one offset are compared
as they are paired by id; an empty table gives no rows; payloads of any length
are hashed whole; extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import prefix_sum
from .common import Scratch

LEAF_BYTES = 1 << 16
FAN_OUT = 16
PAGES_PER_ARCHIVE = 1000


def warc_record(record_id: Column, url: Column, payload: Column) -> Column:
    """A WARC/1.1 response record as bytes."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    body = text(payload)
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), text(record_id),
                    F.lit(">\r\nWARC-Target-URI: "), text(url), F.lit("\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n")).cast("binary")


def archive_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html",
                    per_archive: int = PAGES_PER_ARCHIVE) -> DataFrame:
    """``(archive, offset, page_id, record)``: pages as records of archives
    of ``per_archive`` consecutive ids, laid out in id order."""
    scratch = Scratch(pages.sparkSession, "archives")
    # Written once, with a number for every record: only lengths and digests are sorted and added up.
    rows = scratch.result(pages.select(
        F.expr(f"`{page_id}` div {per_archive}").alias("archive"), F.col(page_id).alias("page_id"),
        warc_record(F.col(page_id), F.col(url), F.col(payload)).alias("record"))
        .withColumn("rid", F.monotonically_increasing_id()))
    # Repeated pages of one id lie one behind the other, unequal ones by their
    # digest, equal records in any order.
    thin = rows.select("archive", "page_id", F.sha2("record", 256).alias("sha"),
                       F.octet_length("record").cast("long").alias("length"), "rid")
    placed = prefix_sum(thin, ["page_id", "sha", "rid"], ["archive"], "length").select(F.col("rid").alias("of"), "offset")
    return rows.join(placed, F.col("rid") == F.col("of")).select("archive", "offset", "page_id", "record")


def digests(records: DataFrame, leaf_bytes: int = LEAF_BYTES) -> DataFrame:
    """``(archive, node, offset, record_id, sha, n_bytes, times)``: records
    hashed; ``node`` is the leaf an offset belongs to."""
    return (records.select("archive", F.expr(f"offset div {leaf_bytes}").alias("node"), "offset",
                           F.col("page_id").alias("record_id"), F.sha2("record", 256).alias("sha"),
                           F.octet_length("record").cast("long").alias("n_bytes"))
            .groupBy("archive", "node", "offset", "record_id", "sha", "n_bytes")
            .agg(F.count(F.lit(1)).alias("times")))


def _digest(*order: str) -> Column:
    """SHA-256 over the group's rows in order."""
    line = F.concat_ws(":", *order)
    rows = F.array_sort(F.collect_list(F.struct(*order[:-1], line.alias("line"))))
    return F.sha2(F.concat_ws("\n", F.transform(rows, lambda r: r["line"])), 256).alias("sha")


def build_tree(records: DataFrame, scratch: Scratch, name: str, leaf_bytes: int = LEAF_BYTES,
               fan_out: int = FAN_OUT) -> list[DataFrame]:
    """Levels of the tree, records first, then leaves, up to the roots."""
    levels = [scratch.table(digests(records, leaf_bytes), f"{name}-records")]
    leaves = levels[0].groupBy("archive", "node").agg(_digest("offset", "sha", "n_bytes", "times"))
    levels.append(scratch.table(leaves, f"{name}-1"))
    top = levels[-1].agg(F.max("node")).first()[0] or 0
    while top > 0:
        up = (levels[-1].withColumn("up", F.expr(f"node div {fan_out}")).groupBy("archive", "up")
              .agg(_digest("node", "sha")).select("archive", F.col("up").alias("node"), "sha"))
        levels.append(scratch.table(up, f"{name}-{len(levels)}"))
        top //= fan_out
    return levels


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes that one replica lacks or that differ."""
    left = a.select(F.col("archive").alias("a_archive"), F.col("node").alias("a_node"), F.col("sha").alias("a_sha"))
    right = b.select(F.col("archive").alias("b_archive"), F.col("node").alias("b_node"), F.col("sha").alias("b_sha"))
    same = F.col("a_archive").eqNullSafe(F.col("b_archive")) & (F.col("a_node") == F.col("b_node"))
    return (left.join(right, same, "full").where(~F.col("a_sha").eqNullSafe(F.col("b_sha")))
            .select(F.when(F.col("a_sha").isNull(), F.col("b_archive")).otherwise(F.col("a_archive")).alias("bad_archive"),
                    F.coalesce("a_node", "b_node").alias("bad_node")))


def _below(level: DataFrame, bad: DataFrame, node: Column) -> DataFrame:
    return level.join(bad, level["archive"].eqNullSafe(F.col("bad_archive")) & (node == F.col("bad_node")), "left_semi")


def audit(replica_a: DataFrame, replica_b: DataFrame, leaf_bytes: int = LEAF_BYTES,
          fan_out: int = FAN_OUT) -> DataFrame:
    """``(archive, leaf, offset, record_id, status, sha_a, sha_b)``: the
    records that differ between replicas of ``(archive, offset, page_id,
    record)``; ``status`` is ``changed``, ``missing`` (only in a) or ``extra``
    (only in b)."""
    scratch = Scratch(replica_a.sparkSession, "fixity")
    a = build_tree(replica_a, scratch, "a", leaf_bytes, fan_out)
    b = build_tree(replica_b, scratch, "b", leaf_bytes, fan_out)
    depth = max(len(a), len(b))
    for tree, name in ((a, "a"), (b, "b")):  # equal depth: repeat the roots
        while len(tree) < depth:
            tree.append(scratch.table(tree[-1].groupBy("archive", F.expr(f"node div {fan_out}").alias("node"))
                                      .agg(_digest("node", "sha")), f"{name}-{len(tree)}"))
    bad = scratch.table(_differing(a[-1], b[-1]), f"bad-{depth - 1}")
    for k in range(depth - 2, 0, -1):
        up = F.expr(f"node div {fan_out}")
        bad = scratch.table(_differing(_below(a[k], bad, up), _below(b[k], bad, up)), f"bad-{k}")
    side = lambda t, s: _below(t[0], bad, F.col("node")).select(
        *[F.col(c).alias(f"{s}_{c}") for c in t[0].columns])
    left, right = side(a, "a"), side(b, "b")
    same = (F.col("a_archive").eqNullSafe(F.col("b_archive")) & (F.col("a_offset") == F.col("b_offset"))
            & F.col("a_record_id").eqNullSafe(F.col("b_record_id")))
    both = left.join(right, same, "full").where(
        ~(F.col("a_sha").eqNullSafe(F.col("b_sha")) & F.col("a_times").eqNullSafe(F.col("b_times"))))
    pick = lambda c: F.when(F.col("a_sha").isNull(), F.col(f"b_{c}")).otherwise(F.col(f"a_{c}")).alias(c)
    return scratch.result(both.select(
        pick("archive"), pick("node").alias("leaf"), pick("offset"), pick("record_id"),
        F.when(F.col("b_sha").isNull(), "missing").when(F.col("a_sha").isNull(), "extra")
        .otherwise("changed").alias("status"), F.col("a_sha").alias("sha_a"), F.col("b_sha").alias("sha_b")))


def aged_replica(records: DataFrame) -> DataFrame:
    """A second replica for the registered query, derived from the first by
    a hash of the record: about 1 in 97 has a damaged byte, 1 in 89 is lost,
    1 in 83 is there twice, at its offset and behind all others."""
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit("aged"), F.col("page_id").cast("string"))
                                    .cast("binary")), 1, 8), 16, 10).cast("long")
    damaged = F.concat(F.substring("record", 1, 4).cast("binary"), F.lit("#").cast("binary"),
                       F.expr("substring(record, 6)").cast("binary"))
    kept = (records.where(F.pmod(draw, F.lit(89)) != 0)
            .withColumn("record", F.when(F.pmod(draw, F.lit(97)) == 0, damaged).otherwise(F.col("record"))))
    twice = (records.where((F.pmod(draw, F.lit(83)) == 0) & (F.pmod(draw, F.lit(89)) != 0))
             .withColumn("offset", F.col("offset") + F.lit(1 << 40)))
    return kept.unionByName(twice)
