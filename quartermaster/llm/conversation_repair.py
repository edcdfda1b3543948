"""Conversation structure repair by a scalar shortest path.

A conversation's rows, by turn, are edited at least cost until their role
initials read ``(s?(ua)+)?``: Keep (0), Rerole to user or assistant (3), Delete
(4; required for a blank or repeated row), Insert an empty user or assistant
row (3). A truncated row that stays costs 3 more. Of the cheapest edits, the
audit (initials of the edits in order) that is least by ASCII wins.

One integer per path decides both: the high digits are the cost, the low ones
a fixed number of 3-bit digits with the audit's letters from the left, D=1 I=2
K=3 R=4, and zeros behind its end, so a smaller integer is a cheaper path or
an equally cheap one of lesser audit. From the last row to the first, a DAG of
four states (nothing yet, after s, after u, after a) takes the integer
minimum; putting a letter in front moves the low digits one place down. The
audit is read off the result's digits, and it fixes every role.

Two passes over rows that Spark deals by conversation and sorts by turn:

1. counts faults and finds the audit. A task holds one byte a row, a 16-byte
   digest per distinct (role, text) of the conversation at hand, and the path
   integers;
2. the audit comes in front of its rows, which are edited as they stream by.

Texts are never held, however many rows a conversation has. A conversation's
audit is one value and its digest one running hash, so each is made in one
task; the integers have 3 bits a letter, so time grows with the square of the
rows of one conversation (README has figures).

Defined results: a null role or text is one space; rows of equal turn (null
turns first) go by role, then text, by code point; a null conversation id is a
conversation; an empty role has no initial and can't be kept; a repeated row
is a duplicate; an empty table gives no rows; a conversation without rows gives
zeros, an empty audit and the hash of the empty string; texts are read whole;
extra columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import ASCII_SPACE, Scratch

RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
# Costs of the edits and the extra cost of a truncated row that stays (fixed values).
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
D, I, K, R = 1, 2, 3, 4
LETTERS = str.maketrans("1234", "DIKR")
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The state after an inserted or reroled row: a user's turn, or an assistant's after a user.
TURN = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
KEEP = {"s": {START: AFTER_S}, "u": {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, "a": {AFTER_U: AFTER_A}}
KEPT = (KEEP["s"], KEEP["u"], KEEP["a"], {})
LEGAL = ("su", "ua", "au")
FINE, GOES, CUT = range(3)  # what a row's fault means: nothing, it must go, it costs if it stays


# ------------------------------------------------------------ one conversation

def cheapest(rows: bytes | bytearray) -> tuple[int, str]:
    """Cost and audit of the best repair. A row is ``4 * fault + initial``
    (fault FINE, GOES or CUT; initial 0 s, 1 u, 2 a, 3 any other)."""
    # Deleting everything costs 4 a row, so no best path inserts more than 4/3 a row (and 2 to end).
    width = 3 * (len(rows) + (DELETE * len(rows) + 2 * INSERT) // INSERT + 2)
    mask, one = (1 << width) - 1, 1 << width
    none = one << 64

    def put(letter: int, cost: int, path: int) -> int:
        return (path & ~mask) + cost * one + (letter << width - 3) + ((path & mask) >> 3)

    def inserts(path: list[int]) -> list[int]:
        """Up to two rows put in; more only repeat a state."""
        once = [min(path[s], put(I, INSERT, path[TURN[s]])) for s in range(4)]
        return [min(path[s], put(I, INSERT, once[TURN[s]])) for s in range(4)]

    path = inserts([0, none, none, 0])
    for row in reversed(rows):
        fault, kept = row >> 2, KEPT[row & 3]
        extra = TRUNCATED if fault == CUT else 0
        now = [put(D, DELETE, path[s]) for s in range(4)]
        if fault != GOES:
            for s in range(4):
                now[s] = min(now[s], put(R, REROLE + extra, path[TURN[s]]))
                if s in kept:
                    now[s] = min(now[s], put(K, extra, path[kept[s]]))
        path = inserts(now)
    cost, low = path[START] >> width, path[START] & mask
    return cost, f"{low:0{width // 3}o}".rstrip("0").translate(LETTERS)


def apply(audit: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str | None, str | None]]:
    """(edit, role, text) of each edit of ``audit``; a deleted row has neither."""
    state, rows = START, iter(rows)
    for edit in audit:
        if edit == "I":
            role, text = None, ""
        else:
            role, text = next(rows)
        if edit == "D":
            yield edit, None, None
            continue
        state = KEEP[role[0]][state] if edit == "K" else TURN[state]
        yield edit, role if edit == "K" else "user" if state == AFTER_U else "assistant", text


# ------------------------------------------------------------ passes

class _Audit:
    """Faults and shape of the conversation at hand."""

    def __init__(self) -> None:
        self.rows, self.seen = bytearray(), set()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.before = None

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]
        end = text.rstrip(ASCII_SPACE)[-1:]
        digest = xxhash.xxh3_128_digest(f"{len(role)}:{role}{text}")
        fault = FINE
        if not end:
            self.blank, fault = self.blank + 1, GOES
        elif digest in self.seen:
            self.duplicate, fault = self.duplicate + 1, GOES
        elif end not in ".!?":
            self.truncated, fault = self.truncated + 1, CUT
        self.seen.add(digest)
        self.rows.append(4 * fault + {"s": 0, "u": 1, "a": 2}.get(role[:1], 3))

    def result(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        cost, audit = cheapest(self.rows)
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _audits(schema: pa.Schema) -> Callable:
    """(conv, counts..., audit) of sorted rows (conv, gone, turn, role, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, started = None, None, False

        def out(found: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*found)) or [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        for batch in batches:
            found = []
            for key, gone, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if not started or key != conv:
                    if started:
                        found.append((conv, *state.result()))
                    conv, state, started = key, _Audit(), True
                if not gone:
                    state.add(turn, role, text)
            yield out(found)
        yield out([(conv, *state.result())] if started else [])

    return run


def _edited(schema: pa.Schema, digest: bool) -> Callable:
    """Sorted (conv, counts..., audit, turn, role, text), where the row with an
    audit comes first, to the edits of each conversation or their digest."""
    n = 2 + len(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, edits, sha, first, position = None, None, None, True, 0
        pending: list[tuple[str, str]] = []

        def rows() -> Iterator[tuple[str, str]]:
            while True:
                yield pending.pop()

        def take(out: list, until_row: bool) -> None:
            """Runs the edits up to the one that uses the row at hand."""
            nonlocal first, position
            for edit, role, text in edits:
                if edit != "D":
                    if digest:
                        sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    else:
                        out.append((head[0], position, edit, role, text))
                    first, position = False, position + 1
                if until_row and edit != "I":
                    return

        def close(out: list) -> None:
            if head is not None:
                take(out, False)
                if digest:
                    out.append((*head, sha.hexdigest()))

        def batch_of(out: list) -> pa.RecordBatch:
            cols = list(zip(*out)) or [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        for batch in batches:
            out: list = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[n - 1] is not None:
                    close(out)
                    head, first, position, sha = row[:n], True, 0, hashlib.sha256()
                    edits = apply(head[-1], rows())
                else:
                    pending.append((row[-2], row[-1]))
                    take(out, True)
            yield batch_of(out)
        out = []
        close(out)
        yield batch_of(out)

    return run


def _schema(conv: StructField, *more: tuple) -> tuple[StructType, pa.Schema]:
    spark = StructType([StructField("conv_id", conv.dataType), *[StructField(n, t) for n, t in more]])
    return spark, to_arrow_schema(spark)


def _passes(df: DataFrame, conv: str, turn: str, role: str, text: str, gone: Column | None, digest: bool) -> DataFrame:
    kind = df.select(F.col(conv)).schema[0]
    counts = [(c, LongType()) for c in RESULT] + [("audit", StringType())]
    space = F.lit(" ")
    rows = df.select(F.col(conv).alias("conv_id"), (F.lit(False) if gone is None else gone).alias("gone"),
                     F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), space).alias("role"),
                     F.coalesce(F.col(text).cast("string"), space).alias("text"))
    order = [F.asc_nulls_first("turn"), "role", "text"]
    scratch = Scratch(df.sparkSession, "conversations")
    spark_schema, arrow = _schema(kind, *counts)
    audits = scratch.table(rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)
                           .mapInArrow(_audits(arrow), spark_schema), "audits")
    none = [F.lit(None).cast(t).alias(c) for c, t in counts]
    both = audits.select("*", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text")) \
        .unionByName(rows.where(~F.col("gone")).select("conv_id", *none, "turn", "role", "text"))
    more = [*counts, ("repaired_sha256", StringType())] if digest else [
        ("position", LongType()), ("edit", StringType()), ("role", StringType()), ("text", StringType())]
    spark_schema, arrow = _schema(kind, *more)
    return scratch.result(both.repartition("conv_id")
                          .sortWithinPartitions("conv_id", F.desc_nulls_last("audit"), *order)
                          .mapInArrow(_edited(arrow, digest), spark_schema))


# ------------------------------------------------------------ operator

def report(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           gone: Column | None = None) -> DataFrame:
    """One row per conversation: ``gaps``, numbers of rows by first fault,
    ``illegal`` neighbours, ``cost``, ``audit`` and ``repaired_sha256`` (of the
    repaired ``role:text`` lines). Rows where ``gone`` holds count for nothing
    but keep their conversation in the result."""
    return _passes(df, conv, turn, role, text, gone, True)


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           gone: Column | None = None) -> DataFrame:
    """The repaired conversations: ``(conv_id, position, edit, role, text)``."""
    return _passes(df, conv, turn, role, text, gone, False)


def damage(df: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, gone)``: rows damaged by the hash of
    ``conv_id:turn`` mod 20 (0 gone, 1 emptied, 2 without ``.!?``, 3 repeated, 4
    role user). Nulls in the hash, the role and the text are one space."""
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn")).cast("binary")) % 20
    return (df.select("conv_id", "turn", as_text("role").alias("role"), as_text("text").alias("text"), draw.alias("draw"))
            .select("conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"), (F.col("draw") == 0).alias("gone"),
                    F.explode(F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .drop("col"))
