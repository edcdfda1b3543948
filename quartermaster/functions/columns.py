"""Column expressions: names, versions, paths, digests, flags.

Every function returns a ``Column`` built from Spark built-ins, so it runs
inside whole-stage codegen with no Python on the executors. DataFrame-level
wrappers add the columns under stable names.
"""

from __future__ import annotations

import re
import string
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- P1 version

def version_text(major: ColumnOrName, minor: ColumnOrName, patch: ColumnOrName) -> Column:
    """``major.minor``, plus ``.patch`` only when patch is present and not 0.

    ``concat_ws`` skips nulls, so an absent or zero patch simply drops out.
    """
    p = _c(patch)
    return F.concat_ws(".", _c(major).cast("string"), _c(minor).cast("string"),
                       F.when(p != 0, p.cast("string")))


def compose_version(df: DataFrame, major="major", minor="minor", patch="patch",
                    status="status", mono: ColumnOrName | None = None) -> DataFrame:
    """Add ``version``, ``version_dash`` (v-status) and ``version_dot``
    (v.status), the latter with a ``.mono`` suffix where ``mono`` is true."""
    v = version_text(major, minor, patch)
    dot = F.concat_ws(".", v, _c(status))
    if mono is not None:
        dot = F.when(_c(mono), F.concat(dot, F.lit(".mono"))).otherwise(dot)
    return (df.withColumn("version", v)
              .withColumn("version_dash", F.concat_ws("-", v, _c(status)))
              .withColumn("version_dot", dot))


# ---------------------------------------------------------------- P2 / S3 split

def field(col: ColumnOrName, sep: str, n: int) -> Column:
    """Field ``n`` (1-based, negative from the end) of a delimited text.

    ``split_part`` gives the empty string when the field is missing, so a
    short row never fails under ANSI mode (``split(...)[i]`` would).
    """
    return F.split_part(_c(col), F.lit(sep), F.lit(n))


def split_ref(df: DataFrame, col: str, name="name", tag="tag", sep=":") -> DataFrame:
    """``repository:tag`` into two columns; a third field is ignored."""
    return df.withColumn(name, field(col, sep, 1)).withColumn(tag, field(col, sep, 2))


# ---------------------------------------------------------------- P4 paths

def base_name(path: ColumnOrName) -> Column:
    """Text after the last ``/`` (the whole text when there is none)."""
    return F.substring_index(_c(path), "/", -1)


def dir_name(path: ColumnOrName) -> Column:
    """Text before the last ``/``; empty when there is no ``/``."""
    p = _c(path)
    return F.when(F.instr(p, "/") > 0,
                  F.regexp_replace(p, r"/[^/]*$", "")).otherwise(F.lit(""))


def drop_suffix(text: ColumnOrName, suffix: str) -> Column:
    """Remove ``suffix`` only where the text ends with it."""
    t = _c(text)
    return F.when(t.endswith(suffix),
                  F.substring(t, F.lit(1), F.length(t) - F.lit(len(suffix)))).otherwise(t)


def drop_first_segment(path: ColumnOrName, sep: str = "/") -> Column:
    """Everything after the first separator; empty when there is none."""
    p = _c(path)
    return F.when(F.instr(p, sep) > 0,
                  F.substring(p, F.instr(p, sep) + F.lit(len(sep)), F.length(p)))\
            .otherwise(F.lit(""))


def path_parts(df: DataFrame, col: str, suffix: str | None = None) -> DataFrame:
    """Base name, directory, base name without suffix, tail after the
    first segment."""
    b = base_name(col)
    out = (df.withColumn("base_name", b)
             .withColumn("dir_name", dir_name(col))
             .withColumn("tail", drop_first_segment(col)))
    if suffix is not None:
        out = out.withColumn("stem", drop_suffix(b, suffix))
    return out


# ---------------------------------------------------------------- P3 packages

def parse_package(df: DataFrame, col: str, suffix: str = ".nupkg") -> DataFrame:
    """Package name and version from a package file path.

    The rules, kept as stated: the stem is the base name without the suffix;
    ``name`` is the stem cut at the first dot followed by a digit;
    ``version_raw`` runs from the first digit of the stem to its end (so a
    digit inside the name starts it early); ``version`` is the part of the
    stem after ``name.``.
    """
    stem = drop_suffix(base_name(col), suffix)
    name = F.regexp_replace(stem, r"\.[0-9].*$", "")
    return (df.withColumn("name", name)
              .withColumn("version_raw", F.regexp_extract(stem, r"[0-9].*$", 0))
              .withColumn("version", F.when(F.length(stem) > F.length(name),
                                            F.substring(stem, F.length(name) + 2, F.length(stem)))
                                      .otherwise(F.lit(""))))


# ---------------------------------------------------------------- P5 templates

def compose_name(template: str, **parts: ColumnOrName) -> Column:
    """P5: fill ``{field}`` placeholders of a template with columns.

    The template is data (``"game.{platform}.{target}{arch}"``), so the
    Windows/Linux dot difference lives in the template, not in code. Built
    with ``concat``: a null part gives a null name.
    """
    pieces: list[Column] = []
    for literal, fname, _, _ in string.Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if fname is not None:
            if fname not in parts:
                raise KeyError(f"template field {fname!r} has no column")
            pieces.append(_c(parts[fname]).cast("string"))
    return F.concat(*pieces) if pieces else F.lit("")


# ---------------------------------------------------------------- P6 defaults

def default_if_empty(col: ColumnOrName, default) -> Column:
    """The default when the value is null *or* empty (``coalesce`` alone
    would keep the empty string)."""
    d = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(_c(col), F.lit("")), d)


# ---------------------------------------------------------------- P7 first match

def replace_first(col: ColumnOrName, pattern: str, replacement: str, literal: bool = False) -> Column:
    """Replace only the first regex match on each line of a text.

    ``regexp_replace`` replaces every match, so the match is anchored to the
    start of the line behind a lazy prefix, which is put back. A pattern that
    can match nothing matches at the start of the line, like sed. The
    replacement is literal; ``literal=True`` makes the pattern literal too
    (``\\Q...\\E``), so the dots of a path are not wildcards. A numbered back
    reference inside the pattern counts the prefix as group 1.
    """
    c = _c(col)
    if literal:
        pattern = "\\Q" + pattern.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    put = replacement.replace("\\", "\\\\").replace("$", "\\$")
    return F.array_join(F.transform(F.split(c, "\n", -1), lambda line: F.regexp_replace(
        line, F.lit(f"(?s)\\A(.*?)(?:{pattern})"), F.lit("$1" + put))), "\n")


# ---------------------------------------------------------------- P8 flags

def flags_from_type(df: DataFrame, col: str, names: Sequence[str], all_value: str = "all",
                    prefix: str = "build_") -> DataFrame:
    """One 0/1 flag per name; ``all_value`` sets every flag; any other
    value sets none (use ``split_valid`` first to reject unknown values)."""
    c = F.col(col)
    for n in names:
        df = df.withColumn(f"{prefix}{n.lower()}",
                           F.when((c == n) | (c == all_value), 1).otherwise(0))
    return df


# ---------------------------------------------------------------- H1 digests

def digest(content: ColumnOrName, bits: int = 512) -> Column:
    """Hex SHA-2 digest (224/256/384/512) of a string or binary column."""
    return F.sha2(_c(content), bits)


def digest_manifest(df: DataFrame, name_col: str, content_col: str, bits: int = 512,
                    name_glob: str | None = None) -> DataFrame:
    """H1: ``(digest, name)`` per member, optionally only names matching a
    glob such as ``[Gg]*``. As in the shell, the glob is matched against the
    whole relative name and ``*`` does not cross ``/`` (so ``mono/G...`` is
    not a top-level match). The filter runs before the hash, so excluded
    members are never hashed."""
    if name_glob is not None:
        df = df.filter(F.col(name_col).cast("string").rlike(glob_to_regex(name_glob)))
    return df.select(digest(content_col, bits).alias("digest"),
                     F.col(name_col).cast("string").alias("name"))


# ---------------------------------------------------------------- globs

def glob_to_regex(glob: str) -> str:
    """Translate a shell glob (``*``, ``?``, ``[...]``, ``[!...]``) to an
    anchored Java regex matching one path component."""
    out, i = ["^"], 0
    while i < len(glob):
        ch = glob[i]
        if ch == "*":
            out.append("[^/]*")
        elif ch == "?":
            out.append("[^/]")
        elif ch == "[":
            j = glob.find("]", i + 2 if i + 1 < len(glob) and glob[i + 1] in "!^" else i + 1)
            if j == -1:
                out.append(re.escape(ch))
            else:
                body = glob[i + 1:j]
                if body[:1] in ("!", "^"):
                    body = "^" + body[1:]
                out.append("[" + body.replace("\\", "\\\\") + "]")
                i = j
        else:
            out.append(re.escape(ch))
        i += 1
    out.append("$")
    return "".join(out)


def map_column(mapping: Mapping[str, str], key: ColumnOrName) -> Column:
    """Look a column up in a small literal map (``create_map``); null when
    the key is absent. For data-sized maps use ``joins.map_lookup``."""
    kv: list[Column] = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*kv), _c(key))
