"""Secret scans with a random forest against false positives (DataFrame
operations and Spark ML only, no Python in the tasks).

1. Candidates: every token of at least ``MIN_LENGTH`` characters of the
   alphabet keys are written in, and after a key word with an assignment or a
   quote the whole value of at least ``MIN_VALUE`` characters, whatever they
   are (up to a blank or the closing quote), with the text around it.
2. Features of a candidate: its length; its character transitions (changes
   between lower case, upper case, digits and marks, share of digits and of
   hexadecimal characters); dictionary coverage (share of its characters
   inside words of the dictionary, which are the most frequent short words
   of the whole corpus); the path it was found under; and the neighbouring
   words (key words, an assignment, quotes).
3. Labelled findings train the forest. Where none are given they come from
   the table: a finding with a known provider prefix or assigned to a key
   word is a secret; plain words and plain numbers, as well as identifiers
   that stand in running text, are not. At most about ``max_labelled`` of
   each label are used, chosen by a hash.
4. Every candidate of every document is scored.

Defined results: null and empty texts have no candidate; repeated rows are
each reported; very long texts cost in proportion to their length; with
fewer than two labels nothing can be learned and the score is the only
label's (0 without any); no token leaves the operator in clear, only its
SHA-256.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, lower_ascii

MIN_LENGTH = 12
MIN_VALUE = 6
CONTEXT = 40
DICTIONARY = 400
MAX_LABELLED = 20_000
THRESHOLD = 0.5
# Words that announce a secret, provider prefixes of keys.
KEY_WORDS = r"(?i)(passw(or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth)"
# A value after a key word (the first lookbehind is a cheap test), a key word
# glued to its value by ``=``, any other token.
_KEY = "(?i:%s)" % KEY_WORDS.removeprefix("(?i)")
_AFTER = r"(?<=%s[\"']?\s{0,4}(?:(?::=|=>|[=:])\s{0,4}[\"']?|[\"']))" % _KEY
TOKEN = "|".join([
    r"(?<=\")%s[^\s\"]{%d,}" % (_AFTER, MIN_VALUE),
    r"(?<=')%s[^\s']{%d,}" % (_AFTER, MIN_VALUE),
    r"(?<=[=:>]\s{0,4})%s[^\s\"'=>]\S{%d,}" % (_AFTER, MIN_VALUE - 1),
    r"(?<![A-Za-z0-9_+/=.~-])[A-Za-z0-9_+/.~-]{0,64}%s=[^\s\"'=>]\S{%d,}" % (_KEY, MIN_VALUE - 1),
    r"[A-Za-z0-9_+/=.~-]{%d,}" % MIN_LENGTH])
PROVIDERS = r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abpr]-|^sk_live_|^AIza[0-9A-Za-z_-]{35}$"
SAMPLE_PATHS = r"(?i)(test|example|sample|mock|fixture|doc)"
FEATURES = ["length", "transitions", "upper_digit", "lower_digit", "digits", "hexes", "marks", "coverage",
            "path_sample", "path_depth", "key_word", "assigned", "quoted", "words_before", "words_after"]


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               path: str | None = "source") -> DataFrame:
    """``(doc_id, path, start, token, before, after)``: every candidate with
    its character offset and up to ``CONTEXT`` characters on each side."""
    parts = docs.select(
        F.monotonically_increasing_id().alias("doc_row"), F.col(doc_id).alias("doc_id"),
        (F.col(path).cast("string") if path else F.lit("")).alias("path"),
        F.regexp_extract_all(F.col(text), F.lit(TOKEN), F.lit(0)).alias("tokens"),
        F.split(F.col(text), TOKEN, -1).alias("gaps")).where(F.size("tokens") > 0)
    # A candidate leaves with its context alone, never with its document.
    near = F.transform("tokens", lambda token, k: F.struct(
        token.alias("token"), F.right(F.get("gaps", k), F.lit(CONTEXT)).alias("before"),
        F.left(F.get("gaps", k + 1), F.lit(CONTEXT)).alias("after"), F.length(F.get("gaps", k)).alias("gap")))
    rows = parts.select("doc_row", "doc_id", "path", F.posexplode(near).alias("at", "x"))
    # Start of a token: the gaps and tokens up to it, itself left out.
    so_far = F.sum(F.col("x.gap").cast("long") + F.length("x.token")).over(
        Window.partitionBy("doc_row").orderBy("at"))
    return rows.select("doc_id", "path", (so_far - F.length("x.token")).alias("start"),
                       "x.token", "x.before", "x.after")


def dictionary(docs: DataFrame, text: str = "text", size: int = DICTIONARY) -> list[str]:
    """The most frequent words of 3 to 8 letters over all documents; ``size``
    bounds what is collected."""
    words = F.explode(F.regexp_extract_all(lower_ascii(F.col(text)), F.lit(r"(?<![0-9a-z])[a-z]{3,8}(?![0-9a-z])"),
                                           F.lit(0)))
    top = (docs.select(words.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), "word").limit(size))
    return [r["word"] for r in top.collect()]


def featurize(found: DataFrame, words: list[str]) -> DataFrame:
    """Adds the feature columns to candidates."""
    token, before = F.col("token"), F.coalesce(F.col("before"), F.lit(""))
    after, path = F.coalesce(F.col("after"), F.lit("")), F.coalesce(F.col("path"), F.lit(""))
    n = F.length(token).cast("double")

    def count(pattern: str, of: Column = token) -> Column:
        return F.regexp_count(of, F.lit(pattern)).cast("double")

    changes = (r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])")
    # Longer words first: a word is not cut by a shorter one inside it.
    known = "|".join(sorted(words, key=lambda w: (-len(w), w))) or r"(?!)"
    rest = F.regexp_replace(lower_ascii(token), known, "")
    return (found
            .withColumn("length", n)
            .withColumn("transitions", count(changes) / n)
            .withColumn("upper_digit", count(r"(?<=[A-Z])(?=[0-9])|(?<=[0-9])(?=[A-Z])") / n)
            .withColumn("lower_digit", count(r"(?<=[a-z])(?=[0-9])|(?<=[0-9])(?=[a-z])") / n)
            .withColumn("digits", count("[0-9]") / n)
            .withColumn("hexes", count("[0-9a-f]") / n)
            .withColumn("marks", count("[^A-Za-z0-9]") / n)
            .withColumn("coverage", (n - F.length(rest)) / n)
            .withColumn("path_sample", path.rlike(SAMPLE_PATHS).cast("double"))
            .withColumn("path_depth", count("/", path))
            .withColumn("key_word", before.rlike(KEY_WORDS + r"\W{0,4}$").cast("double"))
            .withColumn("assigned", before.rlike(r"[=:]\s*[\"']?$").cast("double"))
            .withColumn("quoted", (before.rlike(r"[\"']$") & after.rlike(r"^[\"']")).cast("double"))
            .withColumn("words_before", count(r"\w+", before))
            .withColumn("words_after", count(r"\w+", after)))


def label(found: DataFrame) -> DataFrame:
    """Adds ``label`` from the table's own evidence (null: none). A key word
    glued to the token by ``=`` (``password=...``) counts as assignment."""
    token = F.col("token")
    value = F.regexp_replace(token, r"^[A-Za-z_]+=", "")
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.length(value) >= MIN_VALUE)
    assigned = token.rlike(KEY_WORDS + r"=") | ((F.col("key_word") == 1) & (F.col("assigned") == 1))
    plain = token.rlike(r"^[A-Za-z]+[.]?$") | token.rlike(r"^[0-9. -]+$") | token.rlike(r"^[a-z.]+\.[a-z0-9.-]+$")
    return found.withColumn("label", F.when(token.rlike(PROVIDERS) | (assigned & mixed), 1.0).when(plain, 0.0))


def train(labelled: DataFrame, scratch: Scratch, max_labelled: int = MAX_LABELLED, trees: int = 20,
          depth: int = 6, seed: int = 42):
    """The forest, or the only label there is (0.0 without any)."""
    sizes = {r["label"]: r["n"] for r in labelled.where("label is not null").groupBy("label")
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return next(iter(sizes), 0.0)
    draw = F.pmod(F.xxhash64("token", "before", "after"), F.lit(1 << 20))
    limit = F.when(F.col("label") == 1, int((1 << 20) * min(1.0, max_labelled / sizes[1.0]))) \
             .otherwise(int((1 << 20) * min(1.0, max_labelled / sizes[0.0])))
    sample = scratch.table(labelled.where("label is not null").where(draw < limit)
                           .select("label", *FEATURES).repartition(4, *FEATURES)
                           .sortWithinPartitions("label", *FEATURES), "labelled")
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(rows)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = "source",
         findings: DataFrame | None = None, threshold: float = THRESHOLD, **params) -> DataFrame:
    """``(doc_id, start, length, token_sha256, score, is_secret)`` for every
    candidate. ``findings`` (columns ``token, before, after, path, label``)
    replaces the labels drawn from the table."""
    scratch = Scratch(docs.sparkSession, "secrets")
    words = dictionary(docs, text)
    found = scratch.table(featurize(candidates(docs, doc_id, text, path), words), "candidates")
    labelled = label(found) if findings is None else featurize(findings, words)
    model = train(labelled, scratch, **params)
    if isinstance(model, float):
        scored = found.withColumn("score", F.lit(model))
    else:
        ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
        scored = model.transform(ready).withColumn("score", vector_to_array("probability")[1])
    return scratch.result(scored.select(
        "doc_id", "start", F.col("length").cast("long").alias("length"),
        F.sha2("token", 256).alias("token_sha256"), F.round("score", 6).alias("score"),
        (F.col("score") >= threshold).alias("is_secret")))
