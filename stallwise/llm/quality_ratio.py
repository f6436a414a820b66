"""Quality rules and a hashed n-gram log-likelihood ratio, in built-in functions only.

The method compares two multinomials over ``buckets`` hashed words and word pairs: one
of trusted documents, one of the whole corpus. The score of a document is the mean
over its words and pairs of log(p(trusted) / p(corpus)): the ratio of likelihoods,
normalised by length. Every document is judged by one threshold: ``spread`` standard
deviations below the mean score of trusted documents held out from the counts. No
sampling: the same tables give the same verdicts.

Scale: the corpus is counted in one pass that combines per task, so that at most
``buckets`` rows a task are shuffled. To know which texts are trusted, that pass joins
documents with labels by id, which moves each text once. Scoring looks weights up in
one array of ``buckets`` numbers; a text is one row throughout, whatever its length,
and windows are compared within it. What is written for the threshold has no texts.

Windows are compared by 64-bit hashes, built by doubling from hashes of words; equal
hashes are confirmed word by word. A text whose window hashes all differ has no
repeated window for certain.

Defined results: null and empty texts have no words, no score and fail the base rules;
a document is trusted if a label says quality 1 and none says toxic; null ids have no
label; repeated rows are judged alike, each as a row; without trusted documents, or
with none held out, every score passes; a score equal to the threshold passes; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.sources.staging import stage

BUCKETS = 1 << 14
# Pseudo-count of every bucket in both multinomials.
SMOOTHING = 1.0
# One trusted document in so many is held out for the threshold.
HELD_OUT = 5
# Standard deviations below the mean of held-out scores.
SPREAD = 6.0

BLANK = r"[\x20\x09-\x0D]+"
WORD_CHARACTER = r"[^\x20\x09-\x0D]"
SYMBOL = "[#*$%&|<>]"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK), "")


def _joined(digests: str, step: int) -> Column:
    """Digests of each element with the one ``step`` places on."""
    ahead = F.slice(digests, step + 1, F.size(digests))
    pairs = F.zip_with(digests, ahead, lambda a, b: F.xxhash64(a, b))
    return F.slice(pairs, 1, F.greatest(F.size(digests) - step, F.lit(0)))


def with_grams(rows: DataFrame) -> DataFrame:
    """Adds ``h1`` and ``h2``: hashes of ``words`` and of pairs of neighbours."""
    return rows.withColumn("h1", F.transform("words", lambda w: F.xxhash64(w))).withColumn("h2", _joined("h1", 1))


def with_repeat_words(rows: DataFrame, window: int) -> DataFrame:
    """Adds ``n_repeat_words``: words inside windows that occur twice or more among ``words``, from ``h2``."""
    if window < 2:
        raise ValueError("a window has two words or more")
    width, names = 2, ["h2"]
    while width < window:
        step = min(width, window - width)
        names.append(f"h{width + step}")
        rows = rows.withColumn(names[-1], _joined(names[-2], step))
        width += step
    digests = F.col(names[-1])
    placed = F.arrays_zip(digests.alias("h"), F.sequence(F.lit(1), F.size(digests)).alias("at"))
    repeated = F.size(F.array_distinct(digests)) < F.size(digests)
    rows = rows.withColumn("sorted", F.when(repeated, F.sort_array(placed))).drop(*names[1:])

    def same(a: Column, b: Column) -> Column:
        return (a["h"] == b["h"]) & (F.slice("words", a["at"], window) == F.slice("words", b["at"], window))

    ahead = F.slice("sorted", 2, F.size("sorted"))
    pairs = F.zip_with("sorted", ahead, lambda a, b: F.when(same(a, b), F.array(a["at"], b["at"])))
    starts = F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))
    rows = rows.withColumn("starts", starts).drop("sorted")
    new = F.zip_with("starts", F.slice("starts", 2, F.size("starts")), lambda a, b: F.coalesce(F.least(b - a, F.lit(window)), F.lit(window)))
    total = F.aggregate(new, F.lit(0).cast("long"), lambda n, x: n + x)
    return rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop("starts")


def trusted_labels(labels: DataFrame, id: str = "doc_id", held_out: int = HELD_OUT) -> DataFrame:
    """``label_id``, ``held_out`` of the trusted documents."""
    return (
        labels.groupBy(F.col(id).alias("label_id"))
        .agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .where("label_id IS NOT NULL AND quality = 1 AND coalesce(toxic, 0) = 0")
        .select("label_id", (F.pmod(F.xxhash64("label_id"), F.lit(held_out)) == 0).alias("held_out"))
    )


def gram_counts(docs: DataFrame, trusted: DataFrame, id: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``bucket``, ``raw`` and ``target``: grams of all documents, and of trusted ones not held out."""
    # Trusted ids are many at scale: always a shuffle join, hashed on the ids, so that texts are not sorted.
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(trusted.hint("shuffle_hash"), F.col("id") == F.col("label_id"), "left")
    grams = with_grams(rows.select((~F.coalesce("held_out", F.lit(True))).alias("is_target"), words_of(F.col("text")).alias("words")))
    return (
        # The outer form keeps the optimizer from filtering by the array, which would make it twice.
        grams.select("is_target", F.explode_outer(F.concat("h1", "h2")).alias("gram"))
        .where("gram IS NOT NULL")
        .groupBy(F.pmod("gram", F.lit(buckets)).cast("int").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("raw"), F.count_if("is_target").alias("target"))
    )


def weights(counts: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """One row: ``weights``, log(p(trusted) / p(corpus)) by bucket; zeros without trusted grams."""
    every = counts.sparkSession.range(buckets).selectExpr("CAST(id AS INT) AS bucket").join(counts, "bucket", "left").na.fill(0)
    totals = counts.agg(F.struct(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"), F.coalesce(F.sum("target"), F.lit(0)).alias("target")).alias("total"))
    room = smoothing * buckets
    ratio = F.log((F.col("target") + smoothing) / (F.col("total.target") + room)) - F.log((F.col("raw") + smoothing) / (F.col("total.raw") + room))
    weighed = every.withColumn("total", totals.scalar()).select("bucket", F.when(F.col("total.target") > 0, ratio).otherwise(0.0).alias("weight"))
    return weighed.agg(F.transform(F.sort_array(F.collect_list(F.struct("bucket", "weight"))), lambda x: x["weight"]).alias("weights"))


def features(
    docs: DataFrame, weights: DataFrame, id: str = "doc_id", text: str = "text", buckets: int = BUCKETS, window: int = 8
) -> DataFrame:
    """``id``, the base figures and ``score`` per row; ``score`` is null for texts without words."""
    text_of = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id).alias("id"),
        words_of(F.col(text)).alias("words"),
        F.regexp_count(text_of, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.filter(F.split(text_of, "\n", -1), lambda line: F.regexp_like(line, F.lit(WORD_CHARACTER))).alias("lines"),
    ).select(
        "id", "words", "n_symbols", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    rows = with_grams(rows).withColumn("weights", weights.scalar())

    def summed(hashes: str) -> Column:
        return F.aggregate(hashes, F.lit(0.0), lambda total, h: total + F.col("weights")[F.pmod(h, F.lit(buckets)).cast("int")])

    n = F.size("h1") + F.size("h2")
    rows = rows.withColumn("score", F.when(n > 0, (summed("h1") + summed("h2")) / n)).drop("weights", "h1")
    return with_repeat_words(rows, window).select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score")


def base_failed(shortest: int = 20, repeat_percent: int = 30) -> Column:
    return (F.col("n_words") < shortest) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def quality_verdicts(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
    buckets: int = BUCKETS, spread: float = SPREAD, held_out: int = HELD_OUT,
) -> DataFrame:
    """``id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``kept``, ``score`` and the ``threshold`` of all scores, one row per row."""
    trusted = stage(trusted_labels(labels, id, held_out), "trusted")
    array = stage(weights(stage(gram_counts(docs, trusted, id, text, buckets), "grams"), buckets), "weights")
    found = stage(features(docs, array, id, text, buckets).withColumn("base_failed", base_failed()), "features")
    held = found.where("NOT base_failed").join(trusted.where("held_out"), F.col("id") == F.col("label_id"), "left_semi")
    threshold = held.agg((F.mean("score") - spread * F.stddev_pop("score")).alias("threshold"))
    passed = F.coalesce(F.col("score") >= F.col("threshold"), F.lit(True))
    return found.withColumn("threshold", threshold.scalar()).select(
        F.col("id").alias(id), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & passed).alias("kept"), "score", "threshold",
    )
