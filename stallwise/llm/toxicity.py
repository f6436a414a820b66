"""Toxicity as an ordinal severity: cumulative-link regression on sparse text features.

Grades 0 < 1 < ... < K share one weight vector; ordered thresholds cut its score:
P(grade <= k) = logistic(threshold_k - w.x). The output is the expected severity,
the sum over k of P(grade > k), and the most likely grade.

Features are the different words of a text and their stems of four characters,
hashed into 2^20 buckets; a feature counts once per text, so length does not matter.

Fitting uses at most ``per_grade`` labelled texts of each grade, those with the
smallest hashes of their ids: a bound that does not grow with the data, so the fit
(L-BFGS in numpy, regularised, texts weighted back to the grades' frequencies) runs
on the driver. Scoring is one map-side pass over whole texts, without a shuffle; the
weights sent along are 4 MB, whatever the data.

Defined results: null texts have no features and get the severity of an empty text;
rows with null ids are scored like any other; repeated rows are each scored. Label
rows with a null id or grade are ignored, and of several grades of a document the
highest counts. With labels of fewer than two grades every severity is 0. An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm.word_cache import slices

BUCKETS = 1 << 20
STEM = 4
WORD = r"[^\p{L}\p{N}]+"


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per slice of texts: buckets in text order without repeats, and where each text's begin."""
    for part in slices(texts):
        words = pc.split_pattern_regex(pc.utf8_lower(part), WORD)
        parent = pc.list_parent_indices(words).to_numpy().astype(np.int64)
        coded = words.flatten().dictionary_encode()
        terms, number = coded.dictionary, coded.indices.to_numpy()
        word_bucket = _buckets(terms, b"w")
        stem_bucket = _buckets(pc.utf8_slice_codeunits(terms, 0, STEM), b"s")
        filled = (pc.utf8_length(terms).to_numpy(zero_copy_only=False) > 0)[number]
        parent, number = parent[filled], number[filled]
        pairs = np.unique(np.concatenate([parent * BUCKETS + word_bucket[number], parent * BUCKETS + stem_bucket[number]]))
        yield pairs % BUCKETS, np.searchsorted(pairs, np.arange(len(part) + 1) * BUCKETS)


def _buckets(terms: pa.Array, kind: bytes) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(kind + t.encode()) % BUCKETS for t in terms.to_pylist()], np.int64)


@dataclass
class Severity:
    """A fitted model: bucket weights and ordered thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) per row and threshold."""
        return _logistic(score[:, None] - self.thresholds[None, :])

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = [np.zeros(0)]
        for buckets, starts in features(texts):
            sums = np.concatenate([[0.0], self.weights[buckets].astype(np.float64).cumsum()])
            out.append(np.diff(sums[starts]))
        return np.concatenate(out)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def fit_arrays(
    buckets: np.ndarray, starts: np.ndarray, grades: np.ndarray, weights: np.ndarray, penalty: float = 0.3, steps: int = 100
) -> Severity:
    """Maximum likelihood with a Gaussian penalty on the shared weights.

    ``grades`` are 0..K with every grade present; ``weights`` weigh the texts.
    """
    used, column = np.unique(buckets, return_inverse=True)
    row = np.repeat(np.arange(len(grades)), np.diff(starts))
    levels, size = int(grades.max()), len(used)
    # Each feature enters with the log ratio of its rates above and at the lowest grade, so
    # that the penalty weighs on the many features that tell nothing (Wang and Manning 2012).
    above = grades > 0
    yes = np.bincount(column[above[row]], minlength=size) + 1.0
    no = np.bincount(column[~above[row]], minlength=size) + 1.0
    ratio = np.log(yes / no * ((~above).sum() + 1.0) / (above.sum() + 1.0))

    def cuts(free: np.ndarray) -> np.ndarray:
        return np.concatenate([free[:1], free[0] + np.exp(free[1:]).cumsum()])

    def loss(point: np.ndarray) -> tuple[float, np.ndarray]:
        w, free = point[:size], point[size:]
        score = np.bincount(row, (w * ratio)[column], len(grades))
        edges = np.concatenate([[-np.inf], cuts(free), [np.inf]])
        high, low = _logistic(edges[grades + 1] - score), _logistic(edges[grades] - score)
        share = np.maximum(high - low, 1e-12)
        slope_high, slope_low = high * (1 - high) / share, low * (1 - low) / share
        value = -(weights * np.log(share)).sum() + penalty / 2 * (w @ w)
        by_score = weights * (slope_high - slope_low)
        grad_w = ratio * np.bincount(column, by_score[row], size) + penalty * w
        by_cut = np.bincount(grades, -weights * slope_high, levels + 1)[:-1] + np.bincount(grades, weights * slope_low, levels + 1)[1:]
        spread = np.concatenate([[by_cut.sum()], np.exp(free[1:]) * by_cut[::-1].cumsum()[::-1][1:]])
        return value, np.concatenate([grad_w, spread])

    share = np.bincount(grades, weights, levels + 1).cumsum()[:-1] / weights.sum()
    start = np.log(share / (1 - share))
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    best = minimise(loss, np.concatenate([np.zeros(size), free]), steps)
    full = np.zeros(BUCKETS, np.float32)
    full[used] = best[:size] * ratio
    return Severity(full, cuts(best[size:]))


def minimise(loss, point: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """L-BFGS with step halving."""
    value, slope = loss(point)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        direction, kept = -slope, []
        for s, y, r in reversed(past):
            kept.append(a := r * (s @ direction))
            direction = direction - a * y
        if past:
            s, y, _ = past[-1]
            direction = direction * ((s @ y) / (y @ y))
        else:
            direction = direction / max(1.0, np.abs(slope).max())
        for (s, y, r), a in zip(past, reversed(kept)):
            direction = direction + (a - r * (y @ direction)) * s
        size = 1.0
        while (found := loss(point + size * direction))[0] > value + 1e-4 * size * (slope @ direction) and size > 1e-8:
            size /= 2
        moved, change = size * direction, found[1] - slope
        if found[0] >= value or value - found[0] < 1e-7 * abs(value):
            return point + moved if found[0] < value else point
        point, value, slope = point + moved, *found
        if moved @ change > 1e-12:
            past = [*past[-memory + 1 :], (moved, change, 1 / (moved @ change))]
    return point


def graded(buckets: np.ndarray, starts: np.ndarray, positive: np.ndarray, least: float = 0.01) -> np.ndarray:
    """Grades 0, 1, 2 from yes and no: positive texts are cut at their median number of telling features.

    A feature tells if a share of at least ``least`` of the positive texts and no other text has it.
    """
    row = np.repeat(np.arange(len(positive)), np.diff(starts))
    yes = np.bincount(buckets[positive[row]], minlength=BUCKETS)
    no = np.bincount(buckets[~positive[row]], minlength=BUCKETS)
    telling = (yes >= max(3, least * positive.sum())) & (no == 0)
    found = np.bincount(row, telling[buckets], len(positive))
    severe = found > np.median(found[positive]) if positive.any() else positive
    return positive.astype(int) + (positive & severe)


def fit(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", grade: str = "grade",
    per_grade: int = 3000, derive: bool = False,
) -> Severity:
    """Fit on at most ``per_grade`` labelled texts of each grade of ``labels`` (``id``, ``grade``).

    Grades may be any whole numbers; they are used in their order. With ``derive``
    the lowest grade is 0 and the others, taken together, are cut into 1 and 2 by
    ``graded``: for labels that say only yes or no.
    """
    asked = labels.where(F.col(id).isNotNull() & F.col(grade).isNotNull()).groupBy(F.col(id).alias("id")).agg(F.max(grade).cast("int").alias("grade"))
    counts = {r["grade"]: r["n"] for r in asked.groupBy("grade").agg(F.expr("count(1) AS n")).collect()}
    if len(counts) < 2:
        return Severity(np.zeros(BUCKETS, np.float32), np.array([np.inf]))
    chosen = [asked.where(F.col("grade") == g).orderBy(F.xxhash64("id"), "id").limit(per_grade) for g in sorted(counts)]
    sample = chosen[0]
    for more in chosen[1:]:
        sample = sample.unionAll(more)
    # At most per_grade ids of each grade are broadcast; a repeated document is used once.
    table = (
        docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
        .join(F.broadcast(sample), "id").groupBy("id", "grade").agg(F.min("text").alias("text"))
        .select("grade", feature_lists(F.col("text")).alias("buckets"))
        .toArrow().combine_chunks()
    )
    found, lists = table["grade"].to_numpy(), table["buckets"].combine_chunks()
    order = {g: i for i, g in enumerate(sorted(set(found.tolist())))}
    if len(order) < 2:
        return Severity(np.zeros(BUCKETS, np.float32), np.array([np.inf]))
    grades = np.array([order[g] for g in found.tolist()])
    each = np.bincount(grades)
    frequency = np.array([counts[g] for g in order]) / each
    weights = frequency[grades] * len(grades) / (frequency * each).sum()
    buckets, starts = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    if derive:
        grades = graded(buckets, starts, grades > 0)
    return fit_arrays(buckets, starts, grades, weights)


def feature_lists(text: Column) -> Column:
    @F.arrow_udf("array<int>")
    def lists(texts: pa.Array) -> pa.Array:
        parts = [
            pa.ListArray.from_arrays(pa.array(s.astype(np.int32)), pa.array(b.astype(np.int32))) for b, s in features(texts)
        ]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return lists(text)


def severity(text: Column, model: Severity) -> Column:
    """Struct of expected ``severity`` and most likely ``grade`` of whole texts."""

    @F.arrow_udf("severity double, grade int")
    def score(texts: pa.Array) -> pa.Array:
        above = model.above(model.scores(texts))
        ends = np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], axis=1)
        likely = (ends[:, :-1] - ends[:, 1:]).argmax(1)
        return pa.StructArray.from_arrays([pa.array(above.sum(1)), pa.array(likely.astype(np.int32))], ["severity", "grade"])

    return score(text)


def scored(docs: DataFrame, model: Severity, id: str = "doc_id", text: str = "text", reject_from: float = 0.25) -> DataFrame:
    """``id``, ``severity``, ``grade``, ``rejected`` (severity at least ``reject_from``)."""
    rows = docs.select(F.col(id).alias("id"), severity(F.col(text), model).alias("s"))
    return rows.select(F.col("id").alias(id), "s.severity", "s.grade", (F.col("s.severity") >= reject_from).alias("rejected"))


def without_toxic(docs: DataFrame, model: Severity, text: str = "text", reject_from: float = 0.25) -> DataFrame:
    """``docs`` without rejected rows; all columns stay."""
    return docs.where(severity(docs[text], model)["severity"] < reject_from)
