"""Severity of toxic language by cumulative-link ordinal regression on sparse text features.

P(grade <= k) = logistic(threshold_k - score): one weight vector is shared by all grades and the thresholds
ascend. A document's output is the probability of each grade and the expected grade. Features are words and their first
letters (which catch inflected and compound forms), weighted by the logarithm of one plus their count.

Scale. The model is fitted on at most ``MAX_LABELLED`` labelled rows (those with the smallest hash of their id: a documented bound, the
same rows in every run), whose features are chosen by a distributed count; at most ``MAX_FEATURES`` are kept,
so what the driver gets and what tasks are sent is bounded. Scoring is one pass over all whole texts without a
shuffle.

Defined results. NULL and empty texts have no features and get the base rate. A document labelled several times has
its highest label; NULL labels and labels without a document are ignored. Without labelled rows of at least two grades every
probability is that of grade 0. Repeated rows each get the same result. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlake.llm.common import ship, stage

#: Labelled rows that the model is fitted on.
MAX_LABELLED = 20_000
MAX_FEATURES = 4096
#: A feature must be in so many labelled documents, and differ so many standard errors between grades.
MIN_DOCUMENTS = 5
MIN_DEVIATION = 4.0
#: First letters of a word that are features besides the word itself.
PREFIXES = (3, 4, 5, 6)
GRADES = 4
RIDGE = 1e-3
STEPS = 300
REMEMBERED = 300_000


def features(word: str) -> list[int]:
    """Numbers of a word and its beginnings."""
    parts = [f"={word}", *(word[:n] for n in PREFIXES if len(word) > n)]
    return [xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass")) >> 1 for p in parts]


def words(text: str | None) -> Counter:
    return Counter(re.findall(r"[^\W\d_]+", (text or "").lower()))


@dataclass(frozen=True)
class Model:
    #: Feature number to its place.
    places: dict[int, int]
    weights: np.ndarray
    thresholds: np.ndarray
    #: Places of features that count as markers of toxicity.
    markers: np.ndarray


def vector(text: str | None, places: dict[int, int], known: dict) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the chosen features of a text."""
    total: dict[int, int] = {}
    for word, n in words(text).items():
        own = known.get(word)
        if own is None:
            if len(known) >= REMEMBERED:
                known.clear()
            own = known[word] = tuple(places[f] for f in features(word) if f in places)
        for place in own:
            total[place] = total.get(place, 0) + n
    at = np.fromiter(total.keys(), np.int64, len(total))
    return at, np.log1p(np.fromiter(total.values(), np.float64, len(total)))


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``label, text`` of at most ``MAX_LABELLED`` labelled documents; of several texts of one id that with the smallest hash."""
    best = (
        labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
        .where("id is not null and label is not null")
        .groupBy("id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(MAX_LABELLED)
    )
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    # Bounded by MAX_LABELLED rows of two numbers.
    joined = texts.join(F.broadcast(best), "id")
    # Repeats of an id are combined before the shuffle, so an id that very many rows have is no more than one row a task.
    one = joined.groupBy("id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x"))
    return stage(one.select("label", "x.text"), "labelled")


def choose_features(labelled: DataFrame) -> tuple[dict[int, int], np.ndarray]:
    """Features whose frequency differs most between labelled (above 0) and other documents, and which of
    them are more frequent in the labelled ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for label, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums[label > 0].update({f for w in words(text) for f in features(w)})
        for side, found in enumerate(sums):
            numbers = np.fromiter(found.keys(), np.int64, len(found))
            times = np.fromiter(found.values(), np.int64, len(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers), pa.array(np.full(len(found), side, np.int32)), pa.array(times)], ["f", "side", "n"]
            )

    sizes = labelled.agg(F.count(F.when(F.col("label") > 0, 1)), F.count(F.when(F.col("label") <= 0, 1))).first()
    pos, neg = sizes
    if not pos or not neg:
        return {}, np.zeros(0, np.int64)
    counted = labelled.mapInArrow(count, "f long, side int, n long").groupBy("f").agg(
        F.sum(F.when(F.col("side") == 1, F.col("n")).otherwise(0)).alias("p"),
        F.sum(F.when(F.col("side") == 0, F.col("n")).otherwise(0)).alias("q"),
    ).where(F.col("p") + F.col("q") >= MIN_DOCUMENTS)
    rate = (F.col("p") + F.col("q")) / (pos + neg)
    error = F.sqrt(rate * (1 - rate) * (1 / pos + 1 / neg)) + 1e-9
    deviation = (F.col("p") / pos - F.col("q") / neg) / error
    top = (
        counted.select("f", deviation.alias("z")).where(F.abs("z") >= MIN_DEVIATION)
        .orderBy(F.abs("z").desc(), "f").limit(MAX_FEATURES).collect()
    )
    return {r["f"]: i for i, r in enumerate(top)}, np.array([i for i, r in enumerate(top) if r["z"] > 0], np.int64)


def fit(labelled: DataFrame, grades: int = GRADES) -> Model:
    """Fit on ``label`` (0 not toxic, above 0 toxic) and ``text``.

    With labels 0 and 1 only, toxic documents are graded 1 to ``grades - 1`` by equal shares of the weight of
    marker features in them; labels above 1 are grades already.
    """
    places, markers = choose_features(labelled)
    if not places:
        return Model({}, np.zeros(0), np.array([50.0] * (grades - 1)), markers)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            rows = [vector(t, places, known) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([a.astype(np.int32) for a, _ in rows], pa.list_(pa.int32())),
                 pa.array([v.astype(np.float32) for _, v in rows], pa.list_(pa.float32()))],
                ["label", "at", "value"],
            )

    # At most MAX_LABELLED rows of chosen features.
    rows = labelled.mapInArrow(each, "label int, at array<int>, value array<float>").toPandas()
    # Rows arrive in any order; sums of floats should not depend on it.
    rows = rows.iloc[sorted(range(len(rows)), key=lambda i: (rows.label[i], list(rows["at"][i]), list(rows["value"][i])))]
    label = rows.label.to_numpy()
    lengths = rows["at"].map(len).to_numpy()
    row = np.repeat(np.arange(len(rows)), lengths)
    at = np.concatenate([np.asarray(x, np.int64) for x in rows["at"]])
    value = np.concatenate([np.asarray(x, np.float64) for x in rows["value"]])
    if label.max() == 1:
        strength = np.bincount(row, np.where(np.isin(at, markers), value, 0.0), len(rows))
        cuts = np.quantile(strength[label == 1], np.arange(1, grades - 1) / (grades - 1))
        label = np.where(label == 1, 1 + np.searchsorted(cuts, strength, side="right"), 0)
    weights, thresholds = fit_ordinal(row, at, value, np.minimum(label, grades - 1), len(places), grades)
    return Model(places, weights, thresholds, markers)


def fit_ordinal(
    row: np.ndarray, at: np.ndarray, value: np.ndarray, grade: np.ndarray, size: int, grades: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds that maximise the penalised likelihood (full-batch Adam)."""
    n = len(grade)
    share = np.array([(np.sum(grade <= k) + 0.5) / (n + 1) for k in range(grades - 1)])
    start = np.log(share / (1 - share))
    # threshold_0, then logarithms of the gaps: ascending whatever the values.
    params = np.concatenate([np.zeros(size), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        weights, gaps = params[:size], np.exp(params[size + 1 :])
        cuts = np.concatenate([[-np.inf], params[size] + np.concatenate([[0.0], np.cumsum(gaps)]), [np.inf]])
        score = np.bincount(row, value * weights[at], n)
        upper, lower = _logistic(cuts[grade + 1] - score), _logistic(cuts[grade] - score)
        chance = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        gradient = np.zeros_like(params)
        by_row = (up - low) / n
        gradient[:size] = np.bincount(at, value * by_row[row], size) + RIDGE * weights
        by_cut = np.zeros(grades - 1)
        for k in range(grades - 1):
            by_cut[k] = -(up[grade == k].sum() - low[grade == k + 1].sum()) / n
        gradient[size] = by_cut.sum()
        gradient[size + 1 :] = gaps * np.cumsum(by_cut[::-1])[::-1][1:]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        params = params - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return params[:size], params[size] + np.concatenate([[0.0], np.cumsum(np.exp(params[size + 1 :]))])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def severity(text: str | None, model: Model, known: dict) -> np.ndarray:
    """Probability of each grade."""
    at, value = vector(text, model.places, known)
    score = float(value @ model.weights[at]) if len(at) else 0.0
    below = np.concatenate([_logistic(model.thresholds - score), [1.0]])
    return np.maximum(np.diff(below, prepend=0.0), 0.0)


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, severity`` (expected grade), ``grade`` (most probable), ``p_toxic``, ``toxic``, ``grades`` of every row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            chances = [severity(t, model, known) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([float(c @ np.arange(len(c))) for c in chances], pa.float64()),
                 pa.array([int(np.argmax(c)) for c in chances], pa.int32()),
                 pa.array([float(1 - c[0]) for c in chances], pa.float64()),
                 pa.array([bool(c[0] < 0.5) for c in chances], pa.bool_()),
                 pa.array([c.tolist() for c in chances], pa.list_(pa.float64()))],
                ["doc_id", "severity", "grade", "p_toxic", "toxic", "grades"],
            )

    kept = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return kept.mapInArrow(
        each, "doc_id long, severity double, grade int, p_toxic double, toxic boolean, grades array<double>"
    )


ship(__name__)
