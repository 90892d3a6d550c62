"""Toxicity as an ordered grade, by cumulative-link (proportional-odds)
regression on sparse word features.

``P(grade >= j) = sigmoid(w . x - theta_j)`` with one weight vector for all
thresholds ``theta_1 < theta_2 < ...``; the expected severity is the sum of
these probabilities. Features are hashed words and hashed beginnings of longer
words (``PREFIX`` bytes, for stems), 1 where the text has them.

The model is fitted on a bounded sample of labelled rows (``max_toxic`` and
``max_clean`` documents, those whose id hashes lowest), weighted back to the
shares of all labels; of a text with more than ``max_row_features`` different
features the fit takes those that hash lowest, so what reaches the driver is
bounded however long the texts are. Labels that only say toxic or not are graded by how many
different marked words a document holds: words that nearly only toxic rows of the
sample have. Every document is then scored on its whole text by a projection.

Defined cases: a null or empty text has no features and gets the severity of
the thresholds alone; labels with a null id or grade are not used, an id that is
labelled twice has its highest grade, an id that several documents carry
trains with one of them, the text that hashes lowest; repeated rows are scored each on its own; without toxic or
without clean labels nothing is toxic; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import row_number
from tickwise.llm.textbytes import hash_runs, pieces_of, words_of

FEATURE_BITS = 18
PREFIX = 5
MAX_TOXIC = 2000
MAX_CLEAN = 4000
GRADES = 3
MIN_DOCUMENTS = 3
MAX_FEATURES = 1 << 15
MAX_ROW_FEATURES = 1 << 12
MARKED_SHARE = 0.9
# Few labels are toxic, so the sum of errors is least below one half.
TOXIC_FROM = 0.3


@dataclass
class OrdinalModel:
    weights: np.ndarray  # one a feature
    thresholds: np.ndarray  # increasing

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, ...; one row a score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -60, 60)))


def text_features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of rows: first row, row count, text and number of each feature."""
    for first, count, raw, bounds in pieces_of(column):
        data, starts, ends, words_at = words_of(raw, bounds)
        row_of = np.repeat(np.arange(count), np.diff(words_at))
        long = ends - starts > PREFIX
        hashes = [hash_runs(data, starts, ends), ~hash_runs(data, starts[long], starts[long] + PREFIX)]
        features = (np.concatenate(hashes) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
        yield first, count, np.concatenate([row_of, row_of[long]]), features


def grade(toxic: np.ndarray, row_of: np.ndarray, features: np.ndarray, grades: int) -> np.ndarray:
    """0 for clean rows; for toxic ones 1 to ``grades`` by the number of
    different marked features, cut into shares of equal size."""
    size = 1 << FEATURE_BITS
    in_toxic = np.bincount(features, weights=toxic[row_of], minlength=size)
    in_all = np.bincount(features, minlength=size)
    marked = (in_all >= MIN_DOCUMENTS) & (in_toxic >= MARKED_SHARE * in_all)
    level = np.bincount(row_of, weights=marked[features], minlength=len(toxic))
    own = np.sort(level[toxic > 0])
    cuts = own[[len(own) * i // grades for i in range(1, grades)]]
    return np.where(toxic > 0, 1 + np.searchsorted(np.unique(cuts), level, side="left"), 0)


def fit(
    grades: np.ndarray, weight: np.ndarray, row_of: np.ndarray, features: np.ndarray, steps: int = 300, penalty: float = 0.008
) -> OrdinalModel:
    """Proximal gradient descent (Adam steps, soft threshold) on the weighted
    likelihood. ``row_of`` and ``features`` list the distinct words of rows. The
    penalty falls with the root of the number of rows."""
    n, top = len(grades), int(grades.max())
    penalty /= np.sqrt(n)
    # features whose documents differ most from the rest in being toxic
    seen = np.bincount(features, minlength=1 << FEATURE_BITS)
    rate = (grades > 0).mean()
    found = np.bincount(features, weights=(grades > 0)[row_of], minlength=1 << FEATURE_BITS)
    z = np.where(seen >= MIN_DOCUMENTS, np.abs(found - rate * seen) / np.sqrt(np.maximum(seen, 1) * rate * (1 - rate)), -1)
    used = np.sort(np.argsort(-z, kind="stable")[:MAX_FEATURES])
    used = used[z[used] >= 0]
    chosen = np.zeros(1 << FEATURE_BITS, dtype=bool)
    chosen[used] = True
    keep = chosen[features]
    row_of, column = row_of[keep], np.searchsorted(used, features[keep])
    weight = weight / weight.sum()
    share = np.array([weight[grades >= j].sum() for j in range(1, top + 1)])
    start = np.log((1 - share) / share)
    # thresholds are the first one and the logarithms of the gaps, so they stay in order
    gaps = np.log(np.maximum(np.diff(start), 0.1))
    m = len(used)
    x = np.concatenate([np.zeros(m), start[:1], gaps])
    first, second = np.zeros(len(x)), np.zeros(len(x))
    for step in range(1, steps + 1):
        rate = 0.2 / np.sqrt(1 + step / 30)
        w, thresholds = x[:m], _thresholds(x[m:])
        u = np.ones((n, top + 2))
        u[:, 1:-1] = OrdinalModel(w, thresholds).at_least(np.bincount(row_of, weights=w[column], minlength=n))
        u[:, -1] = 0
        mine, above = u[np.arange(n), grades], u[np.arange(n), grades + 1]
        slope = weight * (mine + above - 1)
        ratio = weight / np.maximum(mine - above, 1e-12)
        by_threshold = np.array(
            [
                (ratio * u[:, j] * (1 - u[:, j]) * ((grades == j).astype(float) - (grades == j - 1))).sum()
                for j in range(1, top + 1)
            ]
        )
        by_gap = [np.exp(x[m + j]) * by_threshold[j:].sum() for j in range(1, top)]
        gradient = np.concatenate(
            [np.bincount(column, weights=slope[row_of], minlength=m), [by_threshold.sum()], by_gap]
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = rate / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        x = x - np.clip(move * first / (1 - 0.9**step), -1, 1)
        x[:m] = np.sign(x[:m]) * np.maximum(np.abs(x[:m]) - np.minimum(move[:m] * penalty, rate), 0)
        x[m + 1 :] = np.maximum(x[m + 1 :], -3)
    weights = np.zeros(1 << FEATURE_BITS, dtype=np.float32)
    weights[used] = x[:m]
    return OrdinalModel(weights, _thresholds(x[m:]))


def _thresholds(parts: np.ndarray) -> np.ndarray:
    return parts[0] + np.concatenate([[0.0], np.cumsum(np.exp(parts[1:]))])


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_toxic: int = MAX_TOXIC,
    max_clean: int = MAX_CLEAN,
    grades: int = GRADES,
    max_row_features: int = MAX_ROW_FEATURES,
) -> OrdinalModel | None:
    """A model, or None if one of the classes has no document. ``label_col``
    holds 0 and 1, or grades from 0 up (then they are used as they are)."""
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(label_col).cast("int").alias("label"))
    )
    totals = {r.toxic: r.n for r in known.groupBy((F.col("label") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect()}
    by_hash = known.orderBy(F.xxhash64("id"), "id")
    chosen = by_hash.where("label > 0").limit(max_toxic).union(by_hash.where("label = 0").limit(max_clean))
    # at most max_toxic + max_clean ids: a bounded table
    numbered = docs.select(row_number(docs).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    # one document an id, however many carry it: numbers only, collapsed before the shuffle
    one = (
        numbered.select("row", "id", F.xxhash64("t").alias("hash"))
        .join(F.broadcast(chosen), "id")
        .groupBy("id")
        .agg(F.min_by("row", "hash").alias("row"), F.max("label").alias("label"))
    )
    texts = numbered.select("row", "t").join(F.broadcast(one.select("row", "label")), "row")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, count, row_of, features in text_features(batch.column(1)):
                pair = np.unique((row_of << FEATURE_BITS) | features)
                cut = np.searchsorted(pair >> FEATURE_BITS, np.arange(count + 1))
                if np.diff(cut).max(initial=0) > max_row_features:
                    pair = pair[np.arange(len(pair)) - cut[pair >> FEATURE_BITS] < max_row_features]
                    cut = np.searchsorted(pair >> FEATURE_BITS, np.arange(count + 1))
                cut = cut.astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(2).slice(first, count),
                        pa.ListArray.from_arrays(cut, pa.array((pair & ((1 << FEATURE_BITS) - 1)).astype(np.int32))),
                    ],
                    names=["label", "features"],
                )

    rows = texts.select("row", "t", "label").mapInArrow(task, "label int, features array<int>").toArrow()
    label = np.asarray(rows["label"].to_numpy(), dtype=np.int64)
    if not len(label) or not (label > 0).any() or not (label == 0).any():
        return None
    lists = rows["features"].combine_chunks()
    row_of = np.repeat(np.arange(len(label)), np.diff(lists.offsets.to_numpy()))
    features = lists.flatten().to_numpy().astype(np.int64)
    toxic = (label > 0).astype(float)
    if label.max() == 1:
        label = grade(toxic, row_of, features, grades)
    weight = np.where(label > 0, totals[True] / toxic.sum(), totals[False] / (1 - toxic).sum())
    return fit(label.astype(np.int64), weight, row_of, features)


def score(docs: DataFrame, model: OrdinalModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``<id_col>, severity`` (expected grade),
    ``p_toxic`` (of grade 1 or more), ``grade`` (the likeliest), ``toxic``
    (``p_toxic`` of ``TOXIC_FROM`` or more)."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    if model is None:
        model = OrdinalModel(np.zeros(1 << FEATURE_BITS, dtype=np.float32), np.array([60.0]))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one float a feature: 1 MB
    id_type = source.schema["id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for first, count, row_of, features in text_features(batch.column(1)):
                value = m.weights[features]
                on = np.flatnonzero(value)
                pair = np.unique((row_of[on] << FEATURE_BITS) | features[on])
                scores = np.bincount(
                    pair >> FEATURE_BITS, weights=m.weights[pair & ((1 << FEATURE_BITS) - 1)], minlength=count
                )
                u = m.at_least(scores)
                chance = np.diff(np.concatenate([np.ones((count, 1)), u, np.zeros((count, 1))], axis=1), axis=1) * -1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, count),
                        pa.array(u.sum(axis=1)),
                        pa.array(u[:, 0]),
                        pa.array(chance.argmax(axis=1).astype(np.int32)),
                        pa.array(u[:, 0] >= TOXIC_FROM),
                    ],
                    names=["id", "severity", "p_toxic", "grade", "toxic"],
                )

    rows = source.mapInArrow(task, f"id {id_type}, severity double, p_toxic double, grade int, toxic boolean")
    return rows.withColumnRenamed("id", id_col)
