from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE
from tests.llm.helpers import ODD_TEXTS, docs_of, prose
from tickwise.llm.toxicity import OrdinalModel, fit, score, train

BAD = ["vile", "nasty", "rotten", "foul"]
LABELS = "doc_id bigint, quality int, toxic int"


def corpus(n, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = prose(seed * 10_000 + i, rng.randrange(20, 120)).split()
        bad = rng.randrange(2, 8) if i % 6 == 0 else 0
        for _ in range(bad):
            words.insert(rng.randrange(len(words)), rng.choice(BAD).upper())
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad > 0)))
    return rows, labels


def test_held_out_grades(spark):
    rows, labels = corpus(1500, 1)
    model = train(docs_of(spark, rows), spark.createDataFrame(labels, LABELS))
    assert (np.diff(model.thresholds) > 0).all()
    fresh, truth = corpus(300, 2)
    got = {r.doc_id: r for r in score(docs_of(spark, fresh), model).collect()}
    right = sum(got[i].toxic == bool(t) for i, _, t in truth)
    assert right >= 0.97 * len(truth)
    for r in got.values():
        assert 0 <= r.p_toxic <= 1 and 0 <= r.severity <= 3 and r.severity >= r.p_toxic - 1e-12 and 0 <= r.grade <= 3
    amount = {i: sum(t.count(b.upper()) for b in BAD) for i, t in fresh}
    few = np.mean([got[i].severity for i in got if amount[i] == 2])
    many = np.mean([got[i].severity for i in got if amount[i] >= 5])
    assert many > few > np.mean([got[i].severity for i in got if amount[i] == 0])


def test_given_data_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF_ORACLE}/documents.parquet"), spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    half = F.xxhash64(F.col("doc_id") + 3) % 2 == 0
    got = score(docs, train(docs, labels.where(half))).join(labels.where(~half).withColumnRenamed("toxic", "truth"), "doc_id").collect()
    clean = [r for r in got if not r.truth]
    assert sum(r.toxic for r in clean) <= 0.05 * len(clean)


def test_graded_labels_are_used_as_they_are(spark):
    rows = [(i, prose(i, 30) + " mild" * (i % 3 == 1) + " grave" * (i % 3 == 2)) for i in range(240)]
    labels = [(i, 1, i % 3) for i in range(240)]
    model = train(docs_of(spark, rows), spark.createDataFrame(labels, LABELS))
    got = {r.doc_id: r.grade for r in score(docs_of(spark, rows), model).collect()}
    assert sum(got[i] == i % 3 for i in got) >= 230


def test_gradient_of_the_thresholds():
    grades = np.array([0] * 50 + [1] * 30 + [2] * 20)
    model = fit(grades, np.ones(100), np.zeros(0, dtype=int), np.zeros(0, dtype=int), steps=400)
    at_least = model.at_least(np.zeros(1))[0]
    assert np.allclose(at_least, [0.5, 0.2], atol=0.02)


def test_awkward_rows(spark):
    rows, labels = corpus(120, 3)
    odd = [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "VILE"), (0, "again"), (0, "again"), (2000, prose(1, 30_000) + " vile nasty")]
    more = [(None, 1, 1), (5, 1, None), (6, 1, 1), (6, 1, 0), (99999, 1, 1)]
    docs = docs_of(spark, rows + odd)
    model = train(docs, spark.createDataFrame(labels + more, LABELS))
    got = score(docs, model).collect()
    assert len(got) == len(rows) + len(odd) and sum(r.doc_id is None for r in got) == 1
    again = score(docs, train(docs, spark.createDataFrame(labels + more, LABELS))).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_without_a_class_nothing_is_toxic(spark):
    rows, _ = corpus(10, 4)
    docs = docs_of(spark, rows)
    for labels in ([], [(1, 1, 0)], [(1, 1, 1)]):
        model = train(docs, spark.createDataFrame(labels, LABELS))
        assert model is None and not any(r.toxic for r in score(docs, model).collect())
    assert score(docs_of(spark, []), None).count() == 0
    assert isinstance(train(docs, spark.createDataFrame([(0, 1, 1), (1, 1, 0)], LABELS)), OrdinalModel)


def test_an_id_trains_with_one_document_however_many_carry_it(spark):
    rows, labels = corpus(400, 3)
    known = spark.createDataFrame(labels, LABELS)
    once = train(docs_of(spark, rows), known)
    copies = train(docs_of(spark, rows + [rows[0]] * 3000 + [rows[1]] * 500), known)
    assert np.allclose(once.thresholds, copies.thresholds, atol=1e-4)
    assert np.allclose(once.weights, copies.weights, atol=1e-4)


def likelihood(x, grades, present):
    """Mean log likelihood by the definition, row by row: one weight a feature, then the thresholds."""
    m = present.shape[1]
    total = 0.0
    for g, row in zip(grades.tolist(), present, strict=True):
        at_least = [1.0, *[1 / (1 + np.exp(t - x[:m] @ row)) for t in x[m:]], 0.0]
        total += np.log(max(at_least[g] - at_least[g + 1], 1e-300))
    return total / len(grades)


@pytest.mark.parametrize("seed", range(3))
def test_fit_is_the_maximum_found_by_searching(seed):
    rng = np.random.default_rng(seed)
    n, m = 240, 3
    present = (rng.random((n, m)) < 0.5).astype(float)
    score = present @ np.array([1.5, -1.0, 0.5]) + rng.logistic(size=n)
    grades = (score > 0.3).astype(int) + (score > 1.6)
    row_of, features = np.nonzero(present)
    model = fit(grades, np.ones(n), row_of, features + 10, penalty=0.0)
    got = np.concatenate([model.weights[10 : 10 + m], model.thresholds])
    # brute force: each coordinate in turn by ever smaller steps, from zero weights
    best, step = np.concatenate([np.zeros(m), [0.0, 1.0]]), 1.0
    value = likelihood(best, grades, present)
    while step > 0.01:
        moved = False
        for j in range(len(best)):
            for sign in (-1, 1):
                trial = best.copy()
                trial[j] += sign * step
                if np.all(np.diff(trial[m:]) > 0) and (v := likelihood(trial, grades, present)) > value:
                    best, value, moved = trial, v, True
        step = step if moved else step / 2
    assert likelihood(got, grades, present) > value - 1e-3
    assert np.abs(got - best).max() < 0.15 and (model.weights != 0).sum() <= m


def test_very_long_texts_train_with_a_bounded_number_of_features(spark):
    """The fit sees a part of a long text's features, the score all of them."""
    rows, labels = corpus(600, 5)
    long_clean = " ".join(f"q{k}" for k in range(30_000))
    rows += [(600, long_clean + " VILE nasty rotten"), (601, long_clean)]
    labels += [(600, 1, 1), (601, 1, 0)]
    docs, marks = docs_of(spark, rows), spark.createDataFrame(labels, LABELS)
    model = train(docs, marks, max_row_features=200)
    got = {r.doc_id: r.toxic for r in score(docs, model).collect()}
    assert got[600] and not got[601]
    assert sum(got[i] == bool(t) for i, _, t in labels) >= 0.97 * len(labels)
    # with no text beyond the bound it changes nothing
    same = [train(docs_of(spark, rows[:600]), marks, max_row_features=n) for n in (300, 1 << 18)]
    assert np.array_equal(same[0].weights, same[1].weights) and np.array_equal(same[0].thresholds, same[1].thresholds)
