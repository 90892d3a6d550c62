"""Search against every document scored by the definition, and the bounds of
blocks against their documents."""

from __future__ import annotations

import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

import tickwise.llm.lexical as lexical
from tests.llm.helpers import ODD_TEXTS, docs_of, prose
from tickwise.llm.common import ASCII_LOWER, ASCII_UPPER
from tickwise.llm.lexical import codes, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(ASCII_UPPER, ASCII_LOWER)


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    held = [terms(t) for _, t in docs]
    n_docs, total = sum(bool(t) for t in held), sum(map(len, held))
    df = Counter(w for t in held for w in set(t))
    out = []
    for item, text in items:
        scored = []
        for (doc, _), t in zip(docs, held, strict=True):
            tf, s = Counter(t), 0
            for w in terms(text):
                if tf[w]:
                    m = 25 + (75 * len(t) * n_docs) // total
                    s += floor(1000 * log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * tf[w] // (1000 * tf[w] + 8 * m))
            if s > 0:
                scored.append((-s, doc is None, doc))
        out += [(item, i + 1, doc, -s) for i, (s, _, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def check(spark, tmp_path, docs, items, **kwargs):
    path = f"{tmp_path}/{random.randrange(10**9)}"
    docs_of(spark, docs).repartition(3).write.parquet(f"{path}/d")
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id bigint, text string, query int, id string")
    table.coalesce(1).write.parquet(f"{path}/q")
    got = search(spark.read.parquet(f"{path}/d"), spark.read.parquet(f"{path}/q"), **kwargs).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, items, kwargs.get("k", 10))
    return got


def corpus(seed, n):
    """Texts with words of very different frequency, passages of the items, and
    copies."""
    rng = random.Random(seed)
    word = lambda: f"w{int(300 * rng.random() ** 3)}"
    items = [(i, " ".join(word() for _ in range(rng.randrange(1, 40)))) for i in range(15)]
    docs = []
    for i in range(n):
        text = " ".join(word() for _ in range(rng.randrange(0, 120)))
        if i % 17 == 0:
            text += ". " + rng.choice(items)[1].upper()
        docs.append((i, text))
    docs += [(10_000 + i, docs[5][1]) for i in range(25)]
    return docs, items


def test_every_query_gets_its_best_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lexical, "SEED", 20)
    monkeypatch.setattr(lexical, "BLOCK", 4)
    docs, items = corpus(1, 400)
    check(spark, tmp_path, docs, items)


def test_groups_of_queries_and_other_k(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lexical, "QUERY_BYTES", 300)
    docs, items = corpus(2, 120)
    check(spark, tmp_path, docs, items, k=3)


def test_blocks_are_skipped_where_bounds_fail(spark, tmp_path, monkeypatch):
    """Documents in families that share a vocabulary; the words of queries are
    strewn over all families. A query opens the blocks of its own family."""
    rng = random.Random(3)
    monkeypatch.setattr(lexical, "BLOCK", 8)
    docs = []
    for f in range(30):
        words = [f"f{f}x{j}" for j in range(30)]
        strewn = [f"f{g}x{j}" for g in range(0, 30, 3) for j in range(12)]
        docs += [(f * 40 + i, " ".join(rng.sample(words, 20) + rng.sample(strewn, 6))) for i in range(40)]
    items = [(f, " ".join(f"f{f}x{j}" for j in range(12)) + " common shared") for f in range(0, 30, 3)]
    seen = []
    inner = lexical._candidates
    monkeypatch.setattr(lexical, "_candidates", lambda index, plan: seen.append((index, inner(index, plan))) or seen[-1][1])
    check(spark, tmp_path, docs, items)
    index, candidates = seen[0]
    held = index.selectExpr("sum(size(rows)) as n").first().n
    assert 0 < candidates.count() < 0.75 * held


def test_odd_rows(spark, tmp_path):
    docs = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "one two"), (None, "ONE two"), (40, "one"), (40, "one"), (41, "x" * 9000)]
    items = [(1, "one two"), (2, None), (3, ""), (4, "é 中文"), (4, "A" * 5000), (None, "x y one one"), (5, "nowhere"), (6, "x" * 9000)]
    check(spark, tmp_path, docs, items)
    check(spark, tmp_path, [], items)
    check(spark, tmp_path, docs, [])
    check(spark, tmp_path, [(1, None), (2, "- -")], items)


def test_similar_documents_have_similar_codes():
    rng = np.random.default_rng(5)
    vocabulary = np.sort(rng.integers(1, 1 << 63, 500, dtype=np.uint64))
    a = np.sort(rng.choice(500, 60, replace=False))
    b = np.sort(np.append(a[:-3], np.setdiff1d(np.arange(500), a)[:3]))
    c = np.setdiff1d(np.arange(500), a)[:60]
    term = np.concatenate([a, b, c])
    code = codes(vocabulary, np.full(500, 7), term, np.full(len(term), 500_000), np.array([0, 60, 120, 180]))
    apart = lambda x, y: bin(int(x) ^ int(y)).count("1")
    assert apart(code[0], code[1]) < apart(code[0], code[2])


@pytest.mark.parametrize("seed", range(3))
def test_bounds_hold_for_every_document(seed):
    rng = np.random.default_rng(seed)
    n_docs, n_terms, n_queries = 60, 40, 5
    sets = [np.sort(rng.choice(n_terms, rng.integers(1, 20), replace=False)) for _ in range(n_docs)]
    term, at = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    impact = rng.integers(1, 10**6, len(term))
    df = np.bincount(term, minlength=n_terms)
    asked = [np.sort(rng.choice(n_terms, 9, replace=False)) for _ in range(n_queries)]
    query = np.repeat(np.arange(n_queries), 9)
    plan = lexical.plan_seeds(query, np.concatenate(asked), rng.integers(1, 9000, len(query)), n_queries, df)
    greatest = np.zeros(n_terms, dtype=np.int64)
    np.maximum.at(greatest, term, impact)
    lexical.plan_lists(plan, query, greatest, df)
    of, doc, docs_at, maxima, maxima_at = lexical.blocks(plan, rng.integers(0, 1 << 32, n_docs), term, impact, at)
    assert len(doc) == len(term[np.isin(term, plan.term)])
    for b in range(len(of)):
        best = maxima[maxima_at[b] : maxima_at[b + 1]]
        axis = plan.axis[plan.axis_at[of[b]] : plan.axis_at[of[b] + 1]]
        for d in doc[docs_at[b] : docs_at[b + 1]]:
            held = dict(zip(sets[d].tolist(), impact[at[d] : at[d + 1]].tolist(), strict=True))
            assert of[b] in held and all(held.get(t, 0) <= u for t, u in zip(axis.tolist(), best.tolist(), strict=True))
