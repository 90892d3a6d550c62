"""Runs against the definition, tried for every period and start."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import ODD_TEXTS, docs_of, prose
from tickwise.llm.periodic import derivation, find_runs, runs_of
from tickwise.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """Maximal runs by definition: for each period the maximal stretches of
    equal words that far apart; a stretch counts under its smallest period."""
    best, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                best.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in best.items())


def collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def batch(texts):
    words = [w for t in texts for w in t]
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    names = {}
    return np.array([names.setdefault((d, w), len(names)) for d, w in zip(text.tolist(), words)], dtype=np.int64), text


def found(texts):
    ids, text = batch(texts)
    out = [[] for _ in texts]
    at = np.cumsum([0] + [len(t) for t in texts])
    for x, y, q in zip(*(a.tolist() for a in runs_of(ids, text)), strict=True):
        d = int(np.searchsorted(at, x, side="right")) - 1
        out[d].append((x - int(at[d]), y - x, q))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=5))
def test_short_texts_over_few_words(texts):
    assert found(texts) == [brute(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(1, 9)), max_size=6),
        min_size=1,
        max_size=3,
    )
)
def test_texts_made_of_powers(parts):
    texts = [[w for root, k in part for w in root * k] for part in parts]
    assert found(texts) == [brute(t) for t in texts]


def test_long_periods_and_nested_runs():
    rng = random.Random(3)
    root = [rng.randrange(50) for _ in range(40)]
    inner = [1, 2] * 5 + [7]
    texts = [
        [99] + root * 6 + root[:13] + [98],
        inner * 4,
        [5] * 3000,
        [1, 2, 3] * 700 + [1, 2],
        list(range(500)),
        root * 4 + [1000] + root * 4,
    ]
    assert found(texts) == [brute(t) for t in texts]


def test_derivation_spells_the_texts():
    """Every symbol stands for the same words wherever it stands, no pair of
    neighbours is left twice, and each text has one root."""
    rng = random.Random(5)
    texts = [[rng.randrange(4) for _ in range(rng.randrange(2, 200))] for _ in range(20)]
    ids, text = batch(texts)
    symbol, start, middle, end = derivation(ids, text)
    spelled = {}
    for s, a, m, e in zip(symbol.tolist(), start.tolist(), middle.tolist(), end.tolist()):
        assert a < m < e
        assert spelled.setdefault(s, tuple(ids[a:e].tolist())) == tuple(ids[a:e].tolist())
    bounds = np.cumsum([0] + [len(t) for t in texts])
    nodes = set(zip(start.tolist(), end.tolist()))
    assert all((int(a), int(b)) in nodes for a, b in zip(bounds[:-1], bounds[1:]))
    assert len(symbol) == sum(len(t) - 1 for t in texts)


def rows_of(texts):
    return [(i, t) for i, t in enumerate(texts)]


def test_operator_on_odd_rows(spark):
    texts = [*ODD_TEXTS, "la " * 7, prose(1, 300) + " x y" * 9 + "\tx\n", "a b " * 6, "A a " * 2 + "a " * 5]
    got = {r.doc_id: r for r in find_runs(docs_of(spark, rows_of(texts))).collect()}
    for i, t in enumerate(texts):
        words = WORD.findall(t or "")
        want = brute(words)
        assert [tuple(r) for r in got[i].runs] == want
        assert (got[i].n_words, got[i].collapsed) == (len(words), collapse(words, want))


def test_repeated_rows_null_ids_empty_table(spark):
    rows = [(None, "a " * 6), (None, "a " * 6), (3, None)]
    assert sorted((r.doc_id is None, len(r.runs)) for r in find_runs(docs_of(spark, rows)).collect()) == [
        (False, 0),
        (True, 1),
        (True, 1),
    ]
    assert find_runs(docs_of(spark, [])).count() == 0


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        (doc_id, len(runs))
        + ((top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4)
        + (sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)), sha(collapse(words, runs)))
    )


def test_registered_query_against_the_definition(spark, tmp_path):
    rng = random.Random(11)
    rows = [(i, prose(i, rng.randrange(0, 90), 30)) for i in range(300)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(2000, "go on " * 50), (2001, prose(9, 4000, 900))]
    docs_of(spark, rows).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect())
    assert got == sorted(expected(i, t) for i, t in rows)
    assert any(r[1] for r in got)
