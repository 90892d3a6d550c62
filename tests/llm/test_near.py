from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import ODD_TEXTS, docs_of, prose
from tickwise.llm.common import ASCII_LOWER, ASCII_UPPER, WORD_CLASS
from tickwise.llm.components import connected_components
from tickwise.llm.near import HASHES, THRESHOLD, TOLERANCE, intersections, near_classes, needed_matches

WORD = re.compile(WORD_CLASS)
LOWER = str.maketrans(ASCII_UPPER, ASCII_LOWER)


def shingles(text, n=5):
    w = tuple(WORD.findall((text or "").translate(LOWER)))
    return {w[i : i + n] for i in range(len(w) - n + 1)} if len(w) >= n else {w} - {()}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    links, parent = Counter(), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 5 * common >= 4 * (len(sets[i]) + len(sets[j]) - common):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    classes = defaultdict(list)
    for i in range(len(rows)):
        classes[root(i)].append(i)
    out = []
    for members in classes.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], min(ids, default=None), links[i]) for i in members]
    return sorted(out, key=str), len(classes)


def edited(text, rng, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def check(spark, rows, **kwargs):
    got = near_classes(docs_of(spark, rows), **kwargs).collect()
    want, n_classes = brute(rows)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == want
    assert sum(r.first for r in got) == n_classes


@pytest.mark.parametrize("chunk", [512, 7])
def test_all_links_of_hubs_copies_and_chains(spark, chunk):
    rng = random.Random(11)
    rows = []
    hub = prose(1, 150, 5000)
    rows += [hub] + [edited(hub, rng, rng.randrange(0, 9)) for _ in range(60)]
    rows += [hub.upper().replace(" ", ",  ")] * 20  # equal shingles, other characters
    chain = prose(2, 120, 5000)
    for _ in range(12):
        chain = edited(chain, rng, 2)
        rows.append(chain)
    passage = prose(3, 45, 5000)
    rows += [passage + " " + prose(100 + i, 60, 5000) for i in range(30)]
    rows += [prose(200 + i, 80, 5000) for i in range(40)] + ["a b c", "A, b. c!", "a b d"]
    rng.shuffle(rows)
    check(spark, list(enumerate(rows)), chunk=chunk)


def test_awkward_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "one two three four five six"), (None, "one two three four five six"), (40, "one two three four five six")]
    rows += [(50, "lone text here with words"), (50, "lone text here with words"), (None, "quite alone among all of these"), (60, "z " * 30_000), (61, "z " * 9)]
    check(spark, rows)


def test_no_rows(spark):
    assert near_classes(docs_of(spark, [])).count() == 0
    assert near_classes(docs_of(spark, [(1, None)])).count() == 1


def test_long_near_copies(spark):
    rng = random.Random(4)
    long = prose(5, 25_000, 40_000)
    check(spark, [(1, long), (2, edited(long, rng, 300)), (3, edited(long, rng, 900)), (4, prose(6, 25_000, 40_000))])


@given(st.lists(st.sets(st.integers(0, 60), min_size=1, max_size=40), min_size=2, max_size=12))
@settings(max_examples=60, deadline=None)
def test_intersections_of_any_sets(sets):
    arrays = [np.array(sorted(s), dtype=np.uint64) for s in sets]
    i, j = np.triu_indices(len(sets), 1)
    assert intersections(arrays, i, j).tolist() == [len(sets[a] & sets[b]) for a, b in zip(i, j, strict=True)]


def test_posterior_bounds():
    bounds = needed_matches()
    assert [n for n, _ in bounds][-1] == HASHES
    for n, least in bounds:
        # numeric integral of the posterior
        grid = np.linspace(0, 1, 20_001)
        for matches, dropped in ((least - 1, True), (least, False)):
            if matches < 0:
                continue
            density = matches * np.log(np.maximum(grid, 1e-300)) + (n - matches) * np.log(np.maximum(1 - grid, 1e-300))
            density = np.exp(density - density.max())
            tail = density[grid >= THRESHOLD].sum() / density.sum()
            assert (tail < TOLERANCE * 1.1) if dropped else (tail > TOLERANCE * 0.9)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(i, i + 1) for i in range(300, 360)] + [(500, i) for i in range(400, 600)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    want = {x: root(x) for a, b in edges if a != b for x in (a, b)}
    got = connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert len(got) == len(want) and {r.node: r.label for r in got} == want
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_words_of_exchanged_blocks_are_not_linked(spark, tmp_path):
    a, b = "a" * 4096, "b" * 4096
    rows = [(1, a + b), (2, b + a), (3, a + b + a), (4, a + a + b)]
    docs_of(spark, rows).write.parquet(f"{tmp_path}/d")
    got = near_classes(spark.read.parquet(f"{tmp_path}/d")).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == [(i, i, 0) for i in range(1, 5)]
