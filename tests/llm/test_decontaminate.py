from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tests.llm.helpers import ODD_TEXTS, docs_of, prose
from tickwise.llm.common import ASCII_LOWER, ASCII_UPPER, WORD_CLASS
from tickwise.llm.decontaminate import candidate_windows, contamination, fingerprints, gram_words, is_contaminated
from tickwise.llm.textbytes import hash_runs

WORD = re.compile(WORD_CLASS)
LOWER = str.maketrans(ASCII_UPPER, ASCII_LOWER)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, n=13):
    windows = {}
    for item, text in items:
        w = words(text)
        m = min(n, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + m]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = {}
    for d, text in docs:
        w = words(text)
        hit, found = set(), set()
        for m in lengths:
            for i in range(len(w) - m + 1):
                owners = windows.get(tuple(w[i : i + m]))
                if owners:
                    hit.update(range(i, i + m))
                    found |= owners
        out[d] = (len(w), len(hit), sorted(str(x) for x in found if x is not None))
    return out


def run(spark, docs, items, n=13):
    rows = contamination(docs_of(spark, docs), spark.createDataFrame(items, "item_id bigint, text string"), n=n)
    got = rows.withColumn("contaminated", is_contaminated()).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words)
    return {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got}


def test_against_brute_force(spark):
    rng = random.Random(5)
    items = [(i, prose(100 + i, rng.choice([3, 8, 12, 13, 14, 40]), 60)) for i in range(25)]
    items += [(50, items[3][1]), (None, "only here with no id at all"), (51, ""), (52, None), (53, "!!"), (54, "solo"), (55, "dup dup dup dup")]
    docs = []
    for d in range(60):
        parts = [prose(d, rng.randrange(0, 80), 60)]
        for _ in range(rng.randrange(3)):
            w = words(rng.choice(items)[1])
            a = rng.randrange(0, max(1, len(w)))
            parts += [" ".join(w[a : a + rng.randrange(1, 30)]).upper(), prose(1000 + d, rng.randrange(0, 9), 60)]
        docs.append((d, ", ".join(parts)))
    docs += [(100 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(200, "dup " * 50), (201, "It is SOLO, only here with no id at all")]
    assert run(spark, docs, items) == brute(docs, items)


def test_any_window_length_keeps_the_guarantee():
    rng = np.random.default_rng(1)
    for length in range(1, 14):
        for _ in range(30):
            shared = rng.integers(1, 9, length, dtype=np.uint64)
            selected = []
            for _ in range(2):
                before, after = rng.integers(1, 9, rng.integers(0, 20), dtype=np.uint64), rng.integers(1, 9, rng.integers(0, 20), dtype=np.uint64)
                text = np.concatenate([before, shared, after])
                _, chosen, _ = fingerprints(text, np.zeros(len(text), dtype=int), length)
                inside = chosen[len(before) : len(before) + length - gram_words(length) + 1]
                selected.append(set(np.flatnonzero(inside)))
            assert selected[0] & selected[1]


def test_long_text_and_repeats(spark):
    item = prose(7, 30)
    long = prose(8, 40_000) + " " + item + " " + prose(9, 40_000)
    docs = [(1, long), (2, item), (2, item), (None, item)]
    got = contamination(docs_of(spark, docs), spark.createDataFrame([(5, item)], "item_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_hit, tuple(r["items"])) for r in got) == [(0, 30, ("5",)), (1, 30, ("5",)), (2, 30, ("5",)), (2, 30, ("5",))]


@pytest.mark.parametrize("items", [[], [(1, None)]])
def test_nothing_to_find(spark, items):
    assert run(spark, [(1, "a b c"), (2, None)], items) == {1: (3, 0, []), 2: (0, 0, [])}
    assert run(spark, [], [(1, "a b c")]) == {}


def test_crowded_filter_only_lets_more_through(spark):
    docs = docs_of(spark, [(1, prose(1, 50))])
    full = np.full(1 << 14, (1 << 64) - 1, dtype=np.uint64)
    assert len(candidate_windows(docs, full, [13]).first().found) == 50 - 12


def test_hash_of_a_run_depends_on_its_bytes_alone():
    a, b = np.frombuffer(b"xx word yy", np.uint8), np.frombuffer(b"word", np.uint8)
    assert hash_runs(a, np.array([3]), np.array([7])) == hash_runs(b, np.array([0]), np.array([4]))
