"""Components against all pairs, with few bands and many, and sets by hand."""

from __future__ import annotations

import random
import re
from fractions import Fraction

import numpy as np
import pytest

from tests.llm.helpers import ODD_TEXTS, docs_of, prose
from tickwise.llm.common import ASCII_LOWER, ASCII_UPPER
from tickwise.llm.queries import QUERIES
from tickwise.llm.stars import BINS, minima, near_components, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(ASCII_UPPER, ASCII_LOWER)


def shingle_set(text, n=3):
    w = tuple(WORD.findall((text or "").translate(LOWER)))
    return {w[i : i + n] for i in range(len(w) - n + 1)} if len(w) >= n else {w} - {()}


def brute(rows, t=Fraction(85, 100)):
    sets = [shingle_set(x) for _, x in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and common >= t * (len(sets[i]) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    of = [root(i) for i in range(len(rows))]
    least = {}
    for r, (i, _) in zip(of, rows, strict=True):
        least[r] = min(x for x in (least.get(r), i) if x is not None) if (least.get(r), i) != (None, None) else None
    out = [(i, len(s), least[r]) for r, s, (i, _) in zip(of, sets, rows, strict=True)]
    return sorted(out, key=str), len(set(of))


def edited(text, rng, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def check(spark, tmp_path, rows, **kwargs):
    path = f"{tmp_path}/docs-{random.randrange(10**9)}"
    docs_of(spark, rows).repartition(3).write.parquet(path)
    got = near_components(spark.read.parquet(path), **kwargs).collect()
    want, n = brute(rows, kwargs.get("threshold", Fraction(85, 100)))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert sum(r["first"] for r in got) == n == len({r.component for r in got})


def test_copies_chains_and_hubs(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, prose(i, rng.randrange(1, 200))) for i in range(60)]
    chain = prose(900, 300)
    for i in range(25):  # each step is linked, the ends are not
        rows.append((100 + i, chain))
        chain = edited(chain, rng, 3)
    hub = prose(901, 150)
    rows += [(200 + i, edited(hub, rng, i % 9)) for i in range(40)]
    rows += [(300 + i, prose(902, 80)) for i in range(30)]
    rows += [(400 + i, " ".join(f"t{(i + k) % 40}" for k in range(20))) for i in range(20)]
    rng.shuffle(rows)
    check(spark, tmp_path, rows)


@pytest.mark.parametrize("band", [1, 2])
def test_links_between_members_that_miss_the_centre(spark, tmp_path, band, monkeypatch):
    """One bin a band puts everything into common buckets, so most links are
    between members of a bucket whose centre is linked to neither; small
    chunks make several blocks of a bucket."""
    import tickwise.llm.stars as stars

    monkeypatch.setattr(stars, "BLOCK", 7)
    monkeypatch.setattr(stars, "BLOCK_WEIGHT", 9000)
    rng = random.Random(2)
    base = prose(77, 120)
    families = [edited(base, rng, 14) for _ in range(12)]
    rows = [(5 * i, base if i == 0 else edited(rng.choice(families), rng, rng.randrange(0, 3))) for i in range(90)]
    check(spark, tmp_path, rows, band=band)


def test_odd_rows_null_and_repeated_ids(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "one two three four"), (None, "One TWO three four")]
    rows += [(7, "one two three four"), (7, "x y"), (None, "x  y"), (50, "x\ty"), (None, "alone and null"), (51, "é É"), (52, "É É")]
    rows += [(60, "a" * 4096 + "b" * 4096), (61, "b" * 4096 + "a" * 4096), (62, "long " + "c" * 9000 + " text"), (63, "long " + "c" * 9000 + " text")]
    check(spark, tmp_path, rows)
    check(spark, tmp_path, [])
    check(spark, tmp_path, [(1, None), (2, "")])


def test_other_threshold(spark, tmp_path):
    rng = random.Random(4)
    base = prose(5, 60)
    check(spark, tmp_path, [(i, edited(base, rng, i % 6)) for i in range(30)], threshold=Fraction(1, 2), band=2)


def test_bins_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(6)
    for size in (3, 20, 200, 3000):
        agree, want = [], []
        for _ in range(60):
            union = np.unique(rng.integers(1, 1 << 63, size + 1, dtype=np.uint64) * np.uint64(2))
            cut = max(1, size // 8)
            a, b = union[cut:], union[: len(union) - cut]
            bins = minima(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            agree.append((bins[0] == bins[1]).mean())
            want.append(len(np.intersect1d(a, b)) / len(union))
        assert bins.shape == (2, BINS) and abs(np.mean(agree) - np.mean(want)) < 0.06


def test_shingles_of_a_batch():
    texts = ["a b c a b c", "", "a b", "A b C", "x"]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    value, at = shingles(data, np.cumsum([0] + [len(t) for t in texts]), 3)
    assert np.diff(at).tolist() == [3, 0, 1, 1, 1]
    assert value[at[3]] in value[at[0] : at[1]]


def test_registered_query(spark, tmp_path):
    rng = random.Random(8)
    base = prose(3, 90)
    rows = [(100 - i, edited(base, rng, i % 5)) for i in range(40)] + [(i + 200, t) for i, t in enumerate(ODD_TEXTS)]
    docs_of(spark, rows).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_minhash_near_dedup"](spark, str(tmp_path)).collect()
    want, _ = brute(rows)
    assert sorted((tuple(r) for r in got), key=str) == sorted(((*w, w[0] == w[2]) for w in want), key=str)
