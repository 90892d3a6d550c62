from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ODD_TEXTS, docs_of, prose
from tickwise.llm.common import stored
from tickwise.llm.sharding import assign_shards


def check(rows, texts, n_shards, spread):
    assert len(rows) == len(texts)
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
        assert 0 <= shard < n_shards
    sizes = [sum(r.size for r in rows if r.shard == s) for s in range(n_shards)]
    assert max(sizes) - min(sizes) <= spread
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts)
    assert sorted((r.size, r.text_crc32) for r in rows) == want


@pytest.mark.parametrize("kwargs", [{}, {"min_ranges": 4, "range_bytes": 500}])
def test_sizes_are_near_equal(spark, kwargs):
    texts = [prose(i, i % 90) for i in range(300)] + ODD_TEXTS[:5] + ["same text here"] * 200
    rows = assign_shards(docs_of(spark, list(enumerate(texts))), 16, **kwargs).collect()
    check(rows, texts, 16, 2 * max(len(t or "") for t in texts) + 2)


def test_one_text_for_all(spark):
    texts = ["copy"] * 400
    rows = assign_shards(docs_of(spark, [(5, t) for t in texts]), 8, min_ranges=4).collect()
    check(rows, texts, 8, 10)


def test_copies_lie_together_where_a_shard_holds_them(spark):
    texts = [prose(i % 40, 60) for i in range(400)]
    rows = assign_shards(docs_of(spark, list(enumerate(texts))), 4).collect()
    homes = {}
    for r in rows:
        homes.setdefault(r.text_crc32, set()).add(r.shard)
    assert sum(len(h) > 1 for h in homes.values()) <= 3


def test_few_rows_nulls_and_none(spark):
    rows = assign_shards(docs_of(spark, [(None, None), (1, "x" * 9000)]), 16).collect()
    assert sorted(r.slot for r in rows) == [0, 0] and len({r.shard for r in rows}) == 2
    assert assign_shards(docs_of(spark, []), 16).count() == 0


@pytest.mark.parametrize("n_shards", [1, 5, 16])
def test_equals_the_whole_line_of_bytes(spark, n_shards):
    """Brute force: all records in key order, end to end, and the middle of
    each on that line; the drawn splitters must not show in the result."""
    texts = [prose(i, i % 60) for i in range(250)] + ["a copy"] * 150 + ODD_TEXTS + ["long " * 3000]
    docs = stored(docs_of(spark, [(i % 301, t) for i, t in enumerate(texts)]).coalesce(1), "test-docs")
    row, text = F.monotonically_increasing_id(), F.coalesce("text", F.lit(""))
    line = sorted(
        docs.select(
            F.xxhash64(text), F.xxhash64("doc_id", row), row, "doc_id", F.octet_length(text) + 1, F.crc32(text.cast("binary"))
        ).collect()
    )
    total, end, want, held = sum(r[4] for r in line), 0, [], [0] * n_shards
    for r in line:
        end += r[4]
        shard = min(int((end - r[4] / 2) / total * n_shards), n_shards - 1)
        want.append((r[3], r[4], r[5], shard, held[shard]))
        held[shard] += 1
    for kwargs in ({}, {"min_ranges": 3, "range_bytes": 1 << 30}, {"min_ranges": 40, "range_bytes": 300}):
        got = assign_shards(docs, n_shards, **kwargs).collect()
        assert sorted((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got) == sorted(want)
