"""Periodic runs of words, found on a grammar of each text.

A run is a stretch of consecutive words with smallest period ``q`` (words
``q`` apart are equal) and at least ``max(LEAST, EXPONENT * q)`` words that
cannot be extended. Repeated phrases, stuttering generators and copied list
items are such runs.

1. Re-Pair: the words of a text, as ids, are compressed by replacing pairs of
   neighbours that occur again by a new symbol, the most frequent ones first.
   A round replaces all occurrences that are more frequent than the pairs they
   overlap, in all texts of a batch at once, until no pair of a text occurs
   twice. What is left of a text becomes the leaves of a balanced tree, so
   every text has one derivation.
2. Each symbol stands for two parts and the boundary between them. The runs
   that cross this boundary are computed once a symbol: one side holds two
   periods, so the three words around the boundary come again one period on;
   the places where they do, in sorted order, are the candidate periods, and
   each is confirmed by extending the match both ways. A multiple of a period
   found before is skipped, so only smallest periods are kept.
3. Every run lies whole in a lowest symbol and crosses its boundary there. The
   runs of a symbol are moved to every place of the derivation where it
   stands; what lies inside a longer run of the same period is dropped, which
   leaves the maximal ones.

The work is one scan without a shuffle: a task holds one piece of a batch
(about 4 MB of text, or one text where it is longer) as arrays.

Defined cases: words are runs of characters other than ``[\\x20\\x09-\\x0D]``
and are compared exactly; null, empty and blank texts have no words and no
runs; very long texts are read whole; repeated rows and null ids give a row
each; an empty table gives no rows; only ``doc_id`` and ``text`` are read, so
other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.textbytes import NOT_SPACE, pieces_of, word_runs

EXPONENT = 4
LEAST = 6

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _ranks(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Dense numbers of the pairs ``(high, low)``, both below 2**32."""
    return np.unique(high.astype(np.int64) << 32 | low, return_inverse=True)[1]


def derivation(ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair over all texts of a batch. ``ids`` are the words, distinct
    between texts; ``text`` is the number of each word's text, ascending.
    Gives, for every inner node of the derivations, its symbol and the word
    positions where it starts, where its second part starts and where it
    ends."""
    nodes: list[tuple[np.ndarray, ...]] = []
    rest: list[tuple[np.ndarray, ...]] = []
    symbol, start, of = ids.astype(np.int64), np.arange(len(ids), dtype=np.int64), text
    end = start + 1
    fresh = int(symbol.max()) + 1 if len(symbol) else 0
    while len(symbol) > 1:
        same = of[:-1] == of[1:]
        key = np.where(same, symbol[:-1] << 32 | symbol[1:], -1)
        twice = same & (symbol[:-1] == symbol[1:])
        if twice.any():  # of overlapping pairs of one symbol, every second counts
            at = np.arange(len(twice))
            begins = twice.copy()
            begins[1:] &= ~twice[:-1]
            key[twice & ((at - np.maximum.accumulate(np.where(begins, at, 0))) % 2 == 1)] = -1
        _, pair, count = np.unique(key, return_inverse=True, return_counts=True)
        frequency = np.where(key < 0, 0, count[pair])
        frequency[frequency < 2] = 0
        if not frequency.any():
            break
        above = (frequency[1:] > frequency[:-1]) | ((frequency[1:] == frequency[:-1]) & (key[1:] > key[:-1]))
        chosen = frequency > 0
        chosen[1:] &= above
        chosen[:-1] &= ~above
        uses = np.bincount(pair[chosen], minlength=len(count))
        chosen &= uses[pair] >= 2
        first = np.flatnonzero(chosen)
        name = fresh + (np.cumsum(uses >= 2) - 1)[pair[first]]
        fresh += int((uses >= 2).sum())
        nodes.append((name, start[first], start[first + 1], end[first + 1]))
        symbol[first], end[first] = name, end[first + 1]
        keep = np.ones(len(symbol), dtype=bool)
        keep[first + 1] = False
        # texts in which no pair came again are done
        open_ = np.zeros(int(of[-1]) + 1, dtype=bool)
        open_[of[:-1][frequency > 0]] = True
        done = keep & ~open_[of]
        if done.any():
            rest.append((start[done], end[done], of[done]))
            keep &= open_[of]
        symbol, start, end, of = symbol[keep], start[keep], end[keep], of[keep]
    rest.append((start, end, of))
    start, end, of = (np.concatenate(part) for part in zip(*rest, strict=True))
    order = np.argsort(start)
    start, end, of = start[order], end[order], of[order]
    while len(start) > 1:  # a balanced tree over what is left
        begins = np.ones(len(of), dtype=bool)
        begins[1:] = of[1:] != of[:-1]
        at = np.arange(len(of))
        odd = (at - np.maximum.accumulate(np.where(begins, at, 0))) % 2 == 1
        second = np.flatnonzero(odd)
        if not len(second):
            break
        nodes.append((fresh + np.arange(len(second)), start[second - 1], start[second], end[second]))
        fresh += len(second)
        end[second - 1] = end[second]
        start, end, of = start[~odd], end[~odd], of[~odd]
    if not nodes:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    return tuple(np.concatenate(part) for part in zip(*nodes, strict=True))


def _extend(ids: np.ndarray, left: np.ndarray, right: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
    """How many words agree from ``left`` and ``right`` on, at most ``most``,
    forwards (``way`` 1) or backwards (-1)."""
    out = np.zeros(len(left), dtype=np.int64)
    active = np.flatnonzero(most > 0)
    width = 8
    while len(active):
        width = max(8, min(width, (1 << 21) // len(active)))
        at = out[active, None] + np.arange(width)
        inside = at < most[active, None]
        at = np.where(inside, at, 0)
        equal = inside & (ids[left[active, None] + way * at] == ids[right[active, None] + way * at])
        run = np.where(equal.all(axis=1), width, equal.argmin(axis=1))
        out[active] += run
        active = active[(run == width) & (out[active] < most[active])]
        width = min(width * 4, 4096)
    return out


def crossing_runs(ids: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs inside ``[start, end)`` that hold the words on both sides of
    ``middle``, for each node. Gives node index, start, end, period."""
    n = len(ids)
    found: list[tuple[np.ndarray, ...]] = []
    if n < LEAST or not len(start):
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    around = -1 - np.arange(n, dtype=np.int64)  # ends of the batch match nothing
    around[1:-1] = _ranks(_ranks(ids[:-1], ids[1:])[:-1], ids[2:])
    order = np.argsort(around, kind="stable")
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    for way in (1, -1):  # the side that holds two periods: after, before
        node = np.arange(len(start))
        word = middle if way == 1 else middle - 1
        room = end - middle if way == 1 else middle - start
        period, reach = np.zeros(len(start), dtype=np.int64), np.zeros(len(start), dtype=np.int64)
        step = 0
        while len(node):
            step += 1
            rank = place[word[node]] + way * step
            node, rank = node[(rank >= 0) & (rank < n)], rank[(rank >= 0) & (rank < n)]
            other = order[rank]
            here = word[node]
            q = way * (other - here)
            in_reach = (around[other] == around[here]) & (EXPONENT * q <= end[node] - start[node]) & (2 * q <= room[node])
            node, other, here, q = node[in_reach], other[in_reach], here[in_reach], q[in_reach]
            known = period[node]
            again = (known > 0) & (q % np.maximum(known, 1) == 0) & (reach[node] >= 2 * q)
            i, o, h, p = node[~again], other[~again], here[~again], q[~again]
            if not len(i):
                continue
            # from the boundary towards the longer side, then across it
            ahead = _extend(ids, h, o, room[i] - p, way)
            across = h - way
            behind = _extend(ids, across, across + way * p, (h - start[i]) if way == 1 else (end[i] - h - 1), -way)
            side = p + ahead  # words of the run on the longer side
            good = (ahead >= p) & (behind >= 1) & (side + behind >= np.maximum(LEAST, EXPONENT * p))
            i, p, side, behind = i[good], p[good], side[good], behind[good]
            period[i], reach[i] = p, side
            x = middle[i] - (behind if way == 1 else side)
            found.append((i, x, x + side + behind, p))
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def maximal(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals that lie in no other of the same period, by start and period."""
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    if len(start):
        group = np.cumsum(np.concatenate([[0], (period[1:] != period[:-1]).astype(np.int64)]))
        high = np.maximum.accumulate(end + group * (int(end.max()) + 1)) - group * (int(end.max()) + 1)
        keep = np.ones(len(start), dtype=bool)
        keep[1:] = (period[1:] != period[:-1]) | (end[1:] > high[:-1])
        start, end, period = start[keep], end[keep], period[keep]
        order = np.lexsort((period, start))
        start, end, period = start[order], end[order], period[order]
    return start, end, period


def runs_of(ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All maximal runs of a batch of texts: start, end and period in word
    positions of the batch, by start, then period."""
    symbol, start, middle, end = derivation(ids, text)
    long_ = end - start >= LEAST
    symbol, start, middle, end = symbol[long_], start[long_], middle[long_], end[long_]
    order = np.argsort(symbol, kind="stable")
    symbol, start = symbol[order], start[order]
    names, first = np.unique(symbol, return_index=True)
    node, x, y, q = crossing_runs(ids, start[first], middle[order][first], end[order][first])
    # to every place where the symbol stands
    low, high = first[node], np.append(first, len(symbol))[1:][node] if len(names) else first[node]
    times = high - low
    place = np.repeat(low, times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    shift = start[place] - np.repeat(start[low], times)
    return maximal(np.repeat(x, times) + shift, np.repeat(y, times) + shift, np.repeat(q, times))


def _batch(doc_ids: pa.Array, data: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    starts, ends = word_runs(data, bounds, NOT_SPACE)
    words_at = np.searchsorted(starts, bounds)
    n_words = np.diff(words_at)
    text = np.repeat(np.arange(len(n_words)), n_words)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    letters = data[NOT_SPACE[data]]
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters))
    numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    ids = _ranks(text, numbers) if len(numbers) else numbers
    x, y, q = runs_of(ids, text)
    # words after the first period of a run are dropped
    depth = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(depth, x + q, 1)
    np.add.at(depth, y, -1)
    kept = np.cumsum(depth)[:-1] == 0
    kept_at = np.concatenate([[0], np.cumsum(kept)])[words_at].astype(np.int32)
    collapsed = pc.binary_join(pa.ListArray.from_arrays(kept_at, words.take(pa.array(np.flatnonzero(kept)))), " ")
    runs = pa.StructArray.from_arrays(
        [pa.array(x - words_at[text[x]]), pa.array(y - x), pa.array(q)], names=["start", "length", "period"]
    )
    runs_at = np.searchsorted(x, words_at).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(n_words.astype(np.int64)), pa.ListArray.from_arrays(runs_at, runs), collapsed],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, count, data, bounds in pieces_of(batch.column("text")):
            yield _batch(batch.column("doc_id").slice(at, count), data, bounds)


def find_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for each row of ``docs(doc_id,
    text)``: the runs by start, then period, and the text with every run cut to
    its first period, words joined by one space."""
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(_find, f"doc_id {id_type}, n_words bigint, runs array<{RUN}>, collapsed string")
