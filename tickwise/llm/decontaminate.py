"""Benchmark decontamination by winnowing.

A window is ``n`` consecutive words of a benchmark item (an item of fewer
words is one window). For windows of ``t`` words, k-grams of ``k = t // 2``
words are hashed and the minima of every run of ``t - k + 1`` k-grams are the
fingerprints: any ``t`` words that a document and an item share hold a
fingerprint of both, so no shared window can be missed.

* The item fingerprints and window hashes fill one Bloom filter of at most
  2^27 bits, which is what the tasks get: its size is bounded however large
  the benchmark is. It is the first side of the fingerprint join.
* A task hashes the words of its documents, winnows them, keeps fingerprints
  that the filter holds, and *extends* each to the windows around it. Windows
  that the filter holds too leave the task with their words.
* These few windows are joined with the windows of the items by their words,
  so the result is exact: hashes only ever let too many through. Items are
  counted from the distinct windows of a document.

Short items: each length below ``n`` that occurs in the benchmark (at most
``n - 1``) is winnowed with its own ``k``.

Defined cases: a null or empty text has no words and no hits; items without
words match nothing; an item with a null id makes hits but is not listed or
counted; repeated rows are judged each on its own; an empty benchmark hits
nothing, an empty table gives no rows. Other columns are not read.
The document table must give the same rows each time it is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import row_number, stored
from tickwise.llm.textbytes import POSITION_WEIGHT, gram_hashes, hash_runs, mix, pieces_of, words_of

WINDOW = 13
MIN_BITS, MAX_BITS = 20, 27


def gram_words(length: int) -> int:
    """Words of a k-gram for windows of ``length`` words."""
    return max(1, length // 2)


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of each ``width`` values in a row."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = best(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


def _salted(hashes: np.ndarray, length: int, what: int) -> np.ndarray:
    return mix(hashes + np.uint64((2 * length + what + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))


def fingerprints(words: np.ndarray, text_of: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For windows of ``length`` words: hash of the k-gram at each word,
    whether winnowing selects it, and whether a window starts at the word.
    ``text_of`` tells the text of each word; no window crosses texts."""
    k = gram_words(length)
    n_windows = len(words) - length + 1
    if n_windows <= 0:
        empty = np.zeros(0, dtype=bool)
        return np.zeros(0, dtype=np.uint64), empty, empty
    grams = _salted(gram_hashes(words, k), length, 0) | np.uint64(1)
    whole = text_of[:n_windows] == text_of[length - 1 :]
    run = length - k + 1
    least = _sliding(grams, run, np.minimum)
    least = np.where(whole, least, np.uint64(0))
    # a k-gram is selected if it is the least of some run it lies in
    padded = np.concatenate([np.zeros(run - 1, dtype=np.uint64), least, np.zeros(run - 1, dtype=np.uint64)])
    return grams, _sliding(padded, run, np.maximum) == grams, whole


def held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes (unsigned 64-bit) a filter of ``key_filter`` holds."""
    mask = np.uint64(64 * len(bits) - 1)

    def bit(p):
        return (bits[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1)

    return (bit(hashes & mask) & bit((hashes >> np.uint64(32)) & mask)).astype(bool)


def _window_text(data: bytes, starts: np.ndarray, ends: np.ndarray, at: int, length: int) -> str:
    return b" ".join([data[starts[i] : ends[i]] for i in range(at, at + length)]).decode()


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = WINDOW) -> DataFrame:
    """One row per item with words: ``item, length, windows, keys`` (keys: the
    hashes of its fingerprints and windows)."""
    source = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("t"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, count, raw, bounds in pieces_of(batch.column(1)):
                data, starts, ends, words_at = words_of(raw, bounds)
                text = data.tobytes()
                rows: list[tuple] = []
                for i in range(count):
                    a, b = int(words_at[i]), int(words_at[i + 1])
                    if a == b:
                        continue
                    length = min(n, b - a)
                    words = hash_runs(data, starts[a:b], ends[a:b])
                    grams, chosen, _ = fingerprints(words, np.zeros(b - a, dtype=np.int8), length)
                    spans = _salted(gram_hashes(words, length), length, 1)
                    keys = np.concatenate([grams[chosen], spans]).view(np.int64).tolist()
                    windows = sorted({_window_text(text, starts, ends, j, length) for j in range(a, b - length + 1)})
                    rows.append((ids[first + i], length, windows, keys))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(c, type=t)
                            for c, t in zip(
                                zip(*rows, strict=True),
                                (pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64())),
                                strict=True,
                            )
                        ],
                        names=["item", "length", "windows", "keys"],
                    )

    return source.mapInArrow(task, "item string, length int, windows array<string>, keys array<bigint>")


def key_filter(items: DataFrame) -> np.ndarray:
    """A Bloom filter of all hashes in the lists ``keys``, as 64-bit words (at
    most 16 MB; beyond about two million keys it only lets more through)."""
    n_keys = items.agg(F.sum(F.size("keys"))).first()[0] or 0
    bits = min(MAX_BITS, max(MIN_BITS, (64 * n_keys).bit_length()))
    mask = F.lit((1 << bits) - 1)
    key = F.col("key")
    place = F.explode(F.array(key.bitwiseAND(mask), F.shiftrightunsigned(key, 32).bitwiseAND(mask)))
    rows = (
        items.select(F.explode("keys").alias("key"))
        .select(place.alias("p"))
        .select(F.shiftright("p", 6).cast("int").alias("w"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("m"))
        .groupBy("w")
        .agg(F.bit_or("m").alias("m"))
        .toPandas()
    )
    out = np.zeros((1 << bits) // 64, dtype=np.uint64)
    out[rows["w"].to_numpy()] = rows["m"].to_numpy().astype(np.int64).view(np.uint64)
    return out


def candidate_windows(
    docs: DataFrame, filter_bits: np.ndarray, lengths: list[int], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``row, id, n_words, found`` with the windows
    that extend a fingerprint of the filter: ``start, length, window``."""
    source = docs.select(
        row_number(docs).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("t")
    )
    shared = docs.sparkSession.sparkContext.broadcast(filter_bits)
    id_type = source.schema["id"].dataType.simpleString()
    found_type = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("window", pa.string())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for first, count, raw, bounds in pieces_of(batch.column(2)):
                data, starts, ends, words_at = words_of(raw, bounds)
                n_words = np.diff(words_at)
                found: list[list[dict]] = [[] for _ in range(count)]
                words = hash_runs(data, starts, ends)
                text_of = np.repeat(np.arange(count), n_words)
                text = data.tobytes() if lengths else b""
                for length in lengths:
                    grams, chosen, whole = fingerprints(words, text_of, length)
                    if not len(grams):
                        continue
                    chosen = np.flatnonzero(chosen)
                    hit = np.zeros(len(grams), dtype=np.int32)
                    hit[chosen[held(bits, grams[chosen])]] = 1
                    upto = np.concatenate([[0], np.cumsum(hit)])
                    run = length - gram_words(length) + 1
                    near = np.flatnonzero(whole & (upto[run:][: len(whole)] > upto[: len(whole)]))
                    spans = np.zeros(len(near), dtype=np.uint64)
                    for j in range(length):
                        spans += words[near + j] * POSITION_WEIGHT[j + 17]
                    near = near[held(bits, _salted(mix(spans), length, 1))]
                    for at in near.tolist():
                        i = int(text_of[at])
                        found[i].append(
                            {
                                "start": at - int(words_at[i]),
                                "length": length,
                                "window": _window_text(text, starts, ends, at, length),
                            }
                        )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, count),
                        batch.column(1).slice(first, count),
                        pa.array(n_words.astype(np.int64)),
                        pa.array(found, type=found_type),
                    ],
                    names=["row", "id", "n_words", "found"],
                )

    return source.mapInArrow(
        task, f"row bigint, id {id_type}, n_words bigint, found array<struct<start:int,length:int,window:string>>"
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    n: int = WINDOW,
) -> DataFrame:
    """One row per document: ``row`` (its ``row_number``), ``<id_col>, n_words, n_hit`` (words inside an occurrence of an
    item's window), ``items`` (ids of items with occurring windows, as
    strings, sorted) and ``spans`` (the windows' starts and lengths in words)."""
    items = stored(item_windows(benchmark, item_col, text_col, n), "item-windows")
    lengths = sorted(r.length for r in items.select("length").distinct().collect())  # at most n
    rows = stored(candidate_windows(docs, key_filter(items), lengths, id_col, text_col), "doc-windows")
    found = rows.select("row", F.explode("found").alias("f")).select("row", "f.*")
    owners = items.select("item", F.explode("windows").alias("window"))
    real = found.join(owners.select("window").distinct(), "window", "left_semi")
    spans = real.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("spans"))
    listed = (
        real.select("row", "window")
        .distinct()
        .join(owners.where("item is not null").distinct(), "window")
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["start"] + s["length"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(a["end"], s["start"]))).alias("n"),
        ),
        lambda a: a["n"].cast("long"),
    )
    return (
        rows.select("row", "id", "n_words")
        .join(spans, "row", "left")
        .join(listed, "row", "left")
        .select(
            "row",
            F.col("id").alias(id_col),
            "n_words",
            F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            "spans",
        )
    )


def is_contaminated():
    """The contract's rule: a hit, and one word in twenty or more is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
