"""Near duplicates by one-permutation hashing and star-shaped candidates.

Documents are sets of ``n``-word shingles. Two documents are linked if their
Jaccard similarity reaches ``threshold``; what is linked, over any number of
steps, is one component. The result is one row a document.

1. One scan hashes the shingles of a text once. The hash range is cut into
   ``BINS`` bins and the smallest hash of each is kept: one permutation gives
   all minima. Optimal densification fills an empty bin from the first filled
   one in a random order of bins that is its own, so bins of two sets agree
   with the probability of their similarity. Documents with equal sets become
   one node through a map-side aggregate; copies are never compared.
2. ``ROWS`` bins make a band, equal bands a bucket. In each bucket every member
   gets one edge, to the smallest member: edges grow with members, not with
   pairs. A pair at the threshold shares no bucket with probability
   ``(1 - threshold ** ROWS) ** BANDS`` (2e-9 at 0.85).
3. Star edges are confirmed on the full sets, which a second scan makes for the
   nodes that share a bucket. Connected components of the confirmed edges are
   labels.
4. Two members of a bucket may be linked although neither is linked to its
   centre. So every bucket whose members still have different labels is looked
   at again, in blocks: members with the centre's label against the others,
   and the others among themselves. Pairs with equal labels need no look; the
   rest is tested by sizes and bins (a pair at the threshold fails with
   probability below 1e-11), and what passes on the full sets. Tasks return
   edges that connect what is linked, never all pairs.
5. Components of all confirmed edges are the result.

Blocks are of bounded size, chosen by hash, so no task holds a whole bucket; a
centre with very many members is a skewed join that Spark splits. Nothing is
broadcast by request. Each step is a table in the shared folder, so a lost
executor costs a step at most.

Defined cases: words are runs of characters other than ``[\\x20\\x09-\\x0D]``, A-Z
in lower case; a text with fewer than ``n`` words, but not none, is one shingle
of all its words; null, empty and blank texts have none and a component of
their own; very long texts are read whole; the component's id is its smallest
non-null ``doc_id`` (null if it has none), its ``component`` the smallest row;
repeated rows and ids are told apart by row; an empty table gives no rows;
other columns are not read. Shingles are compared by 64-bit hashes. The table
must be a stored one (see ``row_number``).
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import row_number, stored
from tickwise.llm.components import connected_components
from tickwise.llm.textbytes import LOWER, NOT_SPACE, gram_hashes, hash_runs, mix, pieces_of, word_runs

N = 3
THRESHOLD = Fraction(85, 100)
BINS = 252
ROWS = 6
SMALL_SET = 64  # sets below this size are not judged by their bins
DEVIATIONS = 7
BLOCK = 256  # members on a side of a block, when bins are compared
BLOCK_WEIGHT = 512_000  # shingles, and 1000 a member, when sets are compared
MEMBER_WEIGHT = 1000

_rng = np.random.default_rng(411)
# _PROBES[j, i]: place of bin j in the order in which bin i looks for a filled
# bin (itself first), times 256, plus j; the smallest value tells the bin.
_PLACE = np.empty((BINS, BINS), dtype=np.uint16)
for _i in range(BINS):
    _others = _rng.permutation(np.delete(np.arange(BINS), _i))
    _PLACE[_i, _i] = 0
    _PLACE[_others, _i] = np.arange(1, BINS)
_PROBES = _PLACE * np.uint16(256) + np.arange(BINS, dtype=np.uint16)[:, None]


def shingles(data: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, by text, then hash, and the bounds
    of each text's part."""
    data = LOWER[data]
    starts, ends = word_runs(data, bounds, NOT_SPACE)
    words_at = np.searchsorted(starts, bounds)
    words = hash_runs(data, starts, ends)
    grams = gram_hashes(words, n)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(words_at))
    whole = np.flatnonzero(np.arange(len(grams)) + n <= words_at[1:][text[: len(grams)]])
    values, of = [grams[whole]], [text[whole]]
    for length in range(1, n):  # texts that are one shorter shingle
        few = np.flatnonzero(np.diff(words_at) == length)
        if len(few):
            values.append(mix(gram_hashes(words, length)[words_at[few]] + np.uint64(length)))
            of.append(few)
    value, owner = np.concatenate(values), np.concatenate(of)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(len(bounds)))


def minima(value: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``BINS`` densified minima, 16 bits of each, for every set (none empty)."""
    n = len(at) - 1
    owner = np.repeat(np.arange(n), np.diff(at))
    bin_ = ((value >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    cell = owner * BINS + bin_.astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))  # hashes ascend within a bin
    cell = cell[first]
    out = np.zeros(n * BINS, dtype=np.uint16)
    out[cell] = mix(value[first] ^ np.uint64(0xA5A5F00D1234ABCD)) & np.uint64(0xFFFF)
    out = out.reshape(n, BINS)
    cells_at = np.searchsorted(cell, np.arange(n + 1) * BINS)
    a = 0
    while a < n:  # some sets at a time
        b = max(a + 1, int(np.searchsorted(cells_at, cells_at[a] + (1 << 16), side="right")) - 1)
        filled = cell[cells_at[a] : cells_at[b]] % BINS
        source = np.minimum.reduceat(_PROBES[filled], cells_at[a:b] - cells_at[a], axis=0) & np.uint16(255)
        out[a:b] = np.take_along_axis(out[a:b], source.astype(np.int64), axis=1)
        a = b
    return out


def _sketches(docs: DataFrame, n: int) -> DataFrame:
    slim = docs.select(row_number(docs).alias("row"), F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, count, data, bounds in pieces_of(batch.column("text")):
                value, at = shingles(data, bounds, n)
                size = np.diff(at)
                some = np.flatnonzero(size)
                prints = np.zeros((2, count), dtype=np.uint64)
                sketch: list[bytes | None] = [None] * count
                if len(some):
                    starts = at[some]
                    prints[0, some] = np.add.reduceat(mix(value + np.uint64(0x51ED270B3A1F4D27)), starts)
                    prints[1, some] = np.add.reduceat(mix(value ^ np.uint64(0x2545F4914F6CDD1D)), starts)
                    bins = minima(value, np.append(starts, len(value)))
                    for i, k in enumerate(some.tolist()):
                        sketch[k] = bins[i].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(start, count),
                        batch.column("id").slice(start, count),
                        pa.array(size.astype(np.int64)),
                        pa.array(prints[0].view(np.int64)),
                        pa.array(prints[1].view(np.int64)),
                        pa.array(sketch, pa.binary()),
                    ],
                    names=["row", "id", "n_shingles", "print_a", "print_b", "sketch"],
                )

    id_type = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(
        scan, f"row bigint, id {id_type}, n_shingles bigint, print_a bigint, print_b bigint, sketch binary"
    )


def _sets(docs: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """``node, shingles`` of the rows in ``nodes(node)``."""
    texts = docs.select(row_number(docs).alias("node"), F.col("text").cast("string").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, count, data, bounds in pieces_of(batch.column("text")):
                value, at = shingles(data, bounds, n)
                sets = pa.ListArray.from_arrays(at.astype(np.int32), pa.array(value.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(start, count), sets], names=["node", "shingles"])

    return texts.join(nodes, "node", "left_semi").mapInArrow(scan, "node bigint, shingles array<bigint>")


def _buckets(reps: DataFrame, rows: int) -> DataFrame:
    """``key, node, n`` of every band."""
    width = 2 * rows
    keys = [F.xxhash64(F.substring("sketch", width * b + 1, width), F.lit(b)) for b in range(BINS // rows)]
    return reps.select(F.explode(F.array(*keys)).alias("key"), F.col("row").alias("node"), F.col("n_shingles").alias("n"))


def _reaches(common, n, m, threshold: Fraction):
    """Similarity of sets of ``n`` and ``m`` elements with ``common`` shared
    ones is at the threshold; for columns and arrays alike."""
    return common * threshold.denominator >= (n + m - common) * threshold.numerator


def _star_links(members: DataFrame, sets: DataFrame, sizes: DataFrame, threshold: Fraction) -> DataFrame:
    edges = members.where("node <> center").select("node", "n", "center").distinct()
    centers = sizes.select(F.col("node").alias("center"), F.col("n").alias("center_n"))
    # the smaller set cannot hold more than all of itself
    fits = edges.join(centers, "center").where(
        _reaches(F.least("n", "center_n"), F.col("n"), F.col("center_n"), threshold)
    )
    other = sets.select(F.col("node").alias("center"), F.col("shingles").alias("center_shingles"))
    common = F.size(F.array_intersect("shingles", "center_shingles"))
    both = stored(fits, "stars-edges").join(sets, "node").join(other, "center")
    return both.where(_reaches(common, F.col("n"), F.col("center_n"), threshold)).select(
        F.col("node").alias("u"), F.col("center").alias("v")
    )


def _blocks(members: DataFrame, weight, capacity: int) -> DataFrame:
    """``members(key, node, main, ...)`` dealt to blocks ``left_, right_`` of
    chunks: those with the centre's label against the others, the others among
    themselves. A chunk weighs about ``capacity``."""
    total = lambda main: F.sum(F.when(F.col("main") == main, weight).otherwise(0))
    chunks = members.groupBy("key").agg(
        F.ceil(total(True) / capacity).alias("mains"), F.greatest(F.lit(1), F.ceil(total(False) / capacity)).alias("others")
    )
    chunk = F.expr("if(main, pmod(xxhash64(node), greatest(mains, 1)), mains + pmod(xxhash64(node), others))")
    pairs = F.expr(
        """if(main, transform(sequence(mains, mains + others - 1), j -> struct(chunk as left_, j as right_)),
        transform(sequence(0L, mains + others - 1), j -> struct(least(j, chunk) as left_, greatest(j, chunk) as right_)))"""
    )
    dealt = members.join(chunks, "key").withColumn("chunk", chunk).withColumn("pair", F.explode(pairs))
    return dealt.select("*", "pair.*").drop("pair", "mains", "others", "main")


def _compare(table: pa.Table, threshold: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of a block that have different labels and pass the
    test of sizes and bins; ascending by first place."""
    chunk = table.column("chunk").to_numpy()
    left = np.flatnonzero(chunk == table.column("left_").to_numpy())
    right = np.flatnonzero(chunk == table.column("right_").to_numpy())
    if not len(left) or not len(right):
        return left[:0], left[:0]
    label, n = table.column("label").to_numpy(), table.column("n").to_numpy()
    bins = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype=np.uint16).reshape(-1, BINS)
    t = float(threshold)
    need = BINS * t - DEVIATIONS * sqrt(BINS * t * (1 - t))
    within = bool((left == right).all()) if len(left) == len(right) else False
    first, second = [], []
    for k, i in enumerate(left.tolist()):
        j = right[k + 1 :] if within else right
        j = j[label[j] != label[i]]
        j = j[_reaches(np.minimum(n[j], n[i]), n[j], n[i], threshold)]
        near = (np.minimum(n[j], n[i]) < SMALL_SET) | ((bins[j] == bins[i]).sum(axis=1) >= need)
        second.append(j[near])
        first.append(np.full(int(near.sum()), i))
    return np.concatenate(first), np.concatenate(second)


def _likely(blocks: DataFrame, threshold: Fraction) -> DataFrame:
    """``key, node`` of the members with a likely partner of another label."""

    def look(table: pa.Table) -> pa.Table:
        i, j = _compare(table, threshold)
        return table.select(["key", "node"]).take(pa.array(np.unique(np.concatenate([i, j]))))

    return blocks.groupBy("key", "left_", "right_").applyInArrow(look, "key bigint, node bigint").distinct()


def _confirmed(blocks: DataFrame, threshold: Fraction) -> DataFrame:
    """Edges ``u, v`` that connect the linked pairs of each block."""

    def confirm(table: pa.Table) -> pa.Table:
        i, j = _compare(table, threshold)
        node, label, n = (table.column(c).to_numpy() for c in ("node", "label", "n"))
        sets = table.column("shingles").combine_chunks()
        at, values = sets.offsets.to_numpy(), sets.values.to_numpy()
        root = {int(x): int(x) for x in label}

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        links = []
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            one, two = top(int(label[a])), top(int(label[b]))
            if one == two:  # connected by now
                continue
            common = len(np.intersect1d(values[at[a] : at[a + 1]], values[at[b] : at[b + 1]], assume_unique=True))
            if _reaches(common, int(n[a]), int(n[b]), threshold):
                root[max(one, two)] = min(one, two)
                links.append((int(node[a]), int(node[b])))
        u, v = zip(*links, strict=True) if links else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return blocks.groupBy("key", "left_", "right_").applyInArrow(confirm, "u bigint, v bigint")


def _missed_links(
    members: DataFrame, labels: DataFrame, reps: DataFrame, sets: DataFrame, threshold: Fraction
) -> DataFrame | None:
    """Links between members of a bucket with different labels; None where no
    bucket has such members beside its centre."""
    of_center = labels.select(F.col("node").alias("center"), F.col("label").alias("center_label"))
    open_ = (
        members.where("size > 2 and node <> center")
        .join(labels, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
        .select("key", "node", "n", "center", "label")
    )
    open_ = stored(open_, "stars-open")
    # buckets with several labels; of those with the same members, one
    several = (
        open_.groupBy("key")
        .agg(
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.min("center").alias("center"),
            F.count(F.lit(1)).alias("c"),
            F.sum(F.xxhash64("node").bitwiseAND(F.lit((1 << 40) - 1))).alias("x"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
        )
        .where("low <> high")
        .groupBy("c", "x", "y", "center")
        .agg(F.min("key").alias("key"))
        .join(of_center, "center", "left")
        .select("key", F.coalesce("center_label", "center").alias("main_label"))
    )
    several = stored(several, "stars-several")
    if several.isEmpty():
        return None
    sketch = reps.select(F.col("row").alias("node"), "sketch")
    looked = stored(
        open_.drop("center").join(several, "key").withColumn("main", F.expr("label = main_label")).drop("main_label"),
        "stars-looked",
    )
    likely = stored(_likely(_blocks(looked, F.lit(1), BLOCK).join(sketch, "node"), threshold), "stars-likely")
    if likely.isEmpty():
        return None
    rest = stored(looked.join(likely, ["key", "node"], "left_semi"), "stars-rest")
    weight = F.col("n") + F.lit(MEMBER_WEIGHT)
    blocks = _blocks(rest, weight, BLOCK_WEIGHT).join(sketch, "node").join(sets, "node")
    return stored(_confirmed(blocks, threshold), "stars-missed")


def near_components(docs: DataFrame, threshold: Fraction = THRESHOLD, n: int = N, band: int = ROWS) -> DataFrame:
    """``row, doc_id, n_shingles, component, component_id, first`` for each row
    of ``docs(doc_id, text)``; ``first`` marks one row of each component.
    ``band`` bins make a band: fewer find more candidates."""
    if BINS % band:
        raise ValueError(f"band must divide {BINS}")
    sketches = stored(_sketches(docs, n), "stars-sketches")
    prints = ["print_a", "print_b", "n_shingles"]
    classes = stored(
        sketches.where("n_shingles > 0").groupBy(*prints).agg(F.min("row").alias("node"), F.min("id").alias("id")),
        "stars-classes",
    )
    reps = sketches.join(classes.select(F.col("node").alias("row")), "row", "left_semi").select("row", "n_shingles", "sketch")
    keys = stored(_buckets(reps, band), "stars-keys")
    centers = keys.groupBy("key").agg(F.min("node").alias("center"), F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stored(keys.join(stored(centers, "stars-centers"), "key"), "stars-members")
    nodes = stored(members.select("node").distinct(), "stars-nodes")
    sets = stored(_sets(docs, nodes, n), "stars-sets")
    sizes = classes.select("node", F.col("n_shingles").alias("n"))
    links = stored(_star_links(members, sets, sizes, threshold), "stars-links")
    labels = stored(connected_components(links), "stars-labels")
    missed = _missed_links(members, labels, reps, sets, threshold)
    if missed is not None and not missed.isEmpty():
        labels = stored(connected_components(links.union(missed)), "stars-labels")
    linked = classes.join(labels, "node", "left").withColumn("component", F.coalesce("label", "node"))
    least = linked.where("label is not null").groupBy("component").agg(F.min("id").alias("least_id"))
    least = stored(least, "stars-least")
    of_class = linked.join(least, "component", "left").select(
        *prints, "component", F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("least_id")).alias("component_id")
    )
    of_class = stored(of_class, "stars-components")
    slim = sketches.select("row", "id", *prints)
    alone = F.col("n_shingles") == 0
    return slim.join(of_class, prints, "left").select(
        "row",
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.when(alone, F.col("row")).otherwise(F.col("component")).alias("component"),
        F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.expr("n_shingles = 0 or row = component").alias("first"),
    )
