"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of ``n``-word shingles. The join finds every pair of
documents with similarity ``threshold`` or more and returns one row per
document: its class (connected documents) and its number of links. Pairs are
never rows: they are looked at in blocks inside tasks, which return counts
and, per block, a forest that connects what is linked.

1. One scan hashes words and shingles and stores a slim row per document: a
   128-bit fingerprint of its shingle set and ``HASHES`` MinHash values.
   Documents with equal sets become one *class representative* through a
   map-side aggregate; copies weigh in as a count and are never expanded.
2. ``BANDS`` keys of ``ROWS`` MinHash values each put similar representatives
   into common buckets; a pair at the threshold misses all with probability
   ``(1 - threshold ** ROWS) ** BANDS`` (5e-9 at 0.8). Buckets with the same
   members are compared once.
3. Inside a bucket, MinHash values are compared a few at a time. A pair whose
   posterior probability (uniform prior) of reaching the threshold falls below
   ``TOLERANCE`` is dropped. What survives connects representatives into
   candidate clusters.
4. The texts of clusters are read in a second scan. All pairs of a cluster
   go through the same test and are then verified on the shingle sets
   exactly; links are counted with the weights of the classes.
5. Connected components of the verified links are the classes.

Large buckets and clusters are cut into chunks of bounded size, and pairs of
chunks are compared in tasks of their own, so no task holds a whole group. A
broadcast is made of one filter of at most 16 MB that marks the rows whose
texts step 4 needs.

Defined cases: words are those of the decontamination contract (lower-case
A-Z, ASCII punctuation cut); a text with fewer than ``n`` words, but not none,
is one shingle; a text without words has no links and a class of its own; ties
fall to the smallest id, then the first row; a null id is larger than any;
repeated rows are copies; an empty table gives no rows; other columns are not
read. The table must give the same rows each time it is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import row_number, stored
from tickwise.llm.components import connected_components
from tickwise.llm.decontaminate import held, key_filter
from tickwise.llm.textbytes import gram_hashes, hash_runs, mix, pieces_of, words_of

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 48, 5
HASHES = BANDS * ROWS
STEP = 40  # MinHash values compared at a time
TOLERANCE = 1e-6
CHUNK = 512  # documents of a block's side
CHUNK_SHINGLES = 1_000_000

_FACTORS = np.random.default_rng(97).integers(1, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingle_sets(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, words_at: np.ndarray, n: int
) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = hash_runs(data, starts, ends)
    grams = gram_hashes(words, n)
    out = []
    for a, b in zip(words_at[:-1].tolist(), words_at[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            out.append(mix(gram_hashes(words[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(words[:0])
    return out


def minhash(sets: list[np.ndarray]) -> np.ndarray:
    """Sixteen bits of each of the ``HASHES`` minima of each set (sets are not
    empty); one row a set."""
    out = np.empty((len(sets), HASHES), dtype=np.uint16)
    at = 0
    while at < len(sets):  # runs of sets of a bounded total
        to, total = at, 0
        while to < len(sets) and (to == at or total + len(sets[to]) <= 1 << 18):
            total += len(sets[to])
            to += 1
        part = sets[at:to]
        values = np.concatenate(part)
        folded = (values ^ (values >> np.uint64(32))).astype(np.uint32)
        first = np.cumsum([0] + [len(s) for s in part[:-1]])
        for k in range(HASHES):
            out[at:to, k] = np.minimum.reduceat(folded * _FACTORS[k], first) & np.uint32(0xFFFF)
        at = to
    return out


def needed_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """``(compared, matches)``: after so many MinHash values a pair with fewer
    matches has a posterior probability under ``tolerance``. With a uniform
    prior the posterior is a beta distribution, whose tail is a binomial sum."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        terms = [comb(n + 1, k) * threshold**k * (1 - threshold) ** (n + 1 - k) for k in range(n + 2)]
        tail = np.cumsum(terms)  # tail[m] = P(similarity >= threshold | m matches)
        out.append((n, int(np.searchsorted(tail, tolerance))))
    return out


def surviving_pairs(left: np.ndarray, right: np.ndarray | None, needed: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that the incremental test keeps. ``right`` None: pairs
    within ``left``, each once."""
    other = left if right is None else right
    n, least = needed[0]
    counts = np.zeros((len(left), len(other)), dtype=np.uint8)
    for k in range(n):
        counts += left[:, k, None] == other[None, :, k]
    keep = counts >= least
    if right is None:
        keep = np.triu(keep, 1)
    i, j = np.nonzero(keep)
    have = counts[i, j].astype(np.int32)
    for to, least in needed[1:]:
        if not len(i):
            break
        for at in range(0, len(i), 1 << 16):
            part = slice(at, at + (1 << 16))
            have[part] += (left[i[part], n:to] == other[j[part], n:to]).sum(axis=1, dtype=np.int32)
        keep = have >= least
        i, j, have, n = i[keep], j[keep], have[keep], to
    return i, j


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest connected index of each of ``n`` nodes under edges ``i, j``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def intersections(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Common elements of the pairs of sorted sets."""
    if not len(i):
        return np.zeros(0, dtype=np.int64)
    used, place = np.unique(np.concatenate([i, j]), return_inverse=True)
    members = [sets[u] for u in used]
    n, sizes = len(members), [len(s) for s in members]
    _, column, count = np.unique(np.concatenate(members), return_inverse=True, return_counts=True)
    common = count >= 2
    width = int(common.sum())
    if 100 * len(i) * max(sizes) < n * n * width:  # few pairs: one by one
        return np.array(
            [len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j, strict=True)], dtype=np.int64
        )
    # many pairs: products of the incidence matrix, some columns at a time
    row = np.repeat(np.arange(n), sizes)
    keep = common[column]
    row, column = row[keep], (np.cumsum(common) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((n, n), dtype=np.float32)
    step = max(256, (4 << 20) // n)
    for at in range(0, width, step):
        a, b = np.searchsorted(column, [at, at + step])
        part = np.zeros((n, min(step, width - at)), dtype=np.float32)
        part[row[a:b], column[a:b] - at] = 1
        total += part @ part.T
    return total[place[: len(i)], place[len(i) :]].astype(np.int64)


def similar_pairs(
    left: list[np.ndarray], right: list[np.ndarray] | None, threshold: Fraction, needed: list[tuple[int, int]]
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with similarity ``threshold`` or more: the incremental test
    first, the sets themselves then."""
    i, j = surviving_pairs(minhash(left), None if right is None else minhash(right), needed)
    sets = left if right is None else left + right
    at = j if right is None else j + len(left)
    common = intersections(sets, i, at)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    union = sizes[i] + sizes[at] - common
    real = common * threshold.denominator >= union * threshold.numerator
    return i[real], j[real]


def _sketches(docs: DataFrame, n: int) -> DataFrame:
    import hashlib

    id_type = docs.schema["id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, count, raw, bounds in pieces_of(batch.column(2)):
                sets = shingle_sets(*words_of(raw, bounds), n)
                full = [k for k, s in enumerate(sets) if len(s)]
                marks, values = [None] * count, [None] * count
                for k, row in zip(full, minhash([sets[k] for k in full]), strict=True):
                    marks[k] = np.frombuffer(hashlib.blake2b(sets[k].tobytes(), digest_size=16).digest(), dtype=np.int64)
                    values[k] = row.astype("<u2").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, count),
                        batch.column(1).slice(first, count),
                        pa.array([len(s) for s in sets], type=pa.int32()),
                        pa.array([None if m is None else int(m[0]) for m in marks], type=pa.int64()),
                        pa.array([None if m is None else int(m[1]) for m in marks], type=pa.int64()),
                        pa.array(values, type=pa.binary()),
                    ],
                    names=["row", "id", "size", "f1", "f2", "sketch"],
                )

    return docs.mapInArrow(task, f"row bigint, id {id_type}, size int, f1 bigint, f2 bigint, sketch binary")


def _blocks(members: DataFrame, group: str, chunks, payload: list[str]) -> DataFrame:
    """Members of a group dealt to its chunks, and one list for each pair of
    chunks: at most two chunks of members."""
    dealt = members.withColumn("chunk", F.pmod(F.xxhash64("row", F.lit(7)), F.col(chunks)).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(chunks) - 1)))
    return (
        dealt.groupBy(group, F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
        .agg(F.collect_list(F.struct("chunk", "row", *payload)).alias("members"))
        .where(F.size("members") > 1)
        .select("i", "j", "members")
    )


def _sides(batch: pa.RecordBatch) -> Iterator[tuple[pa.StructArray, np.ndarray, np.ndarray | None]]:
    """For each block its members and the places of its two sides."""
    first, lists = batch.column(0).to_numpy(), batch.column(2)
    second = batch.column(1).to_numpy()
    for k in range(batch.num_rows):
        members = lists[k].values
        chunk = members.field("chunk").to_numpy()
        if first[k] == second[k]:
            yield members, np.arange(len(chunk)), None
        else:
            yield members, np.flatnonzero(chunk == first[k]), np.flatnonzero(chunk == second[k])


def _stars(rows: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    moved = np.flatnonzero(label != np.arange(len(label)))
    return rows[moved], rows[label[moved]]


def candidate_edges(blocks: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """``u, v``: a forest, block by block, of the pairs that the test keeps."""
    needed = needed_matches(threshold, tolerance)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for members, a, b in _sides(batch):
                values = np.frombuffer(b"".join(members.field("sketch").to_pylist()), dtype="<u2").reshape(-1, HASHES)
                i, j = surviving_pairs(values[a], None if b is None else values[b], needed)
                if len(i):
                    u, v = _stars(
                        members.field("row").to_numpy(), forest(len(members), a[i], (a if b is None else b)[j])
                    )
                    us.append(u)
                    vs.append(v)
            if us:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"]
                )

    return blocks.mapInArrow(task, "u bigint, v bigint")


def block_links(blocks: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Rows ``u, v, n``: with v null, n documents that u is linked to in the
    block; else an edge of the block's forest of links."""
    needed, exact = needed_matches(threshold, tolerance), Fraction(str(threshold))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members, a, b in _sides(batch):
                rows, copies = members.field("row").to_numpy(), members.field("copies").to_numpy()
                sets = [np.frombuffer(s, dtype=np.uint64) for s in members.field("shingles").to_pylist()]
                i, j = similar_pairs([sets[k] for k in a], None if b is None else [sets[k] for k in b], exact, needed)
                if not len(i):
                    continue
                i, j = a[i], (a if b is None else b)[j]
                count = np.zeros(len(rows), dtype=np.int64)
                np.add.at(count, i, copies[j])
                np.add.at(count, j, copies[i])
                linked = np.flatnonzero(count)
                u, v = _stars(rows, forest(len(rows), i, j))
                none = pa.nulls(len(linked), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([rows[linked], u])),
                        pa.concat_arrays([none, pa.array(v)]),
                        pa.array(np.concatenate([count[linked], np.zeros(len(u), dtype=np.int64)])),
                    ],
                    names=["u", "v", "n"],
                )

    return blocks.mapInArrow(task, "u bigint, v bigint, n bigint")


def _texts(docs: DataFrame, wanted: np.ndarray, n: int) -> DataFrame:
    """``row, shingles`` of the rows that the filter holds."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = batch.filter(pa.array(held(shared.value, batch.column(1).to_numpy().view(np.uint64))))
            for first, count, raw, bounds in pieces_of(chosen.column(2)):
                sets = shingle_sets(*words_of(raw, bounds), n)
                yield pa.RecordBatch.from_arrays(
                    [chosen.column(0).slice(first, count), pa.array([s.tobytes() for s in sets], type=pa.binary())],
                    names=["row", "shingles"],
                )

    source = docs.select("row", F.xxhash64("row").alias("h"), "t")
    return source.mapInArrow(task, "row bigint, shingles binary")


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = SHINGLE,
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per document: ``row`` (its ``row_number``),
    ``<id_col>, class_id`` (the smallest id of its class), ``n_links`` (other
    documents with similarity ``threshold`` or more, copies included) and
    ``first`` (whether it stands for its class)."""
    source = docs.select(
        row_number(docs).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("t")
    )
    sketches = stored(_sketches(source, n), "near-sketches")
    full = sketches.where("size > 0")
    classes = stored(
        full.groupBy("f1", "f2").agg(F.min("row").alias("rep"), F.count(F.lit(1)).cast("int").alias("copies")), "near-classes"
    )
    reps = full.join(classes.select(F.col("rep").alias("row")), "row", "left_semi").select("row", "sketch")

    # buckets of two or more; of those with the same members, one
    piece = lambda b: F.expr("substring(sketch, b * {0} + 1, {0})".format(2 * ROWS))
    bands = reps.select("row", "sketch", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("b"))
    bands = bands.select("row", F.xxhash64("b", piece("b")).alias("key"))
    buckets = bands.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("row")).alias("x"),
        F.bit_xor(F.xxhash64("row", F.lit(1))).alias("y"),
    )
    chosen = buckets.where("n > 1").groupBy("n", "x", "y").agg(F.min("key").alias("key"))
    members = bands.join(chosen.select("key", F.ceil(F.col("n") / chunk).cast("int").alias("chunks")), "key")
    edges = candidate_edges(
        _blocks(members.join(sketches.select("row", "sketch"), "row"), "key", "chunks", ["sketch"]), threshold, tolerance
    )

    # clusters of candidates, compared exactly
    slim = classes.select(F.col("rep").alias("row"), "copies").join(full.select("row", "size"), "row")
    cluster = stored(connected_components(edges).withColumnRenamed("node", "row").join(slim, "row"), "near-clusters")
    sizes = cluster.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("s"))
    chunks = F.greatest(F.ceil(F.col("n") / chunk), F.ceil(F.col("s") / CHUNK_SHINGLES)).cast("int")
    # stored, like what follows: only joins of plain shuffles can be split at a hot label
    sized = cluster.join(stored(sizes.select("label", chunks.alias("chunks")), "near-sizes"), "label")
    texts = _texts(source, key_filter(cluster.select(F.array(F.xxhash64("row")).alias("keys"))), n)
    blocks = _blocks(sized.join(texts, "row"), "label", "chunks", ["copies", "shingles"])
    links = stored(block_links(blocks, threshold, tolerance), "near-links")

    counts = links.where("v is null").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("others"))
    joined = connected_components(links.where("v is not null").select("u", "v"))
    labelled = (
        full.select("row", "id", "f1", "f2")
        .join(classes, ["f1", "f2"])
        .join(counts, "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "row",
            "id",
            F.coalesce("label", "rep").alias("label"),
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).cast("long").alias("n_links"),
        )
    )
    labelled = stored(labelled, "near-labels")
    first = labelled.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("f"))
    first = stored(first, "near-firsts")
    found = labelled.join(first, "label").select(
        "row", "id", F.col("f.id").alias("class_id"), "n_links", (F.col("row") == F.col("f.row")).alias("first")
    )
    alone = sketches.where("size = 0").select(
        "row", "id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("first")
    )
    return found.union(alone).withColumnRenamed("id", id_col)
