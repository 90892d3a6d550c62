"""Ranked lexical search with geometric blocks of posting lists.

Every query gets its ``k`` best documents by a weight-times-saturation score
in 64-bit integers (see ``search``), exactly. Queries are taken in groups of at
most ``QUERY_BYTES`` of text; all documents are searched for each group.

1. One scan counts, for every document, the terms that some query of the group
   holds, and all its terms. From these come the corpus statistics (``N``, ``L``,
   document frequencies) and each term's impact on a document.
2. Documents are stored in the order of a code of ``CODE_BITS`` signs of random
   projections of their weighted terms: neighbours are similar documents.
3. A sample of each query's rarest postings is scored, whole documents at a
   time. Its ``k``-th best score is a threshold that the result cannot be below.
   The terms of a query that together cannot reach it, by their greatest
   impacts, need not be opened: every result holds one of the others.
4. Each of the other posting lists is clustered by document similarity: as many
   leading signs as its length asks for make the cells, and the postings of a
   cell and an input batch a block of about ``BLOCK`` documents. Stored with
   the block is the coordinatewise maximum of its documents' impacts, over the
   terms that meet this list's term in some query.
5. For each query and block, the weighted sum of the maxima is an upper bound
   of every document in it. Only where this bound is below the threshold, the
   block is skipped. Documents of the other blocks are scored whole.

Broadcast are arrays over the terms of one group of queries (at most one term
for two bytes of ``QUERY_BYTES``); no table over documents is collected or
broadcast. A task holds one batch of documents.

Defined cases: terms are runs of ASCII letters, digits and all characters from
U+0080 on, A-Z in lower case, compared by 64-bit hashes; null, empty and
termless texts count neither in ``N`` nor in results, such queries get no rows;
very long texts are read whole (a query longer than ``QUERY_BYTES`` is a group
of its own); equal scores rank by id, nulls last, then by row; repeated rows
and ids are documents and queries of their own; empty tables give no rows;
other columns are not read. The document table must be a stored one (see
``row_number``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import ceil, floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwise.llm.common import row_number, stored
from tickwise.llm.textbytes import hash_runs, mix, pieces_of, words_of

QUERY_BYTES = 4 << 20
CODE_BITS = 32
BLOCK = 16
SEED = 2000
_CELLS = 4 << 20  # entries of a dense part of documents by terms


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the bounds of each row's part."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _spread(at: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For parts ``at[i]:at[i + 1]`` of the chosen ``index``: the place in
    ``index`` and the position, for every element."""
    sizes = at[index + 1] - at[index]
    first = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(index)), sizes)
    return owner, np.arange(int(sizes.sum())) - first[owner] + at[index][owner]


def _sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Integer sums by owner (ascending)."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    at = np.searchsorted(owner, np.arange(n + 1))
    return total[at[1:]] - total[at[:-1]]


def term_counts(data: np.ndarray, bounds: np.ndarray, vocabulary: np.ndarray | None = None):
    """``terms per text, text, term, count`` of the distinct terms of each text;
    with a sorted vocabulary of hashes, only its terms, as places in it."""
    lower, starts, ends, words_at = words_of(data, bounds)
    hashes = hash_runs(lower, starts, ends)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(words_at))
    if vocabulary is not None:
        place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
        known = vocabulary[place] == hashes
        key, count = np.unique(text[known] * len(vocabulary) + place[known], return_counts=True)
        return np.diff(words_at), key // len(vocabulary), key % len(vocabulary), count
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])])[: len(text)])
    return np.diff(words_at), text[new], hashes[new], np.diff(np.append(new, len(text)))


def _query_terms(queries: DataFrame) -> DataFrame:
    """``query, hash, count`` of ``queries(query, text)``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, count, data, bounds in pieces_of(batch.column("text")):
                _, text, hashes, times = term_counts(data, bounds)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("query").slice(start, count).take(pa.array(text)),
                        pa.array(hashes.view(np.int64)),
                        pa.array(times.astype(np.int64)),
                    ],
                    names=["query", "hash", "count"],
                )

    return queries.select("query", "text").mapInArrow(scan, "query bigint, hash bigint, count bigint")


def _vectors(docs: DataFrame, vocabulary) -> DataFrame:
    """``row, id, n, terms, counts`` of every document; ``vocabulary`` is a
    broadcast array."""
    slim = docs.select(row_number(docs).alias("row"), F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, count, data, bounds in pieces_of(batch.column("text")):
                n, text, term, times = term_counts(data, bounds, vocabulary.value)
                at = np.searchsorted(text, np.arange(count + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(start, count),
                        batch.column("id").slice(start, count),
                        pa.array(n.astype(np.int64)),
                        pa.ListArray.from_arrays(at, pa.array(term.astype(np.int32))),
                        pa.ListArray.from_arrays(at, pa.array(times.astype(np.int32))),
                    ],
                    names=["row", "id", "n", "terms", "counts"],
                )

    id_type = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(scan, f"row bigint, id {id_type}, n bigint, terms array<int>, counts array<int>")


def codes(vocabulary: np.ndarray, weights: np.ndarray, term: np.ndarray, impact: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``CODE_BITS`` signs of random projections of each document's weighted
    terms, as one integer."""
    out = np.zeros(len(at) - 1, dtype=np.int64)
    bits = np.arange(CODE_BITS, dtype=np.uint64)
    a = 0
    while a < len(out):
        b = max(a + 1, int(np.searchsorted(at, at[a] + (1 << 16), side="right")) - 1)
        part = slice(int(at[a]), int(at[b]))
        signs = ((mix(vocabulary[term[part]])[:, None] >> bits) & np.uint64(1)).astype(np.float32) * 2 - 1
        signs *= (weights[term[part]] * impact[part]).astype(np.float32)[:, None]
        total = np.concatenate([np.zeros((1, CODE_BITS)), np.cumsum(signs, axis=0, dtype=np.float64)])
        positive = total[at[a + 1 : b + 1] - at[a]] > total[at[a:b] - at[a]]
        out[a:b] = positive @ (np.int64(1) << np.arange(CODE_BITS - 1, -1, -1, dtype=np.int64))
        a = b
    return out


def _impacts(vectors: DataFrame, n_docs: int, n_terms: int, vocabulary, weights) -> DataFrame:
    """``row, id, code, terms, impacts`` of the documents with known terms, in
    the order of the code."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term, at = _lists(batch.column("terms"))
            count = batch.column("counts").flatten().to_numpy().astype(np.int64)
            m = 100 - 75 + (75 * batch.column("n").to_numpy() * n_docs) // n_terms
            impact = (1_000_000_000 * count) // (1000 * count + 8 * np.repeat(m, np.diff(at)))
            code = codes(vocabulary.value, weights.value, term, impact, at)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("id"),
                    pa.array(code),
                    batch.column("terms"),
                    pa.ListArray.from_arrays(at.astype(np.int32), pa.array(impact.astype(np.int32))),
                ],
                names=["row", "id", "code", "terms", "impacts"],
            )

    id_type = vectors.schema["id"].dataType.simpleString()
    schema = f"row bigint, id {id_type}, code bigint, terms array<int>, impacts array<int>"
    some = vectors.where("size(terms) > 0").mapInArrow(scan, schema)
    # the row splits a code that very many documents share
    return some.repartitionByRange("code", "row").sortWithinPartitions("code", "row")


@dataclass
class Plan:
    """A group of queries as arrays: query ``j`` holds ``term[at[j]:at[j + 1]]``
    with weights; thresholds and opened lists come later."""

    n_terms: int
    at: np.ndarray
    term: np.ndarray
    weight: np.ndarray
    threshold: np.ndarray
    # lists by term: queries to score for a posting, and one posting of how many
    seed_at: np.ndarray
    seed_query: np.ndarray
    seed_share: np.ndarray
    # opened lists: sign bits of a cell, coordinates of a summary, pairs of
    # list and query with the query's places and weights in the summary
    depth: np.ndarray
    axis_at: np.ndarray
    axis: np.ndarray
    pair_at: np.ndarray
    pair_query: np.ndarray
    entry_at: np.ndarray
    entry_place: np.ndarray
    entry_weight: np.ndarray


def _by_key(key: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(key, np.arange(n + 1))


def plan_seeds(query: np.ndarray, term: np.ndarray, weight: np.ndarray, n_queries: int, df: np.ndarray) -> Plan:
    """Queries as arrays (``query`` ascending) and the postings to sample."""
    n_terms = len(df)
    order = np.lexsort((term, df[term], query))
    sampled = np.minimum(df[term[order]], SEED)
    before = np.cumsum(sampled) - sampled
    at = _by_key(query, n_queries)
    seeds = order[before - before[np.minimum(at[:-1], len(order) - 1)][query[order]] < SEED]
    seeds = seeds[np.argsort(term[seeds], kind="stable")]
    none = np.zeros(0, dtype=np.int64)
    return Plan(
        n_terms, at, term, weight, np.zeros(n_queries, dtype=np.int64),
        _by_key(term[seeds], n_terms), query[seeds], np.maximum(1, -(-df // SEED)),
        none, none, none, none, none, none, none, none,
    )


def plan_lists(plan: Plan, query: np.ndarray, greatest: np.ndarray, df: np.ndarray) -> None:
    """Which lists to open for the thresholds, and their summaries."""
    bound = plan.weight * greatest[plan.term]
    order = np.lexsort((plan.term, bound, query))
    total = np.cumsum(bound[order])
    base = np.concatenate([[0], total])[plan.at[:-1]]
    opened = np.sort(order[(total - base[query[order]] >= plan.threshold[query[order]]) & (bound[order] > 0)])
    by_term = opened[np.argsort(plan.term[opened], kind="stable")]
    plan.pair_at = _by_key(plan.term[by_term], plan.n_terms)
    plan.pair_query = query[by_term]
    plan.depth = np.minimum(CODE_BITS, np.ceil(np.log2(np.maximum(df / BLOCK, 1))).astype(np.int64))
    # coordinates of a list: the terms of the queries that open it
    pair, position = _spread(plan.at, plan.pair_query)
    list_of = plan.term[by_term][pair]
    key = list_of * plan.n_terms + plan.term[position]
    axes, place = np.unique(key, return_inverse=True)
    plan.axis_at = _by_key(axes // plan.n_terms, plan.n_terms)
    plan.axis = axes % plan.n_terms
    plan.entry_at = _by_key(pair, len(plan.pair_query))
    plan.entry_place = place - plan.axis_at[list_of]
    plan.entry_weight = plan.weight[position]


def _dense(term: np.ndarray, impact: np.ndarray, at: np.ndarray, n_terms: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Documents ``a`` to ``b`` as a dense matrix of impacts, some at a time."""
    n, step = len(at) - 1, max(1, _CELLS // n_terms)
    for a in range(0, n, step):
        b = min(n, a + step)
        part = slice(int(at[a]), int(at[b]))
        dense = np.zeros((b - a, n_terms), dtype=np.int32)
        dense[np.repeat(np.arange(b - a), np.diff(at[a : b + 1])), term[part]] = impact[part]
        yield a, b, dense


def scores(plan: Plan, term: np.ndarray, impact: np.ndarray, at: np.ndarray, doc: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Scores of pairs of documents (ascending) and queries."""
    out = np.zeros(len(doc), dtype=np.int64)
    for a, b, dense in _dense(term, impact, at, plan.n_terms):
        low, high = np.searchsorted(doc, [a, b])
        for c in range(low, high, 1 << 15):
            part = slice(c, min(high, c + (1 << 15)))
            owner, position = _spread(plan.at, query[part])
            value = dense[doc[part][owner] - a, plan.term[position]] * plan.weight[position]
            out[part] = _sums(value, owner, part.stop - c)
    return out


def _seed_scores(impacts: DataFrame, plan, k: int) -> DataFrame:
    """``query, score`` of sampled documents: the ``k`` best of a batch."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Plan = plan.value
        for batch in batches:
            term, at = _lists(batch.column("terms"))
            impact = batch.column("impacts").flatten().to_numpy()
            doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
            row = batch.column("row").to_numpy().astype(np.uint64)[doc]
            drawn = mix(row * np.uint64(p.n_terms) + term.astype(np.uint64)) % p.seed_share[term].astype(np.uint64) == 0
            doc, term_ = doc[drawn], term[drawn]
            owner, position = _spread(p.seed_at, term_)
            n_queries = len(p.at) - 1
            pair = np.unique(doc[owner] * n_queries + p.seed_query[position])
            doc, query = pair // n_queries, pair % n_queries
            score = scores(p, term, impact, at, doc, query)
            order = np.lexsort((-score, query))
            query, score = query[order], score[order]
            best = np.arange(len(query)) - np.searchsorted(query, query) < k
            yield pa.RecordBatch.from_arrays([pa.array(query[best]), pa.array(score[best])], names=["query", "score"])

    return impacts.select("row", "terms", "impacts").mapInArrow(scan, "query bigint, score bigint")


def blocks(plan: Plan, code: np.ndarray, term: np.ndarray, impact: np.ndarray, at: np.ndarray):
    """Blocks of the opened lists over a batch of documents: list, documents
    and their bounds, maxima and their bounds."""
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    opened = np.flatnonzero(np.diff(plan.pair_at)[term] > 0)
    cell = code[doc[opened]] >> (CODE_BITS - plan.depth[term[opened]])
    opened = opened[np.lexsort((cell, term[opened]))]
    doc, list_ = doc[opened], term[opened].astype(np.int64)
    cell = code[doc] >> (CODE_BITS - plan.depth[list_])
    first = np.ones(len(doc), dtype=bool)
    first[1:] = (list_[1:] != list_[:-1]) | (cell[1:] != cell[:-1])
    block = np.cumsum(first) - 1
    of = list_[first]
    docs_at = np.append(np.flatnonzero(first), len(doc))
    maxima_at = np.concatenate([[0], np.cumsum(plan.axis_at[of + 1] - plan.axis_at[of])]).astype(np.int64)
    maxima = np.zeros(int(maxima_at[-1]), dtype=np.int32)
    by_doc = np.argsort(doc, kind="stable")
    for a, b, dense in _dense(term, impact, at, plan.n_terms):
        low, high = np.searchsorted(doc[by_doc], [a, b])
        for c in range(low, high, 1 << 14):
            part = by_doc[c : min(high, c + (1 << 14))]
            owner, position = _spread(plan.axis_at, list_[part])
            target = maxima_at[block[part]][owner] + position - plan.axis_at[list_[part]][owner]
            np.maximum.at(maxima, target, dense[doc[part][owner] - a, plan.axis[position]])
    return of, doc, docs_at, maxima, maxima_at


def build_index(impacts: DataFrame, plan) -> DataFrame:
    """``term, rows, maxima``: the blocks of the opened posting lists, the rows
    of their documents and the greatest impact on each coordinate."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term, at = _lists(batch.column("terms"))
            impact = batch.column("impacts").flatten().to_numpy()
            of, doc, docs_at, maxima, maxima_at = blocks(plan.value, batch.column("code").to_numpy(), term, impact, at)
            rows = batch.column("row").to_numpy()[doc]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(of.astype(np.int32)),
                    pa.ListArray.from_arrays(docs_at.astype(np.int32), pa.array(rows)),
                    pa.ListArray.from_arrays(maxima_at.astype(np.int32), pa.array(maxima)),
                ],
                names=["term", "rows", "maxima"],
            )

    return impacts.drop("id").mapInArrow(scan, "term int, rows array<bigint>, maxima array<int>")


def _candidates(index: DataFrame, plan) -> DataFrame:
    """``row, query`` of the documents in blocks whose bound reaches the
    query's threshold."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Plan = plan.value
        for batch in batches:
            maxima, maxima_at = _lists(batch.column("maxima"))
            rows, rows_at = _lists(batch.column("rows"))
            block, pair = _spread(p.pair_at, batch.column("term").to_numpy())
            for c in range(0, len(block), 1 << 15):
                b, q = block[c : c + (1 << 15)], pair[c : c + (1 << 15)]
                owner, entry = _spread(p.entry_at, q)
                value = maxima[maxima_at[b][owner] + p.entry_place[entry]] * p.entry_weight[entry]
                bound = _sums(value, owner, len(b))
                open_ = np.flatnonzero((bound > 0) & (bound >= p.threshold[p.pair_query[q]]))
                owner, position = _spread(rows_at, b[open_])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[position]), pa.array(p.pair_query[q[open_]][owner])], names=["row", "query"]
                )

    return index.mapInArrow(scan, "row bigint, query bigint")


def _found(impacts: DataFrame, candidates: DataFrame, plan) -> DataFrame:
    """``query, id, row, score`` of the candidates that reach the threshold."""
    wanted = candidates.groupBy("row").agg(F.collect_set("query").alias("queries"))  # a group's queries are bounded

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Plan = plan.value
        for batch in batches:
            term, at = _lists(batch.column("terms"))
            impact = batch.column("impacts").flatten().to_numpy()
            query, query_at = _lists(batch.column("queries"))
            doc = np.repeat(np.arange(len(at) - 1), np.diff(query_at))
            score = scores(p, term, impact, at, doc, query)
            good = np.flatnonzero((score > 0) & (score >= p.threshold[query]))
            pick = pa.array(doc[good])
            yield pa.RecordBatch.from_arrays(
                [pa.array(query[good]), batch.column("id").take(pick), batch.column("row").take(pick), pa.array(score[good])],
                names=["query", "id", "row", "score"],
            )

    id_type = impacts.schema["id"].dataType.simpleString()
    joined = impacts.drop("code").join(wanted, "row")
    return joined.mapInArrow(scan, f"query bigint, id {id_type}, row bigint, score bigint")


def _search_group(docs: DataFrame, queries: DataFrame, k: int) -> DataFrame | None:
    """``query, id, row, score`` of the best documents, and ties, for one group."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    counted = _query_terms(queries).toArrow().sort_by([("query", "ascending"), ("hash", "ascending")])
    if not counted.num_rows:
        return None
    vocabulary = np.unique(counted.column("hash").to_numpy().view(np.uint64))
    v = share(vocabulary)
    vectors = stored(_vectors(docs, v), "lexical-vectors")
    size = vectors.where("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    if not size.docs:
        return None
    holding = vectors.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    df[holding.column("t").to_numpy()] = holding.column("count").to_numpy()
    weights = np.array([floor(1000 * log((2 * size.docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)
    impacts = stored(_impacts(vectors, size.docs, size.terms, v, share(weights)), "lexical-impacts")
    pairs = impacts.select(F.explode(F.arrays_zip("terms", "impacts")).alias("p"))
    top = pairs.groupBy(F.col("p.terms").alias("t")).agg(F.max("p.impacts").alias("u")).toArrow()
    greatest = np.zeros(len(vocabulary), dtype=np.int64)
    greatest[top.column("t").to_numpy()] = top.column("u").to_numpy()

    names, query = np.unique(counted.column("query").to_numpy(), return_inverse=True)
    term = np.searchsorted(vocabulary, counted.column("hash").to_numpy().view(np.uint64))
    weight = counted.column("count").to_numpy() * weights[term]
    useful = (weight > 0) & (df[term] > 0)
    query, term, weight = query[useful], term[useful], weight[useful]
    if not len(query):
        return None
    plan = plan_seeds(query, term, weight, len(names), df)
    best = Window.partitionBy("query").orderBy(F.desc("score"))
    seeds = _seed_scores(impacts, share(plan), k).withColumn("place", F.row_number().over(best)).where(F.col("place") == k)
    for r in seeds.toLocalIterator():  # one row a query
        plan.threshold[r.query] = r.score
    plan_lists(plan, query, greatest, df)
    p = share(plan)
    index = stored(build_index(impacts, p), "lexical-index")
    found = _found(impacts, _candidates(index, p), p)
    name = spark.createDataFrame(pa.table({"query": np.arange(len(names)), "name": names}))
    return found.join(name, "query").select(F.col("name").alias("query"), "id", "row", "score")


def search(docs: DataFrame, queries: DataFrame, query_id: str = "item_id", k: int = 10) -> DataFrame:
    """``<query_id>, rank, doc_id, score`` of the ``k`` best documents with a
    score above 0, for each row of ``queries(<query_id>, text)``.

    With ``N`` documents that hold a term, ``L`` terms in all, ``n`` terms in a
    document, ``df`` documents holding a term and ``tf`` occurrences of it: a
    term weighs ``floor(1000 * ln((2N + 2) / (2df + 1)))``, a document's ``m`` is
    ``25 + 75nN div L``, and the score sums ``weight * (10**9 tf div (1000 tf + 8 m))``
    over the query's terms, repeats included."""
    asked = queries.select(
        row_number(queries).alias("query"), F.col(f"`{query_id}`").alias("name"), F.col("text").cast("string").alias("text")
    )
    asked = stored(asked, "lexical-queries")
    size = asked.agg(F.sum(F.octet_length("text")).alias("bytes")).first().bytes or 0
    groups = max(1, ceil(size / QUERY_BYTES))
    dealt = F.expr(f"pmod(xxhash64(query), {groups}L)")
    parts = [_search_group(docs, asked.where(dealt == g).drop("name"), k) for g in range(groups)]
    parts = [p for p in parts if p is not None]
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    if not parts:
        empty = asked.where("false").crossJoin(docs.select(F.col("doc_id").alias("id")).where("false"))
        parts = [empty.select("query", "id", F.lit(0).cast("bigint").alias("row"), F.lit(0).cast("bigint").alias("score"))]
    ranked = reduce(DataFrame.union, parts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("query", "name"), "query").select(
        F.col("name").alias(query_id), "rank", F.col("id").alias("doc_id"), "score"
    )
