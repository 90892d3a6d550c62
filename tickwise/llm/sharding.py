"""Size-weighted sampled splitters, in built-in functions only.

Every record has a sort key ``(text hash, record hash)``: records with equal
texts lie next to each other, and the second part lets a boundary fall inside
a group of copies that is too large for one range.

1. The slim table of keys and sizes is stored once; the texts are read once.
2. Records are drawn with probability in proportion to their size (a hash of
   the record decides, so a task that runs again draws the same ones). The
   number of draws follows the number of ranges, which follows the input up
   to ``max_ranges``: a stated bound on what reaches the driver.
3. Quantiles of the drawn keys are the splitters; a record finds its range by
   binary search. A range with more than twice its share of bytes is drawn
   from again, more densely, and subdivided.
4. Ranges are laid end to end by their exact byte sums; inside a range a
   running sum over the sorted records gives every record its place on the
   whole line of bytes, and equal parts of that line are the shards. So the
   shards' sizes differ by about one record, whatever the draw was.

Defined cases: a null text has the size of an empty one; repeated rows are
records of their own; null ids are kept; an empty table gives no rows; more
shards than records leave shards empty. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickwise.llm.common import stored

RANGE_BYTES = 1 << 20
MIN_RANGES = 1024
MAX_RANGES = 16384
DRAWS_PER_RANGE = 8
MAX_ROUNDS = 4


def _uniform(*columns) -> Column:
    """A number in [0, 1) that depends on the columns alone."""
    return (F.xxhash64(*columns).bitwiseAND(F.lit((1 << 52) - 1))) / F.lit(float(1 << 52))


def _draw(rows: DataFrame, bytes_per_draw: float, turn: int) -> list[tuple[int, int]]:
    """Keys of records drawn in proportion to their size; a record of several
    times ``bytes_per_draw`` counts several times."""
    times = F.floor(F.col("size") / F.lit(float(bytes_per_draw)) + _uniform("k2", F.lit(turn)))
    drawn = rows.select("k1", "k2", times.alias("times")).where("times > 0")
    return sorted((r.k1, r.k2) for r in drawn.collect() for _ in range(min(r.times, DRAWS_PER_RANGE)))


def _literal(values: list[int]) -> Column:
    """A constant array; one string literal that Spark folds once."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _range_of(splitters: list[tuple[int, int]]) -> Column:
    """Number of splitters at or below the record's key, by binary search."""
    if not splitters:
        return F.lit(0)
    n = len(splitters)
    first, second = _literal([a for a, _ in splitters]), _literal([b for _, b in splitters])
    steps = [1 << i for i in range(n.bit_length() - 1, -1, -1)]

    def step(low, width):
        at = low + width
        a, b = F.get(first, at - 1), F.get(second, at - 1)
        below = (at <= F.lit(n)) & ((a < F.col("k1")) | ((a == F.col("k1")) & (b <= F.col("k2"))))
        return F.when(below, at).otherwise(low)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def _sums(ranged: DataFrame) -> list:
    return (
        ranged.groupBy("range")
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        .orderBy("range")
        .collect()
    )


def assign_shards(
    docs: DataFrame,
    n_shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    range_bytes: int = RANGE_BYTES,
    min_ranges: int = MIN_RANGES,
    max_ranges: int = MAX_RANGES,
) -> DataFrame:
    """One row per record: ``<id_col>, size, text_crc32, shard, slot``; shards
    have nearly equal sizes and slots are gapless from 0."""
    spark: SparkSession = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("crc"),
            F.xxhash64(text).alias("k1"),
            F.monotonically_increasing_id().alias("row"),
        ).withColumn("k2", F.xxhash64("id", "row")),
        "shard-keys",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    n_ranges = min(max_ranges, max(min_ranges, total // range_bytes))
    share = max(1.0, total / n_ranges)
    drawn = _draw(rows, share / DRAWS_PER_RANGE, 0)
    splitters = sorted({drawn[len(drawn) * i // n_ranges] for i in range(1, n_ranges)}) if drawn else []
    ranged = rows.withColumn("range", _range_of(splitters))
    sums = _sums(ranged)
    for turn in range(1, MAX_ROUNDS):
        over = {r.range: r.bytes for r in sums if r.bytes > 2 * share and r.rows > 1}
        if not over:
            break
        inside = F.array_contains(_literal(sorted(over)), F.col("range").cast("long"))
        more = _draw(ranged.where(inside), share / DRAWS_PER_RANGE / 4**turn, turn)
        new = more[4**turn * DRAWS_PER_RANGE // 2 :: 4**turn * DRAWS_PER_RANGE // 2]
        merged = sorted({*splitters, *new})
        if len(merged) == len(splitters):
            break
        splitters = merged
        ranged = rows.withColumn("range", _range_of(splitters))
        sums = _sums(ranged)

    before = spark.createDataFrame(_running(sums), "range int, byte_base long, row_base long")
    order = W.partitionBy("range").orderBy("k1", "k2", "row")
    ends = F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0))
    # at most max_ranges + the subdivisions: a bounded table
    placed = ranged.join(F.broadcast(before), "range").select(
        "id",
        "size",
        "crc",
        (F.col("byte_base") + ends).alias("end"),
        (F.col("row_base") + F.row_number().over(order) - 1).alias("rank"),
    )
    # the middle of the record on the line of all bytes decides
    middle = (F.col("end") - F.col("size") / 2) / F.lit(float(max(total, 1)))
    placed = stored(
        placed.withColumn("shard", F.least(F.floor(middle * n_shards), F.lit(n_shards - 1)).cast("int")), "shard-places"
    )
    firsts = {r.shard: r.first for r in placed.groupBy("shard").agg(F.min("rank").alias("first")).collect()}
    start = _literal([firsts.get(i, 0) for i in range(n_shards)])
    return placed.select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        "shard",
        (F.col("rank") - F.get(start, F.col("shard"))).alias("slot"),
    )


def _running(sums: list) -> list[tuple[int, int, int]]:
    out, byte_base, row_base = [], 0, 0
    for r in sums:
        out.append((r.range, byte_base, row_base))
        byte_base += r.bytes
        row_base += r.rows
    return out
