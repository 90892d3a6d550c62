"""Plan-shape guards for the scale claims in the README.

For every registered batch query: each hash shuffle moves the output of a
map-side partial step (partial aggregate, or the partial ``WindowGroupLimit``
of the rate examples) rather than raw rows, so a key holding a third of all
rows is collapsed inside each input task first; no plan pairs rows
(cartesian / nested-loop joins) or sorts for an aggregate; scans read only
the columns the query needs.
"""

import pytest
from conftest import SF_SMALL

from tickwise.plans.registry import all_queries

BATCH = [k for k in all_queries() if not k.startswith("stream_")]
MAP_SIDE = ("HashAggregate(", "ObjectHashAggregate(", "WindowGroupLimit ")


def plan_lines(df) -> list[str]:
    return [ln.strip(" :+-") for ln in df._jdf.queryExecution().executedPlan().toString().splitlines()]


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_lines(all_queries()[name](spark, SF_SMALL)) for name in BATCH}


@pytest.mark.parametrize("name", BATCH)
def test_hash_shuffles_follow_a_map_side_step(plans, name):
    lines = plans[name]
    for i, ln in enumerate(lines):
        if ln.startswith("Exchange hashpartitioning"):
            child = lines[i + 1]
            assert child.startswith(MAP_SIDE), f"{name}: raw rows shuffled: {ln[:80]} <- {child[:80]}"
            if child.startswith("HashAggregate("):
                # a partial step: partial_ functions, or a map-side distinct
                assert "partial_" in child or "functions=[]" in child, child[:120]


@pytest.mark.parametrize("name", BATCH)
def test_no_pairing_joins_or_sort_aggregates(plans, name):
    text = "\n".join(plans[name])
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate"):
        assert bad not in text, f"{name}: {bad}"


@pytest.mark.parametrize("name", BATCH)
def test_scans_are_pruned(plans, name):
    scans = [ln for ln in plans[name] if ln.startswith("FileScan parquet") and "events.parquet" in ln]
    # these return what their own jobs wrote (topic files, stage counts, checks)
    if name not in ("batch_topic_read", "topic_extent", "stage_counts", "gated_run"):
        assert scans, f"{name}: no events scan found"
    for ln in scans:
        cols = ln[ln.index("[") + 1:ln.index("]")].split(",")
        assert "props" not in cols, f"{name} reads an unused column: {cols}"


@pytest.mark.parametrize("name", BATCH)
def test_no_round_robin(plans, name):
    """The scan's own splits decide; nothing deals rows out anew."""
    assert not any("RoundRobinPartitioning" in ln for ln in plans[name])


def test_keyed_table_read_of_a_day_is_pruned(spark, tmp_path):
    from pyspark.sql import functions as F

    from tickwise.sinks.keyed_table import KeyedTable

    table = KeyedTable(spark, str(tmp_path / "t"))
    table.upsert(spark.range(28).select(
        F.lit("A").alias("stock_ticker"), F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, id)").alias("timestamp"),
        F.lit(1.0).alias("price"),
    ))
    plan = table.read(with_partition=True).where("date = date'2024-01-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_topic_extent_comes_from_file_statistics(spark, tmp_path):
    from tickwise.plans.common import topic_records
    from tickwise.sources.topic import append_segment, topic_extent

    append_segment(topic_records(spark, SF_SMALL), str(tmp_path / "topic"))
    plan = executed(topic_extent(spark, str(tmp_path / "topic")))
    assert "PushedAggregation: [COUNT(*), MIN(offset), MAX(offset)]" in plan
    assert "PushedGroupBy: [topic, partition]" in plan


def test_bounded_read_reads_its_ranges(spark, tmp_path):
    from pyspark.sql import functions as F

    from tickwise.plans.common import topic_records
    from tickwise.sources.topic import append_segment, bounded_read, read_topic

    path = str(tmp_path / "topic")
    append_segment(topic_records(spark, SF_SMALL), path)
    got = bounded_read(spark, path=path, starting={0: 1900, 1: 1500}, ending={0: 1950})
    plan = executed(got)
    for p, bound in ((0, "LessThan(offset,1950)"), (0, "GreaterThanOrEqual(offset,1900)"), (1, "GreaterThanOrEqual(offset,1500)")):
        scans = [ln for ln in plan.splitlines() if "Scan parquet" in ln or "FileScan" in ln]
        assert any(f"(partition#" in ln and f" = {p})" in ln and bound in ln for ln in scans), (p, bound, scans)
    assert "Join" not in plan
    every = read_topic(spark, path=path, streaming=False)
    want = every.where(
        "partition = 2 or partition = 0 and offset >= 1900 and offset < 1950 or partition = 1 and offset >= 1500"
    )
    rows = lambda df: sorted((r.partition, r.offset) for r in df.select("partition", F.col("offset")).collect())
    assert rows(got) == rows(want)
