"""Property test: the batch chain (parse -> validate -> dedup -> tumbling
mean) equals a brute-force evaluation in plain Python on random inputs with
duplicates, malformed records and out-of-order times."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickwise.functions.parse import parse_ticks, rejected_ticks, valid_ticks
from tickwise.operators.dedup import dedup_ticks
from tickwise.operators.windows import tumbling_mean

T0 = 1722598200000
WINDOW_MS = 5 * 60 * 1000

tick = st.tuples(
    st.sampled_from(["A", "B", "C"]),
    st.integers(min_value=0, max_value=40 * 60 * 1000),  # within 40 minutes
    st.sampled_from([1.5, 2.25, 10.0, 99.5, 0.125]),
)
record = st.one_of(
    tick.map(lambda t: ("ok", t)),
    st.just(("bad", None)),
)


def brute_force(records):
    first = {}
    for offset, (kind, t) in enumerate(records):
        if kind != "ok":
            continue
        ticker, ms, price = t
        key = (ticker, T0 + ms)
        if key not in first or first[key][0] > offset:
            first[key] = (offset, price)
    sums = {}
    for (ticker, ms), (_o, price) in first.items():
        end = (ms // WINDOW_MS + 1) * WINDOW_MS
        s, n = sums.get((ticker, end), (0.0, 0))
        sums[(ticker, end)] = (s + price, n + 1)
    return {k: round(s / n, 9) for k, (s, n) in sums.items()}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(record, min_size=1, max_size=40).flatmap(
    lambda xs: st.lists(st.sampled_from(list(range(len(xs)))), max_size=10).map(
        lambda dup: xs + [xs[i] for i in dup])))  # replays land at later offsets
def test_batch_chain_matches_brute_force(spark, records):
    rows = []
    for offset, (kind, t) in enumerate(records):
        if kind == "ok":
            value = json.dumps({"id": t[0], "price": t[2], "time": str(T0 + t[1])})
        else:
            value = '{"id": "A", "pri'
        rows.append((value, offset % 3, offset))
    df = spark.createDataFrame(rows, "value string, partition int, offset long")
    parsed = parse_ticks(df)
    got = {
        (r.stock_ticker, int(r.timestamp.timestamp() * 1000)): round(r.price, 9)
        for r in tumbling_mean(dedup_ticks(valid_ticks(parsed))).collect()
    }
    assert got == brute_force(records)
    assert rejected_ticks(parsed).count() == sum(1 for k, _ in records if k != "ok")
