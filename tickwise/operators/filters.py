"""Symbol subscription (watchlist) filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def watchlist(ticks: DataFrame, symbols: Sequence[str] | DataFrame, *, key: str = "stock_ticker") -> DataFrame:
    """Keep ticks whose ``key`` is subscribed; the caller's choice of form
    decides the plan.

    A Python sequence becomes ``IN (...)`` (pushed into Parquet scans when
    ``key`` is a stored column). A DataFrame of symbols is a ``left_semi``
    join; the symbols are de-duplicated first, and AQE broadcasts them once
    their measured size is under the broadcast limit.
    """
    if not isinstance(symbols, DataFrame):
        return ticks.where(F.col(key).isin(list(dict.fromkeys(symbols))))
    subs = symbols.select(F.col(symbols.columns[0]).alias(key)).distinct()
    return ticks.join(subs, key, "left_semi")
