"""Column helpers. Missing values are NULL everywhere; NaN never enters a panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

EPSILON = 1e-10  # guard that is part of the definition of RSI, %K and the band position


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(condition: Column) -> Column:
    """0/1 with an unknown comparison counting as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that yields NULL instead of failing on a zero denominator."""
    return F.try_divide(as_column(numerator), as_column(denominator))


def change(c: Column | str, n: int, order: WindowSpec) -> Column:
    """Relative change against ``n`` rows earlier."""
    c = as_column(c)
    return ratio(c, F.lag(c, n).over(order)) - 1


def finite(c: Column | str) -> Column:
    c = as_column(c).cast("double")
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def zero_if_missing(c: Column | str) -> Column:
    return F.when(finite(c), as_column(c)).otherwise(F.lit(0))


def since_epoch(ts: Column | str) -> Column:
    # Subtracting zone-less timestamps involves no session time zone.
    gap = as_column(ts).cast("timestamp_ntz") - F.lit("1970-01-01").cast("timestamp_ntz")
    return gap.cast("interval second").cast("decimal(18,6)")


def epoch_seconds(ts: Column | str) -> Column:
    return F.floor(since_epoch(ts)).cast("bigint")


def epoch_micros(ts: Column | str) -> Column:
    return (since_epoch(ts) * 1_000_000).cast("bigint")


def time_bucket(ts: Column | str, seconds: int) -> Column:
    return F.floor(epoch_seconds(ts) / seconds).cast("bigint")


def row_hash(seed: int, symbol: str = "symbol", ts: str = "bar_ts") -> Column:
    """Reproducible pseudo-random key of a row: 32 hex digits."""
    micros = epoch_micros(ts).cast("string")
    return F.md5(F.concat_ws("|", F.col(symbol), micros, F.lit(str(seed))))


def display_name(c: Column | str) -> Column:
    """``model_name`` as "Model Name"."""
    return F.initcap(F.translate(as_column(c), "_", " "))


def names(df_columns: Sequence[str], wanted: Sequence[str]) -> list[str]:
    missing = [c for c in wanted if c not in df_columns]
    if missing:
        raise ValueError(f"columns not present: {', '.join(missing)}")
    return list(wanted)
