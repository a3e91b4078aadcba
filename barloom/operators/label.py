"""Forward-looking label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions import flag, ratio
from barloom.operators.panel import block_window
from barloom.operators.step import Step


def target(lookahead: int = 6, threshold: float = 0.001, drop_unlabelled: bool = False) -> Step:
    """1 where the close rises by more than ``threshold`` within ``lookahead`` bars.

    The last bars of a series have no outcome: they are labelled 0, or left null to be dropped by
    ``labelled`` when ``drop_unlabelled`` is set.
    """

    def stages(framed: DataFrame):
        later = F.lead("close", lookahead).over(block_window(framed))
        rise = ratio(later, F.col("close")) - 1 > threshold
        rise = F.when(F.col("close") == 0, later > 0).otherwise(rise)  # from zero, any rise is beyond it
        known = F.when(later.isNotNull(), flag(rise)) if drop_unlabelled else flag(rise)
        return [{"target": known}]

    return Step(stages, ahead=lookahead)


def label_time(lookahead: int = 6) -> Step:
    """``label_ts``: when the label of a bar becomes known; null for the last bars of a series."""
    return Step(lambda framed: [{"label_ts": F.lead("bar_ts", lookahead).over(block_window(framed))}], ahead=lookahead)


def labelled(df: DataFrame) -> DataFrame:
    return df.filter(F.col("target").isNotNull())


def label_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("target").agg(F.count("*").alias("rows"))
