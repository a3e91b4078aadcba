"""Rows of given random ranks, by radix selection.

To mark the k smallest hashes of a class it is enough to know the k-th one. A first pass counts rows per (class, leading digits); the piece in
which the wanted rank lies is then the only one that is looked at again, by its next digits, until a piece ends at the rank. With
``DIGITS`` hexadecimal digits a step a piece holds one in 65 536 rows of the step before, so a table that fits one machine takes one pass and 10^14 rows take
three; what a window sees is a row per piece. Marking is a comparison with one hash per class and rank.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 4
#: Classes whose thresholds are held by the driver and sent to all tasks.
MOST_CLASSES = 100_000


def _pieces(df: DataFrame, keys: Sequence[str], hashed: str, length: int) -> DataFrame:
    """Rows per (keys, leading digits), with the rows before and up to the piece and those of the class."""
    counts = df.groupBy(*keys, F.substring(hashed, 1, length).alias("_lead")).agg(
        F.count(F.lit(1)).alias("_rows"), F.max(hashed).alias("_top")
    )
    series = Window.partitionBy(*keys)
    upto = F.sum("_rows").over(series.orderBy("_lead"))
    return counts.withColumn("_upto", upto).withColumn("_total", F.sum("_rows").over(series))


def hash_thresholds(
    df: DataFrame, keys: Sequence[str], hashed: str, wanted: Callable[[Column], Sequence[Column]], digits: int = DIGITS
) -> list[tuple]:
    """(keys ..., [hash at each wanted rank]) of every class of ``keys``.

    ``hashed`` is a column of lower-case hexadecimal digits of one length; ``wanted`` gives ranks (from 1) from the number of rows of a class. A rank of 0
    has the threshold "", which no hash reaches. Rows of equal hash have one threshold.
    """
    length = digits
    ranks = _pieces(df, keys, hashed, length)
    ranks = ranks.withColumn("_ranks", F.array(*(r.cast("bigint") for r in wanted(F.col("_total")))))
    ranks = ranks.select("*", F.posexplode("_ranks").alias("_slot", "_rank"))
    first = F.col("_rank") <= 0, F.col("_upto") == F.col("_rows")  # no rows: told once, by the first piece
    inside = (F.col("_upto") - F.col("_rows") < F.col("_rank")) & (F.col("_rank") <= F.col("_upto"))
    found = ranks.filter((first[0] & first[1]) | inside).collect()
    done: dict[tuple, dict[int, str]] = {}
    open_slots: list[tuple] = []

    def take(rows) -> None:
        for r in rows:
            key = tuple(r[k] for k in keys)
            slots = done.setdefault(key, {})
            if r["_rank"] <= 0:
                slots[r["_slot"]] = ""
            elif r["_rank"] == r["_upto"]:
                slots[r["_slot"]] = r["_top"]
            else:
                open_slots.append((*key, r["_slot"], r["_lead"], r["_rank"] - (r["_upto"] - r["_rows"])))

    take(found)
    if len(done) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes")
    kind = df.select(*keys).schema
    slots = [T.StructField("_slot", T.IntegerType()), T.StructField("_lead", T.StringType()), T.StructField("_rank", T.LongType())]
    while open_slots:
        asked = F.broadcast(df.sparkSession.createDataFrame(open_slots, T.StructType([*kind.fields, *slots])))  # a row per class and rank
        open_slots = []
        same = [df[k].eqNullSafe(asked[k]) for k in keys]
        inner = df.join(asked, [*same, F.substring(df[hashed], 1, length) == asked["_lead"]])
        inner = inner.select(*(df[k] for k in keys), df[hashed], "_slot", "_rank")
        length += digits
        refined = _pieces(inner, [*keys, "_slot", "_rank"], hashed, length)
        take(refined.filter((F.col("_upto") - F.col("_rows") < F.col("_rank")) & (F.col("_rank") <= F.col("_upto"))).collect())
    return [(*key, [slots[i] for i in sorted(slots)]) for key, slots in done.items()]


def with_thresholds(df: DataFrame, keys: Sequence[str], thresholds: list[tuple]) -> DataFrame:
    """Add ``_at``, the thresholds of the class of each row; the broadcast side has a row per class."""
    kind = T.StructType([*df.select(*keys).schema.fields, T.StructField("_at", T.ArrayType(T.StringType()))])
    return df.join(F.broadcast(df.sparkSession.createDataFrame(thresholds, kind)), list(keys), "left")
