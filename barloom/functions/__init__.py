from barloom.functions.frames import full, long_extreme, long_mean, prior, trailing
from barloom.functions.scalar import (
    EPSILON,
    change,
    display_name,
    epoch_micros,
    epoch_seconds,
    finite,
    flag,
    ratio,
    row_hash,
    since_epoch,
    time_bucket,
    zero_if_missing,
)

__all__ = [
    "EPSILON",
    "change",
    "display_name",
    "epoch_micros",
    "epoch_seconds",
    "finite",
    "flag",
    "full",
    "long_extreme",
    "long_mean",
    "prior",
    "ratio",
    "row_hash",
    "since_epoch",
    "time_bucket",
    "trailing",
    "zero_if_missing",
]
