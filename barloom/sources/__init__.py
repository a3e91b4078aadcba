from barloom.sources.files import read_bars, read_panel, write_bars, write_panel
from barloom.sources.results import (
    comparison_table,
    detail_table,
    evaluation_table,
    write_details,
    write_evaluation,
)
from barloom.sources.store import SeriesStore
from barloom.sources.ticks import bars_from_ticks

__all__ = [
    "SeriesStore",
    "bars_from_ticks",
    "comparison_table",
    "detail_table",
    "evaluation_table",
    "read_bars",
    "read_panel",
    "write_bars",
    "write_details",
    "write_evaluation",
    "write_panel",
]
