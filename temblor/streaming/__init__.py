from temblor.streaming.joins import (
    both_sides,
    fold_history,
    stored_join_sink,
    stream_location_join,
)
from temblor.streaming.late import SETTINGS as LATE_SETTINGS
from temblor.streaming.late import late_metrics, late_rows, late_rows_sink, with_late_merged, with_late_rows
from temblor.streaming.parse import parse_quakes
from temblor.streaming.run import await_all, start_changelog
from temblor.streaming.windows import (
    stream_all,
    stream_avg_magnitude,
    stream_count_gt3,
    stream_equator_count_gt4,
    stream_equator_max,
)

__all__ = [
    "LATE_SETTINGS",
    "await_all",
    "both_sides",
    "fold_history",
    "late_metrics",
    "late_rows",
    "late_rows_sink",
    "parse_quakes",
    "start_changelog",
    "stored_join_sink",
    "stream_all",
    "stream_avg_magnitude",
    "stream_count_gt3",
    "stream_equator_count_gt4",
    "stream_equator_max",
    "stream_location_join",
    "with_late_merged",
    "with_late_rows",
]
