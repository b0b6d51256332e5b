from temblor.sources.files import read_quakes_csv, read_table
from temblor.sources.geojson import flatten_geojson, read_geojson, read_geojson_features
from temblor.sources.replay import release_slices, replay_slices, stage_slices, write_slices
from temblor.sources.stream import read_quake_stream, read_text_stream

__all__ = [
    "flatten_geojson",
    "read_geojson",
    "read_geojson_features",
    "read_quake_stream",
    "read_quakes_csv",
    "read_table",
    "read_text_stream",
    "release_slices",
    "replay_slices",
    "stage_slices",
    "write_slices",
]
