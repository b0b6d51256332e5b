from temblor.operators.latest import compacted, drop_repeats, latest_view
from temblor.operators.proximity import proximity_join, within_reach
from temblor.operators.running import running_profile
from temblor.operators.skew import expand_copies, merge_copies, tile_hot_keys
from temblor.operators.strongest import strongest_near

__all__ = [
    "compacted",
    "drop_repeats",
    "expand_copies",
    "latest_view",
    "merge_copies",
    "proximity_join",
    "running_profile",
    "strongest_near",
    "tile_hot_keys",
    "within_reach",
]
