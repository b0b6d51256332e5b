from temblor.functions.columns import (
    count_where,
    hemisphere,
    in_band,
    in_period,
    literal_like,
    ratio,
)

__all__ = ["count_where", "hemisphere", "in_band", "in_period", "literal_like", "ratio"]
