from temblor.plans.batch import (
    average_magnitude,
    depth_per_state,
    depth_running,
    equator_monthly_average,
    event_pairs,
    events_on_day,
    foreshock_pairs,
    hemisphere_monthly,
    largest_aftershock,
    largest_foreshock,
    ratio_gt3_per_state,
    state_frequency,
    tsunami_by_significance,
    yearly_tsunami_share,
)
from temblor.plans.clean import preprocess_quakes

__all__ = [
    "average_magnitude",
    "depth_per_state",
    "depth_running",
    "equator_monthly_average",
    "event_pairs",
    "events_on_day",
    "foreshock_pairs",
    "hemisphere_monthly",
    "largest_aftershock",
    "largest_foreshock",
    "preprocess_quakes",
    "ratio_gt3_per_state",
    "state_frequency",
    "tsunami_by_significance",
    "yearly_tsunami_share",
]
