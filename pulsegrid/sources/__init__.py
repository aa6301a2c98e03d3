from pulsegrid.sources.panels import (  # noqa: F401
    daily_orders,
    hourly_by_type,
    masked,
    single_series,
    user_series,
)
from pulsegrid.sources.spine import fill_on_spine, time_spine  # noqa: F401
