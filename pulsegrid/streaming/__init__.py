from pulsegrid.streaming.rolling_state import (  # noqa: F401
    current_stats_view,
    replay_source,
    run_to_table,
    stream_rolling,
)
