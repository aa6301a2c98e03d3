from pulsegrid.plans.blocked import (  # noqa: F401
    apply_windows,
    carry_fill,
    choose_plan,
    epoch_micros,
    with_ordinal,
)
