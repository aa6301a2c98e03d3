from pulsegrid.functions.numeric import (  # noqa: F401
    adjusted_kurtosis,
    adjusted_skewness,
    hash_uniform,
    key_normal,
    key_uniform,
    safe_div,
)
