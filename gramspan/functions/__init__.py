from gramspan.functions.vector import (
    clip,
    dot,
    euclidean,
    linear,
    manhattan,
    nearest,
    round_half_away,
    safe_divide,
    sigmoid,
    soft_threshold,
    squared_distance,
)

__all__ = [
    "clip",
    "dot",
    "euclidean",
    "linear",
    "manhattan",
    "nearest",
    "round_half_away",
    "safe_divide",
    "sigmoid",
    "soft_threshold",
    "squared_distance",
]
