from cofi.functions.scalar import (
    RATING_HI,
    RATING_LO,
    checked_rating,
    denormalize,
    in_range,
    mean_or_zero,
    normalized_deviation,
    round_key,
    round_out,
    safe_int,
    scale,
    std_or_zero,
    weighted_deviation,
)

__all__ = [
    "RATING_HI", "RATING_LO", "checked_rating", "scale", "normalized_deviation", "denormalize",
    "weighted_deviation", "safe_int", "in_range", "mean_or_zero", "std_or_zero", "round_out", "round_key",
]
