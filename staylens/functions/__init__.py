"""Column expressions shared by the operators (all JVM-side, codegen-friendly)."""

from staylens.functions.columns import (
    amenity_list,
    amenity_tokens_raw,
    ascii_upper,
    count_found_in,
    haversine_km,
    money_a,
    money_b,
    nights_per_year,
    text_tokens,
)

__all__ = [
    "amenity_list",
    "amenity_tokens_raw",
    "ascii_upper",
    "count_found_in",
    "haversine_km",
    "money_a",
    "money_b",
    "nights_per_year",
    "text_tokens",
]
