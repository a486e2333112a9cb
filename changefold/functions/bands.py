"""Label a number by descending lower bounds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Bands:
    bounds: tuple[tuple[int, str], ...]
    otherwise: str


# The three credit scales in use.
CREDIT_TIERS = Bands(((750, "Excellent"), (700, "Good"), (650, "Average")), "Poor")
CREDIT_BANDS = Bands(
    (
        (800, "800+ Excellent"),
        (750, "750-799 Very Good"),
        (700, "700-749 Good"),
        (650, "650-699 Average"),
        (600, "600-649 Below Average"),
    ),
    "Below 600 Poor",
)
PRICING_TIERS = Bands(((780, "excellent"), (720, "good"), (650, "average")), "poor")


def band(value: Column, bands: Bands) -> Column:
    """First label whose bound ``value`` reaches; NULL takes the last label like any low value."""
    label = F.lit(bands.otherwise)
    for bound, name in sorted(bands.bounds):
        label = F.when(value >= bound, F.lit(name)).otherwise(label)
    return label
