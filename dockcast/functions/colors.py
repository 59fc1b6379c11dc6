"""Display colour of a cluster label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marker colours in palette order.
PALETTE = [
    "red", "blue", "green", "purple", "orange", "darkred", "lightred", "beige", "darkblue",
    "darkgreen", "cadetblue", "darkpurple", "white", "pink", "lightblue", "lightgreen", "gray",
    "black", "lightgray",
]


def cluster_color(label: str) -> Column:
    """Colour of a label; labels beyond the palette start over, null stays null."""
    names = ", ".join(f"'{c}'" for c in PALETTE)
    spot = f"cast(pmod({label}, {len(PALETTE)}) + 1 AS int)"
    return F.expr(f"CASE WHEN {label} IS NOT NULL THEN element_at(array({names}), {spot}) END")
