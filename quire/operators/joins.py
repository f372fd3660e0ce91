"""Joins with an explicit, checked broadcast decision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when its row count is known to be at most this.
# Key/offset tables are a few dozen bytes per row, so this stays well under the
# usual executor broadcast budget.
DEFAULT_BROADCAST_ROWS = 2_000_000


def maybe_broadcast(small: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                    known_rows: int | None = None) -> DataFrame:
    """``broadcast(small)`` when it has at most ``max_rows`` rows, else as is.

    ``known_rows`` skips the count when the caller already has it.  Beyond the
    bound the join stays a shuffle join (sort-merge; AQE may still switch it
    at run time from measured sizes).
    """
    n = small.count() if known_rows is None else known_rows
    return F.broadcast(small) if n <= max_rows else small
