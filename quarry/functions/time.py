"""Event-time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_event_time(c: Column | str) -> Column:
    """Event-time column usable by ``withWatermark``: a ``TIMESTAMP``.

    ``TIMESTAMP_NTZ`` input (as in the driver tables) is re-read in the
    session time zone; keep the session on UTC so the instants are the
    wall-clock values.
    """
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("timestamp")
