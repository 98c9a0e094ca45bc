"""String splitting, kept as JVM-side column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_words(c: Column | str) -> Column:
    """Whitespace split: runs of blanks collapse and the ends are trimmed,
    so ``"  a   b "`` gives ``[a, b]`` and a blank line gives ``[]``."""
    trimmed = F.regexp_replace(_col(c), r"^\s+|\s+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"\s+")
    )


def split_list(c: Column | str, sep: str = ",") -> Column:
    """Plain separator split: no trimming, no case folding, empty items kept
    (``"x,,x"`` gives ``[x, '', x]``); null stays null."""
    return F.split(_col(c), re.escape(sep))
