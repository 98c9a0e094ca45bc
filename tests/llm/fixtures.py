"""Small tables with the awkward rows every operator must bear: nulls, empty,
blank and long texts, repeated rows, clashing column names."""

from __future__ import annotations

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "kind string, spans string, row long, score double, node long, key long"
)


def docs(spark, rows):
    """rows: (doc_id, text[, source])."""
    full = [
        (r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or ""), "k", "s", 1, 0.5, 2, 3) for r in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


AWKWARD = [
    (0, None), (1, ""), (2, "   \t\n"), (3, "one"), (3, "one"), (None, "no id here"), (None, None),
    (4, "é ñ 中文 \U0001f600 " * 3), (5, "word " * 30_000), (6, "x" * 50_000),
]
