"""Regex matches with their positions, from built-in functions only.

``regexp_extract_all`` gives the matches and ``split`` the texts between them;
a running sum over both gives every start. The patterns use possessive
quantifiers and look ahead at most as far as they match or, from the start of a
space-free run, to its end once, so a scan is linear in the text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:int,end:int,value:string,before:string,after:string>"
NONE = f"array<{SPAN}>"
CONTEXT = 48  #: code points of context kept on either side of a match
BLOCK = 64  #: matches per block of the two-level running sum


@dataclass(frozen=True)
class Kind:
    """One kind of span. ``maybe`` is a cheap condition that every text with a
    match meets; ``keep`` drops matches (given the matched text); ``edges`` is
    a character class that matches lose at both ends before that."""

    name: str
    pattern: str
    maybe: Callable[[Column], Column]
    keep: Callable[[Column], Column]
    edges: str = ""


def with_spans(df: DataFrame, text: str, kinds: list[Kind]) -> DataFrame:
    """Adds a column ``_<kind>`` of type array<SPAN> per kind, by start."""
    names = df.columns
    for k in kinds:
        found = F.regexp_extract_all(F.col(text), F.lit(k.pattern), F.lit(0))
        df = df.withColumn("_found", F.when(k.maybe(F.col(text)), found))
        between = F.split(F.col(text), k.pattern, -1)
        df = df.withColumn("_gaps", F.when(F.size("_found") > 0, between))
        df = df.withColumn("_rows", F.when(F.size("_found") > 0, _rows()))
        df = df.withColumn("_parts", F.when(F.size("_rows") > 0, _parts(k.name)))
        spans = _kept(_shifted(F.col("_parts")), k)
        df = df.withColumn(f"_{k.name}", F.coalesce(spans, F.array().cast(NONE)))
        names = [*names, f"_{k.name}"]
        df = df.select(*names)
    return df


def _rows() -> Column:
    """Per match: its text, the gaps before and after, and the matches there."""
    n, none = F.size("_found"), F.array(F.lit(""))
    rows = F.arrays_zip(
        F.col("_found").alias("m"), F.col("_gaps").alias("g"), F.slice("_gaps", F.lit(2), n).alias("h"),
        F.concat(none, F.col("_found")).alias("p"), F.concat(F.slice("_found", F.lit(2), n), none).alias("q"),
    )
    return F.slice(rows, F.lit(1), n)


def _parts(kind: str) -> Column:
    """Blocks of matches: (length of the block's text, spans from its start)."""
    n, rows = F.size("_rows"), F.col("_rows")  # a column, so that it isn't made anew for every block
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")),
        lambda b: F.slice(rows, b * BLOCK + 1, F.lit(BLOCK)),
    )
    start = F.struct(F.lit(0).alias("pos"), F.array().cast(NONE).alias("out"))

    def step(acc: Column, r: Column) -> Column:
        at = acc["pos"] + F.length(r["g"])
        end = at + F.length(r["m"])
        span = F.struct(
            F.lit(kind).alias("kind"), at.alias("start"), end.alias("end"), r["m"].alias("value"),
            # The text around the match, a neighbouring match included.
            F.substring(F.concat(r["p"], r["g"]), -CONTEXT, CONTEXT).alias("before"),
            F.substring(F.concat(r["h"], r["q"]), 1, CONTEXT).alias("after"),
        )
        return F.struct(end.alias("pos"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.transform(blocks, lambda part: F.aggregate(part, start, step))


def _shifted(parts: Column) -> Column:
    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<int>").alias("out"))
    offsets = F.aggregate(
        parts, start,
        lambda acc, p: F.struct(
            (acc["pos"] + p["pos"]).alias("pos"),
            F.concat(acc["out"], F.array(acc["pos"])).alias("out"),
        ),
    )["out"]
    return F.flatten(F.zip_with(parts, offsets, lambda p, o: F.transform(
        p["out"],
        lambda s: s.withField("start", s["start"] + o).withField("end", s["end"] + o),
    )))


def _kept(spans: Column, kind: Kind) -> Column:
    if kind.edges:
        skip = lambda v: F.length(F.regexp_extract(v, f"^[{kind.edges}]*+", 0))
        cut = lambda s, a, b: (
            s.withField("start", s["start"] + a).withField("end", s["end"] - b)
            .withField("value", F.substring(s["value"], a + 1, F.greatest(F.length(s["value"]) - a - b, F.lit(0))))
        )
        spans = F.transform(spans, lambda s: cut(s, skip(s["value"]), skip(F.reverse(s["value"]))))
    return F.filter(spans, lambda s: kind.keep(s["value"]))


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined in the order given."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def ordered(spans: Column, kinds: list[str], by_kind: bool) -> Column:
    """Sorted by kind as listed, then start; or by start, then kind."""
    rank = lambda s: F.array_position(F.array(*map(F.lit, kinds)), s["kind"]).cast("int")
    keyed = F.transform(spans, lambda s: F.struct(
        (rank(s) if by_kind else s["start"]).alias("a"), (s["start"] if by_kind else rank(s)).alias("b"),
        s["end"].alias("c"), s.alias("s"),
    ))
    return F.transform(F.array_sort(keyed), lambda x: x["s"])
