"""Secret scans: known formats plus sliding-window entropy.

Method: every candidate string (a maximal run of a character class, at least
one window long) gets the Shannon entropy of each window of ``window``
characters. The counts of a window are updated from the window before it: the
entering character adds one, the leaving one takes one, and the sum of
``c * log2 c`` changes by those two terms alone. The counts are five bits each,
twelve in a long, so a step costs the same for any class. A candidate whose
highest window reaches its class's threshold is a span of kind ``entropy``,
unless the allow-list holds for all of it. Built-in functions only; no shuffle:
one pass over the texts, each row by itself.

The allow-list takes a run apart at its signs and looks at every piece with
patterns that are one class after the other: Java runs nested groups by
recursion, which a long run would exhaust.

Defined cases: a null text is empty (no spans); empty texts have no spans;
null or repeated doc_ids, ties and further columns (clashing names included)
pass through, as every row is handled alone (:func:`scan` replaces columns
named ``base_spans`` and ``secret_spans``, :func:`redact` leaves them as they
are); an empty table gives an empty result. Nothing is cut, whatever a text's
length.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import packed, unpacked
from quarry.llm.spans import NONE, Kind, joined, ordered, with_spans

#: The base formats. Possessive quantifiers; a run's inner
#: positions can't start a match that its first position doesn't.
_KEY = r"(?i:password|passwd|secret|token|api_?key)"
ASSIGN = _KEY + r"[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)"
BASE = ["assign", "access", "hex"]
KINDS = [*BASE, "entropy"]


@dataclass(frozen=True)
class CharClass:
    """A class of characters, the bits its windows must reach and the
    characters that a candidate must hold."""

    name: str
    chars: str
    bits: float
    needs: tuple[str, ...]


WINDOW = 20
#: Bits: where one in a hundred random strings of one window lies (hex 2.88,
#: 36 characters 3.35 to 3.40, 32 characters 3.34, 64 characters 3.62).
CLASSES = (
    CharClass("hex", "0-9a-fA-F", 2.88, ("[0-9]", "[a-fA-F]")),
    CharClass("lower", "a-z0-9", 3.34, ("[0-9]", "[a-z]")),
    CharClass("upper", "A-Z0-9", 3.34, ("[0-9]", "[A-Z]")),
    CharClass("base64", "A-Za-z0-9+/=_-", 3.6, ("[0-9]", "[a-z]", "[A-Z]")),
)
#: What may stand between the pieces of a run, and sequences
#: that alphabets consist of.
SIGNS = "[+/=_-]"
ALPHABETS = (
    "abcdefghijklmnopqrstuvwxyz|ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "0123456789abcdef|0123456789ABCDEF|0123456789|abcdefghijklmnop|ABCDEFGHIJKLMNOP|" + SIGNS,
)
UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
PLACEHOLDER = "EXAMPLE(?:KEY)?$"


def is_word(piece: Column) -> Column:
    """A word, camel case included, with up to four digits behind it: capitals
    only, or letters whose capitals all have a small letter behind them; or up
    to four digits alone."""
    return (
        piece.rlike("^[0-9]{0,4}$") | piece.rlike("^[A-Z]{2,}+[0-9]{0,4}$")
        | (piece.rlike("^[A-Za-z]++[0-9]{0,4}$") & ~piece.rlike("[A-Z](?![a-z])"))
    )


def allowed(value: Column) -> Column:
    """No secret: words alone or between signs, UUIDs, alphabets in order, and
    what documentation marks as an example at its end."""
    rest = value
    for sequences in ALPHABETS:
        rest = F.regexp_replace(rest, sequences, "")
    return F.forall(F.split(value, f"{SIGNS}++"), is_word) | value.rlike(UUID) | value.rlike(PLACEHOLDER) | (rest == "")


_SLOTS, _BITS, _LONGS = 12, 5, 8  # counts in a long, bits of a count, longs for the characters from blank to ~
#: What a count's step from c to c + 1 adds to the sum of c * log2 c.
_STEPS = [(c + 1) * log2(c + 1) - (c * log2(c) if c else 0.0) for c in range((1 << _BITS) - 1)]


def entropy(value: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy (bits) of any window of printable ASCII
    ``value``, windows of up to 31 characters; -1 where it is shorter than one
    window."""
    if not 0 < window < 1 << _BITS:
        raise ValueError(f"a window has 1 to {(1 << _BITS) - 1} characters, not {window}")
    steps = F.array(*map(F.lit, _STEPS))
    slots = F.transform(F.split(value, ""), lambda c: F.ascii(c) - 32)
    leaving = F.concat(F.array_repeat(F.lit(None).cast("int"), window), F.slice(slots, F.lit(1), F.greatest(F.size(slots) - window, F.lit(0))))
    pairs = F.slice(F.zip_with(slots, leaving, lambda x, y: F.struct(x.alias("came"), y.alias("went"))), F.lit(1), F.length(value))
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), _LONGS).alias("counts"), F.lit(0.0).alias("sum"),
        F.lit(0).alias("n"), F.lit(float("inf")).alias("least"),
    )
    word = lambda slot: F.floor(slot / _SLOTS).cast("int")
    shift = lambda slot: F.pmod(slot, F.lit(_SLOTS)) * _BITS
    shifted = lambda side, number, slot: F.call_function(f"shift{side}", number, shift(slot))
    one = F.lit(1).cast("long")

    def count(acc: Column, slot: Column) -> Column:
        return shifted("right", F.element_at(acc["counts"], word(slot) + 1), slot).bitwiseAND((1 << _BITS) - 1).cast("int")

    def step(acc: Column, p: Column) -> Column:
        came, went = p["came"], p["went"]
        counts = F.transform(acc["counts"], lambda c, i: (
            c + F.when(i == word(came), shifted("left", one, came)).otherwise(F.lit(0))
            - F.when(i == word(went), shifted("left", one, went)).otherwise(F.lit(0))
        ))
        gain = F.element_at(steps, count(acc, came) + 1)
        loss = F.when(went.isNotNull(), F.element_at(steps, count(acc, went))).otherwise(F.lit(0.0))
        total = acc["sum"] + F.when(came.eqNullSafe(went), F.lit(0.0)).otherwise(gain - loss)
        n = acc["n"] + 1
        return F.struct(
            counts.alias("counts"), total.alias("sum"), n.alias("n"),
            F.when(n >= window, F.least(acc["least"], total)).otherwise(acc["least"]).alias("least"),
        )

    # The fewer repeats, the more bits.
    return F.aggregate(
        pairs, start, step,
        lambda acc: F.when(acc["n"] >= window, log2(window) - acc["least"] / window).otherwise(F.lit(-1.0)),
    )


def _kinds(window: int, classes: tuple[CharClass, ...], allow: Callable[[Column], Column]) -> list[Kind]:
    yes = lambda text: text.isNotNull()
    kinds = [
        Kind("assign", ASSIGN, lambda t: t.contains("=") | t.contains(":"),
             lambda v: F.length(F.regexp_extract(v, ASSIGN, 1)) >= 6),
        Kind("access", "AKIA[A-Z0-9]++", lambda t: t.contains("AKIA"), lambda v: F.length(v) >= 20),
        Kind("hex", "(?<![0-9a-f])[0-9a-f]{24,}+", yes, lambda v: F.length(v) >= 24),
    ]
    for c in classes:
        def keep(v: Column, c: CharClass = c) -> Column:
            ok = ~allow(v)
            for needed in c.needs:
                ok = v.rlike(needed) & ok
            return F.when(ok, entropy(v, window) >= c.bits).otherwise(F.lit(False))

        run = f"(?<![{c.chars}])[{c.chars}]{{{window},}}+"
        kinds.append(Kind(f"entropy_{c.name}", run, lambda t: t.rlike("[0-9]"), keep))
    return kinds


def _scanned(
    docs: DataFrame, text: str, window: int = WINDOW,
    classes: tuple[CharClass, ...] = CLASSES, allow: Callable[[Column], Column] = allowed,
) -> DataFrame:
    """(row, base_spans, secret_spans): the columns of ``docs`` in ``row``."""
    kinds = _kinds(window, classes, allow)
    df = packed(docs)
    df = with_spans(df.withColumn("text", F.col("row").getField(text)), "text", kinds)
    base = F.concat(*[F.col(f"_{k}") for k in BASE])
    extra = F.transform(
        F.concat(*[F.col(f"_{k.name}") for k in kinds[len(BASE):]]),
        lambda s: s.withField("kind", F.lit("entropy")),
    )
    df = df.withColumn("base", base).withColumn("extra", extra)
    places = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    df = df.withColumn("places", places).withColumn("extra", F.when(
        F.size("extra") > 0,
        F.filter("extra", lambda s: ~F.array_contains(
            F.col("places"), F.struct(s["start"].alias("start"), s["end"].alias("end"))
        )),
    ).otherwise(F.array().cast(NONE)))
    df = df.withColumn("all", ordered(F.concat("base", "extra"), KINDS, False))

    def first_of_its_place(s: Column, i: Column) -> Column:
        # Classes overlap, so two of them may have found the same run.
        other = F.get(F.col("all"), i - 1)
        return (i == 0) | (other["kind"] != s["kind"]) | (other["start"] != s["start"]) | (other["end"] != s["end"])

    return df.select(
        "row", ordered(F.col("base"), KINDS, False).alias("base_spans"), F.filter("all", first_of_its_place).alias("secret_spans")
    )


def scan(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with ``base_spans`` and ``secret_spans`` (base and entropy),
    arrays of struct(kind, start, end, value, before, after) by start, then
    kind; an entropy span equal in place to a base span is not repeated."""
    names = [c for c in docs.columns if c not in ("base_spans", "secret_spans")]
    df = _scanned(docs, text, **options)
    return df.select(*[F.col("row").getField(n).alias(n) for n in names], "base_spans", "secret_spans")


def redact(docs: DataFrame, text: str = "text", mask: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with every span of :func:`scan` replaced by ``mask`` (spans
    that touch or overlap become one); same columns, null texts stay null."""
    df = _scanned(docs, text, **options).withColumn("body", F.col("row").getField(text))
    start = F.struct(
        F.lit(0).alias("done"), F.array().cast("array<struct<a:int,b:int>>").alias("out")
    )
    # Merged spans as (first code point kept before it, its own start).
    merged = F.aggregate(
        F.col("secret_spans"), start,
        lambda acc, s: F.struct(
            F.greatest(acc["done"], s["end"]).alias("done"),
            F.when(s["start"] < acc["done"], acc["out"]).otherwise(F.concat(
                acc["out"], F.array(F.struct(acc["done"].alias("a"), s["start"].alias("b")))
            )).alias("out"),
        ),
    )
    df = df.withColumn("merged", F.when(F.size("secret_spans") > 0, merged))
    pieces = F.transform(
        F.col("merged.out"),
        lambda p: F.concat(F.substring(F.col("body"), p["a"] + 1, p["b"] - p["a"]), F.lit(mask)),
    )
    tail = F.substring(F.col("body"), F.col("merged.done") + 1, F.length("body"))
    clean = F.when(F.col("merged").isNull(), F.col("body")).otherwise(
        F.concat(F.array_join(pieces, ""), tail)
    )
    return unpacked(df, docs.columns, **{text: clean})


def digest(docs: DataFrame) -> DataFrame:
    """The query's columns from :func:`scan` over (doc_id, text)."""
    df = scan(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base_spans", lambda s: s["kind"] == k)).cast("long")
    return df.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(joined(F.col("base_spans")), 256).alias("base_sha256"),
        joined(F.col("secret_spans")).alias("spans"),
    )


def _sql_matches(kind: str, pattern: str, keep: str) -> str:
    """Rows (doc, kind, start, stop) of a pattern's matches, located by the
    lengths of the texts between them."""
    return f"""
  SELECT doc_id, rn, '{kind}' AS kind, m, start, start + len(m) AS stop FROM (
    SELECT doc_id, rn, ms[i] AS m,
           list_sum(list_transform(gs[1:i], lambda g: len(g))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: len(x))), 0) AS start
    FROM (SELECT doc_id, rn, ms, gs, unnest(range(1, len(ms) + 1)) AS i FROM (
      SELECT doc_id, rn, regexp_extract_all(text, $r${pattern}$r$) AS ms, string_split_regex(text, $r${pattern}$r$) AS gs FROM docs)))
  WHERE {keep}"""


_ASSIGN_SQL = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
_PIECE = "[A-Z]{2,}[0-9]{0,4}|[0-9]{0,4}|[A-Z]?[a-z]+([A-Z][a-z]+)*[0-9]{0,4}"


def _entropy_sql(c: CharClass) -> str:
    rules = [
        *[f"regexp_matches(m, '{n}')" for n in c.needs],
        f"NOT regexp_full_match(m, '({_PIECE})([+/=_-]+({_PIECE}))*')",
        f"NOT regexp_matches(m, '{UUID}')", f"NOT regexp_matches(m, '{PLACEHOLDER}')",
        f"regexp_replace(regexp_replace(m, '{ALPHABETS[0]}', '', 'g'), '{ALPHABETS[1]}', '', 'g') <> ''",
        f"list_max(list_transform(range(1, len(m) - {WINDOW - 2}), lambda i: "
        f"list_aggregate(string_split(substr(m, i, {WINDOW}), ''), 'entropy'))) >= {c.bits}",
    ]
    return _sql_matches(c.name, f"[{c.chars}]{{{WINDOW},}}", " AND ".join(rules))


ORACLE_SQL = (
    "WITH docs AS (SELECT doc_id, row_number() OVER () AS rn, coalesce(text, '') AS text FROM documents), base AS ("
    + _sql_matches("assign", _ASSIGN_SQL, r"len(regexp_extract(m, '[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)$', 1)) >= 6")
    + " UNION ALL " + _sql_matches("access", "AKIA[A-Z0-9]+", "len(m) >= 20")
    + " UNION ALL " + _sql_matches("hex", "[0-9a-f]+", "len(m) >= 24")
    + "), found AS (SELECT DISTINCT doc_id, rn, 'entropy' AS kind, start, stop FROM ("
    + " UNION ALL ".join(map(_entropy_sql, CLASSES))
    + """)), spans AS (
  SELECT doc_id, rn, kind, start, stop FROM base UNION ALL
  SELECT * FROM found f WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rn = f.rn AND b.start = f.start AND b.stop = f.stop)),
digest AS (
  SELECT rn, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, list_position(['assign', 'access', 'hex', 'entropy'], kind), stop) AS spans,
         coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, list_position(['assign', 'access', 'hex', 'entropy'], kind), stop) FILTER (kind <> 'entropy'), '') AS base,
         count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex
  FROM spans GROUP BY rn)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN digest USING (rn)
"""
)
