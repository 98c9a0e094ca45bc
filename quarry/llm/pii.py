"""Personal data: seed entities by format, more by bootstrapped contexts.

Method. Well-formed emails, ip addresses, cards and phone numbers are the
seeds. The word left and the word right of a span are its lexical patterns
(words without the punctuation around them, lower case, a neighbouring number
included). Instances are the seeds' values and the values of candidates: words
that hold enough digits or an ``@``, and digit groups that blanks, brackets,
dots or dashes part, but are no seed. Pattern-instance edges with counts form a
bipartite graph, scored for a fixed number of rounds:

* confidence of a (pattern, kind): the scores of its instances, weighted by
  edge count, over all occurrences of the pattern's word in the corpus (plus a
  constant); patterns with too few different instances, or too low a
  confidence, have none;
* score of an instance for a kind: 1 for a seed, else 1 minus the product of
  (1 - confidence) over its patterns.

Candidates whose score reaches the threshold are found spans of that kind;
the seeds' spans always stay. Built-in functions only.

Skew: words are counted with map-side partial sums; the pattern scores, which
are joined to edges that may pile up on one word, are spread over salts.

Defined cases: a null text is empty (no spans); null or repeated doc_ids are
kept row by row (equal rows get equal spans); empty tables give empty results;
further columns, clashing names included, are not read; a word of
``spans.CONTEXT`` characters or more is no pattern. A scan is linear in the
text, space-free ones included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACE, written
from quarry.llm.spans import CONTEXT, NONE, Kind, joined, ordered, with_spans

KINDS = ["email", "ip", "card", "phone"]
_LOCAL = "A-Za-z0-9._%+-"

ROUNDS = 3  #: rounds of scoring
MIN_INSTANCES = 3  #: different instances a pattern needs
MIN_CONFIDENCE = 0.2  #: below it a pattern says nothing
SMOOTHING = 2.0  #: added to a pattern's occurrences
THRESHOLD = 0.5  #: score at which a candidate is found
SALTS = 8
BUCKETS = 1 << 18  #: hash buckets of the filter on the words that are counted


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass the Luhn check."""
    digits = F.transform(
        F.split(F.reverse(F.regexp_replace(value, "[^0-9]", "")), ""), lambda c: F.ascii(c) - 48
    )
    worth = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(worth, F.lit(0), lambda a, d: a + d) % 10 == 0


def _digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", ""))


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
SEEDS = [
    Kind("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda t: t.contains("@"), lambda v: F.lit(True)),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda t: t.rlike(r"[0-9]\.[0-9]"), lambda v: v.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", lambda t: t.rlike("[0-9][ -]?[0-9]"),
         lambda v: F.when(_digits(v).between(13, 19), luhn(v)).otherwise(F.lit(False))),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: t.contains("+"),
         lambda v: _digits(v).between(9, 15)),
]
_PUNCT = r"!\"#$%&'()*,./:;<=>?\[\\\]^`{|}~_-"
_EDGE = rf"{SPACE}{_PUNCT}"
#: From the start of a space-free run: 7 to 19 digits in groups, or the run if
#: it holds a digit or an @. Punctuation at the ends doesn't count.
CANDIDATE = Kind(
    "candidate",
    rf"(?<![^{SPACE}])(?:[{_PUNCT}]{{0,3}}+[0-9](?:[\x20()./-]{{0,3}}+[0-9]){{6,18}}+(?![^{_EDGE}])"
    rf"|(?=[^{SPACE}0-9@]*+[0-9@])[^{SPACE}]++)",
    lambda t: t.rlike("[0-9@]"),
    lambda v: (F.length(v) >= 5) & ((_digits(v) >= 4) | v.rlike("[^@]@[^@]")),
    _PUNCT,
)


def spans_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, mark, base, candidates): seeds and candidates of every text."""
    df = docs.select(
        F.col(key).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("mark"),
        F.col(text).alias("_text"),
    )
    df = with_spans(df, "_text", [*SEEDS, CANDIDATE])
    base = F.concat(*[F.col(f"_{k}") for k in KINDS])
    return df.select("doc_id", "mark", base.alias("base"), F.col("_candidate").alias("candidates"))


def _patterns(span: Column) -> Column:
    """L:<word left> and R:<word right>, lower case; none at a text's ends. A
    word as long as the context may be cut, so it is none either."""
    left = F.regexp_extract(span["before"], rf"([^{_EDGE}]++)[{_EDGE}]*+$", 1)
    right = F.regexp_extract(span["after"], rf"^[{_EDGE}]*+([^{_EDGE}]++)", 1)
    both = F.array(
        F.struct(F.lit("L").alias("side"), F.lower(left).alias("word")),
        F.struct(F.lit("R").alias("side"), F.lower(right).alias("word")),
    )
    at_edge = lambda word, context: F.length(word) == F.length(context)
    cut = (F.length(span["before"]) == CONTEXT) & at_edge(left, span["before"]), (F.length(span["after"]) == CONTEXT) & at_edge(right, span["after"])
    both = F.filter(both, lambda p: (p["word"] != "") & ~F.when(p["side"] == "L", cut[0]).otherwise(cut[1]))
    return both


def _fits(value: Column, kind: Column) -> Column:
    """Whether a value can be of a kind at all."""
    return F.when(kind == "email", value.contains("@")).otherwise(
        ~value.contains("@") & (_digits(value) >= F.when(kind == "card", 12).when(kind == "phone", 7).otherwise(4))
    )


def word_counts(docs: DataFrame, text: str, needed: DataFrame) -> DataFrame:
    """(word, n): occurrences in the whole corpus, lower case, of the words in
    ``needed``. Other words are sorted out before the shuffle by the hash
    buckets in use, a broadcast of at most BUCKETS numbers."""
    bucket = F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int")
    used = needed.select(bucket.alias("_b")).distinct()
    parts = F.split(F.lower(F.col(text)), rf"[{_EDGE}]++")
    return (
        docs.select(F.explode(parts).alias("word")).withColumn("_b", bucket)
        .join(F.broadcast(used), "_b", "left_semi")
        .groupBy("word").agg(F.count("*").alias("n"))
        .join(needed, "word", "left_semi")
    )


def score_candidates(edges: DataFrame, docs: DataFrame, text: str, rounds: int = ROUNDS) -> DataFrame:
    """Scores the pattern-instance graph: (kind, value, score) of candidate
    values. ``edges``: side, word, value, kind (null: candidate), n."""
    edges = written(edges, "pii-edges")
    # Patterns with fewer instances are never trusted: no need to count them.
    several = edges.groupBy("side", "word", "value").agg(F.lit(1)).groupBy("side", "word").count()
    needed = written(several.where(F.col("count") >= MIN_INSTANCES).select("word").distinct(), "pii-words")
    totals = written(word_counts(docs, text, needed), "pii-totals")
    seeds = edges.where("kind is not null")
    # A candidate may be of every kind that its value fits.
    open_edges = edges.where("kind is null").drop("kind").withColumn(
        "kind", F.explode(F.array(*map(F.lit, KINDS)))
    ).where(_fits(F.col("value"), F.col("kind")))
    salt = F.pmod(F.xxhash64("value"), F.lit(SALTS)).cast("int")
    open_edges = written(open_edges.withColumn("salt", salt), "pii-open")
    scores = None
    for r in range(rounds):
        known = seeds.select("side", "word", "kind", "value", F.col("n").cast("double").alias("w"))
        if scores is not None:
            learned = open_edges.join(scores, ["kind", "value"]).select(
                "side", "word", "kind", "value", (F.col("n") * F.col("score")).alias("w")
            )
            known = known.unionByName(learned)
        per_instance = known.groupBy("side", "word", "kind", "value").agg(F.sum("w").alias("w"))
        trust = (
            per_instance.groupBy("side", "word", "kind").agg(F.sum("w").alias("w"), F.count("*").alias("instances"))
            .where(F.col("instances") >= MIN_INSTANCES)
            .join(totals, "word", "left")
            .withColumn("trust", F.col("w") / (F.greatest(F.coalesce(F.col("n").cast("double"), F.col("w")), F.col("w")) + SMOOTHING))
            .where(F.col("trust") >= MIN_CONFIDENCE)
            .select("side", "word", "kind", "trust")
        )
        spread = trust.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        scores = written(
            open_edges.join(spread, ["side", "word", "kind", "salt"])
            .groupBy("kind", "value", "side", "word").agg(F.max("trust").alias("trust"))
            .groupBy("kind", "value")
            .agg((F.lit(1.0) - F.exp(F.sum(F.log(F.lit(1.0) - F.least("trust", F.lit(0.999)))))).alias("score")),
            f"pii-scores-{r}",
        )
    return scores


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, base, spans): the seeds' spans of every row, and those plus
    the spans that the contexts found; arrays of struct(kind, start, end,
    value, before, after) by kind as listed, then start."""
    marked = written(spans_of(docs, key, text), "pii-spans")
    items = marked.select("doc_id", "mark", F.explode(F.concat("base", "candidates")).alias("s"))
    kind = F.when(F.col("s.kind") != "candidate", F.col("s.kind"))
    edges = (
        items.select(F.lower(F.col("s.value")).alias("value"), kind.alias("kind"), F.explode(_patterns(F.col("s"))).alias("p"))
        .groupBy(F.col("p.side").alias("side"), F.col("p.word").alias("word"), "value", "kind").agg(F.count("*").alias("n"))
    )
    scores = score_candidates(edges, docs, text, rounds)
    best = (
        scores.where(F.col("score") >= threshold).groupBy("value")
        .agg(F.max_by("kind", F.struct(F.col("score"), F.col("kind"))).alias("found"))
        .withColumnRenamed("value", "_value")
    )
    found = (
        marked.select("doc_id", "mark", F.explode("candidates").alias("s"))
        .join(best, F.lower(F.col("s.value")) == F.col("_value"))
        .select("doc_id", "mark", F.col("s").withField("kind", F.col("found")).alias("s"))
        .groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(F.collect_set("s").alias("extra"))
    )
    apart = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return (
        marked.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
        .withColumn("extra", F.coalesce(F.filter("extra", apart), F.array().cast(NONE)))
        .select(
            "doc_id", ordered(F.col("base"), KINDS, True).alias("base"),
            ordered(F.concat("base", "extra"), KINDS, True).alias("spans"),
        )
    )


def digest(docs: DataFrame) -> DataFrame:
    df = find(docs)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return df.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_found"),
    )
