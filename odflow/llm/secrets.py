"""Secret scans with a trigram index.

Each rule's regex is turned into a Boolean query over the trigrams that any match must contain. The
postings of those trigrams (which rows have them) are intersected per rule, and only rows that
satisfy a query are searched with its regex. A rule without mandatory trigrams searches every row. All of it
is built-in column functions, joins and aggregates.

The index folds case, so it finds a superset of what the regexes match; nothing is ever missed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as kinds
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflow.llm.common import packed

# A query over trigrams: a list of alternatives, each a set of trigrams that are all needed.
Query = tuple[frozenset[str], ...]
ANYTHING: Query = (frozenset(),)
# Beyond these sizes a query is weakened, never narrowed.
MAX_STRINGS, MAX_ALTERNATIVES, MAX_CLASS = 64, 64, 8


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` count if the group has ``min_chars`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 1
    base: bool = True


# Fixed patterns of the base kinds; a run of hex digits shorter than its minimum cannot count, so it is not matched.
RULES = (
    Rule("assign", r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", base=False),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
)


def _simplest(query: list[frozenset[str]]) -> Query:
    """Alternatives that do not contain another one."""
    kept: list[frozenset[str]] = []
    for need in sorted(set(query), key=lambda need: (len(need), sorted(need))):
        if not any(less <= need for less in kept):
            kept.append(need)
    return tuple(kept) if len(kept) <= MAX_ALTERNATIVES else ANYTHING


def _both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > MAX_ALTERNATIVES:
        return min(a, b, key=lambda q: (q == ANYTHING, len(q)))
    return _simplest([x | y for x in a for y in b])


def _of_strings(strings: frozenset[str]) -> Query:
    return _simplest([frozenset(s[i: i + 3] for i in range(len(s) - 2)) for s in strings])


def _walk(tokens) -> tuple[frozenset[str] | None, Query]:
    """The strings an expression can match, if they are few, and what any match must contain."""
    strings, query, exact = frozenset([""]), ANYTHING, True
    for op, value in tokens:
        more: frozenset[str] | None = None
        inner = ANYTHING
        if op is kinds.LITERAL:
            more = frozenset([chr(value).lower()])
        elif op is kinds.IN and all(item is kinds.LITERAL for item, _ in value) and len(value) <= MAX_CLASS:
            more = frozenset(chr(code).lower() for _, code in value)
        elif op is kinds.SUBPATTERN:
            more, inner = _walk(value[-1])
        elif op is kinds.BRANCH:
            parts = [_walk(branch) for branch in value[1]]
            if all(found is not None for found, _ in parts):
                more = frozenset().union(*[found for found, _ in parts])
            inner = _simplest([need for found, needs in parts
                               for need in (needs if found is None else _of_strings(found))])
        elif op in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT):
            least, most, body = value
            found, inner = _walk(body)
            if found is not None:
                inner = _of_strings(found)
                if most == 1:
                    more = found | frozenset([""]) if least == 0 else found
            if least == 0:
                inner = ANYTHING
        elif op is kinds.AT:
            more = frozenset([""])
        if more is not None and len(more) * len(strings) <= MAX_STRINGS:
            strings = frozenset(a + b for a in strings for b in more)
            continue
        if more is not None:
            inner = _both(inner, _of_strings(more))
        query = _both(_both(query, _of_strings(strings)), inner)
        strings, exact = frozenset([""]), False
    if exact:
        return strings, ANYTHING
    return None, _both(query, _of_strings(strings))


def trigram_query(pattern: str) -> Query:
    """The trigrams, in lower case, of which any match of the regex has all of some alternative."""
    strings, query = _walk(parser.parse(pattern))
    return query if strings is None else _of_strings(strings)


def postings(docs: DataFrame, trigrams: list[str], key: str = "_key", text: str = "text") -> DataFrame:
    """(trigram, key) for each of the trigrams that a row's text has, case folded."""
    folded = F.lower(F.col(text))
    having = F.filter(F.array(*[F.lit(t) for t in trigrams]), lambda t: F.contains(F.col("_folded"), t))
    return (docs.select(F.col(key), folded.alias("_folded"))
            .select(F.explode(having).alias("trigram"), key))


def candidates(docs: DataFrame, rules: tuple[Rule, ...], key: str = "_key") -> DataFrame:
    """(key, kinds): the rules, of those with mandatory trigrams, whose query a row satisfies."""
    spark = docs.sparkSession
    needs = [(rule.kind, number, trigram, len(need)) for rule in rules
             for number, need in enumerate(trigram_query(rule.pattern)) for trigram in sorted(need)]
    # As small as the rules are: a row per trigram of a query.
    terms = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.lit(number).alias("alternative"), F.lit(trigram).alias("trigram"),
                 F.lit(need).alias("need")) for kind, number, trigram, need in needs])))
    found = postings(docs, sorted({need[2] for need in needs}), key).join(F.broadcast(terms), "trigram")
    # Partitioned by row once; both aggregates follow.
    met = (found.repartition(key).groupBy(key, "kind", "alternative", "need")
           .agg(F.collect_set("trigram").alias("has")).filter(F.size("has") == F.col("need")))
    return met.groupBy(key).agg(F.collect_set("kind").alias("kinds"))


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """Counted matches of a rule, left to right without overlap: (start, rank, end, kind), in characters."""
    # Each match of this goes from the end of the one before to the end of the next match of the rule.
    walk = F.lit(rf"\G(?s:(.*?))({rule.pattern})")
    steps = F.arrays_zip(F.regexp_extract_all(text, walk, F.lit(0)).alias("step"),
                         F.regexp_extract_all(text, walk, F.lit(2)).alias("match"),
                         F.regexp_extract_all(text, walk, F.lit(2 + rule.group)).alias("value"))
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")

    def add(state: Column, step: Column) -> Column:
        end = state["at"] + F.length(step["step"])
        span = F.struct((end - F.length(step["match"])).alias("start"), F.lit(rank).alias("rank"),
                        end.alias("end"), F.lit(rule.kind).alias("kind"))
        counts = F.length(step["value"]) >= rule.min_chars
        return F.struct(end.alias("at"), F.when(counts, F.concat(state["spans"], F.array(span)))
                        .otherwise(state["spans"]).alias("spans"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("at"), empty.alias("spans")), add, lambda state: state["spans"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``secrets``: spans (start, rank, end, kind) by start and then rank of the rule.

    Offsets count code points, ends are exclusive. NULL text is empty. Spans of different rules may
    overlap. Repeated rows are each scanned; a column of ``docs`` named secrets is replaced.
    """
    # A row's key in the index: equal keys can only add a search, so a collision does no harm. The id is in it
    # so that copies of a text spread over the partitions.
    key = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns if c in ("doc_id", "text")])
    keyed = docs.select(packed(docs, but=("secrets",)), key.alias("_key"))
    indexed = tuple(rule for rule in rules if trigram_query(rule.pattern) != ANYTHING)
    if indexed:
        keyed = keyed.join(candidates(docs.select(key.alias("_key"), "text"), indexed)
                           .withColumnRenamed("_key", "_found"), F.col("_key") == F.col("_found"), "left")
    else:
        keyed = keyed.withColumn("kinds", F.array().cast("array<string>"))
    nothing = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    parts = []
    for rank, rule in enumerate(rules):
        searched = F.col("row.text").rlike(rule.pattern)
        if rule in indexed:
            searched = F.array_contains("kinds", rule.kind)
        parts.append(F.when(searched, _spans(F.col("row.text"), rule, rank)).otherwise(nothing))
    return keyed.select("row.*", F.sort_array(F.concat(*parts)).alias("secrets"))


def span_list(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by ``mark`` and ``n_chars`` counted anew where that was done.

    Overlapping spans are replaced as one. All rows and columns stay, but for a column named secrets.
    """
    def step(state: Column, span: Column) -> Column:
        inside = span["start"] < state["at"]
        before = F.substring(F.col("text"), state["at"] + 1, span["start"] - state["at"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"),
                        F.when(inside, state["out"]).otherwise(F.concat(state["out"], before, F.lit(mark))).alias("out"))

    def finish(state: Column) -> Column:
        return F.concat(state["out"], F.substring(F.col("text"), state["at"] + 1, F.length("text")))

    scanned = scan(docs, rules)
    found = F.size("secrets") > 0
    clean = F.aggregate("secrets", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, finish)
    out = scanned.withColumn("text", F.when(found, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(found, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
