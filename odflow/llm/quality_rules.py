"""Quality rules, lines first.

Every line with a word is judged by itself: a line without a sentence mark, a line full of symbols
or shouting, a navigation line or a boilerplate line fails. Failing lines are removed, and a
document that loses too large a share of its text is rejected. Before that a document fails the base rules if
it has too few words or repeats itself. All of it is built-in column functions, row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odflow.llm.common import packed

# White space between words, and the symbols that are counted.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WORD = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class LineRules:
    """Patterns are read alike by Java and RE2."""

    sentence_mark: str = "[.!?…:;。！？]"
    navigation: str = (r"(?i)^[ \t]*(home|menu|search|log ?in|sign ?(in|up)|next|previous|back to top|contact( us)?|"
                       r"about( us)?|site ?map)[ \t]*([|>»•·/-].*)?$")
    boilerplate: str = (r"(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie|licensed under|"
                        r"released under|subscribe (now|to)|enable javascript|copyright \(?c|©)")
    # A line has too many symbols, or too many shouts (!!), if that many come on one word.
    symbols_per_word: float = 0.3
    shouts_per_word: float = 0.3
    # Share of the characters in words that must survive.
    min_kept: float = 0.6
    min_words: int = 50
    max_repeat_percent: int = 50


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")


def failing(line: Column, rules: LineRules) -> Column:
    """Whether a line with a word fails a rule."""
    words = F.size(_words(line))
    symbols = F.length(line) - F.length(_without(line, SYMBOLS))
    shouts = (F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("")))) / 2
    # Words are counted only where there is something to hold against them; most lines have neither symbols nor shouts.
    return (~line.rlike(rules.sentence_mark) | line.rlike(rules.navigation) | line.rlike(rules.boilerplate)
            | ((symbols > 0) & (symbols > words * rules.symbols_per_word))
            | ((shouts > 0) & (shouts > words * rules.shouts_per_word)))


def _with_repeated_words(docs: DataFrame) -> DataFrame:
    """Add n_repeat_words: of ``_words``, those in a window of three words that occurs twice or more.

    The steps are columns of their own: an expression used twice would be worked out twice.
    """
    size = F.size("_words")
    zipped = F.arrays_zip(F.col("_words").alias("a"), F.slice("_words", 2, size).alias("b"), F.slice("_words", 3, size).alias("c"))
    # The last two positions begin no window.
    windows = F.filter(F.transform(zipped, lambda w, at: F.struct(F.concat_ws(" ", w["a"], w["b"], w["c"]).alias("w"),
                                                                  at.alias("at"), w["c"].isNotNull().alias("whole"))),
                       lambda w: w["whole"])
    docs = docs.withColumn("_windows", F.sort_array(windows))
    # Equal windows are neighbours now; each is compared with the ones on its sides.
    texts, count = F.col("_windows").getField("w"), F.size("_windows")
    before = F.concat(F.array(F.lit(None).cast("string")), F.slice(texts, 1, F.greatest(count - 1, F.lit(0))))
    after = F.slice(texts, 2, F.greatest(count, F.lit(0)))
    around = F.arrays_zip(F.col("_windows").alias("own"), before.alias("before"), after.alias("after"))
    docs = docs.withColumn("_around", around)
    twice = F.filter("_around", lambda w: w["own"].isNotNull() & (w["own"]["w"].eqNullSafe(w["before"])
                                                                  | w["own"]["w"].eqNullSafe(w["after"])))
    docs = docs.withColumn("_starts", F.sort_array(F.transform(twice, lambda w: w["own"]["at"])))
    # A window covers three words, less those that the repeated window before it covers.
    covered = F.aggregate(
        "_starts", F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda state, at: F.struct(at.alias("last"), (state["n"] + F.least(F.lit(3), at - state["last"])).alias("n")),
        lambda state: state["n"])
    return docs.withColumn("n_repeat_words", covered)


def measure(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_failed_lines, clean_text,
    base_failed and kept; columns of ``docs`` with these names are replaced.

    NULL text counts as empty: no words, base_failed. ``clean_text`` has the lines that pass, and lines without
    a word as they are.
    """
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_failed_lines", "clean_text",
           "base_failed", "kept"]
    text = F.coalesce("text", F.lit(""))
    split = docs.select(packed(docs, but=(*new, "text")), F.col("text").alias("_original"), text.alias("_text"), _words(text).alias("_words"),
                        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)).alias("_lines"))
    judged = split.withColumns({
        "_bad": F.filter("_lines", lambda line: failing(line, rules)),
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(_without(F.col("_text"), SPACES)).cast("long"),
        "n_symbols": (F.length("_text") - F.length(_without(F.col("_text"), SYMBOLS))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    })
    judged = _with_repeated_words(judged)
    lost = F.length(_without(F.array_join("_bad", ""), SPACES))
    base_failed = ((F.col("n_words") < rules.min_words)
                   | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")))
    clean = F.array_join(F.filter(F.split("_text", "\n"), lambda line: ~(line.rlike(WORD) & failing(line, rules))), "\n")
    enough = F.col("word_chars") - lost >= F.col("word_chars") * rules.min_kept
    return (judged.withColumns({"n_failed_lines": F.size("_bad").cast("long"), "clean_text": clean,
                                "base_failed": base_failed, "kept": ~base_failed & enough})
            .select(*[F.col("_original").alias(c) if c == "text" else F.col(f"row.`{c}`")
                      for c in docs.columns if c not in new], *new))


def clean(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The documents that are kept, with their failing lines removed; columns as in ``docs``."""
    kept = measure(docs, rules).filter("kept").withColumn("text", F.col("clean_text"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
