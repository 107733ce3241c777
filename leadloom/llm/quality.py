"""Quality rules: a table of thresholds compiled into one projection over the whole text.

All measures are native expressions; nothing is joined or shuffled. Null and empty texts have no words and fail the
base rule. Every input row gives one output row, repeated rows too; other columns of the input are kept apart from the
measures, which replace columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.llm.exprs import BLANK, fresh_name, let, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for was on are as with his they be at this from have or by not but what all were we "
    "when your can said there an which she do how their if will le la les des et est un une du en que qui dans pour pas "
    "sur au avec ce il je ne se plus par son der die das und ist nicht ein eine den von zu mit sich auf als auch dem "
    "des im el los las de y una no por con para su al lo como").split()


@dataclass(frozen=True)
class Rule:
    """A measure and the range it must lie in; no bound on a side where the value is None. Unknown measures pass."""

    measure: str
    least: float | None = None
    most: float | None = None


RULES = (
    Rule("mean_word_length", 2.0, 15.0),
    Rule("symbols_per_word", None, 0.1),
    Rule("stop_word_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.5),
    Rule("ellipsis_line_ratio", None, 0.3),
    Rule("bullet_line_ratio", None, 0.9),
    Rule("upper_ratio", None, 0.6),
)


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more; ``windows`` holds one hash per start."""
    placed = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))

    def repeated(pairs: Column) -> Column:
        def start(s: Column, j: Column) -> Column:
            h = s.getField("h")
            same = [F.coalesce(h == F.get(pairs, k).getField("h"), F.lit(False)) for k in (j - 1, j + 1)]
            return F.when(same[0] | same[1], s.getField("p"))
        return F.sort_array(F.filter(F.transform(pairs, start), lambda p: p.isNotNull()))

    begin = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
    return F.aggregate(let(placed, repeated), begin, lambda a, p: F.struct(
        p.alias("last"), (a["total"] + F.least(F.lit(WINDOW), p - a["last"])).alias("total")), lambda a: a["total"])


def repeat_words(word_list: Column) -> Column:
    """How many words lie in runs of eight words that the text holds more than once."""
    def windows(h: Column) -> Column:
        starts = F.when(F.size(h) >= WINDOW, F.sequence(F.lit(0), F.size(h) - WINDOW)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) < F.size(w), _covered(w)).otherwise(F.lit(0))

    return let(F.transform(word_list, lambda x: F.xxhash64(x)), lambda h: let(windows(h), count)).cast("long")


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with all measures of the text beside its columns."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    has_word = r"[^\x20\x09-\x0D]"
    other = [c for c in docs.columns if c not in MEASURES]
    word_list, line_list, stops, upper, letters = (fresh_name(docs, f"q_{n}") for n in ("words", "lines", "stops", "upper", "letters"))
    first = docs.select(*[F.col(f"`{c}`") for c in other], words(body).alias(word_list),
                        F.filter(F.split(body, "\n"), lambda s: s.rlike(has_word)).alias(line_list))
    n = F.greatest(F.col("n_words"), F.lit(1))
    lines = F.greatest(F.size(line_list), F.lit(1))
    counted = first.select(
        *[F.col(f"`{c}`") for c in other], line_list,
        F.size(word_list).cast("long").alias("n_words"),
        F.length(F.regexp_replace(body, BLANK, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(body, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size(line_list) - F.size(F.array_distinct(line_list))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col(word_list)).alias("n_repeat_words"),
        F.size(F.filter(word_list, lambda w: w.isin(STOP_WORDS))).alias(stops),
        F.length(F.regexp_replace(body, r"\P{Lu}+", "")).alias(upper),
        F.length(F.regexp_replace(body, r"\P{L}+", "")).alias(letters))
    return counted.select(
        *[F.col(f"`{c}`") for c in other], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("word_chars") / n).alias("mean_word_length"), (F.col("n_symbols") / n).alias("symbols_per_word"),
        (F.col(stops) / n).alias("stop_word_ratio"), (F.col("n_dup_lines") / lines).alias("dup_line_ratio"),
        (F.size(F.filter(line_list, lambda s: s.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))) / lines).alias("ellipsis_line_ratio"),
        (F.size(F.filter(line_list, lambda s: s.rlike(r"^[\x20\x09-\x0D]*[•*-][\x20\x09-\x0D]"))) / lines).alias("bullet_line_ratio"),
        (F.col(upper) / F.greatest(F.col(letters), F.lit(1))).alias("upper_ratio"),
        ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "mean_word_length", "symbols_per_word",
            "stop_word_ratio", "dup_line_ratio", "ellipsis_line_ratio", "bullet_line_ratio", "upper_ratio", "base_failed",
            "kept")


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The rule table as one boolean expression."""
    ok = ~F.col("base_failed")
    for rule in rules:
        if rule.least is not None:
            ok = ok & (F.col(rule.measure) >= rule.least)
        if rule.most is not None:
            ok = ok & (F.col(rule.measure) <= rule.most)
    return ok.alias("kept")


def quality(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document with all measures, ``base_failed`` and ``kept``."""
    return measures(docs, text).select("*", verdict(rules))
