"""Quality rules: a table of thresholds compiled into one projection, with built-in functions only.

Each rule bounds one measure of a text, a ratio of counts. ``measured`` adds the counts, ``judged`` the verdict of all
rules. Nothing is shuffled, and the cost of a text is linear in its words but for one sort of the windows of texts
that repeat some.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import WORD, col, require_free, unused, words

# Common words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "be", "to", "of", "and", "that", "have", "with", "a", "in", "is", "it", "for", "was", "on", "as", "by",
    "this", "at", "are", "from", "der", "die", "das", "und", "ist", "in", "zu", "den", "mit", "von", "im", "für",
    "auf", "nicht", "ein", "eine", "le", "la", "les", "de", "des", "du", "et", "est", "un", "une", "que", "dans",
    "pour", "sur", "el", "los", "las", "en", "y", "por", "con", "para", "se", "no", "al", "del", "su", "lo",
)


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``; a zero denominator counts as one."""

    name: str
    numerator: str
    denominator: str | None = None
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("n_words", "n_words", None, 50, 1_000_000),
    Rule("mean_word_chars", "word_chars", "n_words", 2, 15),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 0.1),
    Rule("stop_words", "n_stop_words", None, 2, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.3),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 0.3),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 0.5),
)
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines", "n_bullet_lines",
    "n_ellipsis_lines",
)
_SYMBOLS = r"[#*$%&|<>]"


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts of ``COUNTS`` (long); all are 0 for a null text or one without words.

    ``word_chars`` are code points in words; lines are parts between line feeds that hold a word, and a duplicate line
    equals an earlier one; ``n_repeat_words`` are the words in windows of three that occur twice or more.
    """
    require_free(df, *COUNTS)
    content, found, lines, stops, windows = unused(df, "_text", "_words", "_lines", "_stops", "_windows")
    one = df.withColumn(content, F.coalesce(col(text), F.lit("")))
    two = one.withColumn(found, words(col(content))).withColumn(
        lines, F.filter(F.split(col(content), "\n"), lambda x: x.rlike(WORD))
    )
    three = two.withColumn(windows, _window_hashes(col(found)))
    counts = {
        "n_words": F.size(col(found)),
        "word_chars": F.length(F.array_join(col(found), "")),
        "n_symbols": F.regexp_count(col(content), F.lit(_SYMBOLS)),
        "n_dup_lines": F.size(col(lines)) - F.size(F.array_distinct(col(lines))),
        "n_repeat_words": _repeat_words(col(found), col(windows)),
        "n_stop_words": F.size(F.filter(col(found), lambda w: F.lower(w).isin(*sorted(set(STOP_WORDS))))),
        "n_lines": F.size(col(lines)),
        "n_bullet_lines": F.size(F.filter(col(lines), lambda x: F.ltrim(x).substr(1, 1).isin("-", "*", "•"))),
        "n_ellipsis_lines": F.size(F.filter(col(lines), lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))),
    }
    return three.select(*map(col, df.columns), *(x.cast("long").alias(name) for name, x in counts.items()))


def judged(df: DataFrame, rules: Sequence[Rule] = RULES, out: str = "failed") -> DataFrame:
    """``df``, which has the counts, with the names of the rules that it breaks (``array<string>``), in their order."""
    require_free(df, out)
    broken = [F.when(~_holds(rule), F.lit(rule.name)) for rule in rules]
    return df.withColumn(out, F.filter(F.array(*broken), lambda x: x.isNotNull()))


def _holds(rule: Rule) -> Column:
    value = col(rule.numerator).cast("double")
    if rule.denominator:
        value = value / F.greatest(col(rule.denominator), F.lit(1))
    low = F.lit(True) if rule.low is None else value >= rule.low
    return low & (F.lit(True) if rule.high is None else value <= rule.high)


def _window_hashes(found: Column) -> Column:
    """A hash for each window of three words."""
    starts = F.slice(found, F.lit(1), F.greatest(F.size(found) - 2, F.lit(0)))
    return F.transform(starts, lambda w, i: F.xxhash64(w, F.get(found, i + 1), F.get(found, i + 2)))


def _repeat_words(found: Column, windows: Column) -> Column:
    """Words covered by windows that occur twice or more. Where all hashes differ there are none; else the windows are
    sorted by hash and words, so that equal ones are neighbours, and a shared hash alone makes no repeat."""
    keyed = F.sort_array(
        F.transform(windows, lambda h, i: F.struct(h.alias("h"), F.slice(found, i + 1, F.lit(3)).alias("w"), i.alias("i")))
    )

    def twice(all_: Column) -> Column:
        def equal(x: Column, at: Column) -> Column:
            other = F.get(all_, at)
            return F.coalesce((other["h"] == x["h"]) & (other["w"] == x["w"]), F.lit(False))

        return F.filter(all_, lambda x, k: equal(x, k - 1) | equal(x, k + 1))

    again = F.get(F.transform(F.array(keyed), twice), F.lit(0))
    starts = F.sort_array(F.transform(again, lambda x: x["i"]))
    none = F.struct(F.lit(0).alias("n"), F.lit(0).alias("stop"))

    def cover(sum_: Column, start: Column) -> Column:
        stop = start + 3
        return F.struct((sum_["n"] + stop - F.greatest(start, sum_["stop"])).alias("n"), stop.alias("stop"))

    covered = F.aggregate(starts, none, cover)["n"]
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(covered)
