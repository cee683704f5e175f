"""Quality rules: a table of thresholds compiled into one Spark projection.

``RULES`` is data: each row bounds one measure of a text, as a number or as a percentage
of another measure. :func:`failed_rules` turns the table into a single column
expression, and :func:`rule_report` evaluates measures and verdicts in one scan
without a shuffle, a user function or a driver step. Work and memory are those of
the longest text in a task.

Measures, words being ``[^\\x20\\x09-\\x0D]+`` and lines split at ``\\n``:

* length: ``n_words``, ``word_chars`` (code points in words);
* symbols: ``n_symbols`` (``#*$%&|<>``), ``n_marks`` (runs of two and more ``!?``);
* stop words: ``n_stop`` (words of the language's list, lower case or capitalised);
* lines: ``n_lines`` (lines with a word), ``n_dup_lines`` (those equal to an earlier
  one), ``n_bullets``, ``n_ellipses``;
* repetition: ``n_repeat_words``, the words covered by five-word windows that stand twice
  or more in the text. Windows are compared by a 64-bit hash first; only those whose hash
  repeats are compared by their words, so the count is exact.

Null texts count as empty: no words, so the length rule rejects them. A null or unknown language has
no stop-word rule. Repeated rows and null ids are reported each. An empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 5
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

# Frequent function words by language.
STOP_WORDS = {
    "en": "the of and to in a is that for with was on as at by it be are this from have or an not",
    "de": "der die das und in den von zu mit ein eine ist für auf im dem des nicht als auch an sich",
    "fr": "de la le les et des en un une du que est dans pour pas sur par au qui ne se ce il plus",
    "es": "de la que el en y los las del por con para se no un una es al lo su como más o",
}


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie within ``low`` and ``high``: numbers, or percentages of
    the measure ``per``. It is asked of texts of at least ``least_words`` words, and, if
    ``langs`` is given, only of those languages."""

    name: str
    measure: str
    low: int | None = None
    high: int | None = None
    per: str | None = None
    least_words: int = 0
    langs: tuple[str, ...] = ()


# The first two are the base rules, the others the verdict beyond them.
BASE = ("few_words", "repeated_windows")
RULES = (
    Rule("few_words", "n_words", low=10),
    Rule("repeated_windows", "n_repeat_words", high=20, per="n_words"),
    Rule("word_length", "word_chars", low=200, high=2500, per="n_words"),
    Rule("symbols", "n_symbols", high=10, per="n_words"),
    Rule("mark_runs", "n_marks", high=10, per="n_words"),
    Rule("stop_words", "n_stop", low=2, per="n_words", least_words=50, langs=tuple(STOP_WORDS)),
    Rule("repeated_lines", "n_dup_lines", high=50, per="n_lines"),
    Rule("bullets", "n_bullets", high=90, per="n_lines"),
    Rule("ellipses", "n_ellipses", high=30, per="n_lines"),
)
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_marks", "n_stop", "n_lines", "n_dup_lines", "n_bullets", "n_ellipses",
    "n_repeat_words",
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _long(c: Column) -> Column:
    return c.cast("long")


def _has_equal_neighbour(field: str) -> Callable[[Column], Column]:
    """The items of a sorted array of structs whose ``field`` an item next to them shares."""

    def repeated(a: Column) -> Column:
        return F.filter(
            a,
            lambda x, i: (x[field] == F.get(a, i - 1)[field]) | (x[field] == F.get(a, i + 1)[field]),
        )

    return repeated


def _repeated_words(words: Column, hashes: Column) -> Column:
    """Words in windows that stand twice or more; ``hashes`` are the windows' in order."""
    by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    by_words = F.sort_array(
        F.transform(
            _let(by_hash, _has_equal_neighbour("h")),
            lambda x: F.struct(F.array_join(F.slice(words, x["at"] + 1, WINDOW), " ").alias("w"), x["at"].alias("at")),
        )
    )
    places = F.sort_array(F.transform(_let(by_words, _has_equal_neighbour("w")), lambda x: x["at"]))
    # A window adds its words up to the next one's start.
    covered = _let(
        places,
        lambda p: F.aggregate(
            F.transform(p, lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - at, F.lit(WINDOW)))),
            F.lit(0),
            lambda a, b: a + b,
        ),
    )
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered)


def _stop_count(words: Column, lang: Column) -> Column:
    out = F.lit(0)
    for code, listed in STOP_WORDS.items():
        out = F.when(lang == code, _count_listed(words, listed.split())).otherwise(out)
    return out


def _count_listed(words: Column, listed: list[str]) -> Column:
    forms = [f for w in listed for f in (w, w.capitalize())]
    return F.size(F.filter(words, lambda w: w.isin(forms)))


def _count_lines(lines: Column, pattern: str) -> Column:
    return F.size(F.filter(lines, lambda x: x.rlike(pattern)))


def measured(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", lang: str = "lang") -> DataFrame:
    """``keep`` and the ``MEASURES`` of every row of ``docs``."""
    t, words, lines, hashes = (F.col(f"__{c}") for c in ("text", "words", "lines", "hashes"))
    rows = docs.select(
        *[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)],
        F.coalesce(F.col(text), F.lit("")).alias("__text"),
        F.col(lang).alias("__lang"),
    )
    kept = [f"__k{i}" for i in range(len(keep))]
    split = rows.select(
        *kept, "__lang", "__text",
        F.array_remove(F.split(t, SPACES), "").alias("__words"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("__lines"),
    )
    hashed = split.select(
        *kept, "__lang", "__text", "__words", "__lines",
        F.when(
            F.size(words) >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size(words) - WINDOW),
                lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")).alias("__hashes"),
    )
    found = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, "")),
        "n_marks": F.regexp_count(t, F.lit("[!?]{2,}")),
        "n_stop": _stop_count(words, F.col("__lang")),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_bullets": _count_lines(lines, r"^[\x20\x09]*[-*•‣◦·]"),
        "n_ellipses": _count_lines(lines, r"(\.\.\.|…)[\x20\x09-\x0D]*$"),
        "n_repeat_words": _repeated_words(words, hashes),
    }
    # The row passes a generator of one item: a filter on a measure, which the optimizer
    # would otherwise push below with all its expressions copied, stays above it.
    row = F.struct(*[_long(found[m]).alias(m) for m in MEASURES])
    found_rows = hashed.select(*kept, "__lang", F.inline(F.array(row)))
    return found_rows.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], "__lang", *MEASURES)


def failed_rules(rules: Sequence[Rule] = RULES, lang: str = "__lang") -> Column:
    """The names of the rules that a row of measures breaks, in the table's order."""

    def broken(r: Rule) -> Column:
        value = F.col(r.measure) * (100 if r.per else 1)
        bound = F.col(r.per) if r.per else F.lit(1)
        sides = []
        if r.low is not None:
            sides.append(value < bound * r.low)
        if r.high is not None:
            sides.append(value > bound * r.high)
        asked = F.col("n_words") >= r.least_words
        if r.langs:
            asked &= F.coalesce(F.col(lang).isin(*r.langs), F.lit(False))
        return asked & reduce(lambda a, b: a | b, sides)

    return F.array_compact(F.array(*[F.when(broken(r), F.lit(r.name)) for r in rules]))


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep``, the measures and ``failed``, the array of broken rules' names."""
    return measured(docs, keep).withColumn("failed", failed_rules(rules)).drop("__lang")


def rule_report(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per row of ``docs``: measures, the base verdict and the whole one."""
    base = F.arrays_overlap("failed", F.array(*[F.lit(b) for b in BASE]))
    return judge(docs, rules).select(
        "doc_id", *MEASURES, base.alias("base_failed"), (F.size("failed") == 0).alias("kept"),
        F.array_join("failed", ",").alias("failed_rules"),
    )
