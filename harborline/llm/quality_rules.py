"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

`RULES` says which measure must stay inside which bounds. `measure` adds the measures to each row, `verdict` turns the
table into one boolean expression, `kept_documents` filters. No Python runs on the rows and nothing is shuffled, so a
pass costs one scan and a lost task is simply run again.

Defined results: a null text counts as empty; a text without words has all counts 0 and fails (too short); a ratio
without words or lines is 0. Rows are judged alone, so repeated rows and ties change nothing, an empty table stays
empty, and columns of other names are carried along. Repeats of 3-word windows are found by sorting the windows'
hashes within the row, so a long text costs n log n.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from harborline.llm.common import SPACES, whole_text

SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in that is was for it with as on be at by are this from or "
    "der die und das den von zu mit ist im ein eine für auf dem des nicht sich "
    "les la le de et du un une est que pour dans par sur au "
    "el los las del en se por con para su al lo"
).split()


@dataclass(frozen=True)
class Rule:
    """A measure and the bounds, both allowed, that a kept document stays inside; None leaves a side open."""

    measure: str
    least: float | None = None
    most: float | None = None


RULES = (
    Rule("n_words", least=50),
    Rule("repeat_ratio", most=0.5),
    Rule("mean_word_chars", least=2, most=12),
    Rule("symbol_ratio", most=0.1),
    Rule("stop_ratio", least=0.02),
    Rule("dup_line_ratio", most=0.5),
)

# Names of helper columns start so that they meet none of the documents'.
MEASURES = "_harborline_measures"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines")


def _let(value: Column, body) -> Column:
    """Evaluates a value once and uses it by name in a larger expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(words: Column) -> Column:
    """How many words lie in a 3-word window that occurs at least twice."""
    n = F.size(words)
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def same(rows: Column, k: Column, row: Column) -> Column:
        return F.coalesce(F.get(rows, k)["h"] == row["h"], F.lit(False))

    def repeated(rows: Column) -> Column:
        found = F.filter(rows, lambda row, k: ((k > 0) & same(rows, k - 1, row)) | same(rows, k + 1, row))
        return F.array_sort(F.transform(found, lambda row: row["at"]))

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda at, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - at, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, step: total + step)

    def count(hashes: Column) -> Column:
        labelled = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        some = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(some, _let(_let(labelled, repeated), covered)).otherwise(F.lit(0).cast("bigint"))

    return _let(windows, count)


def measure(docs: DataFrame, text: str = "text", into: str = MEASURES) -> DataFrame:
    """The rows with one struct column of counts and ratios (names in COUNTS and RULES)."""
    parts = {f"{into}_{x}": x for x in ("text", "words", "lines")}
    clean, words, lines = (F.col(name) for name in parts)
    cut = docs.withColumn(f"{into}_text", whole_text(text))
    cut = cut.withColumns({
        f"{into}_words": F.filter(F.split(clean, SPACES + "+", -1), lambda w: w != ""),
        f"{into}_lines": F.filter(F.split(clean, "\n", -1), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0),
    })
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.translate(clean, " \t\n\x0b\x0c\r", "")),
        "n_symbols": F.length(clean) - F.length(F.translate(clean, SYMBOLS, "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeat_words(words),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))),
        "n_lines": F.size(lines),
    }
    counted = cut.withColumn(into, F.struct(*[c.cast("bigint").alias(n) for n, c in counts.items()]))

    def ratio(part: str, whole: str) -> Column:
        below = F.col(into)[whole]
        return F.when(below > 0, F.col(into)[part] / below).otherwise(F.lit(0.0))

    ratios = {
        "mean_word_chars": ratio("word_chars", "n_words"),
        "symbol_ratio": ratio("n_symbols", "n_words"),
        "repeat_ratio": ratio("n_repeat_words", "n_words"),
        "stop_ratio": ratio("n_stop_words", "n_words"),
        "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
    }
    fields = [F.col(into)[n].alias(n) for n in COUNTS] + [c.alias(n) for n, c in ratios.items()]
    return counted.select(*docs.columns, F.struct(*fields).alias(into))


def verdict(measures: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """True where every rule of the table holds."""
    holds = F.lit(True)
    for rule in rules:
        value = measures[rule.measure]
        if rule.least is not None:
            holds = holds & (value >= F.lit(rule.least))
        if rule.most is not None:
            holds = holds & (value <= F.lit(rule.most))
    return holds


def kept_documents(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass, with their own columns."""
    # A filter is moved below a projection and then repeats its work for each measure and word; it is not moved
    # below a row number, so every measure is computed once.
    measured = measure(docs, text).withColumn(f"{MEASURES}_row", F.monotonically_increasing_id())
    return measured.where(verdict(F.col(MEASURES), rules) & (F.col(f"{MEASURES}_row") >= 0)).select(*docs.columns)
