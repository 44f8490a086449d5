"""Quality rules: a table of thresholds compiled into one Spark projection.

Measures and rules are column expressions only. Every measure is a ratio or a count over
the whole text; the table says which range of it a document must lie in. A null text is an
empty text: all its measures are 0 and it is not kept.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precinct.llm.common import free_name, word_array

# The characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"

# Frequent function words; natural prose of a language has many of them.
STOP_WORDS = {
    "en": "the of and to in a is that for it was on are as with his they at be this",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur",
    "es": "de la que el en y a los se del las un por con no una su para es lo",
}


@dataclass(frozen=True)
class Rule:
    """A measure and the range in which a document is kept; None is no bound."""

    measure: str
    least: float | None = None
    most: float | None = None


# The base rules come first: too short, or mostly repeated three-word windows.
BASE = (Rule("n_words", least=50), Rule("repeat_ratio", most=0.5))

TABLE = (
    Rule("mean_word_chars", least=2.0, most=14.0),
    Rule("symbol_ratio", most=0.1),
    Rule("stop_ratio", least=0.04),
    Rule("dup_line_ratio", most=0.4),
)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body).getItem(0)


def _repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window found at least twice.

    Window hashes are sorted to find those that occur again. Where they are few, starts are
    found by looking each window up among them; else windows are sorted once more, with
    their positions. So the work is n log n for every text, one repeated word included.
    """
    few = 16

    def covered(starts: Column) -> Column:
        widths = F.transform(
            starts,
            lambda p, j: F.when(
                j + 1 < F.size(starts), F.least(F.lit(3), F.get(starts, j + 1) - p)
            ).otherwise(F.lit(3)),
        )
        return F.aggregate(widths, F.lit(0).cast("long"), lambda total, w: total + w)

    def by_sorting(places: Column) -> Column:
        pairs = F.transform(
            places,
            lambda place, j: F.when(
                F.get(places, j + 1)["h"] == place["h"],
                F.array(place["p"], F.get(places, j + 1)["p"]),
            ),
        )
        return F.sort_array(F.array_distinct(F.flatten(F.array_compact(pairs))))

    def starts(hashes: Column, again: Column) -> Column:
        places = F.transform(hashes, lambda h, j: F.struct(h.alias("h"), j.alias("p")))
        looked_up = F.filter(
            F.sequence(F.lit(0), F.size(hashes) - 1),
            lambda i: F.array_contains(again, F.get(hashes, i)),
        )
        return F.when(F.size(again) <= few, looked_up).otherwise(
            _let(F.sort_array(places), by_sorting)
        )

    def of_hashes(hashes: Column) -> Column:
        def found(again: Column) -> Column:
            repeated = _let(starts(hashes, again), covered)
            return F.when(F.size(again) > 0, repeated).otherwise(F.lit(0))

        twice = _let(
            F.sort_array(hashes), lambda s: F.filter(s, lambda h, j: F.get(s, j + 1) == h)
        )
        return _let(F.array_distinct(twice), found)

    def of_words(w: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        )
        return _let(hashes, of_hashes)

    many = F.size(words) >= 3
    return F.when(many, _let(words, of_words)).otherwise(F.lit(0)).cast("long")


def measures(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """Adds a struct column with all measures of the text; also returns its name."""
    words, lines = free_name(docs, "_words"), free_name(docs, "_lines")
    out = free_name(docs, "_measures")
    whole = F.coalesce(F.col(text), F.lit(""))
    filled = F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    stops = sorted({w for listed in STOP_WORDS.values() for w in listed.split()})
    prepared = docs.withColumns({words: word_array(whole), lines: filled})
    w, n = F.col(words), F.size(words).cast("long")
    counted = prepared.withColumn(
        out,
        F.struct(
            n.alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(whole, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeated_words(w).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.size(F.filter(w, lambda x: x.isin(stops))).cast("long").alias("n_stop_words"),
        ),
    )
    return counted.drop(words, lines), out


def _ratio(name: str, m: str) -> Column:
    """A measure of the table, as an expression over the counts in column ``m``."""
    over = {
        "mean_word_chars": ("word_chars", "n_words"),
        "symbol_ratio": ("n_symbols", "n_words"),
        "stop_ratio": ("n_stop_words", "n_words"),
        "dup_line_ratio": ("n_dup_lines", "n_lines"),
        "repeat_ratio": ("n_repeat_words", "n_words"),
    }
    if name not in over:
        return F.col(m)[name]
    upper, lower = (F.col(m)[part] for part in over[name])
    return F.when(lower > 0, upper / lower).otherwise(F.lit(0.0))


def passes(rules, m: str) -> Column:
    """All rules of a table as one condition."""
    good = F.lit(True)
    for rule in rules:
        value = _ratio(rule.measure, m)
        if rule.least is not None:
            good = good & (value >= F.lit(rule.least))
        if rule.most is not None:
            good = good & (value <= F.lit(rule.most))
    return good


def quality_rules(docs: DataFrame, text: str = "text", base=BASE, rules=TABLE) -> DataFrame:
    """Documents with counts, ``base_failed`` and ``kept``.

    Adds ``n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_stop_words
    base_failed kept``; columns of the input with such a name are replaced. Rows stay as
    they are: null and empty texts have zero counts and fail the base rules, repeated rows
    are judged one by one, an empty table gives an empty result.
    """
    measured, m = measures(docs, text)
    failed = ~passes(base, m)
    names = measured.schema[m].dataType.names
    return measured.withColumns(
        {name: F.col(m)[name] for name in names}
        | {"base_failed": failed, "kept": ~failed & passes(rules, m)}
    ).drop(m)
