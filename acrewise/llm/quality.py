"""Quality rules: a threshold table compiled into one Spark projection.

Only built-in column functions; nothing is shuffled. A rule is a row of :data:`RULES`: a metric of the text, the
least and the greatest value that pass, and the number of words from which the rule is applied.

Null text counts as empty; an empty text has no words and fails the base rule. Rows are judged one by one, so
repeated rows, ties and extra columns have no influence; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acrewise.llm.common import WORD, evaluated, slim, words_of

# Frequent function words of the languages served.
STOP_WORDS = {
    "en": "the of and to in is that for was are with be by on as at it from or an this which not have has",
    "fr": "le la les de des du et en un une que est pour dans qui sur pas au aux par plus ce il elle ou",
    "de": "der die das und ist in den von zu mit ein eine im auf des nicht sich dem als für auch es an",
    "es": "el la los las de que y en un una es por con para del se no su al lo como más o si",
}

#: metric, least, greatest (None: open), words from which the rule is applied
RULES: tuple[tuple[str, float | None, float | None, int], ...] = (
    ("mean_word_chars", 2.0, 15.0, 0),
    ("symbol_ratio", None, 0.04, 0),
    ("stop_word_ratio", 0.02, None, 40),
    ("dup_line_ratio", None, 0.5, 0),
)
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5


def _stop_words() -> list[str]:
    found = {w for line in STOP_WORDS.values() for w in line.split()}
    return sorted(found | {w.capitalize() for w in found})


def _covered(words: Column, windows: Column) -> Column:
    """Words inside windows that occur twice or more; ``windows`` are the joined texts by start."""
    order = F.sort_array(F.transform(windows, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def starts(s: Column) -> Column:
        twice = lambda x, j: (x["g"] == F.get(s, j + 1)["g"]) | (x["g"] == F.get(s, j - 1)["g"])
        return F.sort_array(F.transform(F.filter(s, lambda x, j: F.coalesce(twice(x, j), F.lit(False))), lambda x: x["i"]))

    def union(at: Column) -> Column:
        gaps = F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0), lambda total, x: total + x)

    # one-element arrays bind the sorted windows and their starts once
    bound = F.transform(F.transform(F.array(order), starts), union)
    return F.when(F.size(words) >= WINDOW, bound[0]).otherwise(F.lit(0))


def with_metrics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus the counts and ratios that the rules read; ``text`` must not be null."""
    stop = _stop_words()
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: x.rlike(WORD))
    df = evaluated(df, {"__words": words_of(F.col(text)), "__lines": lines})
    last = F.size("__words") - WINDOW
    hashed = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(*[F.get("__words", i + k) for k in range(WINDOW)]),
    )
    # equal windows hash alike, so texts without equal hashes have no repeats; only the others compare whole windows
    joined = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.array_join(F.slice("__words", i + 1, WINDOW), " "))
    unlike = F.size(F.array_distinct(hashed)) >= F.size("__words") - WINDOW + 1
    n = F.size("__words")
    df = evaluated(
        df,
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.array_join("__words", "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_repeat_words": F.when(unlike, F.lit(0)).otherwise(_covered(F.col("__words"), joined)).cast("long"),
            "__stops": F.size(F.filter("__words", lambda w: w.isin(stop))),
            "__n_lines": F.size("__lines"),
        },
    )
    over = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return df.withColumns(
        {
            "mean_word_chars": over("word_chars", "n_words"),
            "symbol_ratio": over("n_symbols", "word_chars"),
            "stop_word_ratio": over("__stops", "n_words"),
            "dup_line_ratio": over("n_dup_lines", "__n_lines"),
        }
    ).drop("__words", "__lines", "__stops", "__n_lines")


def verdict(rules: Sequence[tuple[str, float | None, float | None, int]] = RULES) -> Column:
    """The threshold table as one boolean expression."""
    passed = F.lit(True)
    for metric, least, greatest, from_words in rules:
        inside = F.lit(True)
        if least is not None:
            inside = inside & (F.col(metric) >= least)
        if greatest is not None:
            inside = inside & (F.col(metric) <= greatest)
        passed = passed & (inside | (F.col("n_words") < from_words))
    return passed


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """One row per row of ``docs``: its id, the metrics, ``base_failed`` and ``kept``."""
    measured = with_metrics(slim(docs, id_col, text_col)).drop("text")
    return _judged(measured, rules)


def _judged(measured: DataFrame, rules) -> DataFrame:
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def keep_good(docs: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they were (even if named like a metric)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), text.alias("text"))
    return _judged(with_metrics(packed), rules).where("kept").select("__row.*")
