"""Quality rules with thresholds that follow the data (native: DataFrame functions only).

Fixed rules reject very short texts and texts full of repeated 8-word windows. Every other rule gets its cutoff
from mergeable quantile sketches of each measure per language and source, over the rows that the fixed rules keep. A
sketch counts values in buckets that grow by a factor ``GAMMA`` and keeps each bucket's least value, so a quantile is
off by less than a thousandth, and exact where a bucket holds one value. Counts and minima merge in any order: a rerun
has the same cutoffs. A value takes one of some 25,000 buckets at most, whatever the input. A group's quantiles are drawn towards those of its language, and a language's towards those of all rows, as
the group is small: by ``SHRINK`` rows' worth of the larger one. A row fails where a measure lies beyond

    high quantile + times * (high quantile - median) + allowance / median size,

all of its group, or, for the measure that has a lower end, as far below its lower quartile. The allowance is a number
of occurrences in a text of the group's median size: it speaks where a measure is mostly zero and has no spread.

Defined results: null or empty text has no words and fails the base rules; null lang or source form groups of
their own; an empty table gives an empty table; ties don't matter (a row is judged by values alone).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, scope

#: Characters that separate words, as a Java class and as literal characters. Fixed values.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\f\r"
#: Symbol characters of the base rules.
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: measure -> (high quantile, times its distance from the median, allowed occurrences, the size they are a share of).
#: Repeats are rare in good and bad texts alike, so their tail counts as ordinary; of others the upper quartile.
RULES: dict[str, tuple[float, float, float, str | None]] = {
    "symbol_share": (0.75, 10.0, 24.0, "word_chars"),
    "dup_line_share": (0.99, 1.0, 0.5, "n_lines"),  # of non-blank lines
    "repeat_share": (0.99, 1.0, 24.0, "n_words"),
    "echo_share": (0.75, 10.0, 8.0, "n_words"),
    "upper_share": (0.75, 10.0, 16.0, "word_chars"),
    "mark_share": (0.75, 10.0, 16.0, "n_words"),
    "word_length": (0.75, 10.0, 0.0, None),
}
#: Measures that may also be too low: so many times the distance of the lower quartile from the median below it.
LOW: dict[str, float] = {"word_length": 10.0}
SIZES = ("n_lines", "n_words", "word_chars")
#: Rows' worth of the larger group's quantiles in a smaller group's.
SHRINK = 100
#: Factor between the bounds of a sketch's buckets; the bucket of zero is below all others.
GAMMA = 1.001
ZERO = -(1 << 31)
#: Threshold rows up to which they are broadcast; beyond, they are joined by a shuffle.
BROADCAST_ROWS = 20_000


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with the base counts and ``m_`` measures of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    d = docs.select(*keep, text.alias("_t"), F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+")).alias("_w"))
    chars = lambda s: F.length("_t") - F.length(F.translate("_t", s, ""))
    d = d.select(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        (F.length("_t") - chars(SPACE_CHARS)).cast("long").alias("word_chars"),
        chars(SYMBOLS).cast("long").alias("n_symbols"),
        chars(UPPER).alias("_upper"),
        chars("!?;:").alias("_marks"),
        F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "").alias("_l"),
        F.transform("_w", lambda x: F.xxhash64(x)).alias("_h"),
    )
    windows = F.transform(F.sequence(F.lit(1), (F.col("n_words") - 7).cast("int")), lambda i: F.xxhash64(F.slice("_h", i, 8)))
    d = d.withColumns({
        "n_lines": F.size("_l").cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "_win": F.when(F.col("n_words") > 8, windows),
        "_echo": F.size(F.filter("_h", lambda x, i: x == F.get("_h", i - 1))),
    }).drop("_l", "_h")
    # only rows with an equal pair of windows pay for sorting them
    d = d.withColumn("_s", F.when(F.size(F.array_distinct("_win")) < F.size("_win"), F.array_sort(F.transform("_win", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))).drop("_win")
    same = lambda i, j: F.get(F.col("_s"), i)["x"] == F.get(F.col("_s"), j)["x"]
    repeated = F.filter("_s", lambda s, k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False)))
    d = d.withColumn("_p", F.array_sort(F.transform(repeated, lambda s: s["i"]))).drop("_s")
    covered = F.aggregate(
        "_p",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-8).alias("p")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(8), p - a["p"])).cast("long").alias("n"), p.alias("p")),
        lambda a: a["n"],
    )
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    d = d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_p")
    return d.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
        ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
        share("n_symbols", "word_chars").alias("m_symbol_share"),
        share("n_dup_lines", "n_lines").alias("m_dup_line_share"),
        share("n_repeat_words", "n_words").alias("m_repeat_share"),
        share("_echo", "n_words").alias("m_echo_share"),
        share("_upper", "word_chars").alias("m_upper_share"),
        share("_marks", "n_words").alias("m_mark_share"),
        share("word_chars", "n_words").alias("m_word_length"),
    )


def sketched() -> dict[str, str]:
    """Sketch name -> the column it is of."""
    return {**{m: f"m_{m}" for m in RULES}, **{n: n for n in SIZES}}


def quantiles_asked() -> list[tuple[str, float]]:
    asked = [(m, q) for m, (high, *_) in RULES.items() for q in (0.5, high)] + [(m, 0.25) for m in LOW] + [(n, 0.5) for n in SIZES]
    return sorted(set(asked))


def quantile_name(sketch: str, q: float) -> str:
    return f"q{round(100 * q)}_{sketch}"


def cutoffs(q: Callable[[str, float], Column]) -> dict[str, Column]:
    """``hi_<measure>`` and ``lo_<measure>`` from a group's quantiles ``q(sketch, share)``."""
    out = {}
    for m, (high, times, allowed, size) in RULES.items():
        top = q(m, high) + times * (q(m, high) - q(m, 0.5))
        out[f"hi_{m}"] = top + allowed / F.greatest(q(size, 0.5), F.lit(1.0)) if size else top
    for m, times in LOW.items():
        out[f"lo_{m}"] = q(m, 0.25) - times * (q(m, 0.5) - q(m, 0.25))
    return out


def sketches(rows: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(t_lang, t_source, sketch, bucket, n, least) of the rows that pass the base rules; ``sketch`` is a place in sketched()."""
    values = F.array(*[F.struct(F.lit(k).alias("sketch"), F.col(c).cast("double").alias("v")) for k, c in enumerate(sketched().values())])
    flat = rows.filter(~F.col("base_failed")).select(F.col(lang).alias("t_lang"), F.col(source).alias("t_source"), F.explode(values).alias("x")).select("t_lang", "t_source", "x.*")
    bucket = F.when(F.col("v") > 0, F.floor(F.log("v") / math.log(GAMMA))).otherwise(ZERO)
    return flat.groupBy("t_lang", "t_source", "sketch", bucket.alias("bucket")).agg(F.count("*").alias("n"), F.min("v").alias("least"))


def quantiles(made: DataFrame, prefix: str, *keys: str) -> DataFrame:
    """One row a group of sketches: its rows as ``<prefix>n`` and every quantile that is asked for; none without rows."""
    group = Window.partitionBy(*keys, "sketch")
    upto = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = made.select(*keys, "sketch", "least", upto.alias("upto"), F.sum("n").over(group).alias("total"))
    place = {k: i for i, k in enumerate(sketched())}
    at = lambda k, q: F.min(F.when((F.col("sketch") == place[k]) & (F.col("upto") >= F.ceil(F.lit(q) * F.col("total"))), F.col("least")))
    out = ranked.groupBy(*keys).agg(F.max("total").alias(f"{prefix}n"), *[at(k, q).alias(prefix + quantile_name(k, q)) for k, q in quantiles_asked()])
    return out.filter(F.col(f"{prefix}n") > 0)


def thresholds(rows: DataFrame, lang: str = "lang", source: str = "source", shrink: float = SHRINK) -> DataFrame:
    """One row per (lang, source): ``hi_<measure>`` and ``lo_<measure>``; groups none of whose rows pass the base rules have none.

    Buckets are counted on the map side, so a hot group moves one row a bucket and task.
    """
    made = materialize(sketches(rows, lang, source), "quality-sketches")
    merged = lambda *keys: made.groupBy(*keys, "sketch", "bucket").agg(F.sum("n").alias("n"), F.min("least").alias("least"))
    own = quantiles(made, "s", "t_lang", "t_source")
    by_lang = quantiles(merged("t_lang"), "l", "t_lang").withColumnRenamed("t_lang", "_lang")
    over = quantiles(merged(), "a")  # one row
    joined = own.join(by_lang, own["t_lang"].eqNullSafe(by_lang["_lang"]), "left").withColumn("_one", F.lit(1)).join(F.broadcast(over.withColumn("_one", F.lit(1))), "_one", "left")
    drawn = lambda value, n, larger: (value * n + larger * shrink) / (n + shrink)

    def q(sketch: str, share: float) -> Column:
        x = quantile_name(sketch, share)
        return drawn(F.col(f"s{x}"), F.col("sn"), drawn(F.col(f"l{x}"), F.col("ln"), F.col(f"a{x}")))

    return joined.select("t_lang", "t_source", *[c.alias(k) for k, c in cutoffs(q).items()])


def judged(rows: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``rows`` with ``kept``: false if the base rules fail or a measure lies beyond its group's cutoff."""
    small = limits.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    limits = F.broadcast(limits) if small else limits
    odd = reduce(Column.__or__, [(F.col(f"m_{m}") > F.col(f"hi_{m}")) for m in RULES] + [(F.col(f"m_{m}") < F.col(f"lo_{m}")) for m in LOW])
    joined = rows.join(limits, rows[lang].eqNullSafe(limits["t_lang"]) & rows[source].eqNullSafe(limits["t_source"]), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(odd, F.lit(False)))


def verdicts(rows: DataFrame) -> DataFrame:
    """Measured ``rows``, as a table, with ``kept``."""
    with scope():
        limits = materialize(thresholds(rows), "quality-cutoffs", result=True)
    return judged(rows, limits)


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed and kept of every row of ``docs``."""
    rows = materialize(measured(docs.select("doc_id", "text", "lang", "source"), ["doc_id", "lang", "source"]), "quality-rows")
    return verdicts(rows).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    Rows that pass the base rules are written once with their measures, so that nothing is measured twice; the
    sketches and the filter read that table, and no text is shuffled.
    """
    wide = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), "text", "lang", "source")
    # a filter that Catalyst pushed below the measures would work them out once more inside each lambda, so the
    # rows get a column it may not move a filter across
    rows = measured(wide, ["_row", "lang", "source"]).withColumn("_seen", F.monotonically_increasing_id())
    rows = materialize(rows.filter(~F.col("base_failed") & (F.col("_seen") >= 0)).drop("_seen"), "quality-rows")
    return verdicts(rows).filter("kept").select("_row.*")
