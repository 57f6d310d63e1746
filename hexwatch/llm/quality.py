"""Quality rules with adaptive thresholds (operator 4), in DataFrame functions only.

Base figures of every text are compared with limits from mergeable quantile sketches (KLL) of its own language and source.
Sketches are built per (language, source) and merged into those of the language and of everything, so that all levels come from
one pass. A group's figure is weighted with that of the next wider level by its number of texts, so small groups lean on the
wider ones, without a size at which the one takes over from the other.

There are no cutoffs of the figures themselves. A first round of sketches gives each group's ordinary rates (signs and repeated
passages a word, repeated lines a line, word length): trimmed means and medians, which a minority of odd texts does not move.
A second round sketches how far each text is from what its group's rate makes of its own length, in units of sampling
noise: square roots of counts have nearly the same noise at any rate, the mean of n word lengths has one that falls with the
root of n. A group's limit begins at its outer fence, the upper quartile plus SPREADS times the distance between the median and
the upper quartile (for counts at least that of pure noise), and follows the upper quantiles as long as none lies beyond the limit
reached so far: usual values of a few texts raise it, a separate heap of odd texts does not.

Defined results: null text counts as empty (no word, so it fails the base rule); null language or source are groups of their
own; very long texts are measured whole; texts at a limit are kept; repeated rows count and are judged each for itself; an empty
table yields no rows. Other columns pass through `metrics` unchanged; a column with the name of a figure is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexwatch.llm.common import column, fresh, small, stored

WORD_SPLIT = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: So many texts of the wider level count with a group's own.
LEAN = 50
SPREADS = 5.0
#: Distance from the median to the upper quartile of noise of unit variance, and what makes the variance of roots of counts even.
NOISE_QUARTILE, ROOT_SHIFT = 0.6745, 0.375
SKETCH_K = 400
#: Broadcast the tables of rates and limits only up to so many rows (about 100 bytes each).
MAX_BROADCAST_ROWS = 20_000
#: Upper quantiles that may raise a limit, and by how much: to the median plus so many times their distance from it.
UPPER = tuple(q / 100 for q in range(76, 100))
GROWTH = 2.0
#: Quantiles whose mean is a group's rate: the upper quarter may be junk.
TRIMMED = tuple(q / 20 for q in range(1, 16))
FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURED = [*FIGURES, "n_lines"]
#: Counts, and what they are counted over. Repeated words come in windows.
COUNTS = {"symbols": ("n_symbols", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"), "repeats": (f"n_repeat_words / {WINDOW}", "n_words")}
RATES = {**{k: f"({a}) / {b}" for k, (a, b) in COUNTS.items()}, "word_length": "word_chars / n_words"}


def metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns, the five base figures and the number of lines with a word, without a shuffle.

    A window of eight words is the hash of two hashes of four, these of two hashes of two. Texts without an equal pair of
    windows end there; in the others the windows are sorted by hash, and the words that windows with an equal neighbour
    cover are counted. Two different windows of one text share a 64-bit hash with negligible probability.
    """
    names = [c for c in docs.columns if c.lower() not in MEASURED]
    keep = [f"`{c.replace('`', '``')}`" for c in names]
    own = "__q"  # prefix of the steps' own columns
    while any(c.startswith(own) for c in names):
        own = f"_{own}"
    t, w, h, s, p = (own + x for x in "twhsp")

    def doubled(gap: int) -> str:
        size = f"greatest(size({h}) - {gap}, 0)"
        return f"zip_with(slice({h}, 1, {size}), slice({h}, {gap + 1}, {size}), (a, b) -> xxhash64(a, b)) as {h}"

    step = docs.select(*(column(docs, c) for c in names), F.coalesce(column(docs, text), F.lit("")).alias(t))
    step = step.select(*keep, t, F.array_remove(F.split(t, WORD_SPLIT), "").alias(w),
                       F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD_CHAR)).alias(s))
    step = step.selectExpr(
        *keep,
        f"cast(size({w}) as bigint) as n_words",
        f"cast(char_length(array_join({w}, '')) as bigint) as word_chars",
        f"cast(octet_length({t}) - octet_length(regexp_replace({t}, '{SYMBOL}', '')) as bigint) as n_symbols",
        f"cast(size({s}) - size(array_distinct({s})) as bigint) as n_dup_lines",
        f"cast(size({s}) as bigint) as n_lines",
        f"transform({w}, x -> xxhash64(x)) as {h}",
    )
    carried = [*FIGURES[:4], "n_lines"]
    for gap in (1, 2, 4):
        step = step.selectExpr(*keep, *carried, doubled(gap))
    step = step.selectExpr(
        *keep, *carried,
        f"case when size({h}) > size(array_distinct({h})) then sort_array(transform({h}, (x, i) -> struct(x as h, i as i))) end as {s}")
    step = step.selectExpr(
        *keep, *carried,
        f"sort_array(transform(filter({s}, (x, k) -> coalesce(x.h = get({s}, k - 1).h, false) or coalesce(x.h = get({s}, k + 1).h, false)), x -> x.i)) as {p}")
    counted = step.selectExpr(
        *keep, *carried,
        f"coalesce(aggregate({p}, struct(-{WINDOW} as last, 0L as n), (a, i) -> struct(i as last, a.n + least({WINDOW}, i - a.last) as n), a -> a.n), 0L) as n_repeat_words")
    # A one-row `inline` keeps predicates on the figures from being rewritten into the chain above, level by level.
    return counted.select(*keep, F.inline(F.array(F.struct(*MEASURED))))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def blended(rows: DataFrame, values: dict[str, str], figure) -> DataFrame:
    """(lang_key, source_key, figures): `figure(sketch, name)` of each value per language and source, weighted with the wider levels.

    One pass builds sketches per (language, source), combined before the shuffle; the wider levels merge these.
    """
    n = F.count("*").alias("n")
    held = rows.select("lang_key", "source_key", *(F.expr(sql).cast("double").alias(k) for k, sql in values.items()))
    own = stored(held.groupBy("lang_key", "source_key").agg(n, *(F.kll_sketch_agg_double(k, SKETCH_K).alias(k) for k in values)), "quality-sketches")

    def wider(*keys: str) -> DataFrame:
        return own.groupBy(*keys).agg(F.sum("n").alias("n"), *(F.kll_merge_agg_double(k, SKETCH_K).alias(k) for k in values))

    def figures(level: DataFrame, *keys: str) -> DataFrame:
        return level.where("n > 0").select(*keys, "n", *(figure(F.col(k), k).alias(k) for k in values))

    overall = figures(wider()).select(F.struct(*values)).scalar()
    by_lang = figures(wider("lang_key"), "lang_key").select(F.col("lang_key").alias("l"), F.struct("n", *values).alias("by_lang"))
    joined = figures(own, "lang_key", "source_key").join(by_lang, F.col("lang_key").eqNullSafe(F.col("l")), "left")

    def lean(k: str) -> Column:
        lang = (F.col("by_lang.n") * F.col("by_lang")[k] + LEAN * overall[k]) / (F.col("by_lang.n") + LEAN)
        return ((F.col("n") * F.col(k) + LEAN * lang) / (F.col("n") + LEAN)).alias(k)

    return joined.select("lang_key", "source_key", F.struct(*(lean(k) for k in values)).alias("figures"))


def rate(sketch: Column, name: str) -> Column:
    if name == "word_length":
        return F.kll_sketch_get_quantile_double(sketch, F.lit(0.5).cast("double"))
    points = F.kll_sketch_get_quantile_double(sketch, F.array(*(F.lit(q).cast("double") for q in TRIMMED)))
    return F.aggregate(points, F.lit(0.0), lambda a, x: a + x) / len(TRIMMED)


def limit(sketch: Column, name: str) -> Column:
    mid, high = (F.kll_sketch_get_quantile_double(sketch, F.lit(q).cast("double")) for q in (0.5, 0.75))
    upper = F.kll_sketch_get_quantile_double(sketch, F.array(*(F.lit(q).cast("double") for q in UPPER)))
    spread = high - mid if name == "word_length" else F.greatest(high - mid, F.lit(NOISE_QUARTILE))
    return F.aggregate(upper, high + SPREADS * spread, lambda most, x: F.when(x <= most, F.greatest(most, mid + GROWTH * (x - mid))).otherwise(most))


def excess(rates: str) -> dict[str, str]:
    """SQL of how far each figure lies above its group's rate, in units of sampling noise."""
    def root(x: str) -> str:
        return f"sqrt({x} + {ROOT_SHIFT})"

    out = {k: f"2 * ({root(a)} - {root(f'{rates}.{k} * {b}')})" for k, (a, b) in COUNTS.items()}
    return {**out, "word_length": f"(word_chars / n_words - {rates}.word_length) * sqrt(n_words)"}


def same_group(rows: DataFrame, lang: str, source: str) -> Column:
    return column(rows, lang).eqNullSafe(F.col("lang_key")) & column(rows, source).eqNullSafe(F.col("source_key"))


def thresholds(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Rates and limits per language and source (lang_key, source_key), from the texts that pass the base rule; read twice."""
    needed = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_words", "n_lines")
    sound = measured.where(~base_failed()).select(column(measured, lang).alias("lang_key"), column(measured, source).alias("source_key"), *needed)
    rates = stored(blended(sound, RATES, rate), "quality-rates").select(F.col("lang_key").alias("l"), F.col("source_key").alias("s"), F.col("figures").alias("rates"))
    near = sound.join(small(rates, MAX_BROADCAST_ROWS), F.col("lang_key").eqNullSafe(F.col("l")) & F.col("source_key").eqNullSafe(F.col("s")))
    limits = blended(near, excess("rates"), limit)
    both = F.col("lang_key").eqNullSafe(F.col("l")) & F.col("source_key").eqNullSafe(F.col("s"))
    return limits.join(small(rates, MAX_BROADCAST_ROWS), both).select("lang_key", "source_key", "rates", F.col("figures").alias("limits"))


def with_limits(measured: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Measured rows with `base_failed` and `kept` by stored thresholds; columns of these names are replaced.

    A text of a group in which nothing passed the base rule is judged by the base rule alone, which it fails.
    """
    names = [c for c in measured.columns if c.lower() not in ("base_failed", "kept", "limits", "rates", "lang_key", "source_key")]
    rows = measured.join(small(limits, MAX_BROADCAST_ROWS), same_group(measured, lang, source), "left")
    within = F.lit(True)
    for k, sql in excess("rates").items():
        within &= F.coalesce(F.expr(sql) <= F.col(f"limits.{k}"), F.lit(True))
    failed = base_failed()
    return rows.select(*(column(measured, c) for c in names), failed.alias("base_failed"), (~failed & within).alias("kept"))


def judged(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Stored measurements with `base_failed` and `kept`, by thresholds from the same rows."""
    return with_limits(measured, stored(thresholds(measured, lang, source), "quality-limits"), lang, source)


def filtered(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows that pass, with the input's columns as they are.

    Texts are measured twice, for the thresholds and for the filter: that costs less than a second copy of all texts. The
    figures alone are stored between.
    """
    row = fresh(docs, "row")
    packed = docs.select(F.struct(*(column(docs, c) for c in docs.columns)).alias(row), column(docs, text).alias("text"),
                         column(docs, lang).alias("lang"), column(docs, source).alias("source"))
    limits = stored(thresholds(stored(metrics(packed).drop(row, "text"), "quality-figures")), "quality-limits")
    kept = with_limits(metrics(packed).drop("text"), limits).where("kept")
    return kept.select(*(F.col(row)[c].alias(c) for c in docs.columns))
