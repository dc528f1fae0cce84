"""Operator 5: quality rules with adaptive thresholds, DataFrame and SQL functions only.

Base features are counted over every whole text.  Four ratios of the rows that pass the base
rules go into mergeable quantile sketches, one per (lang, source): log-linear histograms whose
buckets hold integers to a relative width of 1/16, so merging is adding counts and quantiles do
not depend on the order of merging.  The lower decile, median and upper decile of a language are drawn
towards those of all rows, and a group's towards its language's: the parent counts as ``MIN_ROWS`` further rows, so
small groups lean on it and large ones have their own.  The fences of a ratio lie
``SPREADS * (upper decile - median) + floor`` above and ``SPREADS * (median - decile) + floor`` below the
group's median.  A spread counts up to twice its language's plus half the floor, so that a group
in which more than a tenth is junk does not widen its own fence.  Rows outside are rejected by a join
on (lang, source).

Defined cases: a null or wordless text has zero words and fails the base rules; null languages
and sources are groups of their own; further columns (also ones named like a feature) are
carried by ``keep_good``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapse.llm.names import quoted, unused
from lapse.sources.store import materialize

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_ROWS = 200
SPREADS = 2
#: ratio -> (numerator, denominator, units per one, least room above, least room below or None for no lower fence)
RATIOS = {
    "symbols": ("n_symbols", "n_words", 1000, 60, None),
    "length": ("word_chars", "n_words", 100, 100, 100),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 300, None),
    "repeats": ("n_repeat_words", "n_words", 1000, 150, None),
}
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SPLIT = r"[\\x20\\x09-\\x0D]+"
_GRAMS = (
    "if(size(_words) < 5, cast(array() as array<bigint>), transform(sequence(0, size(_words) - 5), i -> "
    "xxhash64(_words[i], _words[i + 1], _words[i + 2], _words[i + 3], _words[i + 4])))"
)
#: words covered by windows met twice: windows in hash order have their equals beside them; the
#: positions found, in text order, each add the words that the one before does not cover
_REPEATS = """
if(size(array_distinct(_grams)) = size(_grams), 0L,
  aggregate(
    sort_array(flatten(transform(array(sort_array(transform(_grams, (h, i) -> struct(h, i)))), p ->
      filter(transform(p, (x, j) -> if(x.h <=> get(p, j - 1).h or x.h <=> get(p, j + 1).h, x.i, -1)), i -> i >= 0)))),
    named_struct('last', -5, 'n', 0L),
    (a, i) -> named_struct('last', i, 'n', a.n + least(5, i - a.last)),
    a -> a.n))
"""


def features(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` plus the base features, named with ``prefix``, and ``base_failed``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.withColumn("_text", text)
    d = d.withColumn("_words", F.expr(f"filter(split(_text, '{_SPLIT}'), w -> w <> '')"))
    d = d.withColumn("_grams", F.expr(_GRAMS))
    d = d.withColumn("_lines", F.expr(r"filter(split(_text, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]')"))
    p = prefix
    d = d.withColumns({
        f"{p}n_words": F.size("_words").cast("long"),
        f"{p}word_chars": F.length(F.array_join("_words", "")).cast("long"),
        f"{p}n_symbols": F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long"),
        f"{p}n_lines": F.size("_lines").cast("long"),
        f"{p}n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        f"{p}n_repeat_words": F.expr(_REPEATS).cast("long"),
    })
    failed = (F.col(f"{p}n_words") < MIN_WORDS) | (
        100 * F.col(f"{p}n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{p}n_words"))
    return d.withColumn(f"{p}base_failed", failed).drop("_text", "_words", "_grams", "_lines")


def bucket(v: Column) -> Column:
    """Log-linear bucket of a non-negative integer: exact below 32, then 16 buckets per doubling."""
    shift = F.greatest(F.length(F.bin(v)) - 5, F.lit(0))
    return (16 * shift + F.floor(v / F.pow(F.lit(2.0), shift))).cast("int")


def bucket_low(b: Column) -> Column:
    """Smallest integer of a bucket."""
    shift = F.greatest(F.floor(b / 16) - 1, F.lit(0))
    return ((b - 16 * shift) * F.pow(F.lit(2.0), shift)).cast("long")


def ratio(name: str, prefix: str = "") -> Column:
    top, bottom, units, _, _ = RATIOS[name]
    return F.floor(units * F.col(prefix + top) / F.greatest(F.col(prefix + bottom), F.lit(1))).cast("long")


def sketches(rows: DataFrame, lang: str, source: str, prefix: str = "") -> DataFrame:
    """(lang, source, ratio, bucket, n) of the rows that pass the base rules; counts merge by adding."""
    each = F.array(*[F.struct(F.lit(r).alias("ratio"), bucket(ratio(r, prefix)).alias("bucket")) for r in RATIOS])
    one = rows.filter(~F.col(f"{prefix}base_failed")).select(
        F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"), F.explode(each).alias("e"))
    return one.groupBy("lang", "source", "e.ratio", "e.bucket").agg(F.count(F.lit(1)).alias("n"))


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ratio, total, decile, median, upper) of the sketches merged to ``keys``."""
    merged = sketch.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys, "ratio")
    cum = merged.withColumns({"cum": F.sum("n").over(w.orderBy("bucket")), "total": F.sum("n").over(w)})
    at = lambda tenths: bucket_low(F.min(F.when(10 * F.col("cum") >= tenths * F.col("total"), F.col("bucket"))))
    return cum.groupBy(*keys, "ratio").agg(
        F.max("total").alias("total"), at(1).alias("decile"), at(5).alias("median"), at(9).alias("upper"))


def fences(sketch: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """(lang, source, <ratio>_low, <ratio>_high): one row per group met in the sketch."""
    own, by_lang, all_rows = quantiles(sketch, ["lang", "source"]), quantiles(sketch, ["lang"]), quantiles(sketch, [])
    drawn = lambda child, parent, c: F.expr(
        f"({child}.total * {child}.{c} + {min_rows}L * {parent}) div ({child}.total + {min_rows}L)")
    marks = ("decile", "median", "upper")
    j = (
        own.alias("o")
        .join(by_lang.alias("l"), F.col("o.lang").eqNullSafe(F.col("l.lang")) & (F.col("o.ratio") == F.col("l.ratio")))
        .join(all_rows.alias("a"), F.col("o.ratio") == F.col("a.ratio"))
        .select("o.*", *[drawn("l", f"a.{c}", c).alias(f"l_{c}") for c in marks]).alias("o")
        .select("lang", "source", "ratio", "l_decile", "l_median", "l_upper", *[drawn("o", f"l_{c}", c).alias(c) for c in marks])
    )
    out = []
    for r, (_, _, _, above, below) in RATIOS.items():
        spread = F.least(F.col("upper") - F.col("median"), 2 * (F.col("l_upper") - F.col("l_median")) + above // 2)
        out.append(F.max(F.when(F.col("ratio") == r, F.col("median") + SPREADS * spread + above)).alias(f"{r}_high"))
        if below is not None:
            spread = F.least(F.col("median") - F.col("decile"), 2 * (F.col("l_median") - F.col("l_decile")) + below // 2)
            out.append(F.max(F.when(F.col("ratio") == r, F.col("median") - SPREADS * spread - below)).alias(f"{r}_low"))
    return j.groupBy("lang", "source").agg(*out)


def judged(docs: DataFrame, text_col: str = "text", lang: str = "lang", source: str = "source", carry: list[str] | None = None,
           prefix: str = "", min_rows: int = MIN_ROWS) -> DataFrame:
    """The columns ``carry`` of ``docs`` (default: all) plus features, ``base_failed`` and ``kept``.

    Features are counted once and written to the checkpoint folder; sketches and filter read them back.
    """
    carry = docs.columns if carry is None else carry
    named = [quoted(c).alias(f"_c{i}") for i, c in enumerate(carry)]
    base = docs.select(*named, quoted(lang).cast("string").alias("_lang"), quoted(source).cast("string").alias("_source"),
                       quoted(text_col).alias("_body"))
    rows = features(base, "_body", "_f_").drop("_body")
    rows = materialize(rows, "quality-rows")
    fence = fences(sketches(rows, "_lang", "_source", "_f_"), min_rows)
    fence = fence.select(F.col("lang").alias("_kl"), F.col("source").alias("_ks"), *[c for c in fence.columns if c.endswith(("_high", "_low"))])
    j = rows.join(fence, F.col("_lang").eqNullSafe(F.col("_kl")) & F.col("_source").eqNullSafe(F.col("_ks")), "left")
    good = ~F.col("_f_base_failed")
    for r, (_, _, _, _, below) in RATIOS.items():
        good = good & (ratio(r, "_f_") <= F.col(f"{r}_high"))
        if below is not None:
            good = good & (ratio(r, "_f_") >= F.col(f"{r}_low"))
    return j.select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
        *[F.col(f"_f_{f}").alias(prefix + f) for f in (*FEATURES, "base_failed")],
        F.coalesce(good, F.lit(False)).alias(f"{prefix}kept"),
    )


def keep_good(docs: DataFrame, text_col: str = "text", lang: str = "lang", source: str = "source", min_rows: int = MIN_ROWS) -> DataFrame:
    """``docs`` without the rejected rows."""
    prefix = unused("_quality_", docs.columns)
    out = judged(docs, text_col, lang, source, prefix=prefix, min_rows=min_rows)
    return out.filter(F.col(f"{prefix}kept")).select(*[quoted(c) for c in docs.columns])
