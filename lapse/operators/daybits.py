"""Distinct active days per user as bitmaps.

A day of a span of days is one bit; the days of a user are 63-bit words merged by ``bit_or`` (the sign bit
stays free).  Words merge like sums, so distinct days need one HashAggregate level per key - combined in the
tasks, shuffled once on the key - where a distinct count needs a level and a shuffle on (key, day) before.
The number of words follows the span: one for up to 63 days, ``MAX_WORDS`` for 11 years; a longer span is
cut into eras of that length, whose counts are added in a second level.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_DAYS = 63
MAX_WORDS = 64


def day_words(at: Column, n_days: int) -> list[Column]:
    """Aggregates: the days 0 <= ``at`` < ``n_days`` of a group, 63 to a word (null when it has none there)."""
    one = F.lit(1).cast("bigint")
    out = []
    for w in range(max(1, -(-n_days // WORD_DAYS))):
        low, high = w * WORD_DAYS, min((w + 1) * WORD_DAYS, n_days)
        bit = F.call_function("shiftleft", one, (at - low).cast("int"))
        out.append(F.bit_or(F.when((at >= low) & (at < high), bit)))
    return out


def days_in(words: Sequence[Column]) -> Column:
    """Days of merged words."""
    total = F.lit(0).cast("bigint")
    for w in words:
        total = total + F.coalesce(F.bit_count(w), F.lit(0))
    return total.cast("bigint")


def day_span(rows: DataFrame, day: str) -> tuple[dt.date, dt.date] | None:
    """First and last day of a table (one row), None when it has none."""
    r = rows.agg(F.min(day).alias("a"), F.max(day).alias("z")).first()
    return None if r.a is None else (r.a, r.z)


def active_days(rows: DataFrame, key: str, day: str, span: tuple[dt.date, dt.date], sums: dict[str, Column], out: str) -> DataFrame:
    """One row per ``key``: the distinct days within the closed ``span`` as ``out``, and the ``sums``.

    A null day, or one outside the span, is not counted; its row still counts in the sums."""
    first, n_days = span[0], (span[1] - span[0]).days + 1
    at = F.datediff(day, F.lit(first))
    added = [F.sum(c).alias(name) for name, c in sums.items()]
    era_days = WORD_DAYS * MAX_WORDS
    if n_days <= era_days:
        return rows.groupBy(key).agg(days_in(day_words(at, n_days)).alias(out), *added)
    inside = (at >= 0) & (at < n_days)
    eras = rows.withColumn("_at", F.when(inside, at)).withColumn("_era", F.floor(F.col("_at") / era_days))
    per_era = eras.groupBy(key, "_era").agg(days_in(day_words(F.col("_at") % era_days, era_days)).alias(out), *added)
    return per_era.groupBy(key).agg(F.sum(out).alias(out), *[F.sum(name).alias(name) for name in sums])
