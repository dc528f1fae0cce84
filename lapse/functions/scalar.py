"""Scalar functions as Catalyst expressions; all stay inside whole-stage codegen."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "ymd_to_date", "tenure_days", "completion_rate", "ln1p", "exp_m1", "logistic",
    "clip", "age_band", "valid_age", "year_of_ymd", "hours", "r6", "round_half_up", "segment_label",
    "standardise", "COMPLETION_WEIGHTS", "AGE_BANDS", "MAX_DAILY_SECS",
]

# ---- fixed values ----------------------------------------------------------------------
MAX_DAILY_SECS = 86400
# completion counter -> weight in the weighted completion rate
COMPLETION_WEIGHTS = {"sum25": 0.25, "sum50": 0.50, "sum75": 0.75, "sum985": 0.985, "sum100": 1.0}
# age bands, closed bounds; everything else (out of range, null) is 'unknown'
AGE_BANDS = [("1-17", 1, 17), ("18-24", 18, 24), ("25-34", 25, 34), ("35-44", 35, 44), ("45-100", 45, 100)]
# ----------------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def r6(x) -> Column:
    """Round a double to 6 decimals, half up, as ``floor(x * 1e6 + 0.5) / 1e6``."""
    return round_half_up(_c(x), 6)


def round_half_up(x: Column, decimals: int) -> Column:
    """floor(x * 10^d + 0.5) / 10^d, spelled with IEEE operations only, so any engine evaluating
    the same formula gets the same bits (``round`` breaks decimal ties differently).

    Null, NaN and infinities stay as they are.  So does a number of 2^53 / 10^d and more, which has
    no digit left to round (and whose floor would leave the range of BIGINT).
    """
    scale = float(10 ** decimals)
    x = x.cast("double")
    small = F.abs(x) < F.lit(2.0 ** 53 / scale)
    return F.when(small, F.floor(x * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)).otherwise(x)


def ymd_to_date(x) -> Column:
    """int yyyymmdd -> DATE; impossible dates -> null (F1)."""
    return F.try_to_date(_c(x).cast("string"), "yyyyMMdd")


def tenure_days(reg_date, cutoff: dt.date) -> Column:
    """Days from registration to the cutoff; negative kept, not clipped (F2)."""
    return F.datediff(F.lit(cutoff), _c(reg_date)).cast("int")


def completion_rate(prefix: str = "") -> Column:
    """(.25a + .5b + .75c + .985d + e) / (a+b+c+d+e+1)."""
    num = None
    den = F.lit(1)
    for name, w in COMPLETION_WEIGHTS.items():
        term = F.lit(w) * F.col(prefix + name)
        num = term if num is None else num + term
        den = den + F.col(prefix + name)
    return num / den


def ln1p(x) -> Column:
    """ln(1 + x)."""
    return F.ln(F.lit(1.0) + _c(x).cast("double"))


def exp_m1(x) -> Column:
    """exp(x) - 1."""
    return F.exp(_c(x).cast("double")) - F.lit(1.0)


def logistic(z) -> Column:
    """1 / (1 + e^-z)."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(z).cast("double")))


def clip(x, lo, hi) -> Column:
    """greatest(least(x, hi), lo) (P8).  Like the SQL original a null x becomes ``hi``."""
    return F.greatest(F.least(_c(x), F.lit(hi)), F.lit(lo))


def valid_age(x) -> Column:
    """Age if within 1..100, else null."""
    return F.when(_c(x).between(1, 100), _c(x))


def age_band(x) -> Column:
    """Five closed age bands, else 'unknown' (P6)."""
    out = F.lit("unknown")
    for label, lo, hi in reversed(AGE_BANDS):
        out = F.when(_c(x).between(lo, hi), F.lit(label)).otherwise(out)
    return out


def year_of_ymd(x) -> Column:
    """Year prefix of a yyyymmdd int."""
    return F.floor(_c(x) / 10000).cast("int")


def hours(secs) -> Column:
    """Seconds -> hours."""
    return _c(secs).cast("double") / 3600.0


def segment_label(renew, cancel) -> Column:
    """'renew=x/cancel=y' (F10)."""
    return F.format_string("renew=%d/cancel=%d", _c(renew), _c(cancel))


def standardise(x, mean, std) -> Column:
    """(x - mean) / std with a zero std treated as 1."""
    s = F.when(_c(std) == 0, F.lit(1.0)).otherwise(_c(std))
    return (_c(x).cast("double") - _c(mean)) / s
