"""Money, date, age and rate column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.text import _c

# ---------------------------------------------------------------------------
# These must equal the reference's for identical results.
DAYS_PER_MONTH = 30.44          # average month length used for monthly rates
MIN_DAYS_FOR_RATE = 30          # shorter windows give no monthly rate
DAYS_PER_YEAR = 365.25          # age in whole years = floor(days / 365.25)
ADULT_MIN_AGE, MAX_AGE = 18, 100
RE_EPOCH_MS = r"^\d+$"
RE_ISO = r"^\d{4}-\d{2}-\d{2}$"
RE_DMY = r"^\d{2}/\d{2}/\d{4}$"
# ---------------------------------------------------------------------------

# Epoch milliseconds above this are past 9999-12-31 and give NULL, not an error.
_MAX_EPOCH_MS = 253402300800000


def parse_money(col) -> Column:
    """trim, delete ``$`` and ``,``, then decimal(12,2) (half-up); bad text -> NULL."""
    s = F.regexp_replace(F.trim(_c(col)), r"[$,]", "")
    return s.try_cast("decimal(12,2)")


def parse_date_multi(col) -> Column:
    """digits -> epoch milliseconds; ``yyyy-MM-dd``; ``dd/MM/yyyy``; else NULL.

    ``try_*`` forms keep impossible dates (2023-02-30) and over-long digit runs
    NULL under ANSI mode instead of failing the task.
    """
    t = F.trim(_c(col))
    ms = t.try_cast("long")
    epoch_day = F.when((ms >= 0) & (ms < F.lit(_MAX_EPOCH_MS)),
                       F.date_from_unix_date(F.floor(ms / F.lit(86400000)).cast("int")))
    return (F.when(t.rlike(RE_EPOCH_MS), epoch_day)
             .when(t.rlike(RE_ISO), F.try_to_date(t, "yyyy-MM-dd"))
             .when(t.rlike(RE_DMY), F.try_to_date(t, "dd/MM/yyyy"))
             .otherwise(F.lit(None).cast("date")))


def days_between(later, earlier) -> Column:
    """whole days from ``earlier`` to ``later``."""
    return F.datediff(_c(later), _c(earlier))


def age_years(birth, as_of: str) -> Column:
    """floor(days / 365.25) at the ``as_of`` date."""
    return F.floor(F.datediff(F.lit(as_of).cast("date"), _c(birth)) / F.lit(DAYS_PER_YEAR))


def valid_age(birth, as_of: str) -> Column:
    """F12/F13 validity: birth known and ADULT_MIN_AGE <= age <= MAX_AGE."""
    a = age_years(birth, as_of)
    return _c(birth).isNotNull() & (a >= ADULT_MIN_AGE) & (a <= MAX_AGE)


def monthly_rate(value, days) -> Column:
    """Value per average month, only when the window has >= 30 days."""
    d = _c(days)
    return F.when(d >= MIN_DAYS_FOR_RATE, _c(value) / (d / F.lit(DAYS_PER_MONTH)))


def pct_change(new, old) -> Column:
    """(new / old - 1) * 100; NULL when ``old`` is 0."""
    return (F.try_divide(_c(new), _c(old)) - F.lit(1.0)) * F.lit(100.0)
