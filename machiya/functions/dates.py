"""Dates in text, ages and elapsed time.  The present is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The year before the first of each era.
ERAS = (("令和", 2018), ("平成", 1988), ("昭和", 1925))


def _part(c: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit("")).try_cast("int")


def year_month(c: Column) -> Column:
    """Struct (ym, precision) of a date text: year and month in Western or era years, else the year's first month.

    One grammar reads every statement of a text: an optional era, a year, and an optional month.  A Western year with a
    month in words wins over one in figures, then a Western year alone, then an era year with a month; equal ones go to the
    first.  Era years without a month and months that do not exist state nothing.
    """
    names = "|".join(e for e, _ in ERAS)
    grammar = rf"(?:(?:19|20)[0-9]{{2}}|(?:{names})\s*[0-9]{{1,2}})\s*(?:年\s*(?:[0-9]{{1,2}}\s*月)?|[/-]\s*[0-9]{{1,2}})"
    found = F.regexp_extract_all(c, F.lit(grammar), 0)
    base = F.create_map(*[F.lit(x) for e in ERAS for x in e])

    def read(x: Column, i: Column) -> Column:
        era = F.regexp_extract(x, names, 0)
        year = F.regexp_extract(x, "[0-9]+", 0).try_cast("int") + F.coalesce(F.try_element_at(base, era), F.lit(0))
        month = F.nullif(F.regexp_extract(x, r"(?:年|[/-])\s*([0-9]{1,2})", 1), F.lit("")).try_cast("int")
        figures = ~F.contains(x, F.lit("年"))
        rank = F.when((era == "") & month.isNotNull(), F.when(figures, 1).otherwise(0)).when(era == "", 2).when(month.isNotNull() & ~figures, 3)
        valid = rank.isNotNull() & F.coalesce(month.between(1, 12), F.lit(True))
        ym = F.format_string("%04d-%02d", year, F.coalesce(month, F.lit(1)))
        return F.when(valid, F.struct(rank.alias("rank"), i.alias("at"), ym.alias("ym"), F.when(month.isNull(), "year").otherwise("month").alias("precision")))

    best = F.array_min(F.array_compact(F.transform(found, read)))
    return F.when(best.isNotNull(), F.struct(best["ym"].alias("ym"), best["precision"].alias("precision")))


def labelled_date(c: Column, labels: list[str]) -> Column:
    """``YYYY-MM-DD`` of the first date in a text that stands right after one of the labels; null if none does."""
    said = "(?:" + "|".join(labels) + r")\s*[:：]?\s*(20[0-9]{2})年\s*([0-9]{1,2})月\s*([0-9]{1,2})日"
    y, m, d = (_part(c, said, i) for i in (1, 2, 3))
    return F.when(y.isNotNull(), F.format_string("%04d-%02d-%02d", y, m, d))


def months_between_ym(ym: Column, now: Column) -> Column:
    """Whole months from a ``YYYY-MM`` text to a date; null for other texts."""
    y, m = _part(ym, r"^([0-9]{4})-([0-9]{2})$", 1), _part(ym, r"^([0-9]{4})-([0-9]{2})$", 2)
    return (F.year(now) - y) * 12 + F.month(now) - m


def age_years(ym: Column, now: Column, clamp: bool = False) -> Column:
    """Age in years by months, unrounded; a future month is null, or 0 with ``clamp``."""
    months = months_between_ym(ym, now)
    return F.when(months >= 0, months / 12).otherwise(F.when(months < 0, F.lit(0.0)) if clamp else F.lit(None).cast("double"))


def built_year(c: Column, now_year: int) -> Column:
    """Year of construction in text: ``YYYY年``, else ``築N年`` counted back from the present."""
    return F.coalesce(_part(c, r"((?:19|20)[0-9]{2})年", 1), F.lit(now_year) - _part(c, r"築\s*([0-9]{1,3})\s*年", 1))


def quarter_end(c: Column) -> Column:
    """Last second of a quarter written ``2026Q1`` or ``2026年第1四半期``; null for other texts."""
    # The two notations of quarters in the data.
    y = F.coalesce(_part(c, r"(?i)((?:19|20)[0-9]{2})\s*Q([1-4])", 1), _part(c, r"((?:19|20)[0-9]{2})年\s*第?([1-4])四半期", 1))
    q = F.coalesce(_part(c, r"(?i)((?:19|20)[0-9]{2})\s*Q([1-4])", 2), _part(c, r"((?:19|20)[0-9]{2})年\s*第?([1-4])四半期", 2))
    return F.when(y.isNotNull(), F.last_day(F.make_date(y, q * 3, F.lit(1))).cast("timestamp") + F.expr("interval 86399 seconds"))


def whole_days(start: Column, end: Column) -> Column:
    """Whole elapsed days between two times, never negative."""
    days = F.floor((F.unix_micros(end) - F.unix_micros(start)) / F.lit(86_400_000_000))
    return F.when(start.isNotNull() & end.isNotNull(), F.greatest(days, F.lit(0)).cast("int"))


def in_window(t: Column, now: Column, days: int) -> Column:
    """True when a time lies in the closed window of so many days up to now; false when it is unknown."""
    return F.coalesce(t.between(now - F.expr(f"interval {days} days"), now), F.lit(False))


def iso_time(c: Column) -> Column:
    """Time of an ISO 8601 text in the session's zone; null for bad texts."""
    return F.try_to_timestamp(c)
