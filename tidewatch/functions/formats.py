"""Durations, counts, bytes, times and health figures as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit lengths in milliseconds.
SECOND = 1000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR
WEEK = 7 * DAY
YEAR = 365 * DAY

# Number units, byte units.
NUMBER_UNITS = ((1e12, " T"), (1e9, " B"), (1e6, " M"), (1e3, " K"))
BYTE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB", "EB")

# Fixed value: share of collection time that is marked.
GC_WARNING_SHARE = 0.1


def format_duration(ms: Column) -> Column:
    """``99 ms``, ``0.5 s``, ``59 s``, ``9.5 min``, ``42 min``, ``1.5 h``."""
    seconds = ms.cast("double") / 1000
    minutes = seconds / 60
    return (F.when(ms < 100, F.concat(ms.cast("string"), F.lit(" ms")))
            .when(seconds < 1, F.format_string("%.1f s", seconds))
            .when(seconds < 60, F.format_string("%.0f s", seconds))
            .when(minutes < 10, F.format_string("%.1f min", minutes))
            .when(minutes < 60, F.format_string("%.0f min", minutes))
            .otherwise(F.format_string("%.1f h", minutes / 60)))


def _whole(value: Column, unit: int) -> Column:
    return F.floor(value / unit).cast("bigint")


def format_duration_verbose(ms: Column) -> Column:
    """``5 seconds 35 ms`` style with the two or three largest units.

    A unit of zero leaves its place empty, so the blanks around it stay.
    """
    def unit(limit: int | None, length: int, name: str) -> Column:
        rest = ms if limit is None else F.pmod(ms, F.lit(limit))
        number = _whole(rest, length)
        text = number.cast("string")
        return (F.when(number == 0, "").when(number == 1, F.concat(text, F.lit(f" {name}")))
                .otherwise(F.concat(text, F.lit(f" {name}s"))))

    def spaced(*parts: Column) -> Column:
        return F.concat_ws(" ", *parts)

    left = F.pmod(ms, F.lit(SECOND))
    millis = (F.when((ms >= SECOND) & (left == 0), "")
              .otherwise(F.concat(left.cast("string"), F.lit(" ms"))))
    seconds, minutes = unit(MINUTE, SECOND, "second"), unit(HOUR, MINUTE, "minute")
    hours, days = unit(DAY, HOUR, "hour"), unit(WEEK, DAY, "day")
    weeks, years = unit(YEAR, WEEK, "week"), unit(None, YEAR, "year")
    return (F.when(ms < SECOND, millis)
            .when(ms < MINUTE, spaced(seconds, millis))
            .when(ms < HOUR, spaced(minutes, seconds))
            .when(ms < DAY, spaced(hours, minutes, seconds))
            .when(ms < WEEK, spaced(days, hours, minutes))
            .when(ms < YEAR, spaced(weeks, days, hours))
            .otherwise(spaced(years, weeks, days)))


def format_number_unit(number: Column) -> Column:
    """``2.5 M`` once a number reaches twice a unit; below 2000 its whole part."""
    text = None
    for size, suffix in NUMBER_UNITS:
        shown = F.format_string(f"%.1f{suffix}", number / F.lit(size))
        reached = number >= 2 * size
        text = F.when(reached, shown) if text is None else text.when(reached, shown)
    return text.otherwise(number.cast("bigint").cast("string"))


def format_bytes(size: Column, units: Sequence[str] = BYTE_UNITS) -> Column:
    """Base 1000 with at most one decimal: ``2 KB``, ``1.5 MB``; zero is ``0.0 B``.

    Whole numbers throughout, halves up. Sizes beyond the last of ``units`` are given in it (``2500 TB``).
    """
    text = F.when(size == 0, "0.0 B")
    for power in range(len(units) - 1, 0, -1):
        tenth = 1000 ** power // 10
        tenths = (F.call_function("div", size, F.lit(tenth))
                  + F.when(size % tenth >= tenth // 2, 1).otherwise(0))
        whole, left = F.call_function("div", tenths, F.lit(10)), tenths % 10
        shown = F.concat(whole.cast("string"), F.when(left > 0, F.concat(F.lit("."), left.cast("string")))
                         .otherwise(""), F.lit(f" {units[power]}"))
        text = text.when(size >= 1000 ** power, shown)
    return text.when(size >= 1, F.concat(size.cast("string"), F.lit(f" {units[0]}")))


def format_time(ms: Column) -> Column:
    """``yyyy/MM/dd HH:mm:ss`` in the session time zone."""
    return F.date_format(F.timestamp_millis(ms), "yyyy/MM/dd HH:mm:ss")


def format_listing_time(ms: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; ``-`` for values up to zero."""
    return (F.when(ms <= 0, "-")
            .otherwise(F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss")))


def status_label(excluded: Column, active: Column, excluded_stages: Column) -> Column:
    """``Blacklisted``, ``Active``, ``Active (Blacklisted in Stages: [..])`` or ``Dead``."""
    stages = F.array_join(F.transform(excluded_stages, lambda s: s.cast("string")), ", ")
    return (F.when(excluded, "Blacklisted")
            .when(active & (F.coalesce(F.size(excluded_stages), F.lit(0)) <= 0), "Active")
            .when(active, F.concat(F.lit("Active (Blacklisted in Stages: ["), stages,
                                   F.lit("])")))
            .otherwise("Dead"))


def active_ratio(active: Column, most: Column) -> Column:
    return F.when(most > 0, active / most * 0.5 + 0.5).otherwise(F.lit(1.0))


def failed_ratio(failed: Column, total: Column) -> Column:
    return (F.when(total > 0, F.least(failed * 10 / total, F.lit(1.0)) * 0.5 + 0.5)
            .otherwise(F.lit(1.0)))


def gc_ratio(gc: Column, duration: Column) -> Column:
    return F.when(duration > 0, F.least(gc / duration + 0.5, F.lit(1.0))).otherwise(F.lit(1.0))


def gc_heavy(gc: Column, duration: Column, share: float = GC_WARNING_SHARE) -> Column:
    return gc > duration * share


def percent_completed(completed: Column, total: Column) -> Column:
    return F.try_divide(completed.cast("double"), total.cast("double")) * 100


def percent_running(started: Column, completed: Column, total: Column) -> Column:
    """Share of running tasks; speculative copies cannot push it beyond the open ones."""
    open_tasks = F.least(started, total - completed)
    return F.try_divide(open_tasks.cast("double"), total.cast("double")) * 100


def progress_text(started: Column, completed: Column, failed: Column, skipped: Column,
                  total: Column, killed: Column | None = None) -> Column:
    """``3/9 (2 failed) (1 killed: reason)``.

    ``killed`` is an array of (reason, n) structs, shown by falling count.
    """
    def when_some(number: Column, word: str) -> Column:
        return F.when(number > 0, F.concat(F.lit("("), number.cast("string"), F.lit(f" {word})")))

    running = F.when((failed == 0) & (skipped == 0) & (started > 0),
                     F.concat(F.lit("("), started.cast("string"), F.lit(" running)")))
    parts = [F.concat(completed.cast("string"), F.lit("/"), total.cast("string")), running,
             when_some(failed, "failed"), when_some(skipped, "skipped")]
    if killed is not None:
        ranked = F.sort_array(F.transform(killed, lambda k: F.struct(
            (-k["n"]).alias("order"), k["reason"].alias("reason"), k["n"].alias("n"))))
        shown = F.array_join(F.transform(ranked, lambda k: F.concat(
            F.lit("("), k["n"].cast("string"), F.lit(" killed: "), k["reason"], F.lit(")"))), " ")
        parts.append(F.when(F.size(killed) > 0, shown))
    return F.concat_ws(" ", *parts)
