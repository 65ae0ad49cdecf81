"""Scalar text and time functions as Columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ms_to_ts(ms: Column) -> Column:
    part = lambda by, mod: F.pmod(F.floor(ms / by), F.lit(mod)).cast("int")
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3600000).cast("int"), part(60000, 60), part(1000, 60), F.pmod(ms, F.lit(1000)).cast("int"))


def seconds_to_ts(sec: Column) -> Column:
    return ms_to_ts(F.greatest(F.lit(0).cast("long"), F.bround(sec * 1000).cast("long")))


def two_places(x: Column) -> Column:
    """A double to two decimals, rounded by its exact binary value and ties to even, which ``%.2f`` in the JVM does not do.

    The error of ``x * 100`` is computed exactly by splitting x in halves; it decides where the product looks like a tie.
    """
    big = x * 134217729.0
    high = big - (big - x)
    p = x * 100.0
    error = (high * 100.0 - p) + (x - high) * 100.0
    floor = F.floor(p).cast("double")
    whole = F.when((p - floor == 0.5) & (error != 0), floor + F.when(error > 0, 1.0).otherwise(0.0)).otherwise(F.rint(p))
    return F.format_string("%.2f", whole / 100.0)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, "(?U)^\\s+|\\s+$", "")


def strip_period(c: Column) -> Column:
    """Trim, then drop trailing full stops of either script."""
    return F.regexp_replace(strip(c), "(?U)[。.]+\\s*$", "")


def marker_core(c: Column) -> Column:
    return F.regexp_replace(c, "(?U)[\\s*]+\\z", "")


def char_len(c: Column) -> Column:
    return F.length(F.regexp_replace(marker_core(c), "(?U)\\s+", ""))


def clip(c: Column, n: int) -> Column:
    flat = strip(F.regexp_replace(c, "(?U)\\s+", " "))
    short = F.substring(flat, 1, n) if n <= 3 else F.concat(F.regexp_replace(F.substring(flat, 1, n - 3), "(?U)\\s+$", ""), F.lit("..."))
    return F.when(F.length(flat) > n, short).otherwise(flat)


def join_text(a: Column, b: Column) -> Column:
    """Trim both; a space only between two ASCII letters or digits."""
    x, y = strip(a), strip(b)
    gap = F.when(x.rlike("[A-Za-z0-9]$") & y.rlike("^[A-Za-z0-9]"), F.lit(" ")).otherwise(F.lit(""))
    return F.when(x == "", y).when(y == "", x).otherwise(F.concat(x, gap, y))


#: Fixed value: a phrase of 2 to 20 characters, a separator and the phrase again, up to a punctuation mark.
REPEAT = "(?U)(?<![\\x{4e00}-\\x{9fff}A-Za-z0-9])([\\x{4e00}-\\x{9fff}A-Za-z0-9]{2,20})(?:[，,、\\s]+)\\1([！？!?]?)(?=($|[，,。！？!?；;]))"


def collapse_repeats(c: Column) -> Column:
    """White space flattened, immediate repeats of a phrase dropped until none is left; each pass takes three characters or more."""
    flat = strip(F.regexp_replace(F.coalesce(c, F.lit("")), "(?U)\\s+", " "))
    passes = F.sequence(F.lit(1), F.greatest(F.lit(1), F.floor(F.length(flat) / 3)))
    again = F.aggregate(passes, flat, lambda t, _: F.when(t.rlike(REPEAT), F.regexp_replace(t, REPEAT, "$1$2")).otherwise(t))
    return F.when(flat.rlike(REPEAT), again).otherwise(flat)


def tidy(c: Column) -> Column:
    """A finished line: no trailing full stop, white space flattened, no immediate repeats."""
    return collapse_repeats(strip_period(c))


def marked(c: Column) -> Column:
    """Whether a line ends with the mark of low confidence."""
    return c.rlike("(?U)\\*[\\s*]*\\z")


def mark(c: Column, low: Column) -> Column:
    """The line without its mark, and with one again if it is ``low`` and not empty."""
    core = marker_core(c)
    return F.when(low & (core != ""), F.concat(core, F.lit("*"))).otherwise(core)
