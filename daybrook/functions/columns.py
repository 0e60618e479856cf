"""Column expressions shared by the layers. All of them stay inside whole-stage codegen or JVM code."""

import re

from pyspark.sql import Column, functions as F

from daybrook.params import DEFAULTS, Params

# Unicode white space plus the four separators U+001C..U+001F that text tools also split on
SPACE = r"[\s\x{1C}-\x{1F}]"
NON_SPACE_RUN = r"(?U)[^\s\x{1C}-\x{1F}]+"


def strip(c) -> Column:
    """Trim Unicode white space on both ends (``trim`` only knows the ASCII blank)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.regexp_replace(col, rf"(?U)\A{SPACE}+", ""), rf"(?U){SPACE}+\z", "")


def is_blank(c) -> Column:
    """Empty or only white space. A first character that is visible ASCII settles it without the pattern."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(F.ascii(col).between(33, 126), F.lit(False)).otherwise(
        F.coalesce(col.rlike(rf"(?U)\A{SPACE}*\z"), F.lit(True)))


def word_count(c) -> Column:
    """Number of white-space separated words of the whole text."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_count(col, F.lit(NON_SPACE_RUN)).cast("bigint")


def is_int_text(c) -> Column:
    """``-?digits`` and inside the 64-bit range. ``\\z`` because ``$`` also matches before a newline."""
    col = F.col(c) if isinstance(c, str) else c
    value = col.try_cast("bigint")
    # canonical digits settle it; leading zeros and other spellings go through the pattern
    return F.when(value.cast("string") == col, F.lit(True)).otherwise(
        F.coalesce(col.rlike(r"\A-?[0-9]+\z") & value.isNotNull(), F.lit(False)))


def is_number_text(c) -> Column:
    """A finite or infinite decimal number; suffix forms such as ``1.0d`` and NaN do not count."""
    col = F.col(c) if isinstance(c, str) else c
    v = col.try_cast("double")
    return F.coalesce(
        v.isNotNull() & ~F.isnan(v) & ~F.trim(col).rlike(r"[dDfF]\z"), F.lit(False))


def is_bool_text(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.isin("True", "False"), F.lit(False))


def bool_from_text(c) -> Column:
    """``True``/``False`` text to boolean; any other text becomes null (the raw gate rejects it)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col == "True", F.lit(True)).when(col == "False", F.lit(False))


def check_p_date(p_date) -> str:
    """Validate a YYYYMMDD argument."""
    text = str(p_date)
    if not re.fullmatch(r"[0-9]{8}", text):
        raise ValueError(f"p_date must look like YYYYMMDD, got {p_date!r}")
    return text


def is_p_date_text(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.rlike(r"\A[0-9]{8}\z"), F.lit(False))


def label_to_date(c) -> Column:
    return F.to_date(F.col(c) if isinstance(c, str) else c, "yyyyMMdd")


def date_to_label(c) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyyMMdd")


def iso_date(p_date: str) -> str:
    p_date = check_p_date(p_date)
    return f"{p_date[:4]}-{p_date[4:6]}-{p_date[6:]}"


def late_night(hour="p_hour", params: Params = DEFAULTS) -> Column:
    """Hour inside the late-night window, both ends included."""
    return F.col(hour).between(params.late_night_start_hour, params.late_night_end_hour)


def watch_ratio() -> Column:
    return F.try_divide(F.col("watch_time"), F.col("duration"))


def try_ratio(part, total) -> Column:
    """``part / total`` for a column and an expression, null when the divisor is zero."""
    return F.try_divide(F.col(part).cast("double"), total)


def is_rewatch(params: Params = DEFAULTS) -> Column:
    """Strictly longer than the clip; equal is not a rewatch and nothing is capped."""
    return F.col("watch_time") > F.col("duration") * F.lit(params.rewatch_ratio)


def share(part, total) -> Column:
    """``part / total`` as double, null when the total is zero."""
    return F.try_divide(F.col(part).cast("double"), F.col(total).cast("double"))


def count_if(cond: Column) -> Column:
    """Rows where the condition is true; a null condition does not count."""
    return F.coalesce(F.count_if(cond), F.lit(0)).cast("bigint")


def epoch_seconds(ts) -> Column:
    """Whole Unix seconds of a zone-less timestamp, independent of the session time zone."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return (
        F.unix_date(F.to_date(col)).cast("bigint") * 86400
        + F.hour(col).cast("bigint") * 3600 + F.minute(col).cast("bigint") * 60 + F.second(col).cast("bigint")
    )


def epoch_date(seconds, offset_hours: int = 0) -> Column:
    """Calendar date of Unix seconds at a fixed offset from UTC."""
    col = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.date_from_unix_date(F.floor((col + offset_hours * 3600) / F.lit(86400)).cast("int"))


def epoch_hour(seconds, offset_hours: int = 0) -> Column:
    col = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.floor(F.pmod(col + offset_hours * 3600, F.lit(86400)) / F.lit(3600)).cast("int")
