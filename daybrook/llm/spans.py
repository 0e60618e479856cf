"""Where a pattern matches, as column expressions: Spark gives the matches, the text between them gives their places."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

SPAN = "array<struct<start:bigint,end:bigint,match:string>>"


def find_spans(text: Column, pattern: Column | str, measure: Callable[[Column], Column] = F.length) -> Column:
    """Leftmost non-overlapping matches as array of (start, end, match); ``measure`` counts the units of a piece (code points)."""
    regex = F.lit(pattern) if isinstance(pattern, str) else pattern
    pieces = F.zip_with(F.split(text, regex, -1), F.regexp_extract_all(text, regex, F.lit(0)),
                        lambda before, match: F.struct(measure(before).cast("bigint").alias("gap"),
                                                       measure(match).cast("bigint").alias("size"), match.alias("match")))
    nothing = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(acc: Column, piece: Column) -> Column:
        start = acc["at"] + piece["gap"]
        end = start + piece["size"]
        found = F.struct(start.alias("start"), end.alias("end"), piece["match"].alias("match"))
        return F.when(piece["match"].isNull(), acc).otherwise(
            F.struct(end.alias("at"), F.concat(acc["spans"], F.array(found)).alias("spans")))

    return F.aggregate(pieces, nothing, step, lambda acc: acc["spans"])


def spans_where(condition: Column, text: Column, pattern: Column | str, measure=F.length) -> Column:
    """``find_spans`` where the (cheaper) condition holds, else no spans."""
    return F.when(condition, find_spans(text, pattern, measure)).otherwise(F.array().cast(SPAN))
