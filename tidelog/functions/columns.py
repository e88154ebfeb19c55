"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that count as blanks at either end of a text.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0" + "".join(
    map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    A plain ``withColumn`` is inlined wherever it is used, so an expensive parse would
    run again in every filter that looks at its result. A one-row ``inline`` keeps
    Catalyst from copying the expression below or above itself.
    """
    packed = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(packed)))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def blank_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def rate(part: Column, whole: Column) -> Column:
    """``part / whole``, 0.0 for an empty whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def minute(timestamp: Column) -> Column:
    return F.date_trunc("minute", timestamp)
