"""A point that filters are not pushed below."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluated_once(df: DataFrame) -> DataFrame:
    """The same rows. Filters on computed columns stay above this point; pushed below it, Spark would compute
    those columns a second time for the filter. It unpacks a one-element array per row, without a shuffle. What follows is
    also generated as a method of its own: the JIT leaves methods of more than 8,000 bytes to the interpreter."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))
