"""As-of left join on days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def asof_day_join(events: DataFrame, rates: DataFrame, day: str, value: str) -> DataFrame:
    """Add to each event the ``value`` of the latest rate on or before its ``day``.

    ``rates`` has one row per day. Its gaps are filled into a day -> value map that ends at the last rate
    day; events after it look up that last day, so the join is a plain hash join without a pass over the
    events. The map is broadcast: it holds at most one row per calendar day between years 1 and 9999
    (under 3.7 million rows of 12 bytes), however many events there are. Events before the first rate get
    NULL. The window runs over the rates only, which the calendar bounds in the same way.
    """
    spans = rates.select(day, value, F.lead(day).over(W.orderBy(day)).alias("_next"))
    until = F.coalesce(F.date_sub("_next", 1), F.col(day))
    by_day = spans.select(F.explode(F.sequence(day, until)).alias("_rate_day"), value)
    # Taken from the whole rate row so that the plan below it can be shared with the window above.
    last_day = rates.agg(F.max(F.struct(day, value)).alias("last")).select(f"last.{day}").scalar()
    return (
        events.withColumn("_rate_day", F.least(F.col(day), last_day))
        .join(F.broadcast(by_day), "_rate_day", "left")
        .drop("_rate_day")
    )
