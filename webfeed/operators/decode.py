"""Decoding hit columns by a lookup as it was on the hit's delivery day."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import FeedOptionError
from ..paths import quoted
from ..plans.broadcast import bounded_broadcast, row_bytes
from ..sources.lookup import LookupHistory

#: Deliveries of a bucket: a hit meets at most so many intervals of its key.
BUCKET = 32


def decode_as_of(hits: DataFrame, history: LookupHistory, column: str, into: str, day: str = "delivery_date") -> DataFrame:
    """``hits`` with the column ``into``: what the last delivery up to the hit's ``day`` says ``column`` means.

    Null where ``day`` is before the first delivery of the history, null itself, or where that delivery has no such key.

    A hit's day becomes the number of its delivery (a table of the calendar days that the history spans, a
    few bytes each, which is broadcast). An interval stands in every bucket of ``BUCKET`` deliveries that
    it touches, and hits join their key in their bucket: an equality join that meets at most
    ``BUCKET`` intervals a hit, however often a value changed. Spark can split the hits of a hot key.
    """
    if into in hits.columns:
        raise FeedOptionError(f"the hits have a column {into!r} already")
    days = history.days
    calendar = [(d + timedelta(i), n) for n, (d, nxt) in enumerate(zip(days, days[1:], strict=False))
                for i in range((nxt - d).days)] + [(days[-1], len(days) - 1)]
    numbers = hits.sparkSession.createDataFrame(calendar, "__wf_day date, __wf_n int")
    on = F.least(F.col(quoted(day)).cast("date"), F.lit(days[-1]))  # the last delivery holds on
    left = hits.withColumn("__wf_on", F.when(F.col(quoted(day)).isNotNull(), on)) \
        .join(bounded_broadcast(numbers, len(calendar), row_bytes()), F.col("__wf_on") == F.col("__wf_day"), "left") \
        .withColumns({"__wf_key": F.col(quoted(column)).cast("string"), "__wf_bucket": F.floor(F.col("__wf_n") / BUCKET)})
    right = history.intervals.select(
        F.col("lookup_key").alias("__wf_lookup"), F.col("lookup_value").alias(into), "first", "last",
        F.explode(F.sequence(F.floor(F.col("first") / BUCKET), F.floor(F.col("last") / BUCKET))).alias("__wf_in")) \
        .withColumnsRenamed({"first": "__wf_first", "last": "__wf_last"})
    met = (F.col("__wf_key") == F.col("__wf_lookup")) & (F.col("__wf_bucket") == F.col("__wf_in")) \
        & F.col("__wf_n").between(F.col("__wf_first"), F.col("__wf_last"))
    return left.join(right, met, "left").select(*[F.col(quoted(c)) for c in hits.columns], F.col(quoted(into)))
