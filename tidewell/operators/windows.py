"""Event-time windows of created posts, corrected by full recomputation, with arrival observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import QualityError
from ..functions import exprs as X
from ..schemas import MEASURES, WINDOW_KEY


def created_posts(events: DataFrame, source: str = "events") -> DataFrame:
    return events.where((F.col("source") == source) & (F.col("event_type") == "content_created") & (F.col("entity_type") == "post"))


def require_valid(posts: DataFrame) -> DataFrame:
    """``posts``, or QualityError if an id or time is null or an id repeats."""
    if not posts.where("event_id IS NULL OR event_time IS NULL").isEmpty():
        raise QualityError("a post without event_id or event_time")
    if not posts.groupBy("event_id").count().where("count > 1").isEmpty():
        raise QualityError("a post's event_id repeats")
    return posts


#: Offsets of a log partition that one task looks at in order.
RANGE = 100_000
_PLACE = ["log_topic", "log_partition"]


def with_latest_before(posts: DataFrame, size: int | None = None) -> DataFrame:
    """``posts`` with latest_before, the latest event time at an earlier offset of the log partition.

    A log partition is cut into ranges of offsets.  The maximum of each range
    is an aggregate that combines before it shuffles, what came before each
    range a window over these few rows, and the order inside a range a window
    of its own, so no task sorts a whole log partition.
    """
    ranged = posts.withColumn("offsets_", F.floor(F.col("log_offset") / (size or RANGE)).cast("long"))
    latest = ranged.groupBy(*_PLACE, "offsets_").agg(F.max("event_time").alias("latest_"))
    earlier = Window.partitionBy(*_PLACE).orderBy("offsets_").rowsBetween(Window.unboundedPreceding, -1)
    latest = latest.select(*_PLACE, "offsets_", F.max("latest_").over(earlier).alias("before_"))
    inside = Window.partitionBy(*_PLACE, "offsets_").orderBy("log_offset").rowsBetween(Window.unboundedPreceding, -1)
    both = ranged.join(latest, [*_PLACE, "offsets_"], "left").withColumn("latest_before", F.greatest("before_", F.max("event_time").over(inside)))
    return both.drop("offsets_", "before_")


def frontiers(events: DataFrame, *by: str, time: str = "event_time", lag: str = X.VERY_LATE) -> DataFrame:
    """(by, frontier): no event before the frontier is expected any more."""
    return events.groupBy(*by).agg(X.frontier(F.max(time), lag).alias("frontier"))


def with_arrival(posts: DataFrame) -> DataFrame:
    """``posts`` with their window, delay and arrival flags.

    An event is out of order if an earlier offset of its log partition has a
    later event time.
    """
    timed = with_latest_before(posts).withColumn("w", F.window("event_time", X.WINDOW))
    timed = timed.withColumns({"window_start": F.col("w.start"), "window_end": F.col("w.end"), "delay_seconds": X.delay_seconds()})
    return timed.withColumns({"is_out_of_order": X.flag(F.col("latest_before") > F.col("event_time")), **X.arrival_flags()}).drop("w").select(*posts.columns, "latest_before", "window_start", "window_end", "delay_seconds", "is_out_of_order", *X.ARRIVAL_FLAGS)


def post_windows(events: DataFrame, source: str = "events", *, checked: bool = True) -> DataFrame:
    """One row for each source and window, however late its events came; nothing is dropped."""
    posts = created_posts(events, source)
    if checked:
        require_valid(posts)
    total = lambda c: F.sum(c).cast("long")
    measures = [
        F.count("event_id").cast("long"),
        total("is_late"),
        total("is_very_late"),
        total("is_out_of_order"),
        total("is_future_dated"),
        total("is_ingestion_unknown"),
        F.max(F.greatest(F.lit(0.0), F.col("delay_seconds"))),
        F.max("event_time"),
        F.max("ingested_at"),
    ]
    grouped = with_arrival(posts).groupBy(*WINDOW_KEY).agg(*[m.alias(n) for m, n in zip(measures, MEASURES, strict=True)])
    return grouped.withColumn("aggregate_updated_at", X.now())
