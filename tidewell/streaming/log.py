"""The event log as a stream: Kafka where its connector is installed, files elsewhere."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import exprs as X
from ..plans.store import Table
from ..runtime import ship
from ..schemas import LANDING, PAYLOAD
from ..sources.landing import Landing


def kafka_options(servers: str, topic: str, *, starting: str = "earliest", per_trigger: int | None = None) -> dict[str, str]:
    found = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, "failOnDataLoss": "true"}
    return found | ({"maxOffsetsPerTrigger": str(per_trigger)} if per_trigger else {})


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Landing records of a topic; needs the spark-sql-kafka connector on the class path."""
    read = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()
    return landing_records(read)


def landing_records(log: DataFrame, source: str = "events") -> DataFrame:
    """Landing records of (key, value, topic, partition, offset) rows as Kafka gives them."""
    raw = F.col("value").cast("string")
    return log.select(
        F.lit(source).alias("source"),
        F.col("topic").alias("log_topic"),
        F.col("partition").cast("int").alias("log_partition"),
        F.col("offset").cast("long").alias("log_offset"),
        F.col("key").cast("string").alias("log_key"),
        F.from_json(raw, PAYLOAD)["time_us"].alias("source_time_us"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("landed_at"),
        raw.alias("raw_json"),
    )


def file_stream(spark: SparkSession, folder: str, *, per_trigger: int | None = None) -> DataFrame:
    """Landing records from JSON-lines files that appear in a folder."""
    reader = spark.readStream.schema(LANDING).option("mode", "FAILFAST")
    return (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).json(folder)


def to_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Writes (key, value) rows to a topic, at least once."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.enable.idempotence": "true", "checkpointLocation": checkpoint}
    return messages.writeStream.format("kafka").options(**options).start()


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Gives each micro-batch of what is there now to ``each``; a failed one is given again."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def upsert_into(table: Table, key: list[str]) -> Callable[[DataFrame, int], None]:
    """A micro-batch sink that inserts new keys alone, so replays change nothing."""

    def each(rows: DataFrame, _: int) -> None:
        table.insert_new(rows.dropDuplicates(key), key)

    return each


def write_batches(rows: DataFrame, landing: Landing, batch_size: int = 200) -> int:
    """Writes rows as landing batches, by the executors; returns how many.

    A batch is of the offsets of one log partition between two multiples of
    ``batch_size``, so the same rows make the same batches again, whichever
    executor writes them.  ``landing`` is a folder that executors share.
    """
    ship(rows.sparkSession)

    def write(table: pa.Table) -> pa.Table:
        folder, _ = landing.write(table.sort_by("log_offset").to_pylist())
        return pa.table({"batch_id": [folder.name]})

    own = rows.select(*LANDING.names, F.floor(F.col("log_offset") / batch_size).alias("range"))
    keyed = own.groupBy("log_topic", "log_partition", "range").applyInArrow(lambda table: write(table.select(LANDING.names)), "batch_id string")
    return keyed.count()


def land(landing: Landing, batch_size: int = 200) -> Callable[[DataFrame, int], None]:
    """A micro-batch sink that writes landing batches; a micro-batch given again finds its batches there."""

    def each(rows: DataFrame, _: int) -> None:
        write_batches(rows, landing, batch_size)

    return each


def raw_events(landed: DataFrame, batch_id: str) -> DataFrame:
    """Raw-table rows of landing records that a stream brings without batch files."""
    return landed.withColumns({"batch_id": F.lit(batch_id), "landing_path": F.lit(None).cast("string"), "ingested_at": X.now()})


def well_formed(log: DataFrame) -> DataFrame:
    """The rows whose value is a JSON object; others are passed over, as a smoke consumer does."""
    kind = F.expr("schema_of_variant(try_parse_json(cast(value as string)))")
    return log.where(F.coalesce(kind.startswith("OBJECT"), F.lit(False)))


def smoke_messages(spark: SparkSession, n: int = 5) -> DataFrame:
    """A few (key, value) rows to try a log with."""
    number = F.col("id").cast("int").alias("number")
    return spark.range(n).select(F.concat(F.lit("smoke-"), F.col("id")).alias("key"), F.to_json(F.struct(number, F.lit("smoke").alias("kind"))).alias("value"))


def inspect(stream: DataFrame, checkpoint: str, *, show: int = 20, seconds: float = 5, printer: Callable[[str], None] = print) -> StreamingQuery:
    """Shows some of what arrives; positions are committed after each batch was shown."""

    def each(rows: DataFrame, number: int) -> None:
        for row in rows.limit(show).collect():
            printer(f"{number}: {row}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()
