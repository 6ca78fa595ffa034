"""Queries that run the file path: the test tables' log as landing batches, taken in, damaged, published and streamed."""

from __future__ import annotations

import json
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import QualityError, StoreError
from ..operators import checks, windows
from ..schemas import LANDING, MANIFEST, TABLES
from ..sources import batches, eventlog, posts
from ..sources.landing import Landing, Publisher, remote_folder
from ..streaming import firehose, log
from ..streaming.watermark import shared_folder
from . import ddl, jobs
from .store import Store

#: Offsets of a log partition that one batch of the queries spans.
SPAN = 600


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return eventlog.raw_log(eventlog.read_events(spark, d))


def _disk(folder: str) -> Path:
    """The shared folder as a path of the mounted file system, where landing batches are."""
    path = folder.removeprefix("file:")
    if ":" in path.split("/")[0]:
        raise StoreError(f"landing batches need a mounted folder, not {folder}")
    return Path("/" + path.lstrip("/"))


def _landed(spark: SparkSession, d: str) -> Landing:
    landing = Landing(_disk(shared_folder(spark, "landing")))
    log.write_batches(_raw(spark, d).select(*LANDING.names), landing, SPAN)
    return landing


def _root(landing: Landing) -> str:
    return f"file://{landing.ready}"


def _committed(spark: SparkSession, d: str) -> DataFrame:
    return batches.committed(spark, _root(_landed(spark, d)))


def committed(spark: SparkSession, d: str) -> DataFrame:
    return _committed(spark, d).select("batch_id", "log_partition", "first_offset", "last_offset")


def manifests(spark: SparkSession, d: str) -> DataFrame:
    """What the batches' manifests say, as JSON readers see them."""
    read = spark.read.schema(MANIFEST).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", batches.MANIFEST_FILE)
    return read.json(_root(_landed(spark, d))).drop("created_at")


def _damage(folder: Path, how: int) -> None:
    """One kind of damage for each of six numbers; others leave a batch whole."""
    data, described = folder / batches.DATA, folder / batches.MANIFEST_FILE
    manifest = json.loads(described.read_text(encoding="utf-8"))
    body = data.read_bytes()
    changes = {2: {"record_count": 0}, 3: {"log_topic": "other"}, 4: {"sha256": "z"}, 5: {"size_bytes": "many"}}
    if how == 0:
        data.write_bytes(b"[" + body[1:])
    elif how == 1:
        data.write_bytes(body + b"\n")
    elif how in changes:
        described.write_text(json.dumps(manifest | changes[how]), encoding="utf-8")


def problems(spark: SparkSession, d: str) -> DataFrame:
    """Batches of which six in eight are damaged, and what is wrong with each."""
    landing = _landed(spark, d)
    for folder in landing.ready.iterdir():
        _damage(folder, int(folder.name.rsplit("-", 1)[1]) // SPAN % 8)
    root = _root(landing)
    described = batches.manifests(spark, root, batches.committed(spark, root), eventlog.TOPIC)
    return batches.verified(spark, root, described).select("batch_id", "problem")


def _ingested(spark: SparkSession, d: str) -> Store:
    """Batches verified, loaded and merged into tables, twice: the second run finds nothing to do."""
    landing, store = _landed(spark, d), Store(spark, shared_folder(spark, "tables"))
    n = jobs.ingest(store, _root(landing), limit=1 << 30)
    if jobs.ingest(store, _root(landing), limit=1 << 30) or store["ingested_batches"].read().count() != n:
        raise QualityError("a replay took in batches again")
    return store


def ingested_events(spark: SparkSession, d: str) -> DataFrame:
    return _ingested(spark, d)["raw_events"].read().drop("landing_path", "ingested_at")


def ingested_batches(spark: SparkSession, d: str) -> DataFrame:
    return _ingested(spark, d)["ingested_batches"].read().select("batch_id", "record_count", "events_sha256")


def _log_of_even(committed: DataFrame) -> DataFrame:
    return committed.where("first_offset % 2 = 0").select("batch_id")


def pending(spark: SparkSession, d: str, fair: bool = False) -> DataFrame:
    """The next batches, if the log has those whose first offset is even."""
    found = _committed(spark, d)
    return batches.pending(found, _log_of_even(found), fair=fair).select("batch_id")


def history(spark: SparkSession, d: str) -> DataFrame:
    """Versions of a table after an insert, a replay, another insert, a compaction and a replacement."""
    table = Store(spark, shared_folder(spark, "history"))["rejected_native"]
    rows = _raw(spark, d).select(F.concat_ws(":", "log_partition", "log_offset").alias("event_id"), *[F.col(c) for c in ("source", "log_topic", "log_partition", "log_offset")])
    rows = rows.selectExpr("*", "CAST(NULL AS STRING) rejection_reason", "CAST(NULL AS STRING) raw_json", "CAST(NULL AS TIMESTAMP_NTZ) rejected_at")
    for part in (rows.where("log_partition = 0"), rows.where("log_partition = 0"), rows):
        table.insert_new(part, ["event_id"])
    table.compact()
    table.replace(rows.where("log_partition = 1"))
    counts = spark.createDataFrame([(v, table.read(v).count()) for v in range(1, table.version + 1)], "version long, row_count long")
    return table.history().select("version", "operation", F.size("segments").alias("segment_count")).join(counts, "version")


def detail(spark: SparkSession, d: str) -> DataFrame:
    """A compacted table's detail beside what is really there."""
    table = Store(spark, shared_folder(spark, "detail"))["raw_events"]
    table.append(_raw(spark, d))
    table.compact()
    size = sum(table.files.sizes(f"{table.home}/{table.history().first()['segments'][0]}"))
    return table.detail().select("name", "version", "num_files", (F.col("size_bytes") == size).alias("size_agrees"), (F.col("location") == table.home).alias("location_agrees"))


class _Folder:
    """A folder as a remote store."""

    def __init__(self, root: Path):
        self.root = root

    def _at(self, path: str) -> Path:
        return self.root / path.lstrip("/")

    def read(self, path: str) -> bytes | None:
        at = self._at(path)
        return at.read_bytes() if at.exists() else None

    def write(self, path: str, body: bytes, overwrite: bool) -> None:
        at = self._at(path)
        at.parent.mkdir(parents=True, exist_ok=True)
        with open(at, "wb" if overwrite else "xb") as f:
            f.write(body)


def published(spark: SparkSession, d: str) -> DataFrame:
    """Batches at their destination after as many cycles as it takes, and whether they are archived here."""
    landing = _landed(spark, d)
    there = _Folder(landing.root / "remote")
    publisher = Publisher(landing, there, remote_folder("/Volumes/main/landing/events"), per_cycle=200)
    while publisher.cycle():
        pass
    found = batches.committed(spark, f"file://{there.root}")
    own = spark.createDataFrame([(p.name,) for p in landing.archived.iterdir()], "batch_id string").withColumn("archived", F.lit(True))
    return found.join(own, "batch_id", "left").select("batch_id", F.coalesce("archived", F.lit(False)).alias("archived"))


def streamed(spark: SparkSession, d: str) -> DataFrame:
    """The log as a file stream into landing batches, and these as a stream into a table; both given twice."""
    folder = shared_folder(spark, "streamed")
    _raw(spark, d).select(*LANDING.names).write.json(f"{folder}/log")
    landing = Landing(_disk(f"{folder}/landing"))
    table = Store(spark, f"{folder}/tables")["raw_events"]
    upsert = log.upsert_into(table, jobs.LOG_KEY)
    for k in range(2):  # a lost checkpoint gives everything again
        log.run_available(log.file_stream(spark, f"{folder}/log"), log.land(landing, SPAN), f"{folder}/c{k}")
        lines = log.file_stream(spark, f"{_root(landing)}/*/{batches.DATA}")
        log.run_available(lines, lambda rows, i: upsert(log.raw_events(rows, "stream"), i), f"{folder}/d{k}")
    return table.read().select(*LANDING.names)


def firehose_messages(spark: SparkSession, d: str) -> DataFrame:
    """The log's documents through the firehose source, out of time order as they stand in the log, into a table of messages."""
    folder = shared_folder(spark, "firehose")
    disk = _disk(folder)
    disk.mkdir(parents=True)
    with open(disk / "feed.jsonl", "w", encoding="utf-8") as f:
        ordered = _raw(spark, d).where("log_partition = 0").select("raw_json", "log_offset").orderBy("log_offset")
        for row in ordered.toLocalIterator():
            f.write(row["raw_json"] + "\n" if _readable(row["raw_json"]) else "")
    firehose.register(spark)
    stream = spark.readStream.format("tidewell_firehose").option("url", f"ws://recorded?file={disk}/feed.jsonl").load()
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/out").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.schema(firehose.SCHEMA).parquet(f"{folder}/out").distinct()


def _readable(text: str) -> bool:
    try:
        return isinstance(json.loads(text), dict)
    except ValueError:
        return False


def smoke(spark: SparkSession, d: str) -> DataFrame:
    """Smoke messages among others that a consumer passes over."""
    other = spark.createDataFrame([("x", "{"), ("y", "[1]"), ("z", None), ("w", "3")], "key string, value string")
    return log.well_formed(log.smoke_messages(spark, 7).unionByName(other))


def _outcome(run) -> str:
    try:
        run()
    except (QualityError, StoreError) as e:
        return type(e).__name__
    return "passes"


def guards(spark: SparkSession, d: str) -> DataFrame:
    """What each guard says of the table's posts, and of the same with one defect."""
    simple = eventlog.first_occurrences(eventlog.simple_events(eventlog.read_events(spark, d)))
    created = windows.created_posts(simple, eventlog.SOURCE)
    twice = created.unionByName(created.where("log_offset % 7 = 0"))
    timeless = created.withColumn("event_time", F.when(F.col("log_offset") % 7 != 0, F.col("event_time")))
    found, n = windows.post_windows(simple, eventlog.SOURCE), created.count()
    cases = {
        "posts are valid": partial(windows.require_valid, created),
        "posts repeat": partial(windows.require_valid, twice),
        "posts without a time": partial(windows.require_valid, timeless),
        "source is empty": partial(checks.guard_empty, 0, found.count()),
        "windows account for all posts": partial(checks.require_reconciled, found, n, eventlog.SOURCE),
        "windows lack a post": partial(checks.require_reconciled, found, n + 1, eventlog.SOURCE),
        "table name": partial(ddl.identifier, "main.raw_events"),
        "table name with a quote": partial(ddl.identifier, "raw'events"),
        "table that isn't allowed": partial(ddl.identifier, "other", {"raw_events"}),
    }
    return spark.createDataFrame([(k, _outcome(run)) for k, run in cases.items()], "guard string, outcome string")


def catalog_tables(spark: SparkSession, d: str) -> DataFrame:
    """The catalog's tables as their statements made them, by column; an insert-only merge given twice left one of each row."""
    name = f"tidewell_q{shared_folder(spark, 'q').rsplit('/', 1)[1][:12]}"
    rows = []
    try:
        for table in ddl.create_all(spark, name):
            for place, c in enumerate(spark.table(table).schema.fields):
                rows.append((table.split(".")[1], place, c.name, c.dataType.simpleString()))
        raw = _raw(spark, d).select(*spark.table(f"{name}.raw_events").columns)
        for _ in range(2):
            ddl.insert_new(spark, f"{name}.raw_events", raw, jobs.LOG_KEY, {f"{name}.raw_events"})
        rows.append(("raw_events", -1, "rows", str(spark.table(f"{name}.raw_events").count())))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    return spark.createDataFrame(rows, "table_name string, place int, column_name string, kind string")


def queries() -> dict:
    return {
        "landed_batches": committed,
        "landed_manifests": manifests,
        "landed_problems": problems,
        "ingested_events": ingested_events,
        "ingested_batches": ingested_batches,
        "pending_batches": pending,
        "pending_batches_fair": partial(pending, fair=True),
        "published_batches": published,
        "streamed_events": streamed,
        "table_history": history,
        "table_detail": detail,
        "parsed_posts": lambda s, d: posts.posts(_raw(s, d)),
        "log_messages": lambda s, d: posts.messages(_raw(s, d)),
        "firehose_messages": firehose_messages,
        "smoke_messages": smoke,
        "quality_guards": guards,
        "catalog_tables": catalog_tables,
    }


# The same in SQL, over the log that ``registry`` defines there.

_BATCHES = f"""
SELECT 'events_p' || lpad(CAST(log_partition AS VARCHAR), 3, '0') || '_o' || lpad(CAST(min(log_offset) AS VARCHAR), 20, '0') || '-' || lpad(CAST(max(log_offset) AS VARCHAR), 20, '0') AS batch_id,
  log_partition, min(log_offset) AS first_offset, max(log_offset) AS last_offset, count(*) AS record_count, min(t) AS min_t, max(t) AS max_t,
  string_agg(CAST(log_offset AS VARCHAR), ',' ORDER BY log_offset) AS offsets,
  string_agg('{{"source":"events","log_topic":"events.v1","log_partition":' || log_partition || ',"log_offset":' || log_offset || ',"log_key":"' || log_key || '","source_time_us":' || t ||
    ',"landed_at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '","raw_json":"' || replace(raw_json, '"', '\\"') || '"}}' || chr(10), '' ORDER BY log_offset) AS body
FROM raw GROUP BY log_partition, log_offset // {SPAN}"""

_LANDING = "source, log_topic, log_partition, log_offset, log_key, t AS source_time_us, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS landed_at, raw_json"
_POST = "defect NOT IN (101, 103) AND op <> 'archive'"


def _values(rows: list[tuple], names: str) -> str:
    said = ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {said}) AS v({names})"


def oracle_sql() -> dict[str, str]:
    """Statements that go on from the registry's common tables."""
    own = lambda columns, rest="": f"SELECT {columns} FROM ({_BATCHES}) AS b {rest}"
    todo = "WHERE first_offset % 2 <> 0"
    fair = f"SELECT batch_id FROM (SELECT batch_id, log_partition, row_number() OVER (PARTITION BY log_partition ORDER BY first_offset) AS turn FROM ({_BATCHES}) AS b {todo}) ORDER BY turn, log_partition LIMIT 20"
    kinds = ["data checksum mismatch", "data size mismatch", "counts must be positive", "unexpected topic", "invalid checksum", "manifest lacks a required field"]
    said = " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(kinds))
    columns = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST({i} AS INTEGER) AS place, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS kind" for t, schema in TABLES.items() for i, f in enumerate(schema.fields)
    )
    outcomes = [("posts are valid", "passes"), ("posts repeat", "QualityError"), ("posts without a time", "QualityError"), ("source is empty", "QualityError"), ("windows account for all posts", "passes")]
    outcomes += [("windows lack a post", "QualityError"), ("table name", "passes"), ("table name with a quote", "StoreError"), ("table that isn''t allowed", "StoreError")]
    return {
        "landed_batches": own("batch_id, log_partition, first_offset, last_offset"),
        "landed_manifests": own(
            "CAST(1 AS INTEGER) AS format_version, batch_id, 'events' AS source, 'ready' AS status, 'events.v1' AS log_topic, log_partition, first_offset, last_offset, last_offset + 1 AS next_offset, record_count, "
            "'events.jsonl' AS data_file, CAST(strlen(body) AS BIGINT) AS size_bytes, sha256(body) AS sha256, sha256(offsets) AS offsets_sha256, min_t AS min_source_time_us, max_t AS max_source_time_us"
        ),
        "landed_problems": own(f"batch_id, CASE last_offset // {SPAN} % 8 {said} END AS problem"),
        "ingested_events": f"SELECT {_LANDING}, b.batch_id FROM raw JOIN (SELECT batch_id, log_partition, first_offset, last_offset FROM ({_BATCHES})) AS b USING (log_partition) WHERE log_offset BETWEEN first_offset AND last_offset".replace("batch_id, b.batch_id", "b.batch_id"),
        "ingested_batches": own("batch_id, record_count, sha256(body) AS events_sha256"),
        "pending_batches": own("batch_id", f"{todo} ORDER BY batch_id LIMIT 20"),
        "pending_batches_fair": fair,
        "published_batches": own("batch_id, true AS archived"),
        "streamed_events": f"SELECT {_LANDING} FROM raw",
        "table_history": "SELECT version, operation, segment_count, row_count FROM (SELECT (SELECT count(*) FROM raw) AS n, (SELECT count(*) FROM raw WHERE log_partition = 0) AS a, (SELECT count(*) FROM raw WHERE log_partition = 1) AS b), "
        "LATERAL (VALUES (CAST(1 AS BIGINT), 'merge', CAST(1 AS INTEGER), a), (2, 'merge', 2, n), (3, 'compact', 1, n), (4, 'replace', 1, b)) AS v(version, operation, segment_count, row_count)",
        "table_detail": "SELECT 'raw_events' AS name, CAST(2 AS BIGINT) AS version, CAST(1 AS BIGINT) AS num_files, true AS size_agrees, true AS location_agrees",
        "parsed_posts": f"SELECT 'u' || user_id AS did, log_key AS uri, op AS operation, CASE WHEN event_id % 127 = 0 THEN t + 1 ELSE t END AS time_us, '2024-01-01T00:00:00Z' AS created_at, "
        f"CASE WHEN defect <> 109 THEN 'EN' END AS language, CASE WHEN defect = 107 THEN '{{\"m\":1}}' ELSE event_type END AS text FROM raw WHERE {_POST}",
        "log_messages": f"SELECT log_key AS key, raw_json AS value FROM raw WHERE {_POST}",
        "firehose_messages": f"SELECT DISTINCT log_key AS key, raw_json AS value, CASE WHEN event_id % 127 = 0 THEN t + 1 ELSE t END AS time_us, op AS operation FROM raw WHERE log_partition = 0 AND {_POST}",
        "smoke_messages": _values([(f"smoke-{i}", f'{{"number":{i},"kind":"smoke"}}') for i in range(7)], "key, value"),
        "quality_guards": _values(outcomes, "guard, outcome"),
        "catalog_tables": f"{columns} UNION ALL SELECT 'raw_events', CAST(-1 AS INTEGER), 'rows', CAST(count(*) AS VARCHAR) FROM raw",
    }
