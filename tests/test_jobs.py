import json
from datetime import datetime, timedelta

import pytest

from tidewell.errors import BatchError, QualityError, StoreError
from tidewell.functions.contract import Contract
from tidewell.plans import catalog, jobs
from tidewell.plans.store import Store
from tidewell.schemas import CANONICAL
from tidewell.sources import batches
from tidewell.sources.landing import Landing
from tests.test_contract import T0, changed, document


def landed(offset, doc, partition=0, time=T0):
    raw = doc if isinstance(doc, str) else json.dumps(doc)
    return {"source": "events", "log_topic": "events.v1", "log_partition": partition, "log_offset": offset, "log_key": "k", "source_time_us": time, "landed_at": "now", "raw_json": raw}


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/tables")


@pytest.fixture
def landing(tmp_path):
    return Landing(tmp_path / "landing")


def ready(landing):
    return f"file://{landing.ready}"


def seven(landing):
    """Two alike, then one each without time, unreadable, of another kind, with an added field, with a changed type."""
    docs = [document(), document(), changed("time_us"), "{", changed("kind", "identity"), changed("commit.rev", "r9") | {"extra": 1}, document(text={"x": 1})]
    landing.write([landed(i, d) for i, d in enumerate(docs[:4])])
    landing.write([landed(i, d) for i, d in enumerate(docs[4:], 4)])


def sizes(store, *names):
    return [store[n].read().count() for n in names]


PRODUCTS = ["canonical_events", "quarantine", "duplicate_occurrences", "schema_observations"]


def test_from_batches_to_reconciled_products(store, landing):
    seven(landing)
    assert jobs.ingest(store, ready(landing)) == 2
    assert jobs.ingest(store, ready(landing)) == 0
    assert sizes(store, "raw_events", "ingested_batches") == [7, 2]
    jobs.validate_contract(store)
    assert sizes(store, *PRODUCTS)[:3] == [2, 4, 1]
    before = [store[n].version for n in PRODUCTS], [sorted(map(str, store[n].read().collect())) for n in PRODUCTS]
    jobs.validate_contract(store)  # a replay changes nothing
    assert before == ([store[n].version for n in PRODUCTS], [sorted(map(str, store[n].read().collect())) for n in PRODUCTS])
    assert jobs.misplaced(store).count() == 0
    assert catalog.layer_counts(store["raw_events"].read(), store["canonical_events"].read(), store["quarantine"].read(), "events").first().asDict() == {"raw_events": 7, "canonical_events": 2, "rejected_events": 4}
    jobs.normalize_native(store)
    jobs.normalize_native(store)
    assert sum(sizes(store, "canonical_native", "rejected_native")) == 7


def test_a_stop_between_events_and_log_is_replayed(store, landing, spark, monkeypatch):
    seven(landing)
    monkeypatch.setattr("tidewell.plans.store.Table.insert_new", _stop_at(store, "ingested_batches"))
    with pytest.raises(RuntimeError):
        jobs.ingest(store, ready(landing))
    monkeypatch.undo()
    assert sizes(store, "raw_events", "ingested_batches") == [7, 0]
    assert jobs.ingest(store, ready(landing)) == 2
    assert sizes(store, "raw_events", "ingested_batches") == [7, 2]


def _stop_at(store, name):
    from tidewell.plans.store import Table

    real = Table.insert_new

    def insert(self, rows, key):
        if self.name == name:
            raise RuntimeError("stopped")
        return real(self, rows, key)

    return insert


def test_damaged_and_unfinished_batches(store, landing, spark):
    a, _ = landing.write([landed(0, document())])
    b, _ = landing.write([landed(5, document())])
    (b / "manifest.json").rename(b / "manifest.later")
    assert [r.batch_id for r in batches.committed(spark, ready(landing)).collect()] == [a.name]
    (b / "manifest.later").rename(b / "manifest.json")
    data = b / "events.jsonl"
    good = data.read_bytes()
    for body, problem in ((good.replace(b"now", b"nov"), "checksum"), (good + b" ", "size")):
        data.write_bytes(body)
        with pytest.raises(BatchError, match=problem):
            jobs.ingest(store, ready(landing))
    assert sizes(store, "raw_events") == [0]
    data.unlink()
    with pytest.raises(BatchError, match="without data"):
        jobs.ingest(store, ready(landing))


@pytest.mark.parametrize(
    ("change", "problem"),
    [
        ({"batch_id": "x"}, "batch id"),
        ({"log_topic": "x"}, "topic"),
        ({"log_partition": 1}, "partition"),
        ({"log_partition": True}, "required"),
        ({"record_count": "1"}, "required"),
        ({"record_count": 0}, "positive"),
        ({"record_count": 2}, "record count"),
        ({"size_bytes": 1 << 30}, "size limit"),
        ({"sha256": "zz"}, "checksum"),
        ({"sha256": None}, "required"),
        ({"pad": "x" * (64 << 10)}, "size limit"),
    ],
)
def test_manifest_rules(store, landing, change, problem):
    folder, manifest = landing.write([landed(0, document())])
    (folder / "manifest.json").write_text(json.dumps(manifest | change))
    with pytest.raises(BatchError, match=problem):
        jobs.ingest(store, ready(landing))


def test_work_list_is_bounded_and_can_be_fair(store, landing, spark):
    for p in (0, 1):
        for o in (0, 1, 2):
            landing.write([landed(o, document(), p)])
    todo = batches.committed(spark, ready(landing))
    log = store["ingested_batches"].read()
    assert [r.log_partition for r in batches.pending(todo, log, 3).collect()] == [0, 0, 0]
    assert [r.log_partition for r in batches.pending(todo, log, 4, fair=True).collect()] == [0, 1, 0, 1]
    assert jobs.ingest(store, ready(landing), limit=4) == 4 and jobs.ingest(store, ready(landing)) == 2


def test_rebuild_lets_the_first_occurrence_win(store, landing):
    landing.write([landed(5, document())])
    jobs.ingest(store, ready(landing))
    jobs.validate_contract(store)
    landing.write([landed(1, document())])
    jobs.ingest(store, ready(landing))
    jobs.validate_contract(store)  # inserts alone: the late winner is nowhere, the old one in two tables
    assert jobs.misplaced(store).count() == 2
    jobs.validate_contract(store, Contract(), rebuild=True)
    assert jobs.misplaced(store).count() == 0
    assert store["canonical_events"].read().first().log_offset == 1


def event(offset, minute, ingested, id_=None, source="events"):
    day = datetime(2024, 5, 1, 10)
    base = dict.fromkeys(CANONICAL.names)
    at = lambda m: day + timedelta(minutes=m)
    row = base | {"event_id": id_ or f"e{offset}", "source": source, "event_type": "content_created", "entity_type": "post", "event_time": at(minute), "ingested_at": at(ingested), "log_topic": "t", "log_partition": 0, "log_offset": offset}
    return tuple(row[c] for c in CANONICAL.names)


def test_windows_are_corrected_by_late_events(store, spark):
    table = store["canonical_events"]
    table.append(spark.createDataFrame([event(1, 1, 2), event(2, 8, 8)], CANONICAL))
    assert jobs.refresh_windows(store).windows == 2
    window = lambda: {r.window_start.minute: r for r in store["post_windows"].read().collect()}
    first = window()
    jobs.refresh_windows(store)
    assert window() == first  # nothing differs, so no timestamp does
    table.append(spark.createDataFrame([event(3, 1, 8)], CANONICAL))
    assert jobs.refresh_windows(store).posts == 3
    now = window()
    assert (now[0].post_count, now[0].late_post_count, now[0].out_of_order_post_count) == (2, 1, 1)
    assert now[5] == first[5] and now[0].aggregate_updated_at > first[0].aggregate_updated_at


def test_window_preconditions(store, spark):
    table = store["canonical_events"]
    table.append(spark.createDataFrame([event(1, 1, 2), event(2, 8, 8, "e1")], CANONICAL))
    with pytest.raises(QualityError, match="repeats"):
        jobs.refresh_windows(store)
    table.replace(spark.createDataFrame([event(1, 1, 2)], CANONICAL))
    jobs.refresh_windows(store)
    table.replace(spark.createDataFrame([], CANONICAL))
    with pytest.raises(QualityError, match="refusing"):
        jobs.refresh_windows(store)


def test_store_versions_history_and_conflicts(store, spark):
    table = store["ingested_batches"]
    row = lambda i: spark.createDataFrame([(f"b{i}", "p", "s", i)], "batch_id string, landing_path string, events_sha256 string, record_count long").selectExpr("*", "cast(null as timestamp_ntz) processed_at")
    assert table.version == 0 and table.read().count() == 0 and table.history().count() == 0
    assert table.append(row(1)) == 1
    assert table.insert_new(row(1).unionByName(row(2)), ["batch_id"]) == 2 and table.insert_new(row(2), ["batch_id"]) == 2
    assert table.read().count() == 2 and table.read(1).count() == 1
    with pytest.raises(QualityError):
        table.insert_new(row(3).unionByName(row(3)), ["batch_id"])
    base = table.version
    table.append(row(4))
    with pytest.raises(StoreError):  # a writer that began from an older version
        table._publish(row(5), "append", [], base)
    assert table.compact() == 4 and table.read().count() == 3
    assert [r.operation for r in table.history().collect()] == ["compact", "append", "merge", "append"]
    detail = table.detail().first()
    assert detail.num_files == 1 and detail.size_bytes > 0 and detail.version == 4
    store.drop("ingested_batches")
    store.drop("ingested_batches")
    assert table.read().count() == 0
    with pytest.raises(StoreError):
        store["no such"]


def test_merges_look_only_into_segments_that_can_hold_a_key(store, spark):
    table = store["raw_events"]
    key = ["log_topic", "log_partition", "log_offset"]
    rows = lambda p, a, b: spark.range(a, b).selectExpr("'t' log_topic", f"{p} log_partition", "id log_offset")
    full = lambda df: df.selectExpr(*[f"cast({f.name if f.name in df.columns else 'null'} as {f.dataType.simpleString()}) {f.name}" for f in table.schema.fields])
    for p, a, b in ((0, 0, 10), (0, 10, 20), (1, 0, 10)):
        table.insert_new(full(rows(p, a, b)), key)
    state = table._state(table.version)
    seen = lambda p, a, b: [state["segments"].index(s) for s in table._overlapping(state, rows(p, a, b), key)]
    assert seen(0, 5, 8) == [0] and seen(0, 8, 12) == [0, 1] and seen(1, 3, 4) == [2] and seen(0, 30, 40) == [] and seen(0, 5, 5) == [0, 1, 2]
    assert table.insert_new(full(rows(0, 5, 25)), key) == 4 and table.read().count() == 35
    assert table.insert_new(full(rows(0, 0, 25)), key) == 4
    table.compact()
    assert list(table._state(table.version)["ranges"].values())[0]["log_offset"] == [0, 24]


def test_many_segments_are_written_as_few(store, spark, monkeypatch):
    from tidewell.plans import store as module

    monkeypatch.setattr(module, "MOST_SEGMENTS", 6)
    table = store["rejected_native"]
    row = lambda i: spark.range(i, i + 1).selectExpr("concat('e', id) event_id", "'events' source", "'t' log_topic", "0 log_partition", "id log_offset", "'r' rejection_reason", "'{' raw_json", "CAST(NULL AS TIMESTAMP_NTZ) rejected_at")
    for i in range(15):
        table.insert_new(row(i), ["event_id"])
        assert len(table._segments(table.version)) <= 6
    assert sorted(r.log_offset for r in table.read().collect()) == list(range(15)) and table.read(1).count() == 1
    assert [r.operation for r in table.history().collect()].count("compact") >= 2
    before = table.version
    assert table.insert_new(row(3), ["event_id"]) == before and not table.files.names(f"{table.home}/_aside")


def test_a_merge_computes_its_rows_once(store, spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(20).selectExpr("concat('e', id) event_id", "'events' source", "'t' log_topic", "0 log_partition", "id log_offset", "'r' rejection_reason", "'{' raw_json", "CAST(NULL AS TIMESTAMP_NTZ) rejected_at")
    store["rejected_native"].insert_new(rows.mapInArrow(look, rows.schema), ["event_id"])
    assert seen.value == 20
