import json
import time
from datetime import datetime

from tidewell.plans.store import Store
from tidewell.sources.landing import Landing, validate
from tidewell.streaming import firehose, log, watermark
from tests.test_contract import T0, changed, document


def test_watermark_in_four_stages(spark, tmp_path):
    source, target, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "checkpoint"))
    schema = "event_id string, event_time timestamp"

    def add(*rows):
        spark.createDataFrame([(i, datetime(2024, 5, 1, 10, m)) for i, m in rows], schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        query = watermark.append_available(watermark.windowed_counts(stream), target, checkpoint)
        dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
        found = spark.read.schema("window_start timestamp, window_end timestamp, post_count long").parquet(target)
        return {r.window_start.minute: r.post_count for r in found.collect()}, dropped

    assert add(("e1", 1), ("e2", 8)) == ({}, 0)
    assert add(("e3", 1)) == ({}, 0)  # late, but within ten minutes
    assert add(("e4", 20)) == ({0: 2, 5: 1}, 0)
    assert add(("e5", 2)) == ({0: 2, 5: 1}, 1)  # the window has closed


def landed(offset, partition):
    return {"source": "events", "log_topic": "t", "log_partition": partition, "log_offset": offset, "log_key": "k", "source_time_us": 5, "landed_at": "now", "raw_json": "{}"}


def test_stream_lands_batches_and_upserts(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    rows = [landed(o, p) for p in (0, 1) for o in range(5)]
    (folder / "a.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
    landing = Landing(tmp_path / "landing")
    log.run_available(log.file_stream(spark, str(folder)), log.land(landing, 3), f"{tmp_path}/c1")
    found = [validate(p) for p in sorted(landing.ready.iterdir())]
    assert [(m["log_partition"], m["first_offset"], m["record_count"]) for m in found] == [(0, 0, 3), (0, 3, 2), (1, 0, 3), (1, 3, 2)]
    table = Store(spark, f"{tmp_path}/tables")["raw_events"]
    sink = log.upsert_into(table, ["log_topic", "log_partition", "log_offset"])
    for k in range(2):  # a lost checkpoint replays everything
        log.run_available(log.file_stream(spark, str(folder), per_trigger=1), lambda df, i: sink(log.raw_events(df, "stream"), i), f"{tmp_path}/c2{k}")
    assert table.read().count() == 10


def test_log_records_and_options(spark):
    df = spark.createDataFrame([("k", json.dumps(document()).encode(), "t", 2, 9)], "key string, value binary, topic string, partition int, offset long")
    row = log.landing_records(df).first()
    assert (row.log_topic, row.log_partition, row.log_offset, row.log_key, row.source_time_us) == ("t", 2, 9, "k", T0)
    assert log.kafka_options("h:1", "t", per_trigger=5)["maxOffsetsPerTrigger"] == "5"


def docs(path, times):
    with open(path, "a") as f:
        for t in times:
            f.write(json.dumps(document() | {"time_us": t}) + "\n")


def test_firehose_reader(tmp_path):
    path = tmp_path / "feed.jsonl"
    docs(path, [10, 20])
    path.open("a").write(json.dumps(changed("did", "")) + "\n")
    reader = firehose.FirehoseReader({"url": f"ws://local?file={path}"})
    rows, at = reader.read(reader.initialOffset())
    assert [r[2] for r in rows] == [10, 20] and at == {"time_us": 20, "events": 2} and reader.bad == 1
    docs(path, [15])  # an old event is handed on and doesn't take the position back
    rows, later = reader.read(at)
    assert [r[2] for r in rows] == [15] and later == {"time_us": 20, "events": 3}
    with path.open("a") as f:  # another event of a time that was seen
        f.write(json.dumps(document(text="other") | {"time_us": 20}) + "\n")
    docs(path, [30])
    rows, last = reader.read(later)
    assert [r[2] for r in rows] == [20, 30] and last == {"time_us": 30, "events": 5}
    assert list(reader.read(last)[0]) == [] and reader.read(last)[1] == last
    assert {r[2] for r in reader.readBetweenOffsets(later, last)} >= {20, 30}
    again = firehose.FirehoseReader({"url": f"ws://local?file={path}"})
    assert len(list(again.read(last)[0])) == 5  # the overlap once more after a restart
    assert [firehose.backoff(n, lambda: 0) for n in (0, 1, 5, 6, 9)] == [1, 2, 32, 60, 60]


def test_firehose_passes_no_event_over_where_batches_are_cut(tmp_path):
    path = tmp_path / "feed.jsonl"
    times = [5, 9, 9, 9, 3, 9, 12, 1, 12]
    with path.open("w") as f:
        for i, t in enumerate(times):
            f.write(json.dumps(document(text=f"t{i}") | {"time_us": t}) + "\n")
    reader, seen, at = firehose.FirehoseReader({"url": f"ws://local?file={path}", "maxEvents": "2"}), [], {"time_us": 0, "events": 0}
    for _ in range(6):
        rows, at = reader.read(at)
        seen += [r[2] for r in rows]
    assert sorted(seen) == sorted(times) and at == {"time_us": 12, "events": 9}


class Server:
    """A WebSocket server that plays scripts, one for each connection: bytes to send, then the end."""

    def __init__(self, *scripts):
        import socket
        import threading

        self.listening, self.asked, self.got = socket.create_server(("127.0.0.1", 0)), [], []
        self.url = f"ws://127.0.0.1:{self.listening.getsockname()[1]}/subscribe"
        threading.Thread(target=self._serve, args=(scripts,), daemon=True).start()

    def _serve(self, scripts):
        import base64
        import hashlib

        for script in scripts:
            peer, _ = self.listening.accept()
            head = b""
            while b"\r\n\r\n" not in head:
                head += peer.recv(4096)
            self.asked.append(head.split(b" ")[1].decode())
            key = next(x.split(b": ")[1] for x in head.split(b"\r\n") if x.lower().startswith(b"sec-websocket-key"))
            accept = base64.b64encode(hashlib.sha1(key + b"258EAFA5-E914-47DA-95CA-C5AB0DC85B11").digest())
            peer.sendall(b"HTTP/1.1 101 Switching Protocols\r\nUpgrade: websocket\r\nConnection: Upgrade\r\nSec-WebSocket-Accept: " + accept + b"\r\n\r\n" + script)
            if script.startswith(b"\x89"):
                self.got.append(peer.recv(64))
            peer.close()
        self.listening.close()


def frame(body, kind=1, last=True):
    head = bytes([(0x80 if last else 0) | kind])
    size = bytes([len(body)]) if len(body) < 126 else b"\x7e" + len(body).to_bytes(2, "big")
    return head + size + body


def test_live_firehose_connects_again_and_passes_no_event_over(monkeypatch):
    event = lambda t, text="x": json.dumps(document(text=text) | {"time_us": t}).encode()
    long = event(3_000_000_000, "y" * 300)
    server = Server(
        frame(b"hi", 9) + frame(event(9_000_000_000)) + frame(b"not json") + frame(long[:100], 1, False) + frame(long[100:], 0),
        frame(event(9_000_000_000)) + frame(event(9_000_000_000, "same time")) + frame(b"", 8),
        frame(event(8_999_999_999, "late")) + frame(event(9_500_000_000)),
    )
    pauses = []
    monkeypatch.setattr(firehose.FirehoseReader, "connect", staticmethod(lambda url, at, seconds: firehose.connected(url, at, most_seconds=20, most_failures=0 if len(server.asked) == 3 else 8, sleep=pauses.append)))
    reader = firehose.FirehoseReader({"url": server.url, "maxEvents": "5"})
    rows, at = reader.read({"time_us": 9_000_000_000, "events": 0})
    assert [r[2] for r in rows] == [9_000_000_000, 3_000_000_000, 9_000_000_000, 8_999_999_999, 9_500_000_000]
    assert at == {"time_us": 9_500_000_000, "events": 5} and len(pauses) == 2 and 1 <= pauses[0] <= 1.5
    assert server.asked[0] == "/subscribe?wantedCollections=post&cursor=8995000000"
    assert server.got[0][:2] == b"\x8a\x82"  # a masked pong of two bytes


def test_firehose_gives_up_after_many_failures():
    import socket

    import pytest

    with socket.create_server(("127.0.0.1", 0)) as closed:
        url = f"ws://127.0.0.1:{closed.getsockname()[1]}/"
    with pytest.raises(OSError):
        list(firehose.connected(url, None, most_failures=2, sleep=lambda s: None))


def test_firehose_as_a_stream(spark, tmp_path):
    path = tmp_path / "feed.jsonl"
    docs(path, [10, 20, 30])
    firehose.register(spark)
    seen = []
    stream = spark.readStream.format("tidewell_firehose").option("url", f"ws://local?file={path}").load()
    query = stream.writeStream.foreachBatch(lambda df, _: seen.extend(r.time_us for r in df.collect())).option("checkpointLocation", f"{tmp_path}/c").start()
    try:
        for _ in range(60):
            query.awaitTermination(0.5)
            if len(seen) >= 3:
                break
    finally:
        query.stop()
    assert seen == [10, 20, 30]


def numbered(path, times):
    """Adds events of these times, told apart by their texts, and says their values."""
    old = path.read_text().count("\n") if path.exists() else 0
    with path.open("a") as f:
        for i, t in enumerate(times, old):
            f.write(json.dumps(document(text=f"t{i}") | {"time_us": t}) + "\n")
    return list(range(old, old + len(times)))


def texts(rows):
    return [int(json.loads(r[1])["commit"]["record"]["text"][1:]) for r in rows]


def test_recorded_events_older_than_the_overlap_come_after_a_cut_at_the_end_and_after_a_restart(tmp_path):
    path, s = tmp_path / "feed.jsonl", 1_000_000
    numbered(path, [100 * s, 300 * s, 20 * s, 301 * s, 302 * s, 50 * s])
    options = {"url": f"ws://local?file={path}", "maxEvents": "2"}
    reader, at, seen, cuts = firehose.FirehoseReader(options), {"time_us": 0, "events": 0}, [], []
    for _ in range(4):
        rows, end = reader.read(at)
        seen += texts(rows)
        cuts.append((at, end))
        at = end
    assert seen == [0, 1, 2, 3, 4, 5] and at == {"time_us": 302 * s, "events": 6}
    assert [texts(firehose.FirehoseReader(options).readBetweenOffsets(*c)) for c in cuts] == [[0, 1], [2, 3], [4, 5], []]
    numbered(path, [30 * s])  # long past, and appended after the end was seen
    assert texts(reader.read(at)[0]) == [6]
    for start, own, rest in ((cuts[0][1], [1, 2], [3, 4, 5, 6]), (cuts[1][1], [1, 3], [4, 5, 6]), (at, [1, 3], [4, 6])):
        again, seen = firehose.FirehoseReader(options), []
        rows, end = again.read(start)
        assert texts(rows) == own and end != start
        for _ in range(3):  # the overlap once more, and all that wasn't read
            rows, end = again.read(end)
            seen += texts(rows)
        assert seen == rest and again.read(end)[1] == end
        numbered_again = firehose.FirehoseReader(options)  # a second restart, where repeats were handed on between
        assert texts(numbered_again.read(end)[0]) == [1, 3]


def test_recorded_repeats_and_a_line_that_is_being_written(tmp_path):
    path = tmp_path / "feed.jsonl"
    numbered(path, [9_000_000, 9_000_001])
    lines = path.read_text().splitlines()
    path.write_text("\n".join([lines[0], lines[0], lines[1][:-5]]))
    reader = firehose.FirehoseReader({"url": f"ws://local?file={path}"})
    rows, at = reader.read(reader.initialOffset())
    assert texts(rows) == [0]
    with path.open("a") as f:
        f.write(lines[1][-5:])
    rows, end = reader.read(at)
    assert texts(rows) == [1] and texts(firehose.FirehoseReader({"url": f"ws://local?file={path}"}).readBetweenOffsets(at, end)) == [1]
    with path.open("a") as f:
        f.write("\n" + lines[0].replace("9000000", "1") + "\n")
    assert texts(reader.read(end)[0]) == [0]


def test_live_firehose_goes_on_with_its_connection_after_a_full_batch():
    event = lambda t: frame(json.dumps(document(text="t0") | {"time_us": t}).encode())
    times = [9_000_000_000, 9_000_000_001, 3_000_000_000, 2_000_000_000]
    server = Server(b"".join(map(event, times)))
    reader = firehose.FirehoseReader({"url": server.url, "maxEvents": "2", "connectionSeconds": "0.5"})
    rows, at = reader.read({"time_us": 0, "events": 0})
    time.sleep(0.7)  # what the batch takes isn't the connection's
    more, at = reader.read(at)
    assert [r[2] for r in [*rows, *more]] == times and at == {"time_us": 9_000_000_001, "events": 4} and len(server.asked) == 1


def test_firehose_options_as_spark_gives_them():
    from pyspark.sql.datasource import CaseInsensitiveDict

    options = CaseInsensitiveDict({"url": "ws://local", "maxEvents": "7", "overlapSeconds": "2", "connectionSeconds": "3", "Collection": "like"})
    reader = firehose.Firehose(options).simpleStreamReader(None)
    assert (reader.most, reader.overlap, reader.seconds, reader.collection) == (7, 2, 3.0, "like")


def test_firehose_messages_lose_nothing_between_batches(spark, tmp_path):
    import __spark_entry__ as entry
    from tests.oracle import assert_same

    # 36,000 events of one log partition, times in disorder: more than one batch of the source, each event long past in some later batch.
    spark.range(36_000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, pmod(id * 7919, 36000)) AS ts", "id % 500 * 3 AS user_id",
        "element_at(array('view', 'click', 'purchase', 'signup', 'error'), CAST(id % 5 AS INT) + 1) AS event_type", "0.0D AS value", "'{\"k\": 1}' AS props",
    ).write.parquet(f"{tmp_path}/events.parquet")
    assert_same(entry.queries()["firehose_messages"], entry.oracle_sql()["firehose_messages"], spark, str(tmp_path))
