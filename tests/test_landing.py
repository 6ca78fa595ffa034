import json
import os
import time

import pytest

from tidewell.errors import BatchError
from tidewell.sources.landing import Landing, PermissionFailure, Publisher, publish, remote_folder, single_writer, validate


def record(offset, partition=0, **more):
    return {"source": "events", "log_topic": "t", "log_partition": partition, "log_offset": offset, "log_key": "k", "source_time_us": 10 + offset, "landed_at": "now", "raw_json": '{"é":1}', **more}


class Memory:
    def __init__(self):
        self.files, self.order, self.fail = {}, [], None

    def read(self, path):
        return self.files.get(path)

    def write(self, path, body, overwrite):
        if self.fail:
            raise self.fail
        assert overwrite or path not in self.files
        self.files[path] = body
        self.order.append(path.rsplit("/", 1)[1])


@pytest.fixture
def landing(tmp_path):
    return Landing(tmp_path)


def test_writes_a_valid_batch(landing):
    folder, manifest = landing.write([record(3), record(7)])
    assert folder.name == "events_p000_o" + "3".zfill(20) + "-" + "7".zfill(20)
    assert validate(folder) == manifest and manifest["next_offset"] == 8 and manifest["min_source_time_us"] == 13
    assert not list(landing.staging.iterdir())


def test_replay_reuses_and_conflict_fails(landing):
    folder, manifest = landing.write([record(1), record(5)])
    assert landing.write([record(1), record(5)]) == (folder, manifest)
    with pytest.raises(BatchError):
        landing.write([record(1), record(2), record(5)])


@pytest.mark.parametrize("rows", [[], [record(1), record(1)], [record(2), record(1)], [record(1), record(2, partition=1)]])
def test_refuses_bad_batches(landing, rows):
    with pytest.raises(BatchError):
        landing.write(rows)
    assert not list(landing.ready.iterdir())


def test_detects_damage(landing):
    folder, _ = landing.write([record(1)])
    path = folder / "events.jsonl"
    path.write_bytes(path.read_bytes().replace(b"now", b"nov"))
    with pytest.raises(BatchError, match="sha256"):
        validate(folder)


def test_source_times_may_be_missing(landing):
    assert landing.write([record(1, source_time_us=None)])[1]["min_source_time_us"] is None


def test_disk_reserve(tmp_path):
    with pytest.raises(OSError, match="reserved"):
        Landing(tmp_path, min_free_mb=1 << 40).write([record(1)])


def test_cleanup_spares_ready(landing):
    folder, _ = landing.write([record(1)])
    other, _ = landing.write([record(2)])
    archived = landing.archive(other)
    partial = landing.staging / ".partial_x"
    partial.mkdir()
    old = time.time() - 30 * 86_400
    for p in (folder, archived, partial):
        os.utime(p, (old, old))
    assert landing.cleanup() == sorted([archived, partial]) and archived.exists()
    landing.cleanup(apply=True)
    assert folder.exists() and not archived.exists() and not partial.exists()


def test_publishes_data_first_and_verifies(landing):
    folder, _ = landing.write([record(1)])
    remote = Memory()
    assert publish(folder, remote, "/v") and remote.order == ["events.jsonl", "manifest.json"]
    assert not publish(folder, remote, "/v") and len(remote.order) == 2


def test_lost_acknowledgement_is_made_good(landing):
    folder, _ = landing.write([record(1)])
    remote = Memory()
    remote.write("/v/" + folder.name + "/events.jsonl", b"half", True)
    assert publish(folder, remote, "/v")


def test_damage_at_either_end(landing):
    folder, _ = landing.write([record(1)])
    remote = Memory()
    publish(folder, remote, "/v")
    remote.files[f"/v/{folder.name}/events.jsonl"] = b"x"
    with pytest.raises(BatchError, match="damaged"):
        publish(folder, remote, "/v")
    (folder / "events.jsonl").write_bytes(b"{}\n")
    with pytest.raises(BatchError):
        publish(folder, Memory(), "/v")


def test_publisher_waits_longer_after_failures(landing):
    landing.write([record(1)])
    landing.write([record(2)])
    now, remote = [0.0], Memory()
    p = Publisher(landing, remote, "/v", per_cycle=1, clock=lambda: now[0])
    remote.fail = OSError("down")
    assert p.cycle() == []
    remote.fail = None
    assert [n[-1] for n in p.cycle()] == ["2"]  # the first batch waits
    now[0] = 6
    assert [n[-1] for n in p.cycle()] == ["1"] and not list(landing.ready.iterdir()) and len(list(landing.archived.iterdir())) == 2
    assert [Publisher.wait(n) for n in (1, 2, 7, 99)] == [5, 10, 300, 300]


def test_refusal_is_final_and_dry_run_writes_nothing(landing):
    landing.write([record(1)])
    remote = Memory()
    assert Publisher(landing, remote, "/v", dry_run=True).cycle() == [] and not remote.files
    remote.fail = PermissionFailure()
    with pytest.raises(PermissionFailure):
        Publisher(landing, remote, "/v").cycle()


def test_single_writer_and_paths(tmp_path):
    with single_writer(tmp_path / "lock"), pytest.raises(BlockingIOError), single_writer(tmp_path / "lock"):
        pass
    assert remote_folder("/Volumes/a/b/c/d") == "/Volumes/a/b/c/d"
    for bad in ("/tmp/x", "/Volumes/a/b/c/../d", "/Volumes/a/b"):
        with pytest.raises(BatchError):
            remote_folder(bad)


def test_manifest_keys(landing):
    folder, _ = landing.write([record(1)])
    assert len(json.loads((folder / "manifest.json").read_text())) == 17
