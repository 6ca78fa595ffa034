"""Landing batches on a file system: written, validated, published and cleaned up.

A batch appears in ``ready`` by one rename, whole or not at all.  Publishing to
a remote place sends the data first and the manifest last, so a manifest there
means the batch is complete.
"""

from __future__ import annotations

import fcntl
import hashlib
import json
import logging
import os
import re
import shutil
import tempfile
import time
from collections.abc import Callable, Iterable
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime
from pathlib import Path
from typing import Protocol

from ..errors import BatchError
from .batches import DATA, MANIFEST_FILE

log = logging.getLogger(__name__)
PARTIAL = ".partial_"
VOLUME = re.compile(r"/Volumes/[a-z0-9_]+/[a-z0-9_]+/[a-z0-9_]+(?:/[A-Za-z0-9_.-]+)*")


def batch_name(source: str, partition: int, first: int, last: int) -> str:
    """Zero-padded, so that names sort as partitions and offsets do."""
    return f"{source}_p{partition:03d}_o{first:020d}-{last:020d}"


def _sha(parts: Iterable[bytes]) -> str:
    digest = hashlib.sha256()
    for p in parts:
        digest.update(p)
    return digest.hexdigest()


def _offsets_sha(offsets: list[int]) -> str:
    return _sha([",".join(map(str, offsets)).encode()])


def _rising(offsets: list[int]) -> bool:
    return all(a < b for a, b in zip(offsets[:-1], offsets[1:], strict=True))


def validate(folder: Path) -> dict:
    """The manifest of a whole and consistent batch; BatchError for any other."""
    manifest = json.loads((folder / MANIFEST_FILE).read_text(encoding="utf-8"))
    body = (folder / DATA).read_bytes()
    try:
        rows = [json.loads(line) for line in body.splitlines()]
        places = {(r["log_topic"], r["log_partition"]) for r in rows}
        offsets = [r["log_offset"] for r in rows]
    except (KeyError, TypeError, json.JSONDecodeError) as e:
        raise BatchError(f"{folder.name}: a record without its log coordinates") from e
    if not offsets or not all(type(o) is int and o >= 0 for o in offsets) or not _rising(offsets):
        raise BatchError(f"{folder.name}: offsets must be whole numbers and rise")
    found = {
        "log coordinates": (places, {(manifest["log_topic"], manifest["log_partition"])}),
        "record_count": (len(rows), manifest["record_count"]),
        "first_offset": (offsets[0], manifest["first_offset"]),
        "last_offset": (offsets[-1], manifest["last_offset"]),
        "size_bytes": (len(body), manifest["size_bytes"]),
        "sha256": (_sha([body]), manifest["sha256"]),
        "offsets_sha256": (_offsets_sha(offsets), manifest["offsets_sha256"]),
    }
    for what, (got, said) in found.items():
        if got != said:
            raise BatchError(f"{folder.name}: {what} mismatch")
    return manifest


class Landing:
    """The folders ``staging``, ``ready`` and ``archived`` under one root."""

    def __init__(self, root: Path, source: str = "events", min_free_mb: int = 0):
        self.root, self.source, self.min_free_mb = Path(root), source, min_free_mb
        self.staging, self.ready, self.archived = (self.root / n for n in ("staging", "ready", "archived"))
        for folder in (self.staging, self.ready, self.archived):
            folder.mkdir(parents=True, exist_ok=True)

    def require_space(self) -> None:
        free = shutil.disk_usage(self.root).free >> 20
        if free < self.min_free_mb:
            raise OSError(f"only {free} MB free, {self.min_free_mb} are reserved")

    def write(self, records: list[dict]) -> tuple[Path, dict]:
        """(folder, manifest) of the batch of one log partition's records, in offset order.

        The same records again give the batch that is there; other records for
        its name are a conflict.
        """
        if not records:
            raise BatchError("an empty batch")
        places = {(r["log_topic"], r["log_partition"]) for r in records}
        offsets = [r["log_offset"] for r in records]
        if len(places) != 1:
            raise BatchError("a batch is of one log partition")
        if not _rising(offsets):
            raise BatchError("offsets must rise")
        self.require_space()
        ((topic, partition),) = places
        target = self.ready / batch_name(self.source, partition, offsets[0], offsets[-1])
        if target.exists():
            there = validate(target)
            if (there["log_topic"], there["record_count"], there["offsets_sha256"]) != (topic, len(records), _offsets_sha(offsets)):
                raise BatchError(f"{target.name} exists with other records")
            return target, there
        stage = Path(tempfile.mkdtemp(prefix=PARTIAL, dir=self.staging))
        try:
            lines = [json.dumps(r, ensure_ascii=False, separators=(",", ":")).encode() + b"\n" for r in records]
            times = [r["source_time_us"] for r in records if type(r.get("source_time_us")) is int]
            manifest = {
                "format_version": 1,
                "batch_id": target.name,
                "source": self.source,
                "status": "ready",
                "created_at": datetime.now(UTC).isoformat(),
                "log_topic": topic,
                "log_partition": partition,
                "first_offset": offsets[0],
                "last_offset": offsets[-1],
                "next_offset": offsets[-1] + 1,
                "record_count": len(records),
                "data_file": DATA,
                "size_bytes": sum(map(len, lines)),
                "sha256": _sha(lines),
                "offsets_sha256": _offsets_sha(offsets),
                "min_source_time_us": min(times, default=None),
                "max_source_time_us": max(times, default=None),
            }
            for name, body in ((DATA, b"".join(lines)), (MANIFEST_FILE, json.dumps(manifest, indent=2).encode())):
                with open(stage / name, "wb") as f:
                    f.write(body)
                    f.flush()
                    os.fsync(f.fileno())
            validate(stage)
            os.rename(stage, target)
        finally:
            shutil.rmtree(stage, ignore_errors=True)
        return target, manifest

    def archive(self, folder: Path) -> Path:
        target = self.archived / folder.name
        if target.exists():
            shutil.rmtree(folder)
        else:
            os.rename(folder, target)
        return target

    def cleanup(self, staging_minutes: float = 60, archive_days: float = 7, apply: bool = False) -> list[Path]:
        """Unfinished staging folders and archived batches beyond their age, removed if ``apply``; never anything ready."""
        now = time.time()
        old = [p for p in self.staging.glob(f"{PARTIAL}*") if now - p.stat().st_mtime > 60 * staging_minutes]
        old += [p for p in self.archived.iterdir() if p.is_dir() and now - p.stat().st_mtime > 86_400 * archive_days]
        for p in old if apply else []:
            shutil.rmtree(p)
        return sorted(old)


class Remote(Protocol):
    """What publishing needs of a remote store."""

    def read(self, path: str) -> bytes | None:
        """The file's bytes, or None if there is none."""

    def write(self, path: str, body: bytes, overwrite: bool) -> None: ...


def remote_folder(path: str) -> str:
    """The path, if it names a volume folder without detours."""
    if not VOLUME.fullmatch(path) or ".." in path.split("/"):
        raise BatchError(f"no volume path: {path}")
    return path


def publish(batch: Path, remote: Remote, folder: str) -> bool:
    """Sends a validated batch, data first, manifest last; False if it was complete there already.

    What is there is verified before and after, so a lost acknowledgement is
    made good by another try, and damage at either end raises BatchError.
    """
    manifest = validate(batch)
    data, described = (batch / DATA).read_bytes(), (batch / MANIFEST_FILE).read_bytes()
    at = f"{folder}/{batch.name}"

    def matches(name: str, body: bytes) -> bool:
        there = remote.read(f"{at}/{name}")
        return there is not None and _sha([there]) == _sha([body])

    if remote.read(f"{at}/{MANIFEST_FILE}") is not None:
        if not matches(MANIFEST_FILE, described) or not matches(DATA, data):
            raise BatchError(f"{manifest['batch_id']} is damaged at its destination")
        return False
    remote.write(f"{at}/{DATA}", data, True)
    if not matches(DATA, data):
        raise BatchError(f"{manifest['batch_id']}: data arrived damaged")
    remote.write(f"{at}/{MANIFEST_FILE}", described, False)
    if not matches(MANIFEST_FILE, described) or not matches(DATA, data):
        raise BatchError(f"{manifest['batch_id']} arrived damaged")
    return True


class PermissionFailure(Exception):
    """The remote store refuses us; trying again won't help."""


@dataclass
class Publisher:
    """Publishes ready batches in order, a few a cycle, waiting longer after each failure of a batch."""

    landing: Landing
    remote: Remote
    folder: str
    per_cycle: int = 5
    dry_run: bool = False
    clock: Callable[[], float] = time.monotonic
    failures: dict[str, tuple[int, float]] = field(default_factory=dict)

    @staticmethod
    def wait(failed: int) -> float:
        """Seconds after that many failures in a row."""
        return min(300, 5 * 2 ** min(failed - 1, 6))

    def cycle(self) -> list[str]:
        """Names of the batches that are now complete at the destination, archived here."""
        done: list[str] = []
        tried = 0
        for batch in sorted(p for p in self.landing.ready.iterdir() if p.is_dir()):
            failed, due = self.failures.get(batch.name, (0, 0.0))
            if tried >= self.per_cycle:
                break
            if self.clock() < due:
                continue
            tried += 1
            try:
                if self.dry_run:
                    validate(batch)
                    continue
                publish(batch, self.remote, self.folder)
                self.landing.archive(batch)
            except PermissionFailure:
                raise
            except (BatchError, OSError) as e:
                self.failures[batch.name] = (failed + 1, self.clock() + self.wait(failed + 1))
                log.warning("batch %s failed %s times: %s", batch.name, failed + 1, e)
                continue
            self.failures.pop(batch.name, None)
            done.append(batch.name)
        return done


@contextmanager
def single_writer(path: Path):
    """Holds an exclusive lock, or raises BlockingIOError if another process does."""
    with open(path, "a") as f:
        fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        try:
            yield
        finally:
            fcntl.flock(f, fcntl.LOCK_UN)
