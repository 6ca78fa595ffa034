"""The strict event contract, as plain Python over one raw event.

A verdict has a rejection reason or canonical values; the structure seen and
its unknown fields are reported for every readable object, rejected or not.
Rules are a table, read from top to bottom; the first that fails names the
reason.  ``with_verdict`` runs the contract over a DataFrame in Arrow batches:
JSON's corner cases (duplicate keys, NaN, integers of any length) need exactly
one reading, which Spark's own JSON functions don't share.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..runtime import ship
from ..schemas import VERDICT
from .exprs import EVENT_TYPES, TIME_END_US

# Bounds and the fields that the source documents.
MAX_RAW_BYTES = 1_048_576
ARRAY_SAMPLE = 100
KNOWN_FIELDS = {
    "$": frozenset({"did", "kind", "time_us", "commit"}),
    "$.commit": frozenset({"operation", "collection", "rkey", "rev", "cid", "record"}),
    "$.commit.record": frozenset({"$type", "text", "createdAt", "langs", "facets", "embed", "reply", "tags", "labels"}),
}


@dataclass(frozen=True)
class Contract:
    """What one source's posts must look like."""

    source: str = "events"
    collection: str = "post"
    version: str = "post.v1"


def compact(value: Any) -> str:
    return json.dumps(value, ensure_ascii=True, sort_keys=True, separators=(",", ":"))


def kind_of(value: Any) -> str:
    """The JSON type's name; an array's tells the kinds among its first entries."""
    match value:
        case None:
            return "null"
        case bool():
            return "boolean"
        case str():
            return "string"
        case int():
            return "integer"
        case float():
            return "number"
        case dict():
            return "object"
        case list():
            return f"array<{','.join(sorted(set(map(kind_of, value[:ARRAY_SAMPLE]))))}>"
    return "unknown"


def sections(document: dict) -> dict[str, dict]:
    """The objects whose structure the contract governs, by path; a path stops at the first non-object."""
    out, at, path = {"$": document}, document, "$"
    for step in ("commit", "record"):
        at, path = at.get(step), f"{path}.{step}"
        if not isinstance(at, dict):
            break
        out[path] = at
    return out


def shape(document: dict) -> tuple[str, list[str]]:
    """(fingerprint of the governed objects' keys and kinds, their unknown fields)."""
    found = sections(document)
    kinds = {path: {key: kind_of(value) for key, value in obj.items()} for path, obj in found.items()}
    unknown = sorted(f"{path}.{key}" for path, obj in found.items() for key in obj if key not in KNOWN_FIELDS[path])
    return hashlib.sha256(compact(kinds).encode()).hexdigest(), unknown


def iso_micros(text: str) -> int | None:
    """Epoch microseconds of an ISO-8601 time with an offset; None for anything else."""
    try:
        when = datetime.fromisoformat(text.replace("Z", "+00:00"))
        if when.tzinfo is None:
            return None
        return (when - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)
    except (ValueError, OverflowError):
        return None


def _filled(value: Any) -> bool:
    return isinstance(value, str) and value.strip() != ""


def _instant(value: Any) -> bool:
    return type(value) is int and 0 < value < TIME_END_US


@dataclass
class _Reading:
    """One document under test, its parts at hand."""

    contract: Contract
    document: dict
    log_time: Any
    commit: Any = None
    record: Any = None
    created_us: int | None = None
    languages: list[str] = field(default_factory=list)

    def __post_init__(self):
        self.commit = self.document.get("commit")
        self.record = self.commit.get("record") if isinstance(self.commit, dict) else None

    @property
    def writes(self) -> bool:
        return self.commit["operation"] != "delete"

    def languages_ok(self) -> bool:
        given = self.record.get("langs", [])
        if not isinstance(given, list) or not all(isinstance(x, str) for x in given):
            return False
        self.languages = list(dict.fromkeys(x.strip().lower() for x in given if x.strip()))
        return True

    def created_ok(self) -> bool:
        given = self.record.get("createdAt")
        if given is not None:
            self.created_us = iso_micros(given)
        return given is None or self.created_us is not None


def _optional_text(value: Any) -> bool:
    return value is None or isinstance(value, str)


#: (reason, whether the reading passes); later rules may rely on earlier ones.
RULES: list[tuple[str, Callable[[_Reading], bool]]] = [
    ("unsupported_event_kind", lambda r: r.document.get("kind") == "commit"),
    ("invalid_field_type:commit", lambda r: isinstance(r.commit, dict)),
    ("unsupported_operation", lambda r: isinstance(r.commit.get("operation"), str) and r.commit["operation"] in EVENT_TYPES),
    ("unsupported_collection", lambda r: r.commit.get("collection") == r.contract.collection),
    ("missing_actor_did", lambda r: _filled(r.document.get("did"))),
    ("missing_record_key", lambda r: _filled(r.commit.get("rkey"))),
    ("missing_revision", lambda r: _filled(r.commit.get("rev"))),
    ("missing_or_invalid_event_timestamp", lambda r: _instant(r.document.get("time_us")) and _instant(r.log_time)),
    ("timestamp_mismatch", lambda r: r.document["time_us"] == r.log_time),
    ("missing_or_invalid_post_record", lambda r: not r.writes or isinstance(r.record, dict)),
    ("invalid_field_type:commit.record.text", lambda r: not r.writes or isinstance(r.record.get("text"), str)),
    ("invalid_field_type:commit.record.langs", lambda r: not r.writes or r.languages_ok()),
    ("invalid_field_type:commit.record.createdAt", lambda r: not r.writes or _optional_text(r.record.get("createdAt"))),
    ("invalid_content_created_at", lambda r: not r.writes or r.created_ok()),
    ("invalid_field_type:commit.record", lambda r: r.writes or r.record is None or isinstance(r.record, dict)),
    ("invalid_field_type:commit.cid", lambda r: _optional_text(r.commit.get("cid"))),
]


def judge(raw: Any, log_time_us: Any, contract: Contract = Contract()) -> dict[str, Any]:
    """The verdict on one raw event, with the fields of ``schemas.VERDICT``.

    JSON nested too deeply to read counts as malformed.
    """
    verdict: dict[str, Any] = dict.fromkeys(VERDICT.names)
    verdict |= {"language_codes": [], "schema_version": contract.version, "unknown_fields_json": "[]"}
    if not _filled(raw):
        return verdict | {"rejection_reason": "malformed_json"}
    if len(raw.encode("utf-8", errors="replace")) > MAX_RAW_BYTES:
        return verdict | {"rejection_reason": "oversized_json"}
    try:
        document = json.loads(raw)
    except (ValueError, RecursionError):
        return verdict | {"rejection_reason": "malformed_json"}
    if not isinstance(document, dict):
        return verdict | {"rejection_reason": "invalid_root_type"}
    verdict["shape_fingerprint"], unknown = shape(document)
    verdict["unknown_fields_json"] = json.dumps(unknown, separators=(",", ":"))
    reading = _Reading(contract, document, log_time_us)
    for reason, passes in RULES:
        if not passes(reading):
            return verdict | {"rejection_reason": reason}
    return verdict | _canonical(reading, unknown)


def _canonical(r: _Reading, unknown: list[str]) -> dict[str, Any]:
    actor, commit, when = r.document["did"], r.commit, r.document["time_us"]
    operation, collection, key, revision = (commit[k] for k in ("operation", "collection", "rkey", "rev"))
    identity = json.dumps([r.contract.source, actor, collection, key, revision, operation], separators=(",", ":"))
    metadata = {
        "kind": r.document["kind"],
        "operation": operation,
        "collection": collection,
        "rkey": key,
        "revision": revision,
        "cid": commit.get("cid"),
        "time_us": when,
        "unknown_fields": unknown,
    }
    return {
        "event_id": f"{r.contract.source}:{hashlib.sha256(identity.encode()).hexdigest()}",
        "event_type": EVENT_TYPES[operation],
        "event_time_us": when,
        "actor_id": actor,
        "entity_id": f"at://{actor}/{collection}/{key}",
        "entity_type": "post",
        "content_text": r.record["text"] if r.writes else None,
        "language_codes": r.languages,
        "content_created_at_us": r.created_us,
        "source_metadata_json": compact(metadata),
    }


def with_verdict(raw: DataFrame, contract: Contract = Contract(), *, raw_json: str = "raw_json", time_us: str = "source_time_us", out: str = "verdict") -> DataFrame:
    """``raw`` and a struct column with each row's verdict."""
    ship(raw.sparkSession)
    names = [c for c in raw.columns if c != out]
    kind = to_arrow_type(VERDICT)
    source = raw.select(*names)
    at_json, at_time = names.index(raw_json), names.index(time_us)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, times = batch.column(at_json).to_pylist(), batch.column(at_time).to_pylist()
            verdicts = pa.array([judge(t, u, contract) for t, u in zip(texts, times, strict=True)], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, verdicts], names=[*names, out])

    return source.mapInArrow(run, T.StructType([*source.schema.fields, T.StructField(out, VERDICT)]))
