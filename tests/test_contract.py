import json

import pytest

from tidewell.functions.contract import Contract, judge, kind_of, shape, with_verdict

T0 = 1_700_000_000_000_000


def document(**record):
    return {
        "did": "did:a",
        "kind": "commit",
        "time_us": T0,
        "commit": {"operation": "create", "collection": "post", "rkey": "k1", "rev": "r1", "cid": "c", "record": {"text": "hi", "createdAt": "2024-01-01T00:00:00Z", "langs": ["en"], **record}},
    }


def verdict(doc, time=T0):
    return judge(json.dumps(doc) if not isinstance(doc, str) else doc, time)


def changed(path, value="DROP"):
    doc = document()
    at = doc
    *steps, last = path.split(".")
    for s in steps:
        at = at[s]
    if value == "DROP":
        del at[last]
    else:
        at[last] = value
    return doc


def test_accepts_and_names_the_same_commit_alike():
    a, b = verdict(document()), verdict(document())
    assert a["rejection_reason"] is None and a["event_id"] == b["event_id"] and a["event_id"].startswith("events:")
    assert a["entity_id"] == "at://did:a/post/k1" and a["event_type"] == "content_created" and a["language_codes"] == ["en"]


@pytest.mark.parametrize(
    ("doc", "reason"),
    [
        (None, "malformed_json"),
        ("  ", "malformed_json"),
        ('{"a":', "malformed_json"),
        ("[" * 100_000 + "]" * 100_000, "malformed_json"),
        ('"' + "x" * (1 << 20) + '"', "oversized_json"),
        ([1], "invalid_root_type"),
        (changed("time_us"), "missing_or_invalid_event_timestamp"),
        (changed("time_us", True), "missing_or_invalid_event_timestamp"),
        (changed("time_us", 253_402_300_800_000_000), "missing_or_invalid_event_timestamp"),
        (changed("time_us", T0 + 1), "timestamp_mismatch"),
        (changed("kind", "identity"), "unsupported_event_kind"),
        (changed("commit", []), "invalid_field_type:commit"),
        (changed("commit.operation", "archive"), "unsupported_operation"),
        (changed("commit.operation", ["create"]), "unsupported_operation"),
        (changed("commit.collection", "like"), "unsupported_collection"),
        (changed("did", " "), "missing_actor_did"),
        (changed("commit.rkey", 3), "missing_record_key"),
        (changed("commit.rev"), "missing_revision"),
        (changed("commit.record", None), "missing_or_invalid_post_record"),
        (changed("commit.record.text", {"m": 1}), "invalid_field_type:commit.record.text"),
        (changed("commit.record.text"), "invalid_field_type:commit.record.text"),
        (changed("commit.record.langs", "en"), "invalid_field_type:commit.record.langs"),
        (changed("commit.record.langs", None), "invalid_field_type:commit.record.langs"),
        (changed("commit.record.createdAt", 5), "invalid_field_type:commit.record.createdAt"),
        (changed("commit.record.createdAt", "2024-01-01T00:00:00"), "invalid_content_created_at"),
        (changed("commit.cid", 5), "invalid_field_type:commit.cid"),
    ],
)
def test_first_failing_rule_names_the_reason(doc, reason):
    got = judge(doc, T0) if doc is None else verdict(doc)
    assert got["rejection_reason"] == reason
    assert got["event_id"] is None and got["language_codes"] == []


def test_log_time_must_be_a_number():
    assert judge(json.dumps(document()), None)["rejection_reason"] == "missing_or_invalid_event_timestamp"


def test_additive_fields_are_accepted_and_recorded():
    got, base = verdict(document(extra={"a": 1})), verdict(document())
    assert got["rejection_reason"] is None and got["shape_fingerprint"] != base["shape_fingerprint"]
    assert json.loads(got["unknown_fields_json"]) == ["$.commit.record.extra"]
    assert json.loads(got["source_metadata_json"])["unknown_fields"] == ["$.commit.record.extra"]


def test_fingerprint_follows_types_not_values():
    assert verdict(document(text="other"))["shape_fingerprint"] == verdict(document())["shape_fingerprint"]
    assert verdict(document(text={"x": 1}))["shape_fingerprint"] != verdict(document())["shape_fingerprint"]


def test_languages_are_tidied_in_order():
    assert verdict(document(langs=["EN", "en", " fr ", ""]))["language_codes"] == ["en", "fr"]


def test_delete_needs_no_record():
    doc = changed("commit.record")
    doc["commit"]["operation"] = "delete"
    got = verdict(doc)
    assert got["rejection_reason"] is None and got["event_type"] == "content_deleted" and got["content_text"] is None
    doc["commit"]["record"] = "x"
    assert verdict(doc)["rejection_reason"] == "invalid_field_type:commit.record"


def test_revision_changes_the_event_but_not_the_entity():
    a, b = verdict(document()), verdict(changed("commit.rev", "r2"))
    assert a["event_id"] != b["event_id"] and a["entity_id"] == b["entity_id"]


def test_empty_text_and_source_name():
    assert verdict(document(text=""))["rejection_reason"] is None
    assert judge(json.dumps(document()), T0, Contract(source="other"))["event_id"].startswith("other:")


def test_kinds():
    assert [kind_of(x) for x in (None, True, 1, 1.0, "s", {}, [1, "a", [None]])] == ["null", "boolean", "integer", "number", "string", "object", "array<array<null>,integer,string>"]
    assert shape({"b": 1, "a": 2})[0] == shape({"a": 2, "b": 1})[0]


def test_verdicts_in_spark(spark):
    raw = spark.createDataFrame([(json.dumps(document()), T0, "x"), (None, None, None)], "raw_json string, source_time_us long, verdict string")
    good, bad = with_verdict(raw).orderBy("raw_json", ascending=False).collect()
    assert good.verdict.event_type == "content_created" and good.verdict.content_created_at_us == 1_704_067_200_000_000
    assert bad.verdict.rejection_reason == "malformed_json" and bad.verdict.language_codes == []
