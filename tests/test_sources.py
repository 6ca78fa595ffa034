import io
import json
import logging
from datetime import UTC, datetime

import pytest

from tidewell import logs
from tidewell.errors import ConfigurationError
from tidewell.settings import Settings
from tidewell.sources import cursor, posts
from tests.test_contract import T0, changed, document


def test_parses_posts():
    got = posts.parse_post(document(langs=["en", "fr"]))
    assert (got.did, got.uri, got.operation, got.time_us, got.language, got.text) == ("did:a", "at://did:a/post/k1", "create", T0, "en", "hi")
    assert posts.parse_post(document(langs=[3], text=5, createdAt=1)) == posts.Post("did:a", "at://did:a/post/k1", "create", T0)
    assert posts.parse_post(changed("kind", "account")) is None and posts.parse_post(changed("commit.collection", "like")) is None


@pytest.mark.parametrize("doc", [changed("did"), changed("time_us", 0), changed("time_us", True), changed("commit.rkey", ""), changed("commit.operation", "x"), changed("commit", None), changed("commit.record")])
def test_broken_posts_raise(doc):
    with pytest.raises(ValueError):
        posts.parse_post(doc)


def test_messages_keep_the_document_and_its_key():
    doc = document(text="é")
    got = posts.prepare_message(doc)
    assert got.key == "at://did:a/post/k1" and json.loads(got.value) == doc and "é".encode() in got.value
    gone = changed("commit.record")
    gone["commit"]["operation"] = "delete"
    assert posts.prepare_message(gone).key == got.key and posts.parse_post(gone).text is None
    assert posts.prepare_message(changed("kind", "account")) is None


def test_posts_and_messages_in_spark(spark):
    gone = changed("commit.record")
    gone["commit"]["operation"] = "delete"
    docs = [document(), changed("kind", "account"), changed("did", ""), gone, changed("commit.record")]
    raw = spark.createDataFrame([(json.dumps(d),) for d in docs] + [("{",), (None,)], "raw_json string")
    want = [posts.parse_post(document()), posts.parse_post(gone)]
    assert sorted(map(tuple, posts.posts(raw).collect()), key=str) == sorted([(p.did, p.uri, p.operation, p.time_us, p.created_at, p.language, p.text) for p in want], key=str)
    assert {r.key for r in posts.messages(raw).collect()} == {"at://did:a/post/k1"}


def test_cursor(tmp_path):
    path = tmp_path / "a" / "cursor.json"
    assert cursor.load(path) is None
    cursor.save(path, 42)
    assert cursor.load(path) == 42 and len(list(path.parent.iterdir())) == 1
    path.write_text('{"time_us": true}')
    with pytest.raises(ValueError):
        cursor.load(path)
    now = datetime(2024, 1, 3, tzinfo=UTC)
    assert cursor.stale(int(datetime(2024, 1, 1, tzinfo=UTC).timestamp() * 1e6), now) and not cursor.stale(int(now.timestamp() * 1e6), now)


def test_subscription_url():
    got = cursor.subscription_url("wss://h/s?x=1&cursor=9&wantedCollections=q", "post", 12_000_000, 5)
    assert got == "wss://h/s?x=1&wantedCollections=post&cursor=7000000"
    assert cursor.subscription_url("ws://h", "post", 1, 5).endswith("cursor=0")
    with pytest.raises(ValueError):
        cursor.subscription_url("https://h", "post", None, 5)


def test_settings():
    assert Settings.load({}).landing_batch_size == 200
    assert Settings.load({"TIDEWELL_LANDING_BATCH_SIZE": "7", "TIDEWELL_LANDING_ROOT": "/x"}).landing_batch_size == 7
    for bad in ({"TIDEWELL_LANDING_BATCH_SIZE": "0"}, {"TIDEWELL_LANDING_BATCH_SIZE": "x"}, {"TIDEWELL_LOG_LEVEL": "LOUD"}, {"TIDEWELL_LOG_TOPIC": " "}):
        with pytest.raises(ConfigurationError):
            Settings.load(bad)


def test_json_logs():
    out = io.StringIO()
    logs.configure("INFO", out)
    logging.getLogger("x").info("hello %s", "you", extra={"batch": 3})
    try:
        raise KeyError("k")
    except KeyError:
        logging.getLogger("x").exception("bad")
    first, second = map(json.loads, out.getvalue().splitlines())
    assert first["message"] == "hello you" and first["batch"] == 3 and "KeyError" in second["exception"]
