import hashlib
import random
import zlib

import pytest

from tidewell.llm import ogg, registry
from tests.llm.helpers import awkward, frame


def slow_crc(data):
    crc = 0
    for b in data:
        crc ^= b << 24
        for _ in range(8):
            crc = ((crc << 1) ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
    return crc


def test_page_checksum():
    for n in range(40):
        data = random.Random(n).randbytes(n)
        assert ogg.page_crc(data) == slow_crc(data)


@pytest.mark.parametrize("n", [0, 1, 575, 576, 577, 576 * 21, 576 * 22, 576 * 43, 576 * 300, 100_000])
def test_round_trip_and_times(n):
    payload = ogg.padded(random.Random(n).randbytes(n))
    back, packets = ogg.samples(ogg.store(payload))
    assert back == payload
    assert packets == [(i % 2 + 1, i * 576, i * 576 + 576) for i in range(len(payload) // 576)]


@pytest.mark.parametrize(("packet", "streams"), [(255, 1), (510, 3), (1000, 4), (20_000, 2)])
def test_other_packet_sizes_and_streams(packet, streams):
    payload = random.Random(3).randbytes(packet * 9)
    assert ogg.samples(ogg.store(payload, packet, streams=streams))[0] == payload


def test_packets_over_page_ends_and_lengths_divisible_by_255():
    packets = [b"a" * n for n in (0, 255, 510, 70_000, 1, 254)]
    pages = ogg.write_stream(7, b"id", packets, [1, 2, 3, 4, 5, 6], per_page=5)
    streams, bad = ogg.parse(b"".join(pages))
    assert not bad and streams[0].packets == [b"id", *packets] and not streams[0].lost and streams[0].ended
    assert [e for e in streams[0].ends if e][-1] == 6


def test_damage_is_found_and_passed_over():
    data = bytearray(ogg.store(random.Random(1).randbytes(576 * 100)))
    data[len(data) // 2] ^= 1
    with pytest.raises(ValueError):
        ogg.samples(bytes(data))
    streams, bad = ogg.parse(b"junk" + bytes(data))
    assert bad == 2 and sum(s.lost for s in streams) >= 1 and all(len(p) == 576 for s in streams for p in s.packets[1:])
    for broken in (b"", b"OggS", bytes(data)[:-3], b"x" * 99):
        with pytest.raises(ValueError):
            ogg.samples(broken)


def test_a_missing_page_loses_only_its_packets():
    pages = ogg.write_stream(1, b"id", [bytes([i]) * 576 for i in range(60)], list(range(576, 576 * 61, 576)), per_page=32)
    streams, _ = ogg.parse(b"".join(pages[:2] + pages[3:]))
    whole, _ = ogg.parse(b"".join(pages))
    assert streams[0].lost and set(streams[0].packets) < set(whole[0].packets) and streams[0].packets[-1] == whole[0].packets[-1]


def test_in_spark(spark):
    docs = frame(spark, awkward()).withColumnRenamed("score", "media").withColumnRenamed("spans", "payload")
    back = ogg.read_media(ogg.store_text(docs))
    for r in back.collect():
        assert bytes(r.payload) == ogg.padded((r.text or "").encode()) and r.error is None
        assert r.packets[-1].end_us == len(r.payload) * 1_000_000 // 8000
    odd = spark.createDataFrame([(1, None), (2, b"no"), (3, b"")], "id long, media binary")
    assert [(r.payload, bool(r.error)) for r in ogg.read_media(odd).collect()] == [(None, True)] * 3
    assert ogg.read_media(ogg.store_text(frame(spark, []))).count() == 0


def test_query(spark, tiny):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    seen = {}
    for r in registry.queries()["op3_ogg"](spark, tiny).collect():
        raw = texts[r.doc_id].encode()
        payload = ogg.padded(raw)
        media = ogg.store(payload)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
        assert seen.setdefault(raw, r.feature) == r.feature
