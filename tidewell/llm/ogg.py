"""Media columns: payloads in Ogg files, written and read page by page.

``store`` puts a payload of 8-bit samples into two logical streams, packets of
``PACKET`` samples in turn; ``parse`` verifies each page's checksum, rebuilds
packets from lacing values over page ends, separates the logical streams and
derives each packet's time from its page's granule position.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import read, ship
from .textkernel import map_text

#: Samples in a packet, samples a second, lacing values in a page, streams in a file.
PACKET, RATE, LACING, STREAMS = 576, 8000, 64, 2
_HEAD = struct.Struct("<4sBBqIIIB")
_IDENT = struct.Struct("<8sIHH")
_MAGIC = b"tw8bit\x00\x01"
#: Each byte with its bits reversed.
_REVERSED = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def page_crc(data: bytes) -> int:
    """Ogg's checksum: polynomial 0x04C11DB7, bits not reflected, from 0, no final inversion.

    That is zlib's CRC of the bit-reversed bytes without its inversions, with
    the result's bits reversed.
    """
    crc = zlib.crc32(data.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(crc.to_bytes(4, "little").translate(_REVERSED), "big")


@dataclass
class Page:
    flags: int
    granule: int
    serial: int
    sequence: int
    lacing: bytes
    body: bytes


@dataclass
class Stream:
    serial: int
    packets: list[bytes] = field(default_factory=list)
    #: Granule position at each packet's end; None where no page tells it.
    ends: list[int | None] = field(default_factory=list)
    pages: int = 0
    lost: int = 0
    ended: bool = False


def write_page(flags: int, granule: int, serial: int, sequence: int, lacing: bytes, body: bytes) -> bytes:
    head = _HEAD.pack(b"OggS", 0, flags, granule, serial, sequence, 0, len(lacing)) + lacing
    crc = page_crc(head + body)
    return b"".join((head[:22], crc.to_bytes(4, "little"), head[26:], body))


def write_stream(serial: int, ident: bytes, packets: list[bytes], granules: list[int], per_page: int = LACING) -> list[bytes]:
    """The pages of one logical stream: the identification page, then the packets.

    A packet may go on over page ends.  A page's granule position is that of
    the last packet that ends in it, or -1; the last page says so.
    """
    pages = [write_page(2, 0, serial, 0, bytes([len(ident)]), ident)]
    laces = bytearray()
    ends: dict[int, int] = {}
    for p, g in zip(packets, granules, strict=True):
        laces += b"\xff" * (len(p) // 255) + bytes([len(p) % 255])
        ends[len(laces) - 1] = g
    body = b"".join(packets)
    marks = sorted(ends)
    at = m = 0
    for k in range(0, max(len(laces), 1), per_page):
        own = bytes(laces[k : k + per_page])
        granule = -1
        while m < len(marks) and marks[m] < k + len(own):
            granule = ends[marks[m]]
            m += 1
        size = sum(own)
        flags = (1 if k and laces[k - 1] == 255 else 0) | (4 if k + per_page >= len(laces) else 0)
        pages.append(write_page(flags, granule if own else 0, serial, len(pages), own, body[at : at + size]))
        at += size
    return pages


def store(payload: bytes, packet: int = PACKET, rate: int = RATE, streams: int = STREAMS) -> bytes:
    """An Ogg file of 8-bit samples: packet i goes to logical stream i % streams."""
    parts = [payload[i : i + packet] for i in range(0, len(payload), packet)]
    ends = np.cumsum([len(p) for p in parts]).tolist()
    each = [write_stream(s + 1, _IDENT.pack(_MAGIC, rate, s, streams), parts[s::streams], ends[s::streams]) for s in range(streams)]
    out = [pages[0] for pages in each]  # all identification pages come first
    for k in range(1, max(map(len, each))):
        out += [pages[k] for pages in each if k < len(pages)]
    return b"".join(out)


def parse_pages(data: bytes) -> tuple[list[Page], int]:
    """(pages whose checksum holds, number of damaged places); after damage it looks for the next page."""
    pages, bad, at = [], 0, 0
    while at < len(data):
        if data[at : at + 4] != b"OggS" or at + 27 > len(data):
            bad += 1
            at = data.find(b"OggS", at + 1)
            if at < 0:
                break
            continue
        _, version, flags, granule, serial, sequence, crc, n = _HEAD.unpack_from(data, at)
        lacing = data[at + 27 : at + 27 + n]
        end = at + 27 + n + sum(lacing)
        body = data[at + 27 + n : end]
        whole = len(lacing) == n and end <= len(data) and version == 0
        if not whole or page_crc(data[at : at + 22] + b"\0\0\0\0" + data[at + 26 : end]) != crc:
            bad += 1
            at = data.find(b"OggS", at + 1)
            if at < 0:
                break
            continue
        pages.append(Page(flags, granule, serial, sequence, lacing, body))
        at = end
    return pages, bad


def parse(data: bytes) -> tuple[list[Stream], int]:
    """The logical streams in order of appearance, and the number of damaged places.

    A packet with a missing page is left out and counted in its stream's
    ``lost``.
    """
    streams: dict[int, Stream] = {}
    order: list[Stream] = []
    open_: dict[int, bytes | None] = {}
    expect: dict[int, int] = {}
    pages, bad = parse_pages(data)
    for page in pages:
        s = streams.get(page.serial)
        if s is None or page.flags & 2:
            s = streams[page.serial] = Stream(page.serial)
            order.append(s)
            open_[page.serial], expect[page.serial] = None, page.sequence
        gap = page.sequence != expect[page.serial]
        expect[page.serial] = page.sequence + 1
        s.pages += 1
        held = open_[page.serial]
        if held is not None and (gap or not page.flags & 1):
            s.lost += 1
            held = None
        skip = bool(page.flags & 1) and held is None  # its beginning is missing
        s.lost += skip and not gap
        first, at = len(s.packets), 0
        part = [held] if held is not None else []
        size = 0
        for lace in page.lacing:
            size += lace
            if lace < 255:
                part.append(page.body[at : at + size])
                at, size = at + size, 0
                if skip:
                    skip = False
                else:
                    s.packets.append(b"".join(part))
                    s.ends.append(None)
                part = []
        if size or part or page.lacing[-1:] == b"\xff":
            part.append(page.body[at : at + size])
        open_[page.serial] = b"".join(part) if part and not skip else None
        if len(s.packets) > first and page.granule >= 0:
            s.ends[-1] = page.granule
        s.ended |= bool(page.flags & 4)
    for serial, s in streams.items():
        s.lost += open_[serial] is not None
    return order, bad


def samples(data: bytes) -> tuple[bytes, list[tuple[int, int, int]]]:
    """(payload, (serial, start, end) of each packet in samples) of a file that ``store`` wrote.

    Only a page's last packet carries a granule position; those before it are
    timed back from it, a packet of each of the other streams between two of
    one stream.  Raises ValueError if anything is damaged or missing.
    """
    streams, bad = parse(data)
    if bad or not streams or any(s.lost or not s.ended or not s.packets for s in streams):
        raise ValueError("damaged or incomplete Ogg file")
    timed = []
    for s in streams:
        magic, _, channel, count = _IDENT.unpack(s.packets[0])
        if magic != _MAGIC:
            raise ValueError("not an Ogg file of 8-bit samples")
        end = None
        longest = max((len(p) for p in s.packets[1:]), default=0)
        for p, known in zip(reversed(s.packets[1:]), reversed(s.ends[1:]), strict=True):
            if known is not None:
                end = known
            elif end is not None:
                end -= previous + (count - 1) * longest
            if end is None:
                raise ValueError("a packet without a time")
            timed.append((end - len(p), end, s.serial, p))
            previous = len(p)
    timed.sort(key=lambda x: x[:3])
    if any(a[1] != b[0] for a, b in zip(timed[:-1], timed[1:], strict=True)) or timed and timed[0][0]:
        raise ValueError("packets overlap or are missing")
    return b"".join(x[3] for x in timed), [(x[2], x[0], x[1]) for x in timed]


def features(payload: bytes, packets: list[tuple[int, int, int]], rate: int = RATE) -> str:
    """Whole-number features of the samples about their middle, 128, and of the packets' times."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    n = len(x)
    crossings = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
    last = packets[-1][1] * 1_000_000 // rate if packets else 0
    return f"samples={n};packets={len(packets)};streams={len({p[0] for p in packets})};us={n * 1_000_000 // rate};last_start_us={last};sum={int(x.sum())};energy={int((x * x).sum())};peak={int(np.abs(x).max(initial=0))};crossings={crossings}"


def padded(raw: bytes, unit: int = PACKET) -> bytes:
    """The bytes with 255 appended up to a positive multiple of ``unit``."""
    return raw + b"\xff" * (max(unit, -(-len(raw) // unit) * unit) - len(raw))


def store_text(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, media: str = "media") -> DataFrame:
    """Adds ``media``: an Ogg file of each text's padded UTF-8 bytes.

    A null text counts as empty; an input column named ``media`` gives way.
    """

    def run(texts, _):
        return [pa.array([store(padded((t or "").encode())) for t in texts.to_pylist()], pa.binary())]

    return map_text(docs, run, [T.StructField(media, T.BinaryType())], text, keep)


def read_media(files: DataFrame, *, media: str = "media") -> DataFrame:
    """Adds payload, packets (serial, start_us, end_us), feature, error.

    A null, damaged or foreign file has null results and says why in
    ``error``; input columns of these names give way.
    """
    ship(files.sparkSession)
    names = ["payload", "packets", "feature", "error"]
    kept = [c for c in files.columns if c not in names]
    packet = T.StructType([T.StructField("serial", T.LongType()), T.StructField("start_us", T.LongType()), T.StructField("end_us", T.LongType())])
    schema = T.StructType([*[T.StructField(c, files.schema[c].dataType) for c in kept], T.StructField("payload", T.BinaryType()), T.StructField("packets", T.ArrayType(packet)), T.StructField("feature", T.StringType()), T.StructField("error", T.StringType())])
    kind = pa.list_(pa.struct([("serial", pa.int64()), ("start_us", pa.int64()), ("end_us", pa.int64())]))

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                out: list[list] = [[], [], [], []]
                for data in part.column(len(kept)).to_pylist():
                    try:
                        if data is None:
                            raise ValueError("no file")
                        payload, packets = samples(data)
                        row = [payload, [{"serial": s, "start_us": a * 1_000_000 // RATE, "end_us": b * 1_000_000 // RATE} for s, a, b in packets], features(payload, packets), None]
                    except (ValueError, struct.error) as e:
                        row = [None, None, None, str(e)]
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                arrays = [pa.array(out[0], pa.binary()), pa.array(out[1], kind), pa.array(out[2], pa.string()), pa.array(out[3], pa.string())]
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(kept))], *arrays], names=[*kept, *names])

    return files.select(*[files[c].alias(f"k{i}") for i, c in enumerate(kept)], files[media].alias("media_")).mapInArrow(run, schema)


def op3_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    back = read_media(store_text(docs, keep=["doc_id", "n_bytes"]))
    return back.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -32, 32)")).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )
