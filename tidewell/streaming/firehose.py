"""A firehose of source documents as a Python data source, ``format("tidewell_firehose")``.

The reader hands on every valid event, whatever its time.  Its position, the
latest source time seen, only moves forward.  A connection that a full batch
leaves stays open for the next one; a new connection to a socket begins an
overlap before the position, and what a reader has handed on within the overlap
it doesn't hand on again.  A recorded file is read from its start, and its place
in an offset says how many of its valid documents are behind, so events older
than the overlap aren't missed there, wherever batches are cut or a restart goes
on.  After a restart the overlap comes twice, which sinks that insert new keys
alone make harmless.  The connection itself is a function from (url, position)
to documents, so a recorded file serves as well as a socket.
"""

from __future__ import annotations

import hashlib
import json
import logging
import random
import sys
import time
from collections.abc import Callable, Iterator, Mapping
from itertools import islice
from urllib.parse import parse_qs, urlsplit

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from ..runtime import PACKAGE, ship
from ..sources.cursor import stale, subscription_url
from ..sources.posts import prepare_message
from ..sources.websocket import WebSocket

log = logging.getLogger(__name__)
SCHEMA = "key string, value string, time_us bigint, operation string"


class Recorded:
    """All documents of a JSON-lines file given as ?file=...; after its end it goes on with what is appended."""

    def __init__(self, url: str):
        self.file = open(parse_qs(urlsplit(url).query).get("file", [""])[0], "rb")  # noqa: SIM115
        self.line = b""

    def __iter__(self) -> Iterator[dict]:
        return self

    def __next__(self) -> dict:
        while more := self.file.readline():
            self.line += more
            if not self.line.strip():
                self.line = b""
                continue
            try:
                document = json.loads(self.line.decode())
            except ValueError:
                if more.endswith(b"\n"):
                    raise
                continue  # still being written
            self.line = b""
            return document
        raise StopIteration


def connected(url: str, position: int | None, *, silence: float = 90, largest: int = 2 << 20, most_seconds: float = 10, most_failures: int = 8, sleep: Callable[[float], None] = time.sleep) -> Iterator[dict]:
    """Documents of a live socket, for a while; the position is in the address.

    A silent or broken connection is made anew after a pause; who reads on gets
    repeats from the position on.  After too many failures in a row the last
    one is raised.
    """
    end, failures = time.monotonic() + most_seconds, 0
    while time.monotonic() < end:
        try:
            with WebSocket(url, timeout=min(10.0, silence), largest=largest) as socket:
                for message in socket.messages(silence, end):
                    failures = 0
                    try:
                        document = json.loads(message)
                    except ValueError:
                        continue
                    if isinstance(document, dict):
                        given = time.monotonic()
                        yield document
                        end += time.monotonic() - given
            if time.monotonic() < end:
                raise ConnectionError("the server closed the connection")
        except OSError as e:
            failures += 1
            if failures > most_failures:
                raise
            pause = backoff(failures - 1)
            log.warning("firehose connection failed %s times, next in %.1f s: %s", failures, pause, e)
            sleep(max(0.0, min(pause, end - time.monotonic())))


def backoff(failures: int, jitter: Callable[[], float] = random.random) -> float:
    """Seconds before the next connection after that many failures in a row."""
    return min(60.0, 2.0 ** min(failures, 6)) + 0.5 * jitter()


def connection(url: str, position: int | None, seconds: float = 10) -> Iterator[dict]:
    """A recorded file where the address names one, else the live socket."""
    if "file" in parse_qs(urlsplit(url).query):
        return Recorded(url)
    return connected(url, position, most_seconds=seconds)


class FirehoseReader(SimpleDataSourceStreamReader):
    connect: Callable[..., Iterator[dict]] = staticmethod(connection)

    def __init__(self, options: Mapping[str, str]):
        self.base = options["url"]
        self.collection = options.get("collection", "post")
        self.overlap = int(options.get("overlapSeconds", 5))
        self.most = int(options.get("maxEvents", 10_000))
        self.seconds = float(options.get("connectionSeconds", 10))
        self.bad = 0
        self.handed: dict[bytes, int] = {}  # of the overlap before the position
        self.recorded = "file" in parse_qs(urlsplit(self.base).query)
        self.feed: Iterator[dict] | None = None  # an open connection
        self.stands: dict = {}  # the offset up to which it is read
        self.read_of_feed = 0  # valid documents

    def initialOffset(self) -> dict:
        return {"time_us": 0, "events": 0}

    def _connect(self, position: int) -> Iterator[dict]:
        cursor = position or None
        if cursor and stale(cursor):
            log.warning("the firehose may no longer hold what came since %s", cursor)
        url = subscription_url(self.base, self.collection, cursor, self.overlap)
        start = parse_qs(urlsplit(url).query).get("cursor")
        return iter(type(self).connect(url, int(start[0]) if start else None, self.seconds))

    def _messages(self, documents: Iterator[dict]) -> Iterator[tuple]:
        for document in documents:
            try:
                message = prepare_message(document, self.collection)
            except ValueError as e:
                self.bad += 1
                log.warning("a broken document, the %sth: %s", self.bad, e)
                continue
            if message is not None:
                yield (message.key, message.value.decode(), message.time_us, message.operation)

    def read(self, start: dict):
        """What has come and wasn't handed on; the position never goes back."""
        if self.feed is None or self.stands != start:
            self.feed, self.read_of_feed = self._connect(start["time_us"]), 0
        rows, last, behind = [], start["time_us"], _place(start)
        floor = last - self.overlap * 1_000_000
        for row in self._messages(self.feed):
            self.read_of_feed += 1
            if self.recorded and self.read_of_feed <= behind and row[2] < floor:
                continue
            digest = hashlib.sha256(f"{row[2]} {row[0]} {row[1]}".encode()).digest()
            if digest in self.handed:
                continue
            self.handed[digest] = row[2]
            rows.append(row)
            last = max(last, row[2])
            if len(rows) >= self.most:
                break
        else:
            if not self.recorded:
                self.feed = None
        floor = last - self.overlap * 1_000_000
        self.handed = {k: t for k, t in self.handed.items() if t >= floor}
        end = {"time_us": last, "events": start["events"] + len(rows)}
        place = max(behind, self.read_of_feed)
        if self.recorded and place != end["events"]:
            end["place"] = place
        self.stands = end
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict):
        """The same events again after a failure; of a socket also the overlap before them."""
        rows = self._messages(self._connect(start["time_us"]))
        if self.recorded:
            return islice(rows, _place(start), _place(end))
        return (r for r in rows if r[2] <= end["time_us"])


def _place(offset: dict) -> int:
    """Valid documents of a recorded file behind an offset: as many as were handed on, where it doesn't say."""
    return offset.get("place", offset["events"])


class Firehose(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidewell_firehose"

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema) -> FirehoseReader:
        return FirehoseReader(self.options)  # which Spark keeps under lower-case names and finds under any


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, wherever this package is installed.

    Spark plans a source in a Python process of its own, which may not find
    the package, so the classes go there by value.
    """
    ship(spark)
    own = [m for name, m in list(sys.modules.items()) if name.split(".")[0] == PACKAGE.name and m is not None]
    for module in own:
        cloudpickle.register_pickle_by_value(module)
    try:
        spark.dataSource.register(Firehose)
    finally:
        for module in own:
            cloudpickle.unregister_pickle_by_value(module)
