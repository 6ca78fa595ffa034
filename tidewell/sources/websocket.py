"""A reading WebSocket client (RFC 6455) on the standard library alone."""

from __future__ import annotations

import base64
import hashlib
import os
import socket
import ssl
import struct
import time
from collections.abc import Iterator
from urllib.parse import urlsplit

# Fixed values of the protocol.
_GUID = b"258EAFA5-E914-47DA-95CA-C5AB0DC85B11"
_CONTINUED, _TEXT, _BINARY, _CLOSE, _PING, _PONG = 0x0, 0x1, 0x2, 0x8, 0x9, 0xA


class WebSocket:
    """An open connection; ``messages`` gives what the other side sends."""

    def __init__(self, url: str, timeout: float = 10, largest: int = 2 << 20):
        at = urlsplit(url)
        secure = at.scheme == "wss"
        self.largest, self.held = largest, b""
        self.socket = socket.create_connection((at.hostname, at.port or (443 if secure else 80)), timeout)
        try:
            if secure:
                self.socket = ssl.create_default_context().wrap_socket(self.socket, server_hostname=at.hostname)
            self._greet(at)
        except BaseException:
            self.socket.close()
            raise

    def __enter__(self) -> WebSocket:
        return self

    def __exit__(self, *_) -> None:
        self.socket.close()

    def _greet(self, at) -> None:
        key = base64.b64encode(os.urandom(16))
        path = (at.path or "/") + (f"?{at.query}" if at.query else "")
        lines = [f"GET {path} HTTP/1.1", f"Host: {at.netloc}", "Upgrade: websocket", "Connection: Upgrade", f"Sec-WebSocket-Key: {key.decode()}", "Sec-WebSocket-Version: 13"]
        self.socket.sendall("\r\n".join([*lines, "", ""]).encode())
        while b"\r\n\r\n" not in self.held:
            if len(self.held) > 65_536:
                raise ConnectionError("no end to the server's greeting")
            self.held += self._more()
        head, self.held = self.held.split(b"\r\n\r\n", 1)
        status, *rest = head.split(b"\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in rest)}
        accepted = base64.b64encode(hashlib.sha1(key + _GUID).digest())
        if b" 101" not in status or fields.get(b"sec-websocket-accept") != accepted:
            raise ConnectionError(f"the server doesn't speak WebSocket: {status.decode(errors='replace')}")

    def _more(self) -> bytes:
        got = self.socket.recv(65_536)
        if not got:
            raise ConnectionError("the connection was closed")
        return got

    def _take(self, n: int) -> bytes:
        while len(self.held) < n:
            self.held += self._more()
        out, self.held = self.held[:n], self.held[n:]
        return out

    def _send(self, kind: int, body: bytes) -> None:
        mask = os.urandom(4)
        size = bytes([0x80 | len(body)]) if len(body) < 126 else bytes([0x80 | 126]) + struct.pack(">H", len(body))
        self.socket.sendall(bytes([0x80 | kind]) + size + mask + bytes(b ^ mask[i % 4] for i, b in enumerate(body)))

    def _frame(self) -> tuple[bool, int, bytes]:
        first, second = self._take(2)
        size = second & 0x7F
        if size > 125:
            size = int.from_bytes(self._take(2 if size == 126 else 8), "big")
        if size > self.largest or second & 0x80:
            raise ConnectionError("a frame that is too large or masked")
        return bool(first & 0x80), first & 0x0F, self._take(size)

    def messages(self, silence: float, until: float) -> Iterator[bytes]:
        """Whole messages up to the monotonic time ``until``, put off by what their reader takes; TimeoutError after so many seconds of silence before it."""
        parts: list[bytes] = []
        while (left := until - time.monotonic()) > 0:
            self.socket.settimeout(min(silence, left))
            try:
                last, kind, body = self._frame()
            except TimeoutError:
                if left <= silence:
                    return
                raise
            if kind == _PING:
                self._send(_PONG, body[:125])
            elif kind == _CLOSE:
                self._send(_CLOSE, body[:2])
                return
            elif kind in (_TEXT, _BINARY, _CONTINUED):
                parts.append(body)
                if sum(map(len, parts)) > self.largest:
                    raise ConnectionError("a message that is too large")
                if last:
                    given = time.monotonic()
                    yield b"".join(parts)
                    until += time.monotonic() - given
                    parts = []
