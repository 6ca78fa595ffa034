"""Where a firehose reader stopped, and the address at which it goes on."""

from __future__ import annotations

import json
import os
import tempfile
from datetime import UTC, datetime
from pathlib import Path
from urllib.parse import parse_qsl, urlencode, urlsplit


def load(path: Path) -> int | None:
    """The saved position; None if there is none, ValueError if it is unreadable."""
    try:
        saved = json.loads(Path(path).read_text(encoding="utf-8"))
    except FileNotFoundError:
        return None
    position = saved.get("time_us") if isinstance(saved, dict) else None
    if type(position) is not int or position < 0:
        raise ValueError(f"no valid cursor in {path}")
    return position


def save(path: Path, time_us: int) -> None:
    """Replaces the saved position in one step."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    fd, part = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(fd, "w", encoding="utf-8") as f:
            json.dump({"time_us": time_us, "saved_at": datetime.now(UTC).isoformat()}, f)
            f.flush()
            os.fsync(f.fileno())
        os.replace(part, path)
    except BaseException:
        Path(part).unlink(missing_ok=True)
        raise


def subscription_url(base: str, collection: str, cursor_us: int | None, overlap_seconds: int) -> str:
    """``base`` with our filter and, after a stop, a position some seconds before it; other parameters stay."""
    url = urlsplit(base)
    if url.scheme not in ("ws", "wss"):
        raise ValueError("the address must begin with ws:// or wss://")
    query = {k: v for k, v in parse_qsl(url.query) if k not in ("wantedCollections", "cursor")} | {"wantedCollections": collection}
    if cursor_us is not None:
        query["cursor"] = str(max(0, cursor_us - overlap_seconds * 1_000_000))
    return url._replace(query=urlencode(query)).geturl()


def stale(cursor_us: int, now: datetime | None = None, hours: float = 30) -> bool:
    """Whether the position is older than what the source is known to keep."""
    now = now or datetime.now(UTC)
    return now.timestamp() - cursor_us / 1e6 > hours * 3600
