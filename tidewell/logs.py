"""Log records as JSON lines."""

from __future__ import annotations

import json
import logging
import sys
from datetime import UTC, datetime

_STANDARD = frozenset(vars(logging.makeLogRecord({}))) | {"message", "asctime"}


class JsonLines(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        line = {
            "timestamp": datetime.fromtimestamp(record.created, UTC).isoformat(),
            "level": record.levelname,
            "logger": record.name,
            "message": record.getMessage(),
            **{k: v for k, v in vars(record).items() if k not in _STANDARD},
        }
        if record.exc_info:
            line["exception"] = self.formatException(record.exc_info)
        return json.dumps(line, ensure_ascii=False, default=str)


def configure(level: str = "INFO", stream=None) -> None:
    """One handler on the root logger, whatever was there."""
    handler = logging.StreamHandler(stream or sys.stdout)
    handler.setFormatter(JsonLines())
    logging.basicConfig(level=level, handlers=[handler], force=True)
