"""Settings from the environment, checked once."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields
from functools import cache
from pathlib import Path
from typing import ClassVar

from .errors import ConfigurationError

PREFIX = "TIDEWELL_"


@dataclass(frozen=True)
class Settings:
    """Names, places and limits; each can be set as ``TIDEWELL_<NAME>``."""

    environment: str = "development"
    log_level: str = "INFO"
    log_servers: str = "localhost:9092"
    log_topic: str = "events.v1"
    firehose_url: str = "wss://localhost/subscribe"
    collection: str = "post"
    cursor_path: Path = Path("data/cursor.json")
    cursor_overlap_seconds: int = 5
    producer_batch_size: int = 100
    producer_flush_seconds: float = 2.0
    consumer_commit_every: int = 100
    landing_root: Path = Path("data/landing")
    landing_batch_size: int = 200
    landing_flush_seconds: float = 10.0
    min_free_mb: int = 512
    upload_folder: str = "/Volumes/main/landing/events"
    upload_poll_seconds: float = 15.0
    uploads_per_cycle: int = 5

    #: Least and greatest values.
    BOUNDS: ClassVar[dict[str, tuple[float, float]]] = {
        "cursor_overlap_seconds": (0, 3600),
        "producer_batch_size": (1, 10_000),
        "producer_flush_seconds": (0.1, 60),
        "consumer_commit_every": (1, 10_000),
        "landing_batch_size": (1, 10_000),
        "landing_flush_seconds": (0.5, 300),
        "min_free_mb": (0, 1 << 20),
        "upload_poll_seconds": (1, 3600),
        "uploads_per_cycle": (1, 100),
    }

    def __post_init__(self):
        for name, (low, high) in self.BOUNDS.items():
            if not low <= getattr(self, name) <= high:
                raise ConfigurationError(f"{name} must be from {low} to {high}")
        if self.log_level not in ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL"):
            raise ConfigurationError(f"unknown log level {self.log_level!r}")
        for name in ("log_servers", "log_topic", "collection"):
            if not getattr(self, name).strip():
                raise ConfigurationError(f"{name} is empty")

    @classmethod
    def load(cls, env: Mapping[str, str] | None = None) -> Settings:
        env = os.environ if env is None else env
        kinds = {"int": int, "float": float, "Path": Path, "str": str}
        found = {}
        for f in fields(cls):
            if (text := env.get(PREFIX + f.name.upper())) is not None:
                try:
                    found[f.name] = kinds[f.type](text)
                except ValueError as e:
                    raise ConfigurationError(f"{f.name}: {text!r} is no {f.type}") from e
        return cls(**found)


@cache
def settings() -> Settings:
    """The process's settings, read once."""
    return Settings.load()
