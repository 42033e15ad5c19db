"""Plain dataclasses that describe streams, paging and syncs."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Literal

SyncMode = Literal["full_refresh", "incremental"]
WriteMode = Literal["append", "overwrite", "append_dedup"]
ErrorStrategy = Literal["fail", "skip", "retry"]


@dataclass(frozen=True)
class Stop:
    """When a page chain ends: ``empty_page``, ``field``, ``total_count`` or ``total_pages``."""

    kind: Literal["empty_page", "field", "total_count", "total_pages"] = "empty_page"
    path: str | None = None
    value: Any = None


@dataclass(frozen=True)
class Paging:
    """How the pages of one chain follow each other."""

    strategy: Literal["none", "cursor", "offset", "page_number", "link_header", "next_url"] = "none"
    stop: Stop | None = field(default_factory=Stop)
    cursor_param: str = "cursor"
    cursor_path: str | None = None
    offset_param: str = "offset"
    limit_param: str = "limit"
    limit: int = 100
    page_param: str = "page"
    start_page: int = 1
    page_size_param: str | None = None
    page_size: int | None = None
    rel: str = "next"
    next_path: str | None = None


@dataclass(frozen=True)
class StreamSpec:
    """One stream of landed pages."""

    name: str
    fmt: Literal["json", "jsonl", "csv", "xml"] = "json"
    records_path: str | None = None
    paging: Paging = field(default_factory=Paging)
    primary_key: tuple[str, ...] = ()
    cursor_field: str | None = None
    decode_options: dict[str, Any] = field(default_factory=dict)
    max_records: int | None = None
    batch_size: int = 1000


@dataclass(frozen=True)
class TableSpec:
    """One stream read from a database table, a query or files."""

    name: str
    table: str | None = None
    query: str | None = None
    primary_key: tuple[str, ...] = ()
    cursor_field: str | None = None
    lookback_seconds: int = 0


@dataclass(frozen=True)
class SyncSpec:
    """What to do with a stream in one run."""

    sync_mode: SyncMode = "incremental"
    write_mode: WriteMode = "append"
    error_strategy: ErrorStrategy = "fail"
    max_errors: int = 100
    buckets: int = 64
    # Whether a partition with too many bad records fails its stream, or is left out alone.
    fail_fast: bool = True


@dataclass(frozen=True)
class RequestSpec:
    """The templates a stream's requests are rendered from."""

    stream: str
    url: str
    path: str
    params: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class JobSpec:
    """How to read the status of an asynchronous job from a poll response."""

    # The defaults of the job protocol.
    status_path: str = "state"
    completed_value: str = "JobComplete"
    failed_values: tuple[str, ...] = ("Failed", "Aborted")
    max_attempts: int = 120
