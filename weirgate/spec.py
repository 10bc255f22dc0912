"""Plain descriptions of datasets, contracts, limits and folders."""

from __future__ import annotations

import re
from dataclasses import dataclass

SUCCESS = "SUCCESS"
PARTIAL = "PARTIAL"
FAILED = "FAILED"

# Names of datasets and runs become folder names.
NAME = r"[A-Za-z0-9][\w.-]*"

LOAD_TYPES = ("full", "incremental")
CONTRACT_TYPES = (
    "string", "int", "double", "number", "bool", "datetime", "objectid", "array", "object",
)


@dataclass(frozen=True)
class DatasetSpec:
    """What to load and how.

    ``inclusive_mark`` re-reads rows that share the stored mark, ``include_null_mark``
    picks up rows that carry no mark; both imply an upsert so that nothing doubles.
    ``keep_current`` keeps a table of the current record per key beside an appended history.
    ``scan_ranges`` lands the source in so many ranges of its key, so that a repeated run reads only what is missing.
    """

    name: str
    key: str = "_id"
    load_type: str = "full"
    mark_field: str | None = None
    mark_kind: str = "timestamp"
    exclude: tuple[str, ...] = ()
    expected_min: int = 0
    allow_empty: bool = False
    threshold_pct: float | None = None
    inclusive_mark: bool = False
    include_null_mark: bool = False
    rows_per_bucket: int = 1_000_000
    keep_current: bool = False
    scan_ranges: int = 0

    def __post_init__(self) -> None:
        if not re.fullmatch(NAME, self.name):
            raise ValueError(f"dataset name {self.name!r} cannot name a folder")
        if self.load_type not in LOAD_TYPES:
            raise ValueError(f"{self.name}: load_type must be one of {LOAD_TYPES}")
        if self.load_type == "incremental" and not self.mark_field:
            raise ValueError(f"{self.name}: an incremental dataset needs mark_field")

    def upserts(self, force_full: bool = False) -> bool:
        return (
            force_full
            or self.load_type == "full"
            or self.inclusive_mark
            or self.include_null_mark
        )


@dataclass(frozen=True)
class FieldRule:
    name: str
    type: str | None = None
    required: bool = False
    nullable: bool | None = None

    def __post_init__(self) -> None:
        if self.type is not None and self.type not in CONTRACT_TYPES:
            raise ValueError(f"{self.name}: unknown contract type {self.type}")

    @property
    def may_be_null(self) -> bool:
        return (not self.required) if self.nullable is None else self.nullable


@dataclass(frozen=True)
class Contract:
    dataset: str
    fields: tuple[FieldRule, ...] = ()
    forbidden: tuple[str, ...] = ()
    max_violation_pct: float = 5.0
    allow_empty: bool = False


@dataclass(frozen=True)
class Limits:
    threshold_pct: float = 1.0
    hard_fail_pct: float = 5.0
    null_key_is_fatal: bool = True
    fail_on_partial: bool = False


@dataclass(frozen=True)
class Layout:
    """Folders below one root on shared storage."""

    root: str

    def landing(self, dataset: str) -> str:
        return f"{self.root}/landing/{dataset}"

    def bronze(self, dataset: str) -> str:
        return f"{self.root}/bronze/{dataset}"

    def keyed(self, dataset: str) -> str:
        return f"{self.root}/bronze_keyed/{dataset}"

    def scan_state(self, dataset: str, run_id: str) -> str:
        return f"{self.root}/scans/{dataset}/{run_id}"

    def current(self, dataset: str) -> str:
        return f"{self.root}/bronze_current/{dataset}"

    def control(self, table: str) -> str:
        return f"{self.root}/control/{table}"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def checkpoint(self, dataset: str) -> str:
        return f"{self.root}/checkpoints/{dataset}"

    def schemas(self, dataset: str) -> str:
        return f"{self.root}/schemas/{dataset}"
