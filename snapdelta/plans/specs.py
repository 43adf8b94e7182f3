"""Declared tables and transformations, as plain dictionaries or dataclasses."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from ..functions import resolve_ref_date
from ..operators.quality import DEFAULT_RETENTION_DAYS, Contract

SNAPSHOT_MODE = "snapshot_full"


@dataclass(frozen=True)
class TableSpec:
    """One source table: where it is, how to read it and what it must satisfy."""

    name: str
    table: str
    schema: str | None = None
    source_type: str = "oracle"
    primary_keys: tuple[str, ...] = ()
    partition_column: str | None = None
    num_partitions: int = 1
    fetch_size: int = 10000
    reference_date: str | None = None
    row_count_min: int | None = None
    freshness_hours: float | None = None
    domain: str | None = None
    owner: str | None = None
    pii: bool = False
    retention_days: int = DEFAULT_RETENTION_DAYS
    null_safe: bool = True
    unique_keys: bool = False

    @property
    def entity(self) -> str:
        """Name of the table's folder in a layer; tables of two schemas never share one."""
        return self.full_name.lower()

    @property
    def full_name(self) -> str:
        return f"{self.schema}.{self.table}" if self.schema else self.table

    def ref_date(self, as_of: str | dt.date) -> dt.date:
        return resolve_ref_date(self.reference_date, as_of)

    def contract(self, freshness_col: str = "_ingestion_timestamp") -> Contract:
        """The checks declared for the table."""
        key = self.primary_keys or None
        return Contract(
            self.name,
            row_count_min=self.row_count_min,
            freshness_hours=self.freshness_hours,
            freshness_col=freshness_col,
            key=key,
            duplicates_max=0 if key else None,
        )


def _spec(entry: Mapping) -> TableSpec:
    source, ingestion = entry.get("source", {}), entry.get("ingestion", {})
    quality, metadata = entry.get("quality", {}), entry.get("metadata", {})
    name = entry.get("name", "unknown")
    problems = [f"{part} is required" for part in ("name", "source", "ingestion", "metadata") if part not in entry]
    if "type" not in source:
        problems.append("source.type is required")
    if ingestion.get("mode") != SNAPSHOT_MODE:
        problems.append(f"ingestion.mode must be {SNAPSHOT_MODE}")
    if "reference_date" not in ingestion:
        problems.append("ingestion.reference_date is required")
    if "owner" not in metadata:
        problems.append("metadata.owner is required")
    if problems:
        raise ValueError(f"table {name}: " + "; ".join(problems))
    return TableSpec(
        name=name,
        table=source.get("table", name),
        schema=source.get("schema"),
        source_type=source["type"],
        primary_keys=tuple(entry.get("primary_keys", ())),
        partition_column=ingestion.get("partition_column"),
        num_partitions=int(ingestion.get("num_partitions", 1)),
        fetch_size=int(ingestion.get("fetch_size", 10000)),
        reference_date=str(ingestion["reference_date"]),
        row_count_min=quality.get("row_count_min"),
        freshness_hours=quality.get("freshness_hours"),
        domain=metadata.get("domain"),
        owner=metadata["owner"],
        pii=bool(metadata.get("pii", False)),
        retention_days=int(metadata.get("retention_days", DEFAULT_RETENTION_DAYS)),
        null_safe=bool(ingestion.get("null_safe", True)),
        unique_keys=bool(ingestion.get("unique_keys", False)),
    )


def load_specs(config: Mapping) -> list[TableSpec]:
    """The ``bronze_tables`` of a config; an incomplete entry raises ValueError."""
    return [_spec(entry) for entry in config.get("bronze_tables", [])]


def select_specs(specs: Iterable[TableSpec], source_type: str) -> list[TableSpec]:
    return [s for s in specs if s.source_type == source_type]


def transformation_steps(config: Mapping, entity: str) -> Sequence[Mapping]:
    """The silver transformations declared for an entity."""
    return config["silver_transformations"][entity]["transformations"]
