"""Config-driven loading of source tables into staging, in full or by delta."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tillmart.operators.delta import high_water_mark, newer_than, not_older_than
from tillmart.operators.reconcile import differences
from tillmart.operators.versions import current_rows
from tillmart.plans.audit import DONE, FAILED, SKIPPED, Run, counted_write, now, stamped, summary
from tillmart.sources.stores import DEFAULT_FETCH_SIZE, Split, Store, split_from_dict

STAMP_COLUMN = "ingest_timestamp"


@dataclass(frozen=True)
class TableConfig:
    source: str
    target: str
    fields: tuple[str, ...] | None
    load_type: str
    delta_column: str | None = None
    tie_key: str | None = None
    batch_size: int = DEFAULT_FETCH_SIZE
    split: Split | None = None
    target_split: Split | None = None

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> TableConfig:
        """Read one entry of the JSON table configuration."""
        fields = None
        if raw["fields"].strip() != "*":
            fields = tuple(name.strip() for name in raw["fields"].split(","))
        return cls(
            source=_qualified(raw.get("source_schema"), raw["source_table"]),
            target=_qualified(raw.get("target_schema"), raw["target_table"]),
            fields=fields,
            load_type=raw["load_type"].lower(),
            delta_column=raw.get("delta_column"),
            tie_key=raw.get("tie_key"),
            batch_size=int(raw.get("batch_size", DEFAULT_FETCH_SIZE)),
            split=split_from_dict(raw),
            target_split=split_from_dict(raw.get("target_split") or {}),
        )

    @property
    def is_delta(self) -> bool:
        return self.load_type == "delta" and bool(self.delta_column)

    @property
    def mode(self) -> str:
        """Only a full load replaces the target; every other load appends to it."""
        return "overwrite" if self.load_type == "full" else "append"


def _qualified(schema: str | None, table: str) -> str:
    return f"{schema}.{table}" if schema else table


def project(df: DataFrame, fields: Sequence[str] | None) -> DataFrame:
    return df if fields is None else df.select(*fields)


def rows_to_load(source: Store, target: Store, config: TableConfig) -> DataFrame:
    """The projected source rows a load has to write."""
    rows = project(source.read(config.source, config.batch_size, config.split), config.fields)
    if not config.is_delta:
        return rows
    if config.delta_column not in rows.columns:
        raise ValueError(
            f"{config.source}: delta column {config.delta_column!r} is not among the loaded fields"
        )
    marks = target.marks(config.target, config.delta_column)
    if marks is None:
        return rows
    mark = high_water_mark(marks, config.delta_column)
    if config.tie_key:
        if config.tie_key not in rows.columns:
            raise ValueError(
                f"{config.source}: tie key {config.tie_key!r} is not among the loaded fields"
            )
        loaded = target.read(config.target, config.batch_size, config.target_split)
        return not_older_than(rows, loaded, config.delta_column, mark, config.tie_key)
    return newer_than(rows, config.delta_column, mark)


def ingest_table(
    source: Store, target: Store, config: TableConfig, run: Run, reconcile: bool = False
) -> None:
    """Load one table and record what was written.

    `rows_out` is counted by the write. `rows_in` is the size of the source: for a
    load that takes all rows it is the same number; for a delta load, and whenever
    `reconcile` asks for it, the source is counted on its own. `reconcile` also
    counts the target afterwards and puts both counts into the message.
    """
    started = now()
    rows = rows_to_load(source, target, config)
    stamped_rows = stamped(rows, STAMP_COLUMN, run.stamp)
    written = counted_write(
        lambda rows: target.write(stamped_rows, config.target, config.mode, rows=rows)
    )
    rows_in: int | None = None if config.is_delta else written
    message = f"{config.load_type} load, {config.mode}"
    if reconcile:
        rows_in = source.read(config.source, config.batch_size, config.split).count()
        total = target.count(config.target)
        message = f"{message}, source {rows_in}, target {total}"
    run.record(config.target, DONE, started, rows_in, written, message)


def reconcile_rows(
    source: Store, target: Store, config: TableConfig, key: Sequence[str]
) -> DataFrame:
    """The keys in which the target is not what the source says, and how they differ.

    A full load's target must hold the source's rows as they are; of an appended target the
    current row of each key counts, by the delta column, if there is one, and the load's time.
    """
    rows = project(source.read(config.source, config.batch_size, config.split), config.fields)
    loaded = target.read(config.target, config.batch_size, config.target_split)
    if config.mode == "append":
        versions = [c for c in (config.delta_column, STAMP_COLUMN) if c in loaded.columns]
        loaded = current_rows(loaded, key, versions)
    return differences(rows, loaded.drop(STAMP_COLUMN), key)


def pick_configs(
    configs: Iterable[TableConfig], tables: Iterable[str]
) -> list[tuple[str, TableConfig | None]]:
    """Configs of the listed tables, in list order; None where there is none.

    A table is listed as `schema.table`, or by its bare name if only one
    configured table has that name.
    """
    known = list(configs)
    by_name = {config.source: config for config in known}
    by_bare: dict[str, list[TableConfig]] = {}
    for config in known:
        by_bare.setdefault(config.source.rsplit(".", 1)[-1], []).append(config)
    picked = []
    for table in tables:
        config = by_name.get(table)
        if config is None:
            candidates = by_bare.get(table, [])
            if len(candidates) > 1:
                names = ", ".join(candidate.source for candidate in candidates)
                raise ValueError(f"table {table!r} is ambiguous: {names}")
            config = candidates[0] if candidates else None
        picked.append((table, config))
    return picked


def run_ingest(
    spark: SparkSession,
    source: Store,
    target: Store,
    configs: Iterable[TableConfig],
    tables: Iterable[str],
    reconcile: bool = False,
    audit: tuple[Store, str] | None = None,
) -> DataFrame:
    """Load the listed tables in order and return the audit rows.

    A table without a configuration is recorded and passed over. A load that fails
    ends the run, after its row has been recorded.
    """
    run = Run(spark, "ingest")
    try:
        for table, config in pick_configs(configs, tables):
            started = now()
            if config is None:
                run.record(table, SKIPPED, started, message="no configuration")
                continue
            try:
                ingest_table(source, target, config, run, reconcile)
            except Exception as error:
                run.record(config.target, FAILED, started, message=summary(error))
                raise
    finally:
        if audit and run.rows:
            run.save(*audit)
    return run.frame()

