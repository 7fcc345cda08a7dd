"""One audit row per table a job works on."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillmart.schemas import AUDIT
from tillmart.sources.stores import Store

DONE = "DONE"
FAILED = "FAILED"
SKIPPED = "SKIPPED"


@dataclass(frozen=True)
class AuditRow:
    run_id: str
    job: str
    table_name: str
    status: str
    rows_in: int | None
    rows_out: int | None
    started_at: datetime
    ended_at: datetime
    message: str | None


@dataclass
class Run:
    """One run of a job: its id, its single time stamp, and its audit rows."""

    spark: SparkSession
    job: str
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    stamp: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    rows: list[AuditRow] = field(default_factory=list)

    def record(
        self,
        table: str,
        status: str,
        started_at: datetime,
        rows_in: int | None = None,
        rows_out: int | None = None,
        message: str | None = None,
    ) -> None:
        row = AuditRow(
            self.run_id,
            self.job,
            table,
            status,
            rows_in,
            rows_out,
            started_at,
            datetime.now(timezone.utc),
            message,
        )
        self.rows.append(row)

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame([astuple(row) for row in self.rows], AUDIT)

    def save(self, store: Store, table: str) -> None:
        """Append this run's rows to an audit table."""
        store.write(self.frame(), table, "append")

    def each(self, work: Callable[[str], None], tables: Sequence[str], at_once: int) -> None:
        """Work on independent tables, some at a time, and keep the rows in list order.

        Spark shares the cluster among jobs submitted from several threads, so a
        small table does not wait for a large one.
        """
        with ThreadPoolExecutor(max_workers=at_once) as pool:
            list(pool.map(work, tables))
        place = {table: position for position, table in enumerate(tables)}
        self.rows.sort(key=lambda row: place[row.table_name])


def summary(error: Exception) -> str:
    """Kind and first line of an error; the rest may name addresses and logins."""
    return f"{type(error).__name__}: {str(error).splitlines()[0] if str(error) else ''}"


def now() -> datetime:
    return datetime.now(timezone.utc)


def stamped(df: DataFrame, column: str, at: datetime) -> DataFrame:
    """Add an audit time as last column: one value for all rows of a run."""
    return df.withColumn(column, F.lit(at).cast("timestamp"))


def counted_write(write: Callable[[Observation], None]) -> int:
    """Write and return the number of rows written, which the write itself observes."""
    written = Observation()
    write(written)
    return written.get["rows"]
