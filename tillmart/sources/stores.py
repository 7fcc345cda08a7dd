"""Named tables in a folder, in the session catalog, or behind JDBC.

Every store answers to the same four calls: `read`, `find` (None when the table
does not exist yet), `query` and `write`.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.sources.splits import EquiDepth, KeyRange, bounds_sql, ranges_of

DEFAULT_FETCH_SIZE = 10_000
# A database table of at most so many rows may be read by one connection.
SINGLE_CONNECTION_ROWS = 1_000_000

# Formats that keep no types, and the options that make them give back what was written.
TEXT_FORMATS = {
    "csv": {
        "header": "true",
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    },
    "json": {"ignoreNullFields": "false"},
}
# What stands for null in CSV must differ from quoted empty text.
TEXT_READ = {"csv": {"nullValue": "\u0000", "mode": "FAILFAST"}, "json": {"mode": "FAILFAST"}}

# Error conditions and SQL states that mean "no such table".
MISSING_CONDITIONS = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "TABLE_OR_VIEW_NOT_FOUND"}
MISSING_SQL_STATES = {"42P01", "42S02", "42X05"}

class MissingTable(LookupError):
    """The named table does not exist in the store."""


@dataclass(frozen=True)
class ReadSplit:
    """How to cut a JDBC scan into parallel range scans of equal width."""

    column: str
    lower: str
    upper: str
    partitions: int


Split = ReadSplit | EquiDepth


def split_from_dict(raw: Mapping[str, Any]) -> Split | None:
    """`partition_column` and `num_partitions`, with `lower_bound` and `upper_bound` for ranges
    of equal width, without them for parts of equal size, cut along `within` where needed."""
    if not raw.get("partition_column"):
        return None
    parts = int(raw["num_partitions"])
    if raw.get("lower_bound") is None and raw.get("upper_bound") is None:
        return EquiDepth(raw["partition_column"], parts, raw.get("within"))
    return ReadSplit(
        raw["partition_column"], str(raw["lower_bound"]), str(raw["upper_bound"]), parts
    )


class Store:
    spark: SparkSession

    def read(
        self, table: str, fetch_size: int = DEFAULT_FETCH_SIZE, split: Split | None = None
    ) -> DataFrame:
        raise NotImplementedError

    def write(
        self,
        df: DataFrame,
        table: str,
        mode: str,
        partition_by: Sequence[str] = (),
        rows: Observation | None = None,
    ) -> None:
        """Write a table; `rows` is told how many rows the writing tasks wrote."""
        raise NotImplementedError

    def query(self, sql: str, split: Split | None = None) -> DataFrame:
        return self.spark.sql(sql)

    def marks(self, table: str, column: str) -> DataFrame | None:
        """Values of a column whose largest is the largest of the table."""
        return self.find(table)

    def count(self, table: str) -> int:
        return self.read(table).count()

    def find(self, table: str) -> DataFrame | None:
        try:
            return self.read(table)
        except MissingTable:
            return None


class PartStore(Store):
    """A store that can name and remove the parts of a table stored by a column."""

    def parts(self, table: str, column: str) -> list[str]:
        """Values of the column by which the table is stored; none without the table."""
        raise NotImplementedError

    def drop_part(self, table: str, column: str, value: str) -> None:
        raise NotImplementedError


class OneValue(str):
    """A column a table is stored by of which the rows to be written have one value: they are
    written as they lie, since gathering them by it would shuffle them for nothing."""


def _gathered(df: DataFrame, columns: Sequence[str], number: int | None = None) -> DataFrame:
    """Gather rows by the columns a table is stored by, so that a task writes few files.

    The rebalance hint lets adaptive execution cut a value that holds much of the
    data into several tasks, and merge small ones.
    """
    columns = [name for name in columns if not isinstance(name, OneValue)]
    if not columns:
        return df
    return df.hint("rebalance", *([number] if number else []), *columns)


def _observed(df: DataFrame, rows: Observation | None) -> DataFrame:
    """Count the rows as they are written, after any gathering: a map stage that runs again
    for a lost executor would count again."""
    return df.observe(rows, F.count(F.lit(1)).alias("rows")) if rows else df


@dataclass
class FolderStore(PartStore):
    """One folder or file per table: `schema.table` is stored as `root/schema/table`,
    followed by `suffix` if the files carry one.

    CSV and JSON keep no types, so tables in these formats need an entry in `schemas`.
    """

    spark: SparkSession
    root: str
    format: str = "parquet"
    suffix: str = ""
    schemas: Mapping[str, T.StructType] = field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table.replace('.', '/')}{self.suffix}"

    def read(
        self, table: str, fetch_size: int = DEFAULT_FETCH_SIZE, split: Split | None = None
    ) -> DataFrame:
        reader = self.spark.read.format(self.format)
        if self.format in TEXT_FORMATS:
            options = TEXT_FORMATS[self.format] | TEXT_READ[self.format]
            reader = reader.schema(self._schema(table)).options(**options)
        try:
            return reader.load(self.path(table))
        except AnalysisException as error:
            if error.getCondition() in MISSING_CONDITIONS:
                raise MissingTable(table) from error
            raise

    def _schema(self, table: str) -> T.StructType:
        if table not in self.schemas:
            raise ValueError(f"{table}: a table stored as {self.format} needs a schema")
        return self.schemas[table]

    def write(
        self,
        df: DataFrame,
        table: str,
        mode: str,
        partition_by: Sequence[str] = (),
        rows: Observation | None = None,
    ) -> None:
        gathered = _observed(_gathered(df, partition_by), rows)
        writer = gathered.write.format(self.format).mode(mode)
        if self.format in TEXT_FORMATS:
            wanted = [(f.name, f.dataType) for f in self._schema(table)]
            if [(f.name, f.dataType) for f in df.schema] != wanted:
                raise ValueError(f"{table}: the rows do not have the schema of the table")
            writer = writer.options(**TEXT_FORMATS[self.format])
        elif self.format in ("parquet", "orc"):
            writer = writer.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(self.path(table))

    def _files(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def parts(self, table: str, column: str) -> list[str]:
        path, files = self._files(self.path(table))
        if not files.exists(path):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path)]
        return sorted(name.split("=", 1)[1] for name in names if name.startswith(f"{column}="))

    def drop_part(self, table: str, column: str, value: str) -> None:
        path, files = self._files(f"{self.path(table)}/{column}={value}")
        files.delete(path, True)

    def register(self, *tables: str) -> None:
        """Make tables known to SQL text under their own names, with schema if any.

        A view with a schema stays in the catalog, and later runs replace it; runs that may
        meet in one catalog use `registered`.
        """
        for table in tables:
            if "." not in table:
                self.read(table).createOrReplaceTempView(table)
                continue
            self._create_view(table, table, "CREATE OR REPLACE VIEW")

    def _create_view(self, table: str, name: str, create: str) -> None:
        if self.format in TEXT_FORMATS:
            raise ValueError(f"{table}: SQL text would not know its types as {self.format}")
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
        self.spark.sql(f"{create} {name} AS SELECT * FROM {self.format}.`{self.path(table)}`")

    @contextmanager
    def registered(self, *tables: str, schema: str | None = None) -> Iterator[None]:
        """Names for SQL text that last as long as the block; with `schema`, under that schema
        instead of their own. A name that the catalog holds already is an error, so that a run
        never reads what another one staged."""
        wanted = {table: f"{schema}.{table.rsplit('.', 1)[-1]}" if schema else table for table in tables}
        schemas = sorted({name.rsplit(".", 1)[0] for name in wanted.values()})
        new = [name for name in schemas if not self.spark.catalog.databaseExists(name)]
        made: list[str] = []
        try:
            for table, name in wanted.items():
                self._create_view(table, name, "CREATE VIEW")
                made.append(name)
            yield
        finally:
            for name in made:
                self.spark.sql(f"DROP VIEW IF EXISTS {name}")
            for name in new:
                if all(held.isTemporary for held in self.spark.catalog.listTables(name)):
                    self.spark.sql(f"DROP SCHEMA IF EXISTS {name}")


@dataclass
class CatalogStore(PartStore):
    """Tables of the session catalog.

    `buckets` maps a table to (column, number): the table is then written
    bucketed, and joins of two tables bucketed alike read them without a shuffle. A
    bucket is read by one task, so bucket only by keys that hold few rows each.
    """

    spark: SparkSession
    root: str | None = None
    buckets: dict[str, tuple[str, int]] = field(default_factory=dict)

    def read(
        self, table: str, fetch_size: int = DEFAULT_FETCH_SIZE, split: Split | None = None
    ) -> DataFrame:
        try:
            return self.spark.table(table)
        except AnalysisException as error:
            if error.getCondition() in MISSING_CONDITIONS:
                raise MissingTable(table) from error
            raise

    def write(
        self,
        df: DataFrame,
        table: str,
        mode: str,
        partition_by: Sequence[str] = (),
        rows: Observation | None = None,
    ) -> None:
        if "." in table:
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.rsplit('.', 1)[0]}")
        bucket = self.buckets.get(table)
        if bucket and not partition_by:
            df = _gathered(df, [bucket[0]], bucket[1])
        else:
            df = _gathered(df, partition_by)
        writer = _observed(df, rows).write.mode(mode).format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if bucket:
            column, number = bucket
            writer = writer.bucketBy(number, column).sortBy(column)
        if self.root:
            writer = writer.option("path", f"{self.root.rstrip('/')}/{table.replace('.', '/')}")
        writer.saveAsTable(table)

    def parts(self, table: str, column: str) -> list[str]:
        if not self.spark.catalog.tableExists(table):
            return []
        rows = self.spark.sql(f"SHOW PARTITIONS {table}").collect()
        return sorted(row["partition"].split(f"{column}=", 1)[1] for row in rows)

    def drop_part(self, table: str, column: str, value: str) -> None:
        self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = '{value}')")


@dataclass
class JdbcStore(Store):
    """Tables of a relational database. Credentials come from the caller and are
    kept out of `repr`, so that they do not end up in logs.

    A table is scanned by several connections as its split says, which is given with the call
    or in `splits`. Without one it is read by a single connection, and refused if it holds more
    than SINGLE_CONNECTION_ROWS rows. A query without a split is a single connection as well.
    """

    spark: SparkSession
    url: str = field(repr=False)
    user: str = field(repr=False)
    password: str = field(repr=False)
    driver: str
    batch_size: int = DEFAULT_FETCH_SIZE
    splits: Mapping[str, Split] = field(default_factory=dict)
    write_connections: int = 16

    def _login(self) -> dict[str, str]:
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
        }

    def read_options(
        self, relation: str, fetch_size: int, split: ReadSplit | None
    ) -> dict[str, str]:
        options = self._login() | {"dbtable": relation, "fetchsize": str(fetch_size)}
        if split:
            options |= {
                "partitionColumn": split.column,
                "lowerBound": split.lower,
                "upperBound": split.upper,
                "numPartitions": str(split.partitions),
            }
        return options

    def read(
        self, table: str, fetch_size: int = DEFAULT_FETCH_SIZE, split: Split | None = None
    ) -> DataFrame:
        split = split or self.splits.get(table)
        if isinstance(split, EquiDepth):
            return self._load_parts(table, fetch_size, self.key_ranges(table, split))
        if split is None and self.count(table) > SINGLE_CONNECTION_ROWS:
            raise ValueError(f"{table}: a scan of so many rows over JDBC needs a split")
        return self._load(table, self.read_options(table, fetch_size, split))

    def key_ranges(self, table: str, wanted: EquiDepth) -> list[KeyRange]:
        """Ranges of equal size, found by the database; one value that is too large for a range
        is cut along `within`."""
        ranges = ranges_of(wanted.column, self._bounds(table, wanted.column, wanted.parts))
        if wanted.within is None:
            return ranges
        even = -(-self.count(table) // wanted.parts)
        cut: list[KeyRange] = []
        for held in ranges:
            rows = f"(SELECT * FROM {table} WHERE {held.sql()}) AS held"
            parts = -(-self.count(rows) // max(1, even))
            bounds = self._bounds(rows, wanted.within, parts) if parts > 1 else []
            cut += [
                KeyRange(held.column, held.lower, held.upper, held.nulls, inside)
                for inside in ranges_of(wanted.within, bounds)
            ] if parts > 1 else [held]
        return cut

    def _bounds(self, relation: str, column: str, parts: int) -> list[Any]:
        return [row[0] for row in self.query(bounds_sql(relation, column, parts)).collect()]

    def _load_parts(self, table: str, fetch_size: int, ranges: Sequence[KeyRange]) -> DataFrame:
        login = self._login()
        url = login.pop("url")
        properties = login | {"fetchsize": str(fetch_size)}
        try:
            return self.spark.read.jdbc(
                url, table, predicates=[held.sql() for held in ranges], properties=properties
            )
        except (AnalysisException, Py4JJavaError) as error:
            if _sql_state(self.spark, error) in MISSING_SQL_STATES:
                raise MissingTable(table) from error
            raise

    def _load(self, table: str, options: dict[str, str]) -> DataFrame:
        try:
            return self.spark.read.format("jdbc").options(**options).load()
        except (AnalysisException, Py4JJavaError) as error:
            if _sql_state(self.spark, error) in MISSING_SQL_STATES:
                raise MissingTable(table) from error
            raise

    def query(self, sql: str, split: Split | None = None) -> DataFrame:
        """The database evaluates the statement; Spark sees its result."""
        relation = f"({sql}) AS src"
        if isinstance(split, EquiDepth):
            return self._load_parts(relation, DEFAULT_FETCH_SIZE, self.key_ranges(relation, split))
        return self._load(sql, self.read_options(relation, DEFAULT_FETCH_SIZE, split))

    def marks(self, table: str, column: str) -> DataFrame | None:
        try:
            return self.query(f"SELECT MAX({column}) AS {column} FROM {table}")
        except MissingTable:
            return None

    def count(self, table: str) -> int:
        return self.query(f"SELECT COUNT(*) AS n FROM {table}").first()[0]

    def write_options(self, table: str) -> dict[str, str]:
        return self._login() | {
            "dbtable": table,
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.write_connections),
        }

    def write(
        self,
        df: DataFrame,
        table: str,
        mode: str,
        partition_by: Sequence[str] = (),
        rows: Observation | None = None,
    ) -> None:
        if partition_by:
            raise ValueError(f"{table}: a database table is not stored by {list(partition_by)}")
        zoned = _observed(zone_timestamps(df), rows)
        zoned.write.format("jdbc").options(**self.write_options(table)).mode(mode).save()


def zone_timestamps(df: DataFrame) -> DataFrame:
    """Wall-clock columns as instants of the session zone, for sinks that need them."""
    return df.withColumns(
        {
            column.name: F.col(f"`{column.name}`").cast("timestamp")
            for column in df.schema
            if isinstance(column.dataType, T.TimestampNTZType)
        }
    )


def _sql_state(spark: SparkSession, error: Exception) -> str | None:
    """SQL state of the first SQLException among the Java causes, if there is one."""
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None:
        if is_instance_of(spark.sparkContext._gateway, cause, "java.sql.SQLException"):
            return cause.getSQLState()
        cause = cause.getCause()
    return None
