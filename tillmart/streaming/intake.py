"""Continuous intake of raw payload files into the sales tables."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tillmart.operators.sketches import Sketched, bitmaps_for, key_sketch, parts_that_may_hold
from tillmart.sources.payloads import (
    acknowledgments,
    normalize_payloads,
    parse_payloads,
    payload_digest,
    sale_headers,
    sale_items,
    sent_sales,
)
from tillmart.sources.scratch import passing_dir, passing_shuffles
from tillmart.sources.stores import (
    DEFAULT_FETCH_SIZE,
    MissingTable,
    OneValue,
    PartStore,
    ReadSplit,
    Store,
)

BATCH = "intake_batch"
GENERATION = "generation"
SUPERSEDED = "superseded"

SALE, REJECT, COPY = "sale", "reject", "copy"

PAYLOADS_PER_FILE = 200_000

COMMITS = (
    f"batch string, level int, sale_keys long, reject_keys long, is_live boolean, {GENERATION} int"
)


@dataclass(frozen=True)
class Batch:
    """A committed batch, or several that were rewritten as one of a higher level."""

    batch: str
    level: int
    sale_keys: int
    reject_keys: int


@dataclass
class SalesIntake:
    """Where accepted sales, their lines, acknowledgments and rejects go.

    Every batch writes its rows of all tables under a name of its own, and is committed by one
    row written last; `read` shows rows of committed batches only, so a batch is seen in all
    tables or in none. A later batch asks the sketches of the committed ones which of them may
    hold its keys, and reads only those. `merge_at` batches of one level are rewritten as one
    of the next, so there are fewer than `merge_at` batches of each level. There must be one
    intake at a time for a store.
    """

    store: PartStore
    sales_table: str = "sales_transactions.sales"
    items_table: str = "sales_transactions.sales_items"
    acks_table: str = "sales_transactions.acknowledgments"
    rejects_table: str = "sales_transactions.rejected_payloads"
    choices_table: str = "sales_transactions.chosen_payloads"
    sketches_table: str = "sales_transactions.intake_sketches"
    commits_table: str = "sales_transactions.intake_commits"
    merge_at: int = 8

    @property
    def row_tables(self) -> list[str]:
        return [
            self.items_table, self.sales_table, self.acks_table, self.choices_table, self.rejects_table,
        ]

    # --- what is committed ---------------------------------------------------------

    def _log(self) -> tuple[int, list[Batch]]:
        """The newest generation of the log, and the batches that are live in it."""
        log = self.store.find(self.commits_table)
        if log is None:
            return 0, []
        newest = max(map(int, self.store.parts(self.commits_table, GENERATION)), default=0)
        rows = log.filter((F.col(GENERATION) == newest) & F.col("is_live")).collect()
        return newest, [Batch(r["batch"], r["level"], r["sale_keys"], r["reject_keys"]) for r in rows]

    def batches(self) -> list[Batch]:
        """The committed batches, after rewriting."""
        return self._log()[1]

    def find(self, table: str) -> DataFrame | None:
        """The rows of committed batches; None before the first of them."""
        return self._rows_of(table, [b.batch for b in self.batches()])

    def _rows_of(self, table: str, batches: Sequence[str]) -> DataFrame | None:
        stored = self.store.find(table) if batches else None
        return None if stored is None else stored.filter(F.col(BATCH).isin(list(batches))).drop(BATCH)

    def read(self, table: str) -> DataFrame:
        found = self.find(table)
        if found is None:
            raise MissingTable(table)
        return found

    def committed(self) -> CommittedStore:
        """The store as later jobs should read it."""
        return CommittedStore(self.store.spark, self)

    # --- taking in a batch ----------------------------------------------------------

    def take(self, raw: DataFrame) -> None:
        """Take in a batch of payload texts.

        A payload is identified by its digest: exact copies are replays and add nothing. One
        payload is chosen for each sale, and a sale once committed keeps its choice. Payloads
        that cannot be read, and those not chosen, now or later, go to the rejects with the
        reason. So every payload is a sale, a copy, or a reject. A batch that breaks off leaves
        nothing to be seen, and is taken again from the start.

        The batch is read twice, and must give the same texts again. Everything is decided on
        keys, a few bytes a payload; the second reading parses what is to be written, and texts
        are shuffled only if some are copies, rejects, or of known sales. What is used more than
        once lies in files of a passing folder: executors hold nothing between their tasks.
        """
        live = self.batches()
        spark = self.store.spark
        # A stream has a session of its own.
        with (
            passing_dir(spark, "intake-batch") as folder,
            passing_shuffles(spark),
            passing_shuffles(raw.sparkSession),
        ):
            kept = itertools.count()

            def keep(df: DataFrame) -> DataFrame:
                at = f"{folder}/{next(kept)}"
                df.write.option("compression", "zstd").parquet(at)
                return spark.read.schema(df.schema).parquet(at)

            told, alone = self._told(raw.select("value"), live, keep)
            counts = {row["fate"]: row["rows"] for row in _counted(told, "fate").collect()}
            sales, rejects = counts.get(SALE, 0) + alone, counts.get(REJECT, 0)
            if sales or rejects:
                rows = keep(_fated(raw.select("value"), told if counts else None))
                self._write_batch(rows, sales, rejects)
        with passing_shuffles(spark):
            self._merge_small()

    def _told(
        self, raw: DataFrame, live: Sequence[Batch], keep: Callable[[DataFrame], DataFrame]
    ) -> tuple[DataFrame, int]:
        """`payload_digest, fate, reject_reason` of the payloads that are not the only one of a
        new sale, and how many are."""
        key = "transaction_id"
        parsed = normalize_payloads(parse_payloads(raw))
        keys = keep(parsed.select(key, "transaction_date", "reject_reason", _digest()))
        good = keys.filter(F.col("reject_reason").isNull())
        sent = keep(sent_sales(good).withColumnRenamed("payload_digest", "chosen"))
        committed = self._held(sent, key, self.choices_table, SALE, live)
        choices = sent.withColumn("is_new", F.lit(True))
        if committed is not None:
            known = committed.select(key, F.unhex("payload_digest").alias("known"))
            choices = keep(
                sent.join(known, key, "left").select(
                    key,
                    F.coalesce("known", "chosen").alias("chosen"),
                    "payloads",
                    F.col("known").isNull().alias("is_new"),
                )
            )
        is_alone = F.col("is_new") & (F.col("payloads") == 1)
        found = choices.agg(F.count(F.lit(1)).alias("sales"), F.count_if(is_alone).alias("alone")).first()
        alone = found["alone"]
        is_chosen = F.col("payload_digest") == F.col("chosen")
        shared = (
            good.select(key, "payload_digest")
            .join(choices.filter(~is_alone).select(key, "chosen", "is_new"), key)
            .select(
                key,
                "payload_digest",
                F.when(~is_chosen, REJECT).when(F.col("is_new"), SALE).otherwise(COPY).alias("fate"),
                F.when(~is_chosen, F.lit(SUPERSEDED)).alias("reject_reason"),
            )
            .distinct()
            .drop(key)
        )
        bad = keys.filter(F.col("reject_reason").isNotNull()).select(
            "payload_digest", F.lit(REJECT).alias("fate"), "reject_reason"
        )
        bad = bad.distinct()
        # Without shared sales their join would shuffle all keys to find none.
        told = keep(shared.unionByName(bad) if alone < found["sales"] else bad)
        rejects = told.filter(F.col("fate") == REJECT).select(_hex("payload_digest"))
        seen = self._held(rejects, "payload_digest", self.rejects_table, REJECT, live)
        if seen is None:
            return told, alone
        seen = seen.select(F.unhex("payload_digest").alias("payload_digest"), F.lit(True).alias("is_seen"))
        is_copy = (F.col("fate") == REJECT) & F.col("is_seen")
        fate = F.when(is_copy, COPY).otherwise(F.col("fate")).alias("fate")
        told = told.join(seen, "payload_digest", "left")
        return keep(told.select("payload_digest", fate, "reject_reason")), alone

    def _held(
        self, rows: DataFrame, key: str, table: str, kind: str, live: Sequence[Batch]
    ) -> DataFrame | None:
        """Rows of a stored table in the batches that may hold a key of `rows`."""
        sizes = {b.batch: b.sale_keys if kind == SALE else b.reject_keys for b in live}
        parts = [Sketched(batch, bitmaps_for(keys)) for batch, keys in sizes.items() if keys]
        stored = self.store.find(self.sketches_table) if parts else None
        if stored is None:
            return None
        sketches = stored.filter(F.col("kind") == kind).withColumnRenamed(BATCH, "part")
        near = parts_that_may_hold(rows, key, sketches, parts)
        return self._rows_of(table, near)

    def _write_batch(self, fated: DataFrame, sale_keys: int, reject_keys: int) -> None:
        name = f"b{uuid.uuid4().hex}"
        sales = fated.filter(F.col("fate") == SALE).coalesce(_files(sale_keys))
        rejects = fated.filter(F.col("fate") == REJECT).coalesce(_files(reject_keys))
        if sale_keys:
            self._write(sale_items(sales), self.items_table, name)
            self._write(sale_headers(sales), self.sales_table, name)
            self._write(acknowledgments(sales), self.acks_table, name)
            self._write(sales.select("transaction_id", "payload_digest"), self.choices_table, name)
        if reject_keys:
            self._write(rejects.select("payload_digest", "reject_reason", "raw"), self.rejects_table, name)
        self._write_sketches(sales, rejects, name, sale_keys, reject_keys)
        generation, _ = self._log()
        self._commit([Batch(name, 0, sale_keys, reject_keys)], [], generation)

    def _write(self, rows: DataFrame, table: str, batch: str) -> None:
        self.store.write(rows.withColumn(BATCH, F.lit(batch)), table, "append", [OneValue(BATCH)])

    def _write_sketches(
        self, sales: DataFrame, rejects: DataFrame, batch: str, sale_keys: int, reject_keys: int
    ) -> None:
        kinds = [(SALE, sales, "transaction_id", sale_keys), (REJECT, rejects, "payload_digest", reject_keys)]
        sketches = [
            key_sketch(rows, key, bitmaps_for(keys)).withColumn("kind", F.lit(kind))
            for kind, rows, key, keys in kinds
            if keys
        ]
        whole = sketches[0] if len(sketches) == 1 else sketches[0].unionByName(sketches[1])
        self._write(whole.coalesce(_files(sale_keys + reject_keys)), self.sketches_table, batch)

    def _commit(self, live: Sequence[Batch], replaced: Sequence[str], generation: int) -> None:
        """One file of rows of the log; with it the batches are there, or no longer."""
        rows = [(b.batch, b.level, b.sale_keys, b.reject_keys, True, generation) for b in live]
        rows += [(name, 0, 0, 0, False, generation) for name in replaced]
        log = self.store.spark.createDataFrame(rows, COMMITS).coalesce(1)
        self.store.write(log, self.commits_table, "append", [OneValue(GENERATION)])

    # --- keeping the tables compact ---------------------------------------------------

    def _merge_small(self) -> None:
        """Rewrite batches as one wherever a level has `merge_at` of them.

        The new log names what is live and what it replaces. Replaced rows and the log before
        stay until the next rewriting, for readers that have begun; all older parts, and those
        of batches that broke off, are removed.
        """
        generation, live = self._log()
        small: list[Batch] = []
        level = 0
        while len(near := [b for b in live if b.level == level]) + bool(small) >= self.merge_at:
            small += near
            level += 1
        if not small:
            return
        live = [b for b in live if b not in small] + [self._merged(small, level)]
        replaced = [b.batch for b in small]
        self._commit(live, replaced, generation + 1)
        kept = {b.batch for b in live} | set(replaced)
        for table in [*self.row_tables, self.sketches_table]:
            for part in self.store.parts(table, BATCH):
                if part not in kept:
                    self.store.drop_part(table, BATCH, part)
        for part in self.store.parts(self.commits_table, GENERATION):
            if int(part) < generation:
                self.store.drop_part(self.commits_table, GENERATION, part)

    def _merged(self, small: Sequence[Batch], level: int) -> Batch:
        old = [b.batch for b in small]
        name = f"m{uuid.uuid4().hex}"
        found = {table: self._rows_of(table, old) for table in self.row_tables}
        merged = Batch(
            name, level, sum(b.sale_keys for b in small), sum(b.reject_keys for b in small)
        )
        for table, rows in found.items():
            if rows is not None:
                keys = merged.reject_keys if table == self.rejects_table else merged.sale_keys
                self._write(rows.coalesce(_files(keys)), table, name)
        self._write_sketches(
            found[self.choices_table], found[self.rejects_table], name, merged.sale_keys, merged.reject_keys
        )
        return merged

    def start(
        self,
        spark: SparkSession,
        payload_dir: str,
        checkpoint_dir: str,
        files_per_batch: int | None = None,
        once: bool = True,
    ) -> StreamingQuery:
        """Follow a folder of payload files, one JSON document per line.

        `once` takes what is there now and stops; otherwise the query goes on.
        """
        reader = spark.readStream.format("text")
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        writer = (
            reader.load(payload_dir)
            .writeStream.foreachBatch(lambda batch, _: self.take(batch))
            .option("checkpointLocation", checkpoint_dir)
        )
        if once:
            writer = writer.trigger(availableNow=True)
        return writer.start()


def _files(keys: int) -> int:
    """Files for the rows of so many payloads. Rows of a batch lie in its tasks already, so they
    are joined to larger tasks without a shuffle."""
    return max(1, -(-keys // PAYLOADS_PER_FILE))


def _digest() -> Column:
    """The digest in half the bytes of its text, for shuffles."""
    return F.unhex(payload_digest()).alias("payload_digest")


def _hex(digest: str) -> Column:
    return F.lower(F.hex(digest)).alias(digest)


def _fated(raw: DataFrame, told: DataFrame | None) -> DataFrame:
    """The payloads to be written, parsed, with their fate and the reason of rejects.

    Without `told` all are sales. Otherwise copies are taken out as texts: equal ones of a task
    go to the shuffle once.
    """
    nothing = F.lit(None).cast("string")
    if told is None:
        texts = raw.select("value", nothing.alias("fate"), nothing.alias("told_reason"))
    else:
        digest = F.unhex(F.sha2("value", 256)).alias("payload_digest")
        texts = (
            raw.groupBy(digest)
            .agg(F.first("value").alias("value"))
            .join(told.withColumnRenamed("reject_reason", "told_reason"), "payload_digest", "left")
            .filter(F.coalesce("fate", F.lit(SALE)) != COPY)
        )
    names = ["fate", "told_reason"]
    rows = normalize_payloads(parse_payloads(texts, kept=names), kept=names)
    own = F.when(F.col("reject_reason").isNull(), SALE).otherwise(REJECT)
    rows = rows.withColumns(
        {
            "fate": F.coalesce("fate", own),
            "reject_reason": F.coalesce("told_reason", "reject_reason"),
            "payload_digest": payload_digest(),
        }
    )
    # What is not written is not kept either: the text of a sale, the lines of a reject.
    is_sale = F.col("fate") == SALE
    return rows.drop("told_reason").withColumns(
        {"raw": F.when(~is_sale, F.col("raw")), "items": F.when(is_sale, F.col("items"))}
    )


def _counted(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


@dataclass
class CommittedStore(Store):
    """The tables of an intake, with the rows of committed batches only; for reading."""

    spark: SparkSession
    intake: SalesIntake = field(repr=False)

    def read(
        self, table: str, fetch_size: int = DEFAULT_FETCH_SIZE, split: ReadSplit | None = None
    ) -> DataFrame:
        return self.intake.read(table)

    def write(
        self,
        df: DataFrame,
        table: str,
        mode: str,
        partition_by: Sequence[str] = (),
        rows: Observation | None = None,
    ) -> None:
        raise ValueError(f"{table}: tables of an intake are written by the intake")
