"""Checkpointed micro-batch ingestion: documents -> records -> valid and invalid tables."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkbrook import models
from sparkbrook.operators import clean
from sparkbrook.operators.chain import run_chain
from sparkbrook.operators.shape import explode_records
from sparkbrook.operators.split import Split, has_all, split_required
from sparkbrook.scratch import read_text
from sparkbrook.sources.store import Batch, TableStore

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class BatchReport:
    batch: str
    records: int
    valid: int
    invalid: int
    failures: tuple[str, ...] = ()
    skipped: tuple[str, ...] = ()  # tables that had the batch already


@dataclass
class Ingest:
    """What one batch goes through, and where it ends up.

    lenient: keep the stream alive when a write fails and note the failure in the report;
        otherwise the failure stops the query before the batch counts as done.
    now: replaces the clock.
    corrupt_column: holds the text of documents that couldn't be parsed, if the input has
        it; such a text becomes an invalid record.
    table_schema: what both tables are created with before the first batch.
    """

    store: TableStore
    valid_table: str = "records"
    invalid_table: str = "records_invalid"
    records_column: str = "hotels"
    mandatory: Sequence[str] = models.MANDATORY_FIELDS
    address: Sequence[str] = models.ADDRESS_FIELDS
    lenient: bool = False
    now: Column | None = None
    corrupt_column: str | None = None
    table_schema: T.StructType = field(default_factory=models.bronze_schema)
    reports: list[BatchReport] = field(default_factory=list)

    def prepare(self) -> None:
        """Both tables, empty where they aren't there yet, so that readers find them whatever the input holds."""
        for table in (self.valid_table, self.invalid_table):
            self.store.create(table, schema=self.table_schema)

    def flatten(self, documents: DataFrame) -> DataFrame:
        if self.corrupt_column not in documents.columns:
            return explode_records(documents, self.records_column, raw_column=models.RAW_COLUMN)
        records = explode_records(documents, self.records_column, raw_column=models.RAW_COLUMN, keep=(self.corrupt_column,))
        return records.withColumn(models.RAW_COLUMN, F.coalesce(F.col(f"`{self.corrupt_column}`"), models.RAW_COLUMN)).drop(self.corrupt_column)

    def polish(self, valid: DataFrame) -> DataFrame:
        """Address, lower case, time, defaults: in this order, which decides the results."""
        return run_chain(
            valid,
            (
                lambda df: clean.combine_address(df, self.address),
                lambda df: clean.lowercase_strings(df, exclude=(models.RAW_COLUMN,)),
                lambda df: clean.stamp_time(df, self.now),
                lambda df: clean.fill_defaults(df, keep=self.mandatory, now=self.now),
            ),
        )

    def split(self, documents: DataFrame) -> Split:
        """The two output frames of a batch of documents, without writing them."""
        return self._outputs(self.flatten(documents))

    def _outputs(self, records: DataFrame) -> Split:
        parts = split_required(records, self.mandatory)
        return Split(self.polish(parts.valid), clean.stamp_time(parts.invalid, self.now))

    def run_batch(self, documents: DataFrame, batch: Batch) -> BatchReport | None:
        """Writes both parts once each; a batch that is in a table already is not added again, and the report says so."""
        self.prepare()
        if documents.isEmpty():
            return None
        records = self.flatten(documents).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            total, valid = records.agg(F.count(F.lit(1)), F.count_if(has_all(self.mandatory))).first()
            failures, skipped = [], []
            for table, frame in zip((self.valid_table, self.invalid_table), self._outputs(records), strict=True):
                try:
                    if self.store.committed(table, batch):
                        skipped.append(table)
                    else:
                        self.store.write(table, frame, batch=batch)
                except Exception as error:
                    if not self.lenient:
                        raise
                    log.exception("batch %s was not written to %s", batch, table)
                    failures.append(f"{table}: {error}")
            report = BatchReport(batch if isinstance(batch, str) else f"{batch[0]}-{batch[1]}", total, valid, total - valid, tuple(failures), tuple(skipped))
            self.reports.append(report)
            return report
        finally:
            records.unpersist()


def run_stream(stream: DataFrame, ingest: Ingest, checkpoint: str, name: str = "ingest", wait: bool = True, on_start: Callable[[StreamingQuery], None] | None = None) -> StreamingQuery:
    """Runs everything that is there now through ``ingest`` and stops.

    The checkpoint is mandatory: with it a rerun reads new files only, and batch numbers in
    the tables' manifests keep a repeated batch from being written twice. They count for
    the stream that the checkpoint names, so another source, or a checkpoint made anew,
    starts from the first batch without being taken for a repetition.
    """
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint folder")
    ingest.prepare()
    names: list[str] = []

    def run(df: DataFrame, number: int) -> None:
        if not names:
            names.append(json.loads(read_text(df.sparkSession, f"{checkpoint}/metadata"))["id"])
        ingest.run_batch(df, (f"{name}-{names[0]}", number))

    query = (
        stream.writeStream.queryName(name)
        .foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if on_start:
        on_start(query)
    if wait:
        try:
            query.awaitTermination()
        finally:
            query.stop()
    return query


def console(df: DataFrame, rows: int = 20) -> StreamingQuery | None:
    """Rows as text on the driver's output: a frame's first ones at once, a stream's batch by batch."""
    if df.isStreaming:
        return df.writeStream.format("console").option("numRows", rows).option("truncate", "false").outputMode("append").start()
    df.show(rows, truncate=False)
    return None
