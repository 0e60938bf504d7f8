"""Contiguous, byte-balanced shards by global prefix sums of document sizes.

Rows are put in order of their id by a range partitioning of (id, size, checksum); each
partition numbers its own rows and sums its own bytes, and the partitions' totals (one row
per partition, so as many as the job has tasks) give every row its global start. Cutting
the byte axis at equal targets then needs no further exchange of rows. A row belongs to
the shard that holds its middle byte, so a shard differs from its target by at most one
document. Any key may repeat: ids only order the rows.

Groups of equal texts have no say: where a text's copies lie is decided by their ids alone,
so they are spread over shards. Null text counts as empty, null ids come first, ids of any
whole-number type are read as long, rows that tie in id, size and checksum are alike and
each get a slot of their own, a text of any length counts by its bytes in the JVM and never
travels, an empty table gives an empty result, and other columns of the input, whatever
their names, play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbrook.scratch import materialize


def _number(batches):
    """Running row number and byte start within the partition."""
    part, rows, done = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        sizes = batch.column("size").to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes) + done
        extra = [pa.array(np.full(len(sizes), part, "int32")), pa.array(np.arange(rows, rows + len(sizes), dtype="int64")), pa.array(ends - sizes)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "part", "row", "start"])
        rows, done = rows + len(sizes), int(ends[-1]) if len(ends) else done


def shard_by_bytes(docs: DataFrame, shards: int = 40, id_column: str = "doc_id", text_column: str = "text", overhead: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, shard (0 to ``shards`` - 1) and slot, gapless from 0 in each shard.

    size is the UTF-8 length of the text plus ``overhead``.
    """
    text = F.encode(F.coalesce(F.col(text_column), F.lit("")), "utf-8")
    sized = docs.select(F.col(id_column).cast("long").alias("doc_id"), (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    keys = ["doc_id", "size", "text_crc32"]
    spark = docs.sparkSession
    ordered = sized.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys)
    schema = "doc_id long, size long, text_crc32 long, part int, row long, start long"
    rows = materialize(ordered.mapInArrow(_number, schema), "shard-rows")

    totals = sorted(rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).collect())
    before, n, total = [], 0, 0
    for part, count, size in totals:
        before.append((part, n, total))
        n, total = n + count, total + size
    offsets = spark.createDataFrame(before, "part int, rows_before long, bytes_before long")
    placed = rows.join(F.broadcast(offsets), "part").select(
        *keys,
        F.least(F.lit(shards - 1), F.expr(f"(2 * (start + bytes_before) + size) * {shards}L div {2 * max(total, 1)}L").cast("int")).alias("shard"),
        (F.col("row") + F.col("rows_before")).alias("position"),
    )
    first = placed.groupBy("shard").agg(F.min("position").alias("first"))  # a row per shard
    return placed.join(F.broadcast(first), "shard").select(*keys, "shard", (F.col("position") - F.col("first")).alias("slot"))
