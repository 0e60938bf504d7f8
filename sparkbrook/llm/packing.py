"""Vector best-fit packing of token sequences, over a histogram of lengths.

Pieces of one length are interchangeable, so the corpus enters the packing as one count
per length, at most ``capacity`` numbers however many documents there are. Best-fit
decreasing runs over those counts on the driver, a whole group of equal bins at a time:
bins carry a vector of residual capacities (tokens, documents, attention cost), a piece
goes into the fitting bin with the best score, and a bin fits only if every capacity
holds. The outcome is a list of (length, first and last rank, bin and place), whose size
depends on the number of lengths and not on the corpus. Ranks of pieces within their
length are counted in hash buckets, so that a length that a third of all pieces share is
numbered in many tasks; a lookup by (length, rank) then gives every piece its bin.

Scores: ``dot`` takes the bin with the smallest weighted dot product of residual and
demand, ``norm`` the one whose weighted residual after the piece has the smallest norm;
of equal ones the oldest bin.

Null text counts as empty, and its one piece is the end id; null ids are ids like others;
repeated rows are pieces of their own, spread over hash buckets by a number that is written
with them; very long texts are cut and lose nothing; an empty table gives an empty result;
further columns of documents, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbrook.llm import tokens
from sparkbrook.llm.memory import returning
from sparkbrook.scratch import materialize


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds: tokens, pieces of documents, and the sum of squared lengths."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.05, 0.2)
    score: str = "norm"

    def demand(self, length: int) -> tuple[int, int, int]:
        return length, 1, length * length

    @property
    def full(self) -> tuple[int, int, int]:
        return self.tokens, self.documents, self.attention

    def rate(self, residual: tuple[int, ...], demand: tuple[int, ...]) -> float:
        """Smaller is better."""
        parts = [(w, r / c, d / c) for w, r, d, c in zip(self.weights, residual, demand, self.full, strict=True) if c]
        if self.score == "dot":
            return sum(w * r * d for w, r, d in parts)
        return sum(w * (r - d) ** 2 for w, r, d in parts)


def plan_bins(histogram: dict[int, int], capacity: Capacity = Capacity()) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, count, first bin, offset): ``count`` pieces of a length, from a
    rank on, go one each into consecutive bins, at one offset.

    Lengths over a capacity raise ValueError. Among bins of equal score the oldest is taken.
    """
    rows: list[tuple[int, int, int, int, int]] = []
    # bins with equal residuals: residual -> list of (first bin, count), consecutive numbers
    states: dict[tuple[int, int, int], list[list[int]]] = {}
    bins = 0
    for length in sorted(histogram, reverse=True):
        left, rank, need = histogram[length], 0, capacity.demand(length)
        if left and any(d > c for d, c in zip(need, capacity.full, strict=True)):
            raise ValueError(f"a piece of {length} tokens exceeds a capacity")
        fits = lambda state: all(r >= d for r, d in zip(state, need, strict=True))  # noqa: B023, E731
        queue = [(capacity.rate(s, need), runs[0][0], s) for s, runs in states.items() if runs and fits(s)]
        heapq.heapify(queue)
        while left:
            if not queue:  # open bins: each takes one piece, and then waits as a state of its own
                per = min(c // d if d else left for c, d in zip(capacity.full, need, strict=True))
                fresh = -(-left // per)
                state = capacity.full
                states.setdefault(state, []).append([bins, fresh])
                bins += fresh
                queue.append((capacity.rate(state, need), states[state][0][0], state))
            _, _, state = heapq.heappop(queue)
            runs = states[state]
            after = tuple(r - d for r, d in zip(state, need, strict=True))
            known = after in states and bool(states[after])
            while runs and left:
                first, count = runs[0]
                used = min(count, left)
                rows.append((length, rank, used, first, capacity.tokens - state[0]))
                states.setdefault(after, []).append([first, used])
                rank, left = rank + used, left - used
                if used == count:
                    runs.pop(0)
                else:
                    runs[0] = [first + used, count - used]
            if not runs:
                del states[state]
            if left and fits(after) and not known:
                heapq.heappush(queue, (capacity.rate(after, need), states[after][0][0], after))
    return rows


def tokenized_pieces(docs: DataFrame, vocabulary: str, limit: int, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pieces of at most ``limit`` tokens: doc_id, piece, start, length, ids_crc32.

    A document is its ids and then ``end_id``; only longer ones are cut.
    """

    def cut(batches):
        for batch in batches:
            bpe = tokens.word_bpe(vocabulary)
            out: list[list] = [[], [], [], [], []]
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                packed = bpe.packed(text or "") + end_id.to_bytes(4, "little")
                for piece, at in enumerate(range(0, len(packed), 4 * limit)):
                    part = packed[at : at + 4 * limit]
                    for column, value in zip(out, (number, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(returning(cut), "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack_pieces(pieces: DataFrame, capacity: Capacity = Capacity(), rows_per_bucket: int = 20_000, salt: str | None = None) -> DataFrame:
    """``pieces`` (materialised, with a column length) with sequence_id and offset.

    salt: a column that tells equal rows apart, so that many of them take many buckets; it
    is left out of the result.

    Every piece is in one sequence; a sequence's pieces lie gapless from offset 0. Repeated
    rows are pieces of their own. An empty table gives an empty result.
    """
    keys = [c for c in pieces.columns if c != salt]
    told = [*keys, salt] if salt else keys
    counts = pieces.groupBy("length").count()  # a row per length: bounded by the capacity
    histogram = {length: n for length, n in counts.collect()}
    total = sum(histogram.values())
    buckets = max(1, -(-total // rows_per_bucket))
    rows = plan_bins(histogram, capacity)

    spread = pieces.withColumn("bucket", F.pmod(F.xxhash64(*told), F.lit(buckets)).cast("int"))
    sizes = spread.groupBy("length", "bucket").count()
    before = sizes.selectExpr("length", "bucket", "sum(count) OVER (PARTITION BY length ORDER BY bucket) - count AS before")
    ranked = spread.selectExpr("*", f"row_number() OVER (PARTITION BY length, bucket ORDER BY {', '.join(f'`{k}`' for k in keys)}) - 1 AS within")
    numbered = ranked.join(before, ["length", "bucket"]).withColumn("rank", F.col("within") + F.col("before"))

    by_length: dict[int, list[tuple[int, int, int]]] = {}
    for length, first, _, bin_, offset in rows:
        by_length.setdefault(length, []).append((first, bin_, offset))
    # goes to the workers with the function: bounded by the number of lengths, as said above
    lookup = {length: tuple(np.array(c, "int64") for c in zip(*sorted(runs), strict=True)) for length, runs in by_length.items()}

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            bins, places = np.empty(len(rank), "int64"), np.empty(len(rank), "int64")
            for value in np.unique(length):
                at = np.flatnonzero(length == value)
                starts, first_bins, offsets = lookup[int(value)]
                run = np.searchsorted(starts, rank[at], side="right") - 1
                bins[at], places[at] = first_bins[run] + rank[at] - starts[run], offsets[run]
            kept = [batch.column(k) for k in keys]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(bins), pa.array(places)], names=[*keys, "sequence_id", "offset"])

    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes if n != salt) + ", sequence_id long, offset long"
    return numbered.select(*keys, "rank").mapInArrow(returning(place), schema)


def pack_documents(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", capacity: Capacity = Capacity(), end_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Tokenizes, cuts and packs whole documents; null text counts as empty.

    Tokenizing is the costly part and runs once: the pieces are written before they are
    counted and placed.
    """
    pieces = tokenized_pieces(docs, vocabulary, capacity.tokens, end_id, id_column, text_column)
    salted = pieces.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(4096)))
    return pack_pieces(materialize(salted, "pieces"), capacity, salt="_salt")
