"""Near-duplicate embeddings: spherical k-means cells and blocked cosine products.

Equal vectors are one node with a count, so a vector that a third of all rows share is
compared once. A bounded sample gives the centroids; every vector has its home in the cell
of its nearest centroid. A vector within distance d of another can lie beyond the border
of two cells only if it is itself within d of that border, so each vector also visits the
cells whose border is that close: no pair at or above the threshold is missed. Cells with
more than ``block`` vectors are cut into blocks. A pair is compared in one place, the
block of the lower number, as one product of a home block with a batch of visitors.

There are about as many cells as the root of the number of vectors, and the sample grows
with the cells up to a bound, so a vector's work grows with the root, not with the table.

A block returns link counts and links that span what it found, one row per vector and not
one per pair. Vectors of different lengths are never compared. Vectors that are null,
empty, zero, or hold null or non-finite components link with nothing, and neither do those
with a null id, whose component is null; repeated rows count each other; centroids that
are equally near are taken in their order; an empty table gives an empty result; further
columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbrook.llm.components import connected_components
from sparkbrook.scratch import materialize


@dataclass(frozen=True)
class Cells:
    """threshold: of the cosine. per_cell: vectors a cell at most, on average, while the root allows it.

    sample: vectors that the centroids are fitted on, or 16 a cell, most_sample at most.
    slack: share of the border distance that visits are bound by; 1 misses nothing.
    """

    threshold: float = 0.95
    per_cell: int = 4096
    least_cells: int = 12
    block: int = 8192
    sample: int = 20_000
    most_sample: int = 200_000
    rounds: int = 8
    slack: float = 1.0
    seed: int = 11


def _keyed(batches):
    """vec_id, length, a digest of the vector, and the vector as doubles; nulls where it is unusable."""
    for batch in batches:
        lengths, keys, packed = [], [], []
        for v in batch.column("embedding").to_pylist():
            x = np.array(v, np.float64) if v and None not in v else None
            if x is None or not np.isfinite(x).all() or not x.any():
                lengths.append(None), keys.append(None), packed.append(None)
                continue
            x = x + 0.0  # one zero
            lengths.append(len(x)), keys.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest()), packed.append(x.astype("<f8").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(lengths, pa.int32()), pa.array(keys, pa.binary()), pa.array(packed, pa.binary())], names=["vec_id", "d", "key", "vector"])


def _units(packed: list[bytes], d: int) -> np.ndarray:
    x = np.frombuffer(b"".join(packed), "<f8").reshape(-1, d)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_cells(sample: np.ndarray, k: int, cells: Cells) -> np.ndarray:
    """Unit centroids of a sample of unit vectors by spherical Lloyd rounds."""
    rng = np.random.default_rng(cells.seed)
    centroids = sample[rng.permutation(len(sample))[:k]].copy()
    for _ in range(cells.rounds):
        home = (sample @ centroids.T).argmax(1)
        for c in range(len(centroids)):
            total = sample[home == c].sum(0)
            size = np.linalg.norm(total)
            if size > 0:
                centroids[c] = total / size
    return centroids


def between(centroids: np.ndarray) -> np.ndarray:
    """Distances of the centroids from each other, once a task."""
    return np.sqrt(np.maximum(0, 2 - 2 * centroids @ centroids.T))


def visits(units: np.ndarray, centroids: np.ndarray, apart: np.ndarray, cells: Cells) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each vector, and a matrix of the cells that it may have neighbours in."""
    near = math.sqrt(2 - 2 * cells.threshold) * cells.slack + 1e-9
    dots = units @ centroids.T
    home = dots.argmax(1)
    return home, dots[np.arange(len(units)), home][:, None] - dots <= near * apart[home] + 1e-6


def _stars(hits: np.ndarray) -> np.ndarray:
    """Per row of a symmetric matrix of links, the first row of its component."""
    first = np.full(len(hits), -1)
    for start in range(len(hits)):
        if first[start] >= 0:
            continue
        first[start], front = start, np.array([start])
        while len(front):  # every row is in the front once
            front = np.flatnonzero(hits[front].any(0) & (first < 0))
            first[front] = start
    return first


def _products(d: int, threshold: float):
    """Rows come sorted by (cell, block, visitor): a block is held, its visitors pass by in batches."""

    def run(batches):
        key, ids, packed, counts, built = None, [], [], [], None
        links, sums = [], []  # pieces of (a, b) and of (vector, links)

        def gained(numbers, amounts):
            some = np.flatnonzero(amounts)
            sums.append((numbers[some], amounts[some]))

        def add(their_ids, their_counts, hits):
            """hits: home rows x visitors. A visitor is linked to one row of each component that it touches."""
            _, home_ids, home_counts, first = built
            at = np.flatnonzero(hits.any(0))
            if not len(at):
                return
            part = hits[:, at]
            gained(home_ids, part @ their_counts[at])
            gained(their_ids[at], home_counts @ part)
            column, row = np.nonzero(part.T)
            pairs = np.unique(column * len(first) + first[row])
            links.append((home_ids[pairs % len(first)], their_ids[at][pairs // len(first)]))

        def build():
            nonlocal built
            units, numbers, n = _units(packed, d), np.array(ids, np.int64), np.array(counts, np.int64)
            hits = np.empty((len(ids), len(ids)), bool)
            for a in range(0, len(ids), 1024):
                hits[:, a : a + 1024] = units @ units[a : a + 1024].T >= threshold
            hits |= hits.T
            np.fill_diagonal(hits, False)
            gained(numbers, hits @ n)
            first = _stars(hits)
            some = np.flatnonzero(first != np.arange(len(first)))
            links.append((numbers[first[some]], numbers[some]))
            built = (units, numbers, n, first)

        def out():
            a = np.concatenate([np.empty(0, np.int64), *(x for x, _ in links), *(v for v, _ in sums)])
            b = np.concatenate([np.empty(0, np.int64), *(y for _, y in links), *(v for v, _ in sums)])
            n = np.concatenate([np.empty(0, np.int64), *(np.zeros(len(x), np.int64) for x, _ in links), *(n for _, n in sums)])
            links.clear(), sums.clear()
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n)], names=["a", "b", "n"])

        for batch in batches:
            cell, block, visitor = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "block", "visitor"))
            marks = np.flatnonzero(np.diff(cell) | np.diff(block) | np.diff(visitor)) + 1 if len(cell) else []
            for lo, hi in zip([0, *marks], [*marks, len(cell)], strict=True):
                if lo == hi:
                    continue
                now = (int(cell[lo]), int(block[lo]))
                if now != key:
                    if built is None and ids:
                        build()
                    key, ids, packed, counts, built = now, [], [], [], None
                part = batch.slice(lo, hi - lo)
                some, vectors, n = part.column("sid").to_pylist(), part.column("vector").to_pylist(), part.column("copies").to_pylist()
                if not visitor[lo]:
                    ids += some
                    packed += vectors
                    counts += n
                elif ids:
                    if built is None:
                        build()
                    for a in range(0, len(some), 1024):
                        hits = built[0] @ _units(vectors[a : a + 1024], d).T >= threshold
                        add(np.array(some[a : a + 1024], np.int64), np.array(n[a : a + 1024], np.int64), hits)
            yield out()
        if built is None and ids:
            build()
            yield out()

    return run


def near_vectors(rows: DataFrame, cells: Cells = Cells(), id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id (smallest vec_id reachable) and kept, one row per row."""
    spark = rows.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chosen = rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("embedding"))
    keyed = materialize(chosen.mapInArrow(_keyed, "vec_id long, d int, key binary, vector binary"), "vectors")
    usable = keyed.filter("key IS NOT NULL AND vec_id IS NOT NULL")
    nodes = usable.groupBy("key").agg(F.min("vec_id").alias("sid"), F.count(F.lit(1)).alias("copies"))
    nodes = materialize(nodes, "vector-nodes")
    distinct = usable.join(nodes, (usable["key"] == nodes["key"]) & (usable["vec_id"] == nodes["sid"])).select("sid", "copies", "d", "vector").dropDuplicates(["sid"])
    distinct = materialize(distinct, "distinct-vectors")

    found = None
    for d, n in sorted((r["d"], r["count"]) for r in distinct.groupBy("d").count().collect()):  # one row per vector length
        some = distinct.filter(F.col("d") == d)
        k = max(cells.least_cells, min(-(-n // cells.per_cell), math.isqrt(n)))
        most = min(cells.most_sample, max(cells.sample, 16 * k))
        share = min(1.0, most / n)
        draw = F.pmod(F.xxhash64(F.lit(cells.seed), "sid"), F.lit(1 << 30)) / float(1 << 30)
        picked = some.filter(draw < share).select("vector", "sid").orderBy("sid").limit(2 * most).collect()
        sample = _units([bytes(r["vector"]) for r in picked] or [bytes(some.first()["vector"])], d)
        centroids = fit_cells(sample, min(k, len(sample)), cells)

        rows_at_once = max(1, 4_000_000 // len(centroids))

        def home(batches, d=d, centroids=centroids, rows_at_once=rows_at_once):
            for whole in batches:
                for at in range(0, whole.num_rows, rows_at_once):
                    where = (_units(whole.slice(at, rows_at_once).column("vector").to_pylist(), d) @ centroids.T).argmax(1)
                    yield pa.RecordBatch.from_arrays([pa.array(where.astype(np.int32))], names=["cell"])

        sizes = some.mapInArrow(home, "cell int").groupBy("cell").count().collect()  # one row per cell
        blocks = {r["cell"]: -(-r["count"] // cells.block) for r in sizes}

        def dealt(batches, d=d, centroids=centroids, blocks=blocks, rows_at_once=rows_at_once):
            apart = between(centroids)
            for batch in (whole.slice(at, rows_at_once) for whole in batches for at in range(0, whole.num_rows, rows_at_once)):
                where, may = visits(_units(batch.column("vector").to_pylist(), d), centroids, apart, cells)
                sids = batch.column("sid").to_pylist()
                take, cell, block, visitor = [], [], [], []
                for i, (c, s) in enumerate(zip(where.tolist(), sids, strict=True)):
                    own = int.from_bytes(hashlib.blake2b(str(s).encode(), digest_size=4).digest(), "little") % blocks[c]
                    for other in np.flatnonzero(may[i, : c + 1]).tolist():
                        for b in range(own + 1 if other == c else blocks.get(other, 0)):
                            take.append(i)
                            cell.append(other)
                            block.append(b)
                            visitor.append(int(other != c or b != own))
                for a in range(0, len(take), 20_000):
                    part = batch.take(pa.array(take[a : a + 20_000]))
                    yield pa.RecordBatch.from_arrays([pa.array(x[a : a + 20_000], t) for x, t in ((cell, pa.int32()), (block, pa.int32()), (visitor, pa.int32()))] + [part.column(c) for c in ("sid", "copies", "vector")], names=["cell", "block", "visitor", "sid", "copies", "vector"])

        spread = some.select("sid", "copies", "vector").mapInArrow(dealt, "cell int, block int, visitor int, sid long, copies long, vector binary")
        sorted_ = spread.repartition(n_parts, "cell", "block").sortWithinPartitions("cell", "block", "visitor", "sid")
        part = sorted_.mapInArrow(_products(d, cells.threshold), "a long, b long, n long")
        found = part if found is None else found.unionByName(part)

    if found is None:
        found = spark.createDataFrame([], "a long, b long, n long")
    found = materialize(found, "vector-links")
    linked = found.filter("a = b").groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "sid")
    reached = connected_components(found.filter("a <> b").select("a", "b")).withColumnRenamed("node", "sid")
    named = nodes.join(linked, "sid", "left").join(reached, "sid", "left").select("key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "sid").alias("component"))
    out = keyed.select("vec_id", "key").join(named, "key", "left")
    have = F.col("vec_id").isNotNull()
    out = out.select("vec_id", F.when(have, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"), F.when(have, F.coalesce("component", "vec_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
