"""Near-duplicate documents with HyperMinHash sketches, linked exactly.

A document is the set of its word shingles, each hashed once. The hash deals the shingle
to one of ``buckets`` registers by its first bits; of the rest, the register keeps the
smallest, compressed to the count of leading zeros and ten bits of mantissa. Registers
that stay empty borrow from one that isn't, in an order fixed for each. Bands of registers,
hashed, give the candidates: sets that share a band go to the band's smallest member, so a
band with a third of all rows gives one row per member and never its pairs.

Groups of candidates are compared inside tiles of at most ``tile`` sets a side: the
registers give a Jaccard estimate, corrected for chance collisions, which orders pairs and
drops those far below the threshold; the others are confirmed on the full sets. A tile
returns links that span what it found, not all pairs, and skips pairs that are connected
already. Small groups are one tile. Large ones take two steps, whose rows grow with the
group and not with its square:

1. Every block of ``tile`` sets is compared in itself and with the first ``hubs`` blocks.
   A dense group of copies is settled by this, but for few outsiders.
2. Sets outside the group's largest component meet the others by prefix filtering: two
   sets at or above the threshold share one of the rarest shingles of either, in any
   order that all sets use alike. Sets that share only what the whole group shares, as a
   notice or a licence, have no such shingle in common and never meet. Those that meet
   over a shingle of at most ``meet`` sets, and whose sizes and one-bit sketches allow a
   link, go to tiles again. A shingle that is among the rarest of more sets than that is
   the mark of a dense group: all its sets go to tiles with the group's outsiders. The
   order comes from a table of ``cells`` counts, whose size is fixed.

Equal sets are one node from the start, so thousands of exact copies cost one. At J = 0.8
a pair shares none of 42 bands of six with probability 3e-6, and at 0.85 with 1e-9.

Null text and text without words has the empty set and links with nothing; a text with
fewer words than a shingle is one shingle; a null id forms its own row with a null
component; repeated rows get the same answer and count once; rows that share an id but not
their text are documents of their own, named by that id each; very long texts are handled
whole, a row at a time; ties between equal ids or estimates don't change the result; an
empty table gives an empty result; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbrook.llm.components import connected_components
from sparkbrook.llm.memory import returning
from sparkbrook.scratch import materialize

_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_MANTISSA = 10
_EMPTY = np.uint16(0xFFFF)  # 63 leading zeros and a full mantissa: no register of a shingle


@dataclass(frozen=True)
class Similarity:
    """A link needs 100 * intersection >= percent * union, on sets of ``words``-word shingles.

    slack: standard errors that an estimate may lie below the threshold before its pair is
    dropped unconfirmed. broadcast_rows: up to so many members of candidate groups (36
    bytes each) the texts are picked by a broadcast table, beyond it by a shuffled join.
    """

    words: int = 5
    percent: int = 80
    bands: int = 42
    rows: int = 6
    slack: float = 5.0
    tile: int = 64
    hubs: int = 2
    meet: int = 256
    tile_shingles: int = 2_000_000
    cells: int = 1 << 20
    broadcast_rows: int = 1_000_000

    @property
    def bucket_bits(self) -> int:
        return max(1, (self.bands * self.rows - 1).bit_length())

    @property
    def buckets(self) -> int:
        return 1 << self.bucket_bits

    def least_overlap(self, size: int) -> int:
        """What a set of this size shares with every set that it is linked to, at least."""
        return -(-self.percent * size // 100)


class Sketcher:
    """Shingle sets and registers; word hashes are kept in a bounded table."""

    LIMIT = 400_000

    def __init__(self, how: Similarity):
        self.how = how
        self.known: dict[bytes, int] = {}
        rng = np.random.default_rng(20)
        n = how.buckets
        self.mixers = rng.integers(0, 2**63, (how.bands, how.rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.order = np.argsort(rng.random((n, n)), 1)  # per register: where it borrows, first choice first
        self.borders = np.arange(n, dtype=np.uint64) << np.uint64(64 - how.bucket_bits)
        self.coins = rng.integers(0, 2**63, (2, n), dtype=np.uint64)

    def shingles(self, text: str | None) -> np.ndarray:
        """The sorted 64-bit hashes of the text's distinct shingles. A-Z are lower-cased, words are cut at ASCII white space."""
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        new = set(words).difference(known)
        if new:
            if len(known) + len(new) > self.LIMIT:
                known.clear()
                new = set(words)
            for w in new:
                known[w] = struct.unpack("<Q", hashlib.blake2b(w, digest_size=8).digest())[0]
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.how.words, len(words))
        out = np.full(len(words) - width + 1, width, np.uint64)  # a short text's one shingle is none of longer texts'
        for i in range(width):
            out = ((out << np.uint64(25)) | (out >> np.uint64(39))) * _K1 ^ h[i : i + len(out)]
            out ^= out >> np.uint64(31)
            out *= _K2
        out ^= out >> np.uint64(29)
        return np.unique(out)

    def registers(self, shingles: np.ndarray) -> np.ndarray:
        """Leading zeros and mantissa of each bucket's minimum, as 16-bit numbers; ``_EMPTY`` where a bucket has none.

        Buckets are ranges of the sorted hashes, and the first hash of a range is its minimum.
        """
        out = np.full(self.how.buckets, _EMPTY)
        first = np.searchsorted(shingles, self.borders)
        used = np.flatnonzero(np.diff(first, append=len(shingles)))
        least = (shingles[first[used]] << np.uint64(self.how.bucket_bits)).astype(np.float64)
        fraction, exponent = np.frexp(least)
        zeros = np.clip(64 - exponent, 0, 62).astype(np.uint16)
        mantissa = np.clip((fraction * 2 - 1) * (1 << _MANTISSA), 0, (1 << _MANTISSA) - 1).astype(np.uint16)
        out[used] = (zeros << np.uint16(_MANTISSA)) | mantissa
        return out

    def filled(self, registers: np.ndarray) -> np.ndarray:
        """Registers with their bucket's number; an empty one takes the first of its order that isn't empty."""
        used = registers != _EMPTY
        at = np.arange(len(registers))
        empty = np.flatnonzero(~used)
        if len(empty):
            at[empty] = self.order[empty, used[self.order[empty]].argmax(1)]
        return (at.astype(np.uint64) << np.uint64(16)) | registers[at]

    def band_keys(self, filled: np.ndarray) -> np.ndarray:
        how = self.how
        r = filled[: how.bands * how.rows].reshape(how.bands, how.rows) + np.uint64(1)
        key = np.arange(how.bands, dtype=np.uint64)
        for i in range(how.rows):
            key = (key ^ (r[:, i] * self.mixers[:, i])) * _K1
            key ^= key >> np.uint64(32)
        return key.view(np.int64)

    def bits(self, filled: np.ndarray) -> bytes:
        """Two bits of each filled register: equal registers agree, others by the toss of a coin."""
        x = (filled ^ self.coins).ravel() * _K1
        x ^= x >> np.uint64(32)
        return np.packbits((x * _K2 >> np.uint64(63)).astype(bool)).tobytes()

    def set_key(self, shingles: np.ndarray) -> bytes:
        return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard of each row of ``a`` with ``b``, and how many registers it rests on.

    Equal registers over those that are not empty on both sides, less the collisions that
    chance gives: two independent minima agree if they fall into one cell of the compressed
    scale, for sets of n and m with a chance of about 0.72 n m / (n + m) ** 2 / 2 ** mantissa bits.
    """
    used = ((a != _EMPTY) | (b != _EMPTY)).sum(1)
    equal = ((a == b) & (a != _EMPTY)).sum(1) / np.maximum(used, 1)
    n, m = size_a.astype(np.float64), float(size_b)
    chance = 0.72 * n * m / np.maximum((n + m) ** 2, 1) / (1 << _MANTISSA)
    return (equal - chance) / (1 - chance), used


def _sketch(how: Similarity):
    def run(batches):
        sketcher = Sketcher(how)
        for batch in batches:
            sizes, keys, bands = [], [], []
            for text in batch.column("text").to_pylist():
                s = sketcher.shingles(text)
                sizes.append(len(s))
                keys.append(sketcher.set_key(s) if len(s) else None)
                bands.append(sketcher.band_keys(sketcher.filled(sketcher.registers(s))) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_key", "bands"],
            )

    return run


def _sets_of(how: Similarity):
    """The sets of picked documents as bytes; rows whose text isn't the picked set's, and repeated ones, are left out."""

    def run(batches):
        sketcher, seen = Sketcher(how), set()
        for batch in batches:
            keep, sets = [], []
            for i, (sid, key, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("sid", "set_key", "text")), strict=True)):
                if sid in seen:
                    continue
                s = sketcher.shingles(text)
                if len(s) and sketcher.set_key(s) == key:
                    seen.add(sid)
                    keep.append(i)
                    sets.append(s.astype("<u8").tobytes())
            part = batch.select(["sid", "grp", "block"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sets, pa.binary())], names=["sid", "grp", "block", "shingles"])

    return run


class _Sets:
    """One side of a tile: ids, sets and registers."""

    def __init__(self, rows: list[tuple], sketcher: Sketcher):
        self.ids = [r[0] for r in rows]
        self.sets = [np.frombuffer(r[1], "<u8") for r in rows]
        self.sizes = np.array([len(s) for s in self.sets])
        self.registers = np.stack([sketcher.registers(s) for s in self.sets]) if rows else np.empty((0, sketcher.how.buckets), np.uint16)


def _links_of_tile(left: list[tuple], right: list[tuple] | None, how: Similarity, sketcher: Sketcher, components: dict[int, int]):
    """Links that span all links of the tile; ``components``: what is known already. right None: left with itself."""
    a = _Sets(left, sketcher)
    b = a if right is None else _Sets(right, sketcher)
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for node, component in components.items():
        parent[find(node)] = find(("component", component))
    for j in range(len(b.ids)):
        stop = j if right is None else len(a.ids)
        if not stop:
            continue
        small, large = np.minimum(a.sizes[:stop], b.sizes[j]), np.maximum(a.sizes[:stop], b.sizes[j])
        near = np.flatnonzero(100 * small >= how.percent * large)
        if not len(near):
            continue
        guess, used = estimate(a.registers[near], b.registers[j], a.sizes[near], b.sizes[j])
        likely = guess >= how.percent / 100 - how.slack * np.sqrt(0.16 / np.maximum(used, 1)) - 1e-9
        rest = near[likely][np.argsort(-guess[likely], kind="stable")].tolist()
        tried = False  # the likeliest alone, for it often connects the others too; then what is left at once
        while rest := [i for i in rest if a.ids[i] != b.ids[j] and find(a.ids[i]) != find(b.ids[j])]:
            some, rest, tried = (rest, [], tried) if tried else (rest[:1], rest[1:], True)
            for i in np.array(some)[_linked([a.sets[i] for i in some], b.sets[j], how.percent)].tolist():
                if find(a.ids[i]) != find(b.ids[j]):
                    parent[find(a.ids[i])] = find(b.ids[j])
                    yield a.ids[i], b.ids[j]


def _linked(sets: list[np.ndarray], other: np.ndarray, percent: int) -> np.ndarray:
    """Which of the sets share enough with ``other``, counted in full."""
    sizes = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    common = np.add.reduceat(other[np.minimum(np.searchsorted(other, every), len(other) - 1)] == every, np.cumsum(sizes) - sizes, dtype=np.int64)
    return 100 * common >= percent * (sizes + len(other) - common)


def _compare(how: Similarity):
    """Tiles come sorted by (grp, p, q, side): one tile is held at a time."""

    def run(batches):
        sketcher, key, sides, components, found = Sketcher(how), None, ([], []), {}, []

        def batch_of(links):
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["a", "b"])

        for batch in batches:
            for grp, p, q, side, sid, component, shingles in zip(*(batch.column(c).to_pylist() for c in ("grp", "p", "q", "side", "sid", "component", "shingles")), strict=True):
                now = (grp, p, q)
                if key is not None and now != key:
                    found += _links_of_tile(sides[0], sides[1] or None, how, sketcher, components)
                    sides, components = ([], []), {}
                key = now
                sides[side].append((sid, shingles))
                components[sid] = component
            yield batch_of(found)
            found = []
        if key is not None:
            yield batch_of(list(_links_of_tile(sides[0], sides[1] or None, how, sketcher, components)))

    return run


_TILE = ["grp", "p", "q", "side", "sid", "component", "shingles"]


def _tiled(rows: DataFrame, how: Similarity, n: int) -> DataFrame:
    """Links of the tiles that ``rows`` (grp, p, q, side, sid, component, shingles) make up."""
    dealt = rows.select(_TILE).repartition(n, "grp", "p", "q").sortWithinPartitions("grp", "p", "q", "side", "sid")
    return dealt.mapInArrow(returning(_compare(how)), "a bigint, b bigint")


def _count_cells(how: Similarity):
    """How often shingles fall into each cell, in this task."""

    def run(batches):
        counts = np.zeros(how.cells, np.int64)
        for batch in batches:
            for s in batch.column("shingles").to_pylist():
                np.add.at(counts, (np.frombuffer(s, "<u8") % np.uint64(how.cells)).astype(np.int64), 1)
        at = np.flatnonzero(counts)
        for a in range(0, len(at), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[a : a + 100_000], pa.int64()), pa.array(counts[at[a : a + 100_000]])], names=["cell", "n"])

    return run


_MEMBER = ["sid", "grp", "component", "block", "part", "outside"]


def _prefixes(how: Similarity, counts: np.ndarray):
    """A row for each of a set's rarest shingles that another set may have: one of them is in every set that it is linked to."""

    def run(batches):
        sketcher = Sketcher(how)
        for batch in batches:
            owner, tokens, sizes, bits = [], [], [], []
            for i, packed in enumerate(batch.column("shingles").to_pylist()):
                s = np.frombuffer(packed, "<u8")
                often = counts[(s % np.uint64(how.cells)).astype(np.int64)]
                first = np.argsort(often, kind="stable")[: len(s) - how.least_overlap(len(s)) + 1]
                some = s[first[often[first] > 1]]
                owner.append(np.full(len(some), i))
                tokens.append(some)
                sizes.append(len(s))
                bits.append(sketcher.bits(sketcher.filled(sketcher.registers(s))))
            if not owner:
                continue
            whole = pa.RecordBatch.from_arrays([*(batch.column(c) for c in _MEMBER), pa.array(sizes, pa.int64()), pa.array(bits, pa.binary())], names=[*_MEMBER, "n", "bits"])
            owner, tokens = np.concatenate(owner), np.concatenate(tokens).view(np.int64)
            for a in range(0, len(owner), 20_000):
                part = whole.take(pa.array(owner[a : a + 20_000]))
                yield pa.RecordBatch.from_arrays([pa.array(tokens[a : a + 20_000]), *part.columns], names=["token", *part.schema.names])

    return run


def _meetings(how: Similarity):
    """Places in tiles for sets that share a rare shingle and may be linked. Rows come sorted by token."""

    def tiles_of(rows: list[tuple]):
        sid, grp, component, block, part = (np.array([r[c] for r in rows], np.int64) for c in range(5))
        outside, n = np.array([r[5] for r in rows]), np.array([r[6] for r in rows], np.int64)
        bits = np.frombuffer(b"".join(r[7] for r in rows), np.uint64).reshape(len(rows), -1)
        most = 64 * bits.shape[1] * (1 - _AGREE)
        for i in np.flatnonzero(outside):
            may = (grp == grp[i]) & (component != component[i]) & (~outside | (sid > sid[i]))
            may &= 100 * np.minimum(n, n[i]) >= how.percent * np.maximum(n, n[i])
            at = np.flatnonzero(may)
            if len(at):
                at = at[np.bitwise_count(bits[at] ^ bits[i]).sum(1) <= most]
            for j in at.tolist():
                yield int(grp[i]), int(part[i]), int(block[j]), 0, int(sid[i])
                yield int(grp[i]), int(part[i]), int(block[j]), 1, int(sid[j])

    def out(found):
        return pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], t) for c, t in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()))], names=["grp", "p", "q", "side", "sid"])

    def run(batches):
        key, held, found = None, [], set()
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("token", "sid", "grp", "component", "block", "part", "outside", "n", "bits")]
            for token, *row in zip(*columns, strict=True):
                if key is not None and key != token:
                    found.update(tiles_of(held) if len(held) > 1 else ())
                    held = []
                    if len(found) > 100_000:
                        yield out(found)
                        found.clear()
                key = token
                held.append(row)
        found.update(tiles_of(held) if len(held) > 1 else ())
        yield out(found)

    return run


#: Share of the bits that agrees in linked sets, at least: 0.9 expected at J = 0.8, less five standard errors.
_AGREE = 0.8


def _outsiders(sets: DataFrame, large: DataFrame, links: DataFrame, how: Similarity, n: int, small: bool) -> DataFrame | None:
    """Step 2: links of large groups that step 1 left open; None where there is nothing to do."""
    found = connected_components(links).withColumnRenamed("node", "sid")
    inside = sets.join(F.broadcast(large) if small else large, "grp")
    known = materialize(inside.select("sid", "grp", "block").join(found, "sid", "left").select("sid", "grp", "block", F.coalesce("component", "sid").alias("component")), "known")
    main = known.groupBy("grp", "component").count().groupBy("grp").agg(F.max_by("component", F.struct("count", "component")).alias("main"))
    placed = known.join(main, "grp").withColumn("outside", F.col("component") != F.col("main")).drop("main")
    parts = placed.groupBy("grp").agg(F.ceil(F.count_if("outside") / how.tile).cast("int").alias("parts")).filter("parts > 0")
    placed = placed.join(parts, "grp").withColumn("part", F.pmod(F.xxhash64(F.lit(1), "sid"), F.col("parts")).cast("int"))
    pool = materialize(placed.select(_MEMBER).join(sets.select("sid", "shingles"), "sid").select(*_MEMBER, "shingles"), "pool")
    if pool.isEmpty():
        return None
    cells = pool.select("shingles").mapInArrow(returning(_count_cells(how)), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most ``cells`` rows
    counts = np.zeros(how.cells, np.int32)
    counts[cells.column("cell").to_numpy()] = np.minimum(cells.column("n").to_numpy(), np.iinfo(np.int32).max)
    schema = "token long, sid long, grp long, component long, block int, part int, outside boolean, n long, bits binary"
    keys = materialize(pool.mapInArrow(returning(_prefixes(how, counts)), schema), "prefixes")
    shared = keys.groupBy("token").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("low"), F.max("component").alias("high"), F.max("outside").alias("any"))
    shared = materialize(shared.filter("low < high AND any").select("token", (F.col("size") > how.meet).alias("often")), "shared")
    meet = keys.join(shared.filter("NOT often").select("token"), "token").repartition(n, "token").sortWithinPartitions("token")
    tiles = meet.mapInArrow(returning(_meetings(how)), "grp long, p int, q int, side int, sid long").distinct()
    # sets of dense groups, in blocks of their own: outsiders at every block, and all at every part of the outsiders
    dense = materialize(keys.join(shared.filter("often").select("token"), "token").select("sid", "grp", "outside").distinct(), "dense")
    sizes = dense.groupBy("grp").agg(F.ceil(F.count_if("outside") / how.tile).cast("int").alias("parts"), F.ceil(F.count(F.lit(1)) / how.tile).cast("int").alias("blocks")).filter("parts > 0")
    dense = dense.join(sizes, "grp").withColumn("part", F.pmod(F.xxhash64(F.lit(3), "sid"), F.col("parts")).cast("int")).withColumn("block", F.pmod(F.xxhash64(F.lit(4), "sid"), F.col("blocks")).cast("int"))
    left = dense.filter("outside").selectExpr("grp", "-1 - part AS p", "explode(sequence(0, blocks - 1)) AS q", "0 AS side", "sid")
    right = dense.selectExpr("sid", "grp", "block AS q", "explode(sequence(0, parts - 1)) AS part").selectExpr("grp", "-1 - part AS p", "q", "1 AS side", "sid")
    tiles = materialize(tiles.unionByName(left).unionByName(right), "meetings")
    return materialize(_tiled(tiles.join(pool.select("sid", "component", "shingles"), "sid"), how, n), "more-links")


def near_duplicates(docs: DataFrame, how: Similarity = Similarity(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links, itself included) and kept, per row."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    sketches = materialize(rows.mapInArrow(returning(_sketch(how)), "doc_id long, n_shingles long, set_key binary, bands array<bigint>"), "sketches")

    # equal sets are one node with a number of its own, fixed as it is written
    usable = sketches.filter("set_key IS NOT NULL AND doc_id IS NOT NULL")
    nodes = usable.groupBy("set_key").agg(F.min("doc_id").alias("least_id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    nodes = materialize(nodes.withColumn("sid", F.monotonically_increasing_id()), "nodes")
    banded = nodes.select("sid", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("sid").alias("first"), F.max("sid").alias("last")).filter("first < last").select("band", "first")
    shared = materialize(shared, "bands")  # written tables on both sides of a join: a band of many sets can be split
    candidates = banded.join(shared, "band").filter("sid <> first").select(F.col("first").alias("a"), F.col("sid").alias("b")).distinct()
    groups = materialize(connected_components(candidates).selectExpr("node AS sid", "component AS grp"), "groups")

    # sets of the members, each in a block of its group that holds a bounded number of sets and shingles
    sized = groups.join(nodes.drop("bands"), "sid")
    blocks = sized.groupBy("grp").agg(F.greatest(F.ceil(F.count(F.lit(1)) / how.tile), F.ceil(F.sum("n_shingles") / how.tile_shingles)).cast("int").alias("blocks"))
    blocks = materialize(blocks, "blocks")
    members = sized.join(blocks, "grp").select(F.col("least_id").alias("doc_id"), "set_key", "sid", "grp", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int").alias("block"))
    members = materialize(members, "members")
    count = members.count()
    few = count <= how.broadcast_rows
    sets = rows.join(F.broadcast(members) if few else members, "doc_id").mapInArrow(returning(_sets_of(how)), "sid long, grp long, block int, shingles binary")
    sets = materialize(sets, "sets")
    if sets.count() > count:  # repeated rows in several tasks
        sets = materialize(sets.groupBy("sid", "grp", "block").agg(F.first("shingles").alias("shingles")), "sets")

    # step 1: each block with itself, and with the group's first blocks
    own = blocks.select("grp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("q"))
    diagonal = own.selectExpr("grp", "q AS p", "q", "0 AS side", "q AS block")
    hub = own.filter("q > 0").selectExpr("grp", f"explode(sequence(0, least(q, {how.hubs}) - 1)) AS p", "q")
    hub = hub.selectExpr("grp", "p", "q", "inline(array(struct(0 AS side, p AS block), struct(1 AS side, q AS block)))")
    first = sets.withColumn("component", F.col("sid")).join(diagonal.unionByName(hub), ["grp", "block"])
    links = materialize(_tiled(first, how, n), "links")

    large = materialize(blocks.filter("blocks > 1").select("grp"), "large-groups")
    if not large.isEmpty():
        more = _outsiders(sets, large, links, how, n, few)
        links = links if more is None else links.unionByName(more)

    # nodes are numbered, components are named by their smallest document
    reached = materialize(connected_components(links).withColumnRenamed("node", "sid").join(nodes.select("sid", "set_key", "least_id"), "sid"), "reached")
    names = reached.groupBy("component").agg(F.min("least_id").alias("name"))
    named = reached.join(names, "component").select("set_key", "name")
    # one join by set, against a written table, so that the rows of a set with many copies can be split
    final = nodes.select("set_key", "least_id").join(named, "set_key", "left").select("set_key", F.coalesce("name", "least_id").alias("name"))
    out = sketches.select("doc_id", "n_shingles", "set_key").join(materialize(final, "names"), "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("name", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
