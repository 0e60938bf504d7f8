"""Byte-level BPE of texts of any length by tree concatenation, and decoding.

A short text is encoded at once. A long one is halved until its leaves are short, the
leaves are encoded in parallel by different tasks, and the halves are joined level by
level: up to ``FAN`` neighbours in a task, then the nodes that gives, until a document is
one node. Every node holds the exact encoding of its own text, so only the join can differ:
a window around it, from a place that the left side's words fix, is encoded again and
grows until one of its word ends is a word end of the right side too. From there on both
sides agree, because the word pattern looks ahead but never back.

A single word that is longer than ``LONG`` bytes (text without any split) is itself
encoded by halves: windows of tokens around the join grow until their outermost tokens
are the ones that both sides have there. A sequence is the encoding of its bytes if and
only if that holds for every two neighbours, so agreement at both rims proves the whole.

The words of leaves and windows come from a fast pattern where all characters are of one
class in every Unicode version, and from the tokenizers library's own word splitter
elsewhere, so texts of any script go the same way.

Special tokens are cut out first, as the tokenizers library does. Null text counts as
empty and gives no ids; repeated rows are encoded once where they are long, and give a row
each; rows that share an id but not their text are told apart by a hash of the text; texts
of any length are encoded whole, with arrays of 12 bytes a token in the task that ends the
joining; an empty table gives an empty result; further columns, whatever their names, are
not read.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbrook.llm import tokens
from sparkbrook.scratch import materialize

#: Fixed value: the vocabulary's word pattern (for texts that ``_PLAIN`` accepts).
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: Characters that the pattern looks ahead beyond the end of a match, and one more.
_MARGIN = 3
#: Bytes of a word from which it is encoded by halves.
LONG = 4096
#: Characters of a leaf.
LEAF = 32_768
#: Neighbours that one task joins.
FAN = 64

_RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _empty() -> np.ndarray:
    return np.empty(0, np.uint32)


@dataclass
class Node:
    """The exact encoding of a text: its pieces' characters and tokens, and all ids."""

    chars: np.ndarray = field(default_factory=_empty)
    counts: np.ndarray = field(default_factory=_empty)
    ids: np.ndarray = field(default_factory=_empty)


def _node(chars: list[int], counts: list[int], ids: list[int]) -> Node:
    return Node(np.array(chars, np.uint32), np.array(counts, np.uint32), np.array(ids, np.uint32))


class ByteBpe:
    LIMIT = 300_000

    def __init__(self, name: str):
        import tiktoken

        self.name = name
        ranks, self.special = tokens._ranks(name)
        self.table: list[bytes] = [b""] * (1 + max([*ranks.values(), *self.special.values()]))
        for piece, number in ranks.items():
            self.table[number] = piece
        for text, number in self.special.items():
            self.table[number] = text.encode()
        self.coder = tiktoken.Encoding("bytes", pat_str=_FAST, mergeable_ranks=ranks, special_tokens={})
        self.one = self.coder._core_bpe.encode_single_piece
        self.cuts = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.known: dict[str, list[int]] = {}
        self.splitter = tokens.load(name).pre_tokenizer

    def plain(self, text: str) -> bool:
        return tokens._PLAIN.match(text).end() == len(text) and not tokens._NUMERIC.search(text)

    def pieces(self, text: str) -> list[str]:
        """The text's words in order; together they are the text."""
        if self.plain(text):
            return _PIECES.findall(text)
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def segments(self, text: str) -> list[str]:
        return [s for s in self.cuts.split(text) if s] if self.cuts else [text] if text else []

    # --- whole short texts ----------------------------------------------------
    def encode(self, text: str) -> list[int]:
        """Ids of a text in one piece."""
        if not self.plain(text):
            return tokens.load(self.name).encode(text, add_special_tokens=False).ids
        if self.cuts is None or "<" not in text or not self.cuts.search(text):
            return self._ordinary(text)
        return [n for s in self.segments(text) for n in ([self.special[s]] if s in self.special else self._ordinary(s))]

    def _ordinary(self, text: str) -> list[int]:
        return self.coder.encode_ordinary(text) if len(text) <= LONG or not _has_long(text) else self.leaf(text).ids.tolist()

    # --- words without a split --------------------------------------------------
    def word(self, data: bytes) -> list[int]:
        if len(data) <= LONG:
            return self.one(data)
        half = len(data) // 2
        return self.join_word(self.word(data[:half]), self.word(data[half:]))

    def join_word(self, left: list[int], right: list[int], width: int = 8) -> list[int]:
        while True:
            tail, head = left[-width:], right[:width]
            window = self.one(b"".join(map(self.table.__getitem__, tail + head)))
            if (width >= len(left) or window[0] == tail[0]) and (width >= len(right) or window[-1] == head[-1]):
                return left[: max(0, len(left) - width)] + window + right[width:]
            width *= 2

    def piece(self, text: str) -> list[int]:
        if len(text) > 64:
            return self.word(text.encode())
        found = self.known.get(text)
        if found is None:
            if len(self.known) >= self.LIMIT:
                self.known.clear()
            found = self.known[text] = self.one(text.encode())
        return found

    # --- halves -------------------------------------------------------------------
    def leaf(self, text: str) -> Node:
        chars, counts, out = [], [], []
        for p in self.pieces(text):
            ids = self.piece(p)
            chars.append(len(p))
            counts.append(len(ids))
            out += ids
        return _node(chars, counts, out)

    def text(self, ids: np.ndarray) -> str:
        return b"".join(map(self.table.__getitem__, ids.tolist())).decode("utf-8", "surrogatepass")

    def join(self, a: Node, b: Node) -> Node:
        """The encoding of both texts in a row, from the encodings of each."""
        if not len(a.ids) or not len(b.ids):
            return b if not len(a.ids) else a
        width = 4
        while True:
            first = max(0, len(a.chars) - width)
            while first and a.chars[first:].sum() < _MARGIN:
                first -= 1
            last = min(len(b.chars), width)
            kept = len(a.ids) - int(a.counts[first:].sum())
            tail, head = a.ids[kept:], b.ids[: int(b.counts[:last].sum())]
            left = int(a.chars[first:].sum())
            window = self.text(np.concatenate([tail, head]))
            ends = {left + int(n): i + 1 for i, n in enumerate(np.cumsum(b.chars[:last]))}
            limit = len(window) - (_MARGIN if last < len(b.chars) else 0)
            chars, counts, new, at = [], [], [], 0
            for p in self.pieces(window):
                at += len(p)
                if at > limit:
                    break
                ids = self._crossing(p, at, left, a, b)
                chars.append(len(p))
                counts.append(len(ids))
                new += ids
                if at in ends:
                    cut = ends[at]
                    middle, skipped = _node(chars, counts, new), int(b.counts[:cut].sum())
                    parts = ((a.chars[:first], middle.chars, b.chars[cut:]), (a.counts[:first], middle.counts, b.counts[cut:]), (a.ids[:kept], middle.ids, b.ids[skipped:]))
                    return Node(*map(np.concatenate, parts))
            width *= 2

    def _crossing(self, p: str, end: int, left: int, a: Node, b: Node) -> list[int]:
        """A long word that is just the last of the left and the first of the right side is joined, not encoded anew."""
        if len(p) > LONG and end - left == b.chars[0] and len(p) == a.chars[-1] + b.chars[0]:
            return self.join_word(a.ids[len(a.ids) - int(a.counts[-1]) :].tolist(), b.ids[: int(b.counts[0])].tolist())
        return self.piece(p)

    def tree(self, nodes: list[Node]) -> Node:
        while len(nodes) > 1:
            nodes = [self.join(*nodes[i : i + 2]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
        return nodes[0] if nodes else Node()

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.table.__getitem__, ids)).decode("utf-8", "replace")


#: The same pattern in the fast encoder's syntax.
_FAST = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_RUN = re.compile(r"\S{%d}|\s{%d}" % (LONG, LONG))


def _has_long(text: str) -> bool:
    return _RUN.search(text) is not None


def byte_bpe(name: str) -> ByteBpe:
    key = ("bytes", name)
    if key not in tokens._loaded:
        tokens._loaded[key] = ByteBpe(name)
    return tokens._loaded[key]


def halves(text: str, leaf: int = LEAF) -> list[str]:
    """The leaves of the halving, in order; only the length decides."""
    if len(text) <= leaf:
        return [text]
    middle = len(text) // 2
    return halves(text[:middle], leaf) + halves(text[middle:], leaf)


def _digests(coder: ByteBpe, parts: list) -> tuple[int, str, str]:
    """Count of ids and the two digests, from parts of the ids in order, a piece at a time."""
    n, ids_hash, text_hash, decoder = 0, hashlib.sha256(), hashlib.sha256(), codecs.getincrementaldecoder("utf-8")("replace")
    for part in parts:
        for at in range(0, len(part), 65_536):
            some = part[at : at + 65_536]
            some = some if isinstance(some, list) else some.tolist()
            ids_hash.update((("," if n else "") + ",".join(map(str, some))).encode())
            text_hash.update(decoder.decode(b"".join(map(coder.table.__getitem__, some))).encode())
            n += len(some)
    text_hash.update(decoder.decode(b"", True).encode())
    return n, ids_hash.hexdigest(), text_hash.hexdigest()


def _rows(numbers: list, digests: list[tuple[int, str, str]]) -> pa.RecordBatch:
    n, i, d = zip(*digests, strict=True) if digests else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(n, pa.int64()), pa.array(i, pa.string()), pa.array(d, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


#: What tells a long document from others, whoever computes it; and its place in the text.
_KEY = ("doc_id", "digest", "size")
_LEAVES = "doc_id long, digest long, size long, leaves int, segment int, leaf int"
_NODES = f"{_LEAVES}, copies long, chars binary, counts binary, ids binary"
_NODE_NAMES = [c.split()[0] for c in _NODES.split(", ")]


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    types = [kinds[c.split()[1]] for c in _NODES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=_NODE_NAMES)


_DONE = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _either(done: pa.RecordBatch | None, nodes: pa.RecordBatch | None) -> pa.RecordBatch:
    """Rows of nodes and of finished documents in one form; what the other kind has is null."""
    m = (nodes if done is None else done).num_rows
    null = lambda t: pa.nulls(m, t)
    blank = _packed([])
    left = nodes.columns if nodes is not None else [done.column("doc_id"), *(null(blank.schema.field(c).type) for c in _NODE_NAMES[1:])]
    right = done.columns[1:] if done is not None else [null(pa.int64()), null(pa.string()), null(pa.string())]
    return pa.RecordBatch.from_arrays([*left, *right], names=[*_NODE_NAMES, "n_tokens", "ids_sha256", "decoded_sha256"])


def _grouped(batches, key: tuple[str, ...]):
    """(the last row, its group's nodes) of rows that come sorted by ``key`` and leaf; one group is held at a time."""
    now, last, held = None, None, []
    for batch in batches:
        for r in batch.to_pylist():
            mine = tuple(r[c] for c in key)
            if now is not None and mine != now:
                yield last, held
                held = []
            now, last = mine, r
            held.append((r["segment"], Node(*(np.frombuffer(r[c], "<u4") for c in ("chars", "counts", "ids")))))
    if now is not None:
        yield last, held


def encode_digests(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", leaf: int = LEAF, fan: int = FAN, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: the number of ids, and digests of the ids and of the text decoded from them."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))

    def short(batches):
        coder = byte_bpe(vocabulary)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield _rows(batch.column("doc_id").to_pylist(), [_digests(coder, [coder.encode(t)]) for t in texts])

    def split(batches):
        coder = byte_bpe(vocabulary)
        for batch in batches:
            for number, digest, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "digest", "text")), strict=True):
                leaves = [(s, x) for s, segment in enumerate(coder.segments(text)) for x in ([segment] if segment in coder.special else halves(segment, leaf))]
                for at in range(0, len(leaves), 64):
                    some = leaves[at : at + 64]
                    m = len(some)
                    columns = ([number] * m, [digest] * m, [len(text)] * m, [len(leaves)] * m, [s for s, _ in some], list(range(at, at + m)), [x for _, x in some])
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string()), strict=True)], names=[*_NODE_NAMES[:6], "text"])

    def encode(batches):
        coder = byte_bpe(vocabulary)
        u32 = lambda x: x.astype("<u4").tobytes()
        for batch in batches:
            nodes = [_node([len(text)], [1], [coder.special[text]]) if text in coder.special else coder.leaf(text) for text in batch.column("text").to_pylist()]
            kept = [batch.column(c) for c in _NODE_NAMES[:7]]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array([u32(getattr(n, c)) for n in nodes], pa.binary()) for c in ("chars", "counts", "ids"))], names=_NODE_NAMES)

    def segments_of(coder, held):
        """A node for each segment, in order."""
        by_segment: dict[int, list[Node]] = {}
        for segment, node in held:
            by_segment.setdefault(segment, []).append(node)
        return [(s, coder.tree(by_segment[s])) for s in sorted(by_segment)]

    def finished(r, nodes):
        """A row for each copy of a document that is joined to the end."""
        found = _digests(byte_bpe(vocabulary), [n.ids for _, n in nodes])
        for a in range(0, r["copies"], 10_000):
            m = min(10_000, r["copies"] - a)
            yield _rows([r["doc_id"]] * m, [found] * m)

    def neighbours(batches):
        """Joins ``fan`` neighbouring leaves of a segment into one node, in the first one's place; documents that this ends are finished."""
        for r, held in _grouped(batches, (*_KEY, "team")):
            nodes = segments_of(byte_bpe(vocabulary), held)
            if r["leaves"] <= fan:
                yield from (_either(done, None) for done in finished(r, nodes))
            else:
                at = r["team"] * fan
                yield _either(None, _packed([(*(r[c] for c in _KEY), r["leaves"], s, at + i, r["copies"], *(x.astype("<u4").tobytes() for x in (n.chars, n.counts, n.ids))) for i, (s, n) in enumerate(nodes)]))

    def joined(batches):
        for r, held in _grouped(batches, _KEY):
            yield from finished(r, segments_of(byte_bpe(vocabulary), held))

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    long = F.char_length("text") > leaf
    cut = rows.filter(long).select("doc_id", F.xxhash64("text").alias("digest"), "text").mapInArrow(split, f"{_LEAVES}, text string")
    # equal rows have equal leaves: counted before the exchange, encoded once
    keys = [*_KEY, "leaves", "segment", "leaf"]
    leaves = cut.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"))
    teams = leaves.mapInArrow(encode, _NODES).withColumn("team", F.floor(F.col("leaf") / fan).cast("int"))
    teams = teams.repartition(n, *_KEY, "team").sortWithinPartitions(*_KEY, "team", "leaf")
    mixed = materialize(teams.mapInArrow(neighbours, f"{_NODES}, {_DONE}"), "joined-leaves")
    ends = mixed.filter("ids IS NULL").selectExpr("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    rest = mixed.filter("ids IS NOT NULL").select(_NODE_NAMES).repartition(n, *_KEY).sortWithinPartitions(*_KEY, "leaf").mapInArrow(joined, _RESULT)
    whole = ends.unionByName(rest)
    return rows.filter(~long).mapInArrow(short, _RESULT).unionByName(whole)
