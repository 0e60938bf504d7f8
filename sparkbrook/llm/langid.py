"""Language identification with hyperdimensional letter n-gram profiles.

Every letter has a fixed random vector of +1 and -1. An n-gram is one vector: its letters'
vectors, each permuted by a rotation for its place, bound by multiplication. A document
is the bundle (sum) of its n-grams, a language the bundle of its training documents, and
a document gets the language whose prototype has the largest cosine with it.

Bundling is linear, so a batch of documents is one matrix product: n-gram counts times
n-gram vectors. Every labelled document trains. The prototypes are ``languages x dimensions``
numbers whatever the size of the corpus; only they go to the workers.

Null text, text without a letter, and no trained language give ``und`` and 0; equal cosines
give the first language by name; repeated rows are judged alike, and train as often as they
occur; texts of any length count whole, a group of texts at a time; an empty table gives an
empty result. Columns of the input with the names of results are left out of the result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbrook.llm.memory import returning

UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_ROWS = 256
_CHARS = 400_000
_OPEN = 500


@dataclass(frozen=True)
class Profile:
    """Dimensions and n-gram length."""

    dimensions: int = 1024
    n: int = 3
    seed: int = 7


def letters_only(text: str) -> str:
    """Lower-case letters, runs of anything else as one space, a space at either end; or ``""``."""
    words = _NOT_LETTERS.sub(" ", text.lower()).strip()
    words = "".join(c for c in words if c == " " or c.isalpha()) if not words.isascii() else words
    return f" {words} " if words.strip() else ""


class Encoder:
    """N-gram vectors, made on first use and kept in a bounded table."""

    LIMIT = 40_000

    def __init__(self, profile: Profile):
        self.profile = profile
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.table = np.empty((1024, profile.dimensions), np.int8)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            if len(self.letters) > self.LIMIT:
                self.letters.clear()
            rng = np.random.default_rng([self.profile.seed, code])
            self.letters[code] = rng.integers(0, 2, self.profile.dimensions, dtype=np.int8) * 2 - 1
        return self.letters[code]

    def _make(self, gram: int) -> np.ndarray:
        bound = np.ones(self.profile.dimensions, np.int8)
        for place in range(self.profile.n):  # the last letter is in the lowest bits
            bound *= np.roll(self.letter((gram >> (21 * place)) & 0x1FFFFF), place)
        return bound

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        names = grams.tolist()
        missing = [g for g in names if g not in self.rows]
        if len(self.rows) + len(missing) > self.LIMIT:
            self.rows.clear()
            missing = names
        for g in missing:
            at = len(self.rows)
            if at == len(self.table):
                self.table = np.concatenate([self.table, np.empty_like(self.table)])
            self.rows[g] = at
            self.table[at] = self._make(g)
        return self.table[[self.rows[g] for g in names]]

    def grams(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        n = self.profile.n
        if len(codes) < n:
            return np.empty(0, np.int64)
        out = np.zeros(len(codes) - n + 1, np.int64)
        for place in range(n):
            out = (out << 21) | codes[place : place + len(out)]
        return out

    def bundles(self, texts: list[str]) -> np.ndarray:
        """One bundle per text; a text without letters has the zero vector."""
        each = [self.grams(t) for t in texts]
        out = np.zeros((len(texts), self.profile.dimensions), np.float32)
        if not sum(map(len, each)):
            return out
        grams, index = np.unique(np.concatenate(each), return_inverse=True)
        owner = np.repeat(np.arange(len(texts)), [len(e) for e in each])
        for at in range(0, len(grams), 8192):  # in blocks, so that many scripts at once stay small
            width = min(8192, len(grams) - at)
            inside = (index >= at) & (index < at + width) if len(grams) > 8192 else slice(None)
            counts = np.bincount(owner[inside] * width + (index[inside] - at), minlength=len(texts) * width).reshape(len(texts), width)
            out += counts.astype(np.float32) @ self.vectors(grams[at : at + width]).astype(np.float32)
        return out


def _groups(texts: list[str]):
    """Consecutive texts, few enough to handle at once."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and (i - start >= _ROWS or size + len(t) > _CHARS):
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def train_prototypes(labelled: DataFrame, profile: Profile = Profile()) -> tuple[list[str], np.ndarray]:
    """Languages in order, and their unit prototypes, from the columns text and lang.

    Every row with both takes part and weighs the same, however long. Workers bundle their
    own documents; their sums are added by dimension.
    """
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")

    def rows_of(sums):
        for lang, v in sums.items():
            whole = np.rint(v * 2**20).astype(np.int64)  # whole numbers: the sum has no order
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(whole)), pa.array(range(len(whole)), pa.int32()), pa.array(whole)], names=["lang", "d", "v"])

    def bundle(batches):
        encoder, sums = Encoder(profile), {}
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), [letters_only(t) for t in batch.column("text").to_pylist()]
            for a, b in _groups(texts):
                v = encoder.bundles(texts[a:b])
                size = np.linalg.norm(v, axis=1, keepdims=True)
                v = v / np.where(size > 0, size, 1)
                for lang in set(langs[a:b]):
                    part = v[[i for i, x in enumerate(langs[a:b]) if x == lang]].sum(0, dtype=np.float64)
                    sums[lang] = sums.get(lang, 0) + part
                if len(sums) > _OPEN:  # bounded memory: what is known goes out, and is forgotten
                    yield from rows_of(sums)
                    sums.clear()
        yield from rows_of(sums)

    sums = usable.mapInArrow(returning(bundle), "lang string, d int, v long").groupBy("lang", "d").agg(F.sum("v").alias("v"))
    sums = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("d", "v")))["v"].alias("v")).toArrow()
    names = sorted(sums.column("lang").to_pylist())
    table, places = np.zeros((len(names), profile.dimensions), np.float32), {name: i for i, name in enumerate(names)}
    for batch in sums.to_batches():
        rows = batch.column("v").flatten().to_numpy().reshape(-1, profile.dimensions).astype(float)
        size = np.linalg.norm(rows, axis=1, keepdims=True)
        table[[places[lang] for lang in batch.column("lang").to_pylist()]] = rows / np.where(size > 0, size, 1)
    return names, table


def identify(docs: DataFrame, names: list[str], prototypes: np.ndarray, profile: Profile = Profile(), text_column: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, the cosine with the winner, at least 0.

    Rows are independent: no exchange.
    """
    docs = docs.select([F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "score")])
    schema = docs.schema

    def run(batches):
        encoder = Encoder(profile)
        for batch in batches:
            texts = [letters_only(t or "") for t in batch.column(at).to_pylist()]
            preds, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for a, b in _groups(texts) if names else ():
                v = encoder.bundles(texts[a:b])
                size = np.linalg.norm(v, axis=1)
                cosine = (v @ prototypes.T) / np.where(size > 0, size, 1)[:, None]
                best = cosine.argmax(1)
                for i in np.flatnonzero(size > 0):
                    preds[a + i], scores[a + i] = names[best[i]], min(1.0, max(0.0, float(cosine[i, best[i]])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(preds), pa.array(scores)], names=[*batch.schema.names, "lang_pred", "score"])

    at = docs.columns.index(text_column)
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return docs.mapInArrow(returning(run), f"{out}, lang_pred string, score double")


def held_out(id_column: str = "doc_id"):
    """True for the documents that training never sees."""
    return F.crc32(F.col(id_column).cast("string")) % 4 == 2
