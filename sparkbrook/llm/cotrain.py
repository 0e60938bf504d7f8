"""Co-training of a text classifier and a metadata classifier for document quality.

Two views of a document: what its text looks like (surface statistics and hashed words)
and what is known about it (source, language, length). Each view has a logistic model.
In every round each model scores all unlabelled documents, labels those that it is most
sure of, and the other model learns from those labels. The labelled documents that
training leaves out calibrate both models (Platt scaling) and fit the weights of the two
calibrated log-odds. Only the models, whose size is fixed, go to the workers, which score
every document whole.

Labels are taken from documents that a hash of the id picks, at most ``labelled`` of
them. Features are computed once and written; in a round every task returns the surest
documents of its rows, of which the surest of all are taken, ``per_round`` a teacher, by
the share of each class. Rows that share an id count once. Without labels of both classes every document
scores the share of good labels (0.5 without any). Null or empty text has the statistics
of no words, and texts of any length are read whole; null metadata is a value of its own;
repeated rows score alike; equally sure documents are taken in the order of a checksum of
the id; an empty table gives an empty result; columns other than doc_id, text, source, lang
and n_chars, whatever their names, are not read.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkbrook.llm.memory import returning
from sparkbrook.scratch import materialize


@dataclass(frozen=True)
class CoTraining:
    labelled: int = 4000
    rounds: int = 4
    per_round: int = 200
    sure: float = 0.9
    cells: int = 2048
    threshold: float = 0.5
    seed: int = 5


_STATS = 12
_META = 256
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[^\w\s.,;:'\"!?()-]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_DIGIT = re.compile(r"\d")
_STRONG = re.compile(r"[!?]")


class TextView:
    """Surface statistics, then the square-rooted shares of hashed words."""

    LIMIT = 400_000

    def __init__(self, cells: int):
        self.cells, self.known = cells, {}

    def __call__(self, text: str | None) -> np.ndarray:
        out = np.zeros(_STATS + self.cells, np.float32)
        text = text or ""
        words = _WORD.findall(text)
        n, size = len(words), max(1, len(text))
        lines = [line for line in text.split("\n") if line.strip()]
        out[:_STATS] = (
            1.0,
            min(1.0, np.log1p(n) / 10),
            min(2.0, 10 * len(_SYMBOL.findall(text)) / size),
            3 * len(_UPPER.findall(text)) / size,
            5 * len(_DIGIT.findall(text)) / size,
            len(_STRONG.findall(text)) / max(1, n),
            3 * (1 - len(set(words)) / n) if n else 0,
            min(2.0, size / max(1, n) / 10),
            1 - len(set(lines)) / len(lines) if lines else 0,
            text.count("|") / max(1, n),
            float(n < 20),
            3 * sum(a == b for a, b in zip(words, words[1:])) / max(1, n),
        )
        if n:
            new = set(words).difference(self.known)
            if new:
                if len(self.known) + len(new) > self.LIMIT:
                    self.known.clear()
                    new = set(words)
                for w in new:
                    self.known[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) % self.cells
            counts = np.bincount(np.fromiter(map(self.known.__getitem__, words), np.int64, n), minlength=self.cells)
            out[_STATS:] = np.sqrt(counts / n)
        return out


def meta_view(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    out = np.zeros(_META, np.float32)
    size = -1 if n_chars is None else min(30, int(np.log2(n_chars + 1) * 2)) if n_chars >= 0 else -2
    for name in ("bias", f"source={source}", f"lang={lang}", f"size={size}"):
        out[zlib.crc32(name.encode("utf-8", "surrogatepass")) % _META] = 1.0
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-3, steps: int = 150) -> np.ndarray:
    """Weights by accelerated gradient descent; the step comes from a bound of the curvature."""
    w = np.zeros(x.shape[1], np.float32)
    weight = np.ones(len(y)) if weight is None else weight
    weight = (weight / weight.sum()).astype(np.float32)
    x = x.astype(np.float32)
    v = np.ones(x.shape[1], np.float32)
    for _ in range(12):
        v = x.T @ (weight * (x @ v))
        bound = np.linalg.norm(v)
        v /= max(bound, 1e-12)
    step, ahead, t = float(1 / (0.3 * bound + ridge)), w, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        new = ahead - step * (x.T @ (weight * (p - y.astype(np.float32))) + ridge * ahead)
        t, before = float(1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = new + (before - 1) / t * (new - w), new
    return w


@dataclass
class Model:
    text: np.ndarray
    meta: np.ndarray
    platt: np.ndarray  # per view: slope and offset
    mix: np.ndarray  # weight of each view's calibrated log-odds, and an offset
    prior: float


def _odds(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w, -30, 30)


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, pick, how: CoTraining) -> Model:
    """Fits both views; rows are in a fixed order, every fourth is kept for calibration.

    ``pick(weights, taken, quotas)``: the surest unlabelled documents that a learner has not
    taken, as a list of (learner, label, id, text, meta) in a fixed order.
    """
    prior = float(y.mean()) if len(y) else 0.5
    held = np.arange(len(y)) % 4 == 3
    if len(np.unique(y[~held])) < 2 or len(np.unique(y[held])) < 2:
        flat = np.zeros(2)
        return Model(np.zeros(text.shape[1]), np.zeros(meta.shape[1]), np.array([flat, flat]), np.zeros(3), prior)
    views = [[text[~held], y[~held].astype(float)], [meta[~held], y[~held].astype(float)]]
    taken: list[set[int]] = [set(), set()]
    base = float(views[0][1].mean())
    for turn in range(how.rounds + 1):
        weights = [fit_logistic(x, t) for x, t in views]
        if turn == how.rounds:
            break
        quotas = [max(1, round(how.per_round * share)) for share in (1 - base, base)]
        picked = pick(weights, taken, quotas)
        if not picked:  # the weights stay as they are, and so would all later rounds
            break
        for learner in (0, 1):
            new = [r for r in picked if r[0] == learner]
            if new:
                taken[learner].update(r[2] for r in new)
                views[learner] = [np.concatenate([views[learner][0], np.stack([r[3 + learner] for r in new])]), np.concatenate([views[learner][1], [float(r[1]) for r in new]])]
    t = y[held].astype(float)
    odds = [_odds(text[held], weights[0]), _odds(meta[held], weights[1])]
    platt = np.array([fit_logistic(np.stack([o, np.ones_like(o)], 1), t, ridge=1e-4, steps=400) for o in odds])
    calibrated = np.stack([*(o * s + b for o, (s, b) in zip(odds, platt, strict=True)), np.ones_like(t)], 1)
    return Model(weights[0], weights[1], platt, fit_logistic(calibrated, t, ridge=1e-4, steps=400), prior)


def _meta_columns(docs: DataFrame) -> list:
    have = set(docs.columns)
    get = lambda name, kind: (F.col(name) if name in have else F.lit(None)).cast(kind).alias(name)
    return [get("source", "string"), get("lang", "string"), get("n_chars", "long")]


def _features(how: CoTraining):
    def run(batches):
        view = TextView(how.cells)
        for batch in batches:
            rows = batch.to_pylist()
            texts = [view(r["text"]).astype("<f4").tobytes() for r in rows]
            metas = [meta_view(r["source"], r["lang"], r["n_chars"]).astype("<f4").tobytes() for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array([zlib.compress(t, 1) for t in texts], pa.binary()), pa.array(metas, pa.binary())], names=["doc_id", "quality", "t", "m"])

    return run


def _unpacked(t: bytes, m: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(zlib.decompress(bytes(t)), "<f4"), np.frombuffer(bytes(m), "<f4")


def _surest(weights: list[np.ndarray], taken: list[set[int]], quotas: list[int], how: CoTraining):
    """The surest documents of a task's rows for each learner and label, each id once."""

    def run(batches):
        best: dict[tuple[int, int], dict] = {(learner, label): {} for learner in (0, 1) for label in (0, 1)}

        def cut(found: dict, n: int) -> dict:
            return dict(sorted(found.items(), key=lambda e: (-e[1][0], zlib.crc32(str(e[0]).encode()), e[0]))[:n])

        for batch in batches:
            ids, ts, ms = (batch.column(c).to_pylist() for c in ("doc_id", "t", "m"))
            if not ids:
                continue
            views = [np.stack(x) for x in zip(*map(_unpacked, ts, ms), strict=True)]
            for learner in (0, 1):
                # rounded, so that the order does not depend on how rows are batched
                odds = np.round(_odds(views[1 - learner].astype(float), weights[1 - learner].astype(float)), 6)
                p = 1 / (1 + np.exp(-odds))
                for label, sure in ((1, p), (0, 1 - p)):
                    found = best[learner, label]
                    for i in np.flatnonzero(sure >= how.sure).tolist():
                        row = (float(sure[i]), ts[i], ms[i])
                        if ids[i] not in taken[learner] and (ids[i] not in found or found[ids[i]] < row):
                            found[ids[i]] = row
                    if len(found) > quotas[label]:
                        best[learner, label] = cut(found, quotas[label])
        rows = [(learner, label, i, *row) for (learner, label), found in best.items() for i, row in found.items()]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], names=["learner", "label", "doc_id", "sure", "t", "m"])

    return run


def train(docs: DataFrame, labels: DataFrame, how: CoTraining = CoTraining()) -> Model:
    """The model from a bounded sample of labelled documents and all unlabelled ones."""
    labelled = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    draw = F.xxhash64(F.lit(how.seed), "doc_id")
    some = labelled.orderBy(draw, "doc_id").limit(how.labelled)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *_meta_columns(docs)).filter("doc_id IS NOT NULL").join(F.broadcast(some), "doc_id", "left")
    features = materialize(rows.mapInArrow(returning(_features(how)), "doc_id long, quality int, t binary, m binary"), "features")
    # one row per id, reduced before the exchange: rows that repeat an id never reach the driver
    known = features.filter("quality IS NOT NULL").groupBy("doc_id", "quality").agg(F.min(F.struct("t", "m")).alias("_least")).select("doc_id", "quality", "_least.*").collect()
    known.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]))
    free = features.filter("quality IS NULL").select("doc_id", "t", "m")

    def pick(weights, taken, quotas):
        each = free.mapInArrow(returning(_surest(weights, taken, quotas, how)), "learner int, label int, doc_id long, sure double, t binary, m binary")
        each = each.groupBy("learner", "label", "doc_id").agg(F.max(F.struct("sure", "t", "m")).alias("_most")).select("learner", "label", "doc_id", "_most.*")
        place = F.row_number().over(Window.partitionBy("learner", "label").orderBy(F.desc("sure"), F.crc32(F.col("doc_id").cast("string")), "doc_id"))
        top = each.withColumn("place", place).filter(F.col("place") <= F.when(F.col("label") == 1, quotas[1]).otherwise(quotas[0])).filter(F.col("place") <= max(quotas)).collect()
        top.sort(key=lambda r: (r["learner"], -r["label"], r["place"]))
        return [(r["learner"], r["label"], r["doc_id"], *_unpacked(r["t"], r["m"])) for r in top]

    unpacked = [_unpacked(r["t"], r["m"]) for r in known]
    text, meta = (np.stack(x) for x in zip(*unpacked, strict=True)) if known else (np.empty((0, _STATS + how.cells), np.float32), np.empty((0, _META), np.float32))
    return co_train(text, meta, np.array([r["quality"] for r in known], int), pick, how)


def score(docs: DataFrame, model: Model, how: CoTraining = CoTraining()) -> DataFrame:
    """doc_id, text_score, meta_score (each calibrated), score and kept, a row per row."""

    def run(batches):
        view = TextView(how.cells)
        for batch in batches:
            rows = batch.to_pylist()
            t = np.array([float(view(r["text"]) @ model.text) for r in rows]).clip(-30, 30)
            m = np.array([float(meta_view(r["source"], r["lang"], r["n_chars"]) @ model.meta) for r in rows]).clip(-30, 30)
            t, m = t * model.platt[0, 0] + model.platt[0, 1], m * model.platt[1, 0] + model.platt[1, 1]
            both = t * model.mix[0] + m * model.mix[1] + model.mix[2]
            if not model.mix.any():
                both = np.full(len(rows), np.log(max(model.prior, 1e-9) / max(1 - model.prior, 1e-9)))
            p = 1 / (1 + np.exp(-both.clip(-30, 30)))
            each = [1 / (1 + np.exp(-x.clip(-30, 30))) for x in (t, m)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, each), pa.array(p), pa.array(p >= how.threshold)], names=["doc_id", "text_score", "meta_score", "score", "kept"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *_meta_columns(docs))
    return rows.mapInArrow(returning(run), "doc_id long, text_score double, meta_score double, score double, kept boolean")


def classify(docs: DataFrame, labels: DataFrame, how: CoTraining = CoTraining()) -> DataFrame:
    return score(docs, train(docs, labels, how), how)
