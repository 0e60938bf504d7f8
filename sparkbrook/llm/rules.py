"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target to the raw corpus.

Words are cut at ASCII white space. The n-grams are whole words and, from a ``width`` of 2,
pairs of adjacent words, hashed into ``buckets`` cells. Two multinomials over the cells, one of all documents and
one of the trusted documents, however many, give each cell a log ratio with ``prior``
pseudo-counts; a document's verdict is the mean ratio of its n-grams against a threshold.
Ratios are rounded to whole millionths, so sums have no order and the verdict is the same
on every run.

A threshold that isn't given comes from trusted documents that are kept out of the target,
a quarter of them by a checksum of the id: it is the ratio that all but a share of those
reach that pass the base rules, 0 at most, and ``fallback`` where there are none.

Everything is DataFrame expressions: arrays within the row for what concerns one
document, one aggregation with map-side sums for the corpus (at most ``buckets`` rows per
task are exchanged, whatever the skew of texts or words), and a broadcast table of
``buckets`` numbers for scoring. Trusted ids are broadcast up to a counted bound; beyond, their
documents are found by a shuffled join and written once. The threshold's place among the
ratios is found by counts in bins, so no task holds them all.

Null text has no words, so it fails the base rules; repeated rows are judged alike and
count as often as they occur, in both multinomials where their id is trusted; null ids are
trusted by nothing; texts of any length are judged whole, in arrays of their words; a ratio
that equals the threshold is kept; with no trusted document the ratios are 0 and the base
rules decide; an empty table gives an empty result. Columns of the input with the names of
results are left out of the result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbrook.scratch import materialize


@dataclass(frozen=True)
class Rules:
    """width: words of the longest n-grams, 1 or 2.

    threshold: None to take it from the trusted documents that are kept out; then ``keep``
    is the share of them that passes.
    """

    buckets: int = 16_384
    width: int = 1
    prior: float = 5.0
    threshold: float | None = -0.4
    keep: float = 0.995
    fallback: float = -0.1
    min_words: int = 20
    max_repeated_percent: int = 30
    window: int = 8


#: What the query and the pipeline use: words and pairs, with a threshold from trusted documents kept out of the target.
PAIRS = Rules(width=2, threshold=None)

#: Up to so many trusted ids are broadcast; beyond, the join is shuffled.
BROADCAST_IDS = 1_000_000
#: Counts that come to the driver at once where a threshold is looked for.
_BINS = 4096

_SPACE = "[ \\\\t-\\\\r]+"
_BLANK = " \\t\\n\\u000b\\u000c\\r"
#: Fixed value: the characters that count as symbols.
_SYMBOLS = "#*$%&|<>"


def _once(sql: str):
    """An expression that the optimizer leaves where it is.

    Filters move down through projections by putting expressions in place of names; inside
    a lambda that would compute an array anew for each of its elements. Spark moves
    nothing across a partition id, which is never negative.
    """
    return F.expr(f"CASE WHEN spark_partition_id() >= 0 THEN {sql} END")


def _worded(docs: DataFrame, text_column: str) -> DataFrame:
    """Adds _text and _words."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    trimmed = f"trim(BOTH '{_BLANK}' FROM _text)"
    return docs.withColumn("_text", text).withColumn("_words", _once(f"CASE WHEN {trimmed} = '' THEN CAST(array() AS array<string>) ELSE split({trimmed}, '{_SPACE}') END"))


_HASHES = "transform(_words, w -> xxhash64(w))"


def _joined(name: str, step: int, width: int) -> str:
    """SQL of an array against itself moved on, in pairs of equal length."""
    return f"zip_with(slice({name}, 1, size(_words) - {width - 1}), slice({name}, {step + 1}, size(_words) - {width - 1}), (a, b) -> xxhash64(a, b))"


def _cells(rules: Rules) -> str:
    """SQL of the cells of a document's n-grams, from _words, _hashes and _two."""
    if rules.width not in (1, 2):
        raise ValueError("n-grams are words or words and pairs")
    grams = "concat(_hashes, coalesce(_two, CAST(array() AS array<bigint>)))" if rules.width == 2 else "_hashes"
    return f"transform({grams}, h -> CAST(pmod(h, {rules.buckets}) AS INT))"


def _known(docs: DataFrame, trusted: DataFrame, text_column: str) -> DataFrame:
    """The rows of ``docs`` with trusted ids: text, and whether the id is kept out of the target where a threshold is fitted."""
    ids = trusted.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    ids = materialize(ids.withColumn("_out", F.crc32(F.col("doc_id").cast("string")) % 4 == 3), "trusted")
    few = ids.count() <= BROADCAST_IDS
    known = docs.select("doc_id", F.col(text_column).alias("text")).join(F.broadcast(ids) if few else ids, "doc_id").select("text", "_out")
    return known if few else materialize(known, "known")


def ratios(docs: DataFrame, target: DataFrame, rules: Rules, text_column: str = "text") -> DataFrame:
    """One row: an array with each cell's log ratio in millionths. ``target``: the texts of all its documents, a column text."""
    raw = docs.select(F.col(text_column).alias("text"), F.lit(1).alias("_raw"), F.lit(None).cast("int").alias("_trusted"))
    flagged = raw.unionByName(target.select("text", F.lit(None).cast("int").alias("_raw"), F.lit(1).alias("_trusted")))
    hashed = _worded(flagged, "text").withColumn("_hashes", _once(_HASHES)).withColumn("_two", _once(f"CASE WHEN size(_words) > 1 THEN {_joined('_hashes', 1, 2)} END"))
    grams = hashed.select("_raw", "_trusted", F.explode_outer(F.expr(_cells(rules))).alias("cell")).filter("cell IS NOT NULL")
    counts = grams.groupBy("cell").agg(F.count("_raw").alias("raw"), F.count("_trusted").alias("target"))
    every = docs.sparkSession.range(rules.buckets, numPartitions=1).select(F.col("id").cast("int").alias("cell"))
    table = every.join(counts, "cell", "left").select("cell", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target"))
    listed = table.agg(F.sum("raw").alias("n_raw"), F.sum("target").alias("n_target"), F.sort_array(F.collect_list(F.struct("cell", "raw", "target"))).alias("cells"))
    ratio = f"ln((c.target + {rules.prior}D) / (c.raw * CAST(n_target AS DOUBLE) / greatest(n_raw, 1) + {rules.prior}D))"
    return listed.select(F.expr(f"transform(cells, c -> CASE WHEN n_target = 0 THEN 0 ELSE CAST(round({ratio} * 1000000) AS INT) END)").alias("_ratios"))


def base_columns(rules: Rules) -> list[tuple[str, str]]:
    """(name, SQL) in order of use, from _text and _words."""
    n, k = "n_words", rules.window
    if k != 8:
        raise ValueError("windows are hashed by doubling: 8 words")
    same = "_sorted[i].w = _sorted[greatest(i - 1, 0)].w"
    return [
        ("n_words", "CAST(size(_words) AS BIGINT)"),
        ("word_chars", "CAST(char_length(array_join(_words, '')) AS BIGINT)"),
        ("n_symbols", f"CAST(char_length(_text) - char_length(regexp_replace(_text, '[{_SYMBOLS}]', '')) AS BIGINT)"),
        ("_lines", f"filter(split(_text, '\\n'), l -> trim(BOTH '{_BLANK}' FROM l) <> '')"),
        ("n_dup_lines", "CAST(size(_lines) - size(array_distinct(_lines)) AS BIGINT)"),
        ("_hashes", _HASHES),
        ("_two", f"CASE WHEN {n} > 1 THEN {_joined('_hashes', 1, 2)} END"),
        ("_four", f"CASE WHEN {n} > {k} THEN {_joined('_two', 2, 4)} END"),
        # no window occurs twice where no half of one does
        ("_windows", f"CASE WHEN size(array_distinct(_four)) < size(_four) THEN {_joined('_four', 4, 8)} END"),
        ("_sorted", "CASE WHEN size(array_distinct(_windows)) < size(_windows) THEN sort_array(transform(_windows, (w, i) -> struct(w, i))) END"),
        (
            "_places",
            f"sort_array(transform(filter(sequence(0, size(_sorted) - 1), i -> i > 0 AND {same} "
            "OR i < size(_sorted) - 1 AND _sorted[least(i + 1, size(_sorted) - 1)].w = _sorted[i].w), i -> _sorted[i].i))",
        ),
        (
            "n_repeat_words",
            f"CASE WHEN _places IS NULL THEN 0L ELSE CAST(aggregate(sequence(1, size(_places) - 1), {k}, (s, i) -> s + least({k}, _places[i] - _places[i - 1])) AS BIGINT) END",
        ),
        ("base_failed", f"{n} < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeated_percent} * {n}"),
    ]


RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept")


def _judged(frame: DataFrame, table: DataFrame, rules: Rules, text_column: str) -> DataFrame:
    """Adds the base columns, and llr by the one row of ``table``."""
    frame = _worded(frame, text_column)
    for name, sql in base_columns(rules):
        frame = frame.withColumn(name, _once(sql))
    frame = frame.withColumn("_cells", _once(_cells(rules))).withColumn("_one", F.lit(1))
    frame = frame.join(F.broadcast(table.withColumn("_one", F.lit(1))), "_one", "left")
    total = "aggregate(_cells, 0L, (s, c) -> s + _ratios[c])"
    return frame.withColumn("llr", _once(f"CASE WHEN size(_cells) = 0 THEN 0D ELSE {total} / size(_cells) / 1000000D END"))


def _percentile(values: DataFrame, share: float) -> float | None:
    """What F.percentile gives for the one column of ``values``, of numbers; the range around the place shrinks bin by bin."""
    x = F.col(f"`{values.columns[0]}`")
    n, low, high = values.agg(F.count(x), F.min(x), F.max(x)).first()
    if n == 0:
        return None
    place = (n - 1) * share
    rank, below, top = math.floor(place), 0, high
    while low < high:
        there = F.least(F.floor((x - F.lit(low)) / F.lit((high - low) / _BINS)), F.lit(_BINS - 1))
        counts = values.filter(x.between(low, high)).groupBy(there.alias("bin")).agg(F.count(x), F.min(x), F.max(x)).collect()
        for _, count, low, high in sorted(counts):
            if below + count > rank:
                break
            below += count
    # low is the value of that rank; the next one is the same unless it is the last of its kind
    if place == rank or low == top or below + count > rank + 1:
        return low
    return (rank + 1 - place) * low + (place - rank) * values.filter(x > low).agg(F.min(x)).first()[0]


def fitted_threshold(kept_out: DataFrame, table: DataFrame, rules: Rules) -> float:
    """The ratio that a share ``rules.keep`` of the documents in ``kept_out`` reaches, a column text; all of them count."""
    passed = materialize(_judged(kept_out, table, rules, "text").filter("NOT base_failed").select("llr"), "reached")
    found = _percentile(passed, 1 - rules.keep)
    return rules.fallback if found is None else min(0.0, found)


def judge(docs: DataFrame, trusted: DataFrame, rules: Rules = Rules(), text_column: str = "text") -> DataFrame:
    """``docs`` with the base counts, base_failed, the mean log ratio llr, and kept. ``trusted``: a column doc_id."""
    kept_columns = [c for c in docs.columns if c.lower() not in RESULT]
    known = _known(docs, trusted, text_column)
    threshold = rules.threshold
    if threshold is None:
        table = materialize(ratios(docs, known.filter("NOT _out"), rules, text_column), "ratios")
        threshold = fitted_threshold(known.filter("_out"), table, rules)
    else:
        table = ratios(docs, known, rules, text_column)
    frame = _judged(docs.select([F.col(f"`{c}`") for c in kept_columns]), table, rules, text_column)
    frame = frame.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(threshold)))
    return frame.select(*[F.col(f"`{c}`") for c in kept_columns], *RESULT)
