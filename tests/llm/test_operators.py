"""Each operator against a brute-force version, an exact round trip or held-out accuracy."""

import gzip
import hashlib
import math
import random
import struct
import zlib
from collections import Counter, defaultdict
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("sparkbrook.llm")

from sparkbrook.llm import bpe, catalog, cotrain, html, langid, neardup, packing, rules, sharding, tokens, vectors, warc  # noqa: E402
from sparkbrook.llm.components import connected_components  # noqa: E402

SF = "/root/testdata/sf0.001"
BYTES, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"


def components_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# --- BPE --------------------------------------------------------------------------------
ATOMS = ["a", "b", " ", "  ", "'", "'ll", "s", "é", "12", "!", "\n", "the", " of", "ing", "<|endoftext|>", "中", " \t", "²", "ſ", "\x1d", "é", "Σ", "½", "😀", "👩‍👩‍👧", "שלום", "مرحبا ", "हिन्दी", "ไทย", "\u2028", "\xa0", "\u3000", "٣"]


def by_tree(coder, text, leaf):
    out = []
    for part in coder.segments(text):
        out += [coder.special[part]] if part in coder.special else coder.tree([coder.leaf(x) for x in bpe.halves(part, leaf)]).ids.tolist()
    return out


def test_tree_concatenation_equals_library(monkeypatch):
    coder, library, rng = bpe.byte_bpe(BYTES), tokens.load(BYTES), random.Random(3)
    for _ in range(600):
        text = "".join(rng.choice(ATOMS[: rng.choice([5, 12, 16, 22, len(ATOMS)])]) for _ in range(rng.randint(0, 60)))
        want = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == want
        assert all(by_tree(coder, text, leaf) == want for leaf in (1, 3, 13)), text
        assert coder.decode(want) == library.decode(want, skip_special_tokens=False)
    monkeypatch.setattr(bpe, "LONG", 16)  # long words without a split go by halves too
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", "e", "th", "er", "in", "ab"][: rng.randint(1, 7)]) for _ in range(rng.randint(1, 400)))
        want = library.encode(text, add_special_tokens=False).ids
        assert coder.word(text.encode()) == want
        assert by_tree(coder, text, 33) == want


def test_word_vocabulary_equals_library():
    mine, library, rng = tokens.word_bpe(WORDS), tokens.load(WORDS), random.Random(4)
    for _ in range(800):
        text = "".join(rng.choice([*ATOMS, "İ", "Ä", "ß", "½", "don't", "I'LL", " ", "_", "٣"]) for _ in range(rng.randint(0, 60)))
        assert mine.packed(text) == tokens._pack(library.encode(text, add_special_tokens=False).ids), text


def test_encode_digests_of_long_and_short_texts(spark):
    rows = [(1, "short text"), (2, "word " * 900 + "x" * 5000 + "<|endoftext|>" + " tail's" * 700), (2, "again " * 999), (None, "é" * 4000), (3, None), (4, "")]
    rng = random.Random(13)
    mixed = "".join(rng.choice([*ATOMS, " the", " word", " नमस्ते", "،"]) for _ in range(1500))
    rows += [(5, mixed), (6, "😀" * 700 + "½ " * 300 + "مرحبا بالعالم " * 60 + "<|endoftext|>" + "हिन्दी में " * 40), (7, "ab" * 900)] + [(8, mixed[::-1])] * 3 + [(8, mixed[1:])]
    library = tokens.load(BYTES)

    def digest(number, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        return number, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    frame, want = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), Counter(digest(*r) for r in rows)
    for leaf, fan in ((1, 64), (7, 3), (500, 2), (500, 64)):
        some = frame if leaf > 1 else frame.filter("doc_id IN (4, 5, 6, 8)")
        found = Counter(tuple(r) for r in bpe.encode_digests(some, leaf=leaf, fan=fan).collect())
        assert found == (want if leaf > 1 else Counter({k: v for k, v in want.items() if k[0] in (4, 5, 6, 8)})), (leaf, fan)


# --- packing ----------------------------------------------------------------------------
def check_plan(histogram, capacity):
    fill, seen = defaultdict(list), Counter()
    for length, rank, count, first, offset in packing.plan_bins(histogram, capacity):
        assert rank == seen[length]
        seen[length] += count
        for i in range(count):
            fill[first + i].append((offset, length))
    assert seen == Counter({k: v for k, v in histogram.items() if v})
    for pieces in fill.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity.tokens and len(pieces) <= capacity.documents and sum(n * n for _, n in pieces) <= capacity.attention
    return len(fill)


def test_plan_holds_every_capacity():
    rng = random.Random(1)
    for _ in range(150):
        capacity = packing.Capacity(64, rng.choice([2, 3, 64]), rng.choice([4096, 5000]), score=rng.choice(["dot", "norm"]))
        check_plan({rng.randint(1, 64): rng.randint(0, 40) for _ in range(rng.randint(0, 30))}, capacity)
    with pytest.raises(ValueError):
        packing.plan_bins({65: 1}, packing.Capacity(64, 5, 99999))


def test_plan_is_near_the_bound():
    rng = random.Random(2)
    histogram = Counter(min(2048, int(rng.expovariate(1 / 700)) + 1) for _ in range(20_000))
    histogram[300] += 8000
    bound = -(-sum(k * v for k, v in histogram.items()) // 2048)
    assert check_plan(histogram, packing.Capacity()) <= 1.01 * bound


def test_packed_pieces_are_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "word " * 5000), (-4, "same"), (-4, "same")], "doc_id long, text string"))
    packed = packing.pack_documents(docs).toPandas()
    library, want = tokens.load(WORDS), Counter()
    for number, text in docs.collect():
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for at in range(0, len(ids), 2048):
            part = ids[at : at + 2048]
            want[(number, at // 2048, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))] += 1
    assert Counter(packed[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == want
    for _, group in packed.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert list(group.offset) == [0, *np.cumsum(group.length)[:-1]] and group.length.sum() <= 2048
    assert packed.sequence_id.nunique() <= 1.02 * packed.length.sum() / 2048 + 1


# --- language ---------------------------------------------------------------------------
def test_held_out_accuracy(spark):
    found = catalog.op4_hyperdimensional_langid(spark, "/root/testdata/sf0.01").toPandas()
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    both = found.merge(truth, on="doc_id")
    assert (both[both.held_out].lang_pred == both[both.held_out].lang).mean() > 0.98
    assert both.score.between(0, 1).all()
    assert all((zlib.crc32(str(i).encode()) % 4 == 2) == h for i, h in zip(found.doc_id, found.held_out))


def test_bundles_and_cosines_by_loops(spark):
    profile = langid.Profile(dimensions=64)
    encoder = langid.Encoder(profile)

    def bundle(text):
        letters = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
        out = [0] * 64
        for a, b, c in zip(letters, letters[1:], letters[2:]):
            va, vb, vc = (encoder.letter(ord(x)).tolist() for x in (a, b, c))
            for i in range(64):
                out[i] += va[(i - 2) % 64] * vb[(i - 1) % 64] * vc[i]
        return out

    texts = ["The cat, the mat!", "Ça va bien; très bien", "ab", "x", "été 12 été", "Straße ohne Ende"]
    bundles = [bundle(t) for t in texts]
    assert encoder.bundles([langid.letters_only(t) for t in texts]).tolist() == bundles
    unit = lambda v: [x / math.sqrt(sum(y * y for y in v)) for x in v]
    langs = ["en", "fr", "en", "en", "fr", "de"]
    prototypes = {name: unit([sum(x) for x in zip(*(unit(b) for b, la in zip(bundles, langs) if la == name))]) for name in sorted(set(langs))}
    docs = spark.createDataFrame([(i, t, la, 1.5, "x") for i, (t, la) in enumerate(zip(texts, langs))], "doc_id long, text string, lang string, score double, lang_pred string")
    names, table = langid.train_prototypes(docs, profile)
    found = langid.identify(docs, names, table, profile)
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    for r in found.collect():
        cosines = {name: sum(a * b for a, b in zip(unit(bundles[r["doc_id"]]), p)) for name, p in prototypes.items()}
        assert abs(r["score"] - max(0, max(cosines.values()))) < 1e-5 and abs(cosines[r["lang_pred"]] - max(cosines.values())) < 1e-5


def test_every_language_can_be_predicted(spark):
    rng = random.Random(4)
    words = {f"l{i:03}": "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12)) for i in range(600)}
    docs = spark.createDataFrame([(i, f"{w} {w}", lang) for i, (lang, w) in enumerate(words.items())], "doc_id long, text string, lang string")
    profile = langid.Profile(dimensions=256)
    names, prototypes = langid.train_prototypes(docs, profile)
    assert names == sorted(words)
    assert all(r["lang"] == r["lang_pred"] for r in langid.identify(docs, names, prototypes, profile).collect())


# --- WARC -------------------------------------------------------------------------------
def test_loser_tree_merges_sorted_runs():
    rng = random.Random(5)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(rng.randint(0, 50) for _ in range(rng.randint(0, 30))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs], lambda x: x)) == sorted(x for r in runs for x in r)


def strict_records(data, offset=0):
    """(offset, fields, block) of the gzip members of a file, by the letter of the format and nothing of the package."""
    while offset < len(data):
        unpack = zlib.decompressobj(31)
        plain = unpack.decompress(data[offset:])
        assert unpack.eof
        after = len(data) - len(unpack.unused_data)
        if plain:
            head, _, rest = plain.partition(b"\r\n\r\n")
            version, *lines = head.split(b"\r\n")
            assert version == b"WARC/1.1"
            fields = {k.decode(): v.decode() for k, v in (line.split(b": ", 1) for line in lines)}
            n = int(fields["Content-Length"])
            assert len(rest) == n + 4 and rest[n:] == b"\r\n\r\n"
            yield offset, fields, rest[:n]
        offset = after


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_archives_round_trip_and_order(spark, tmp_path, broadcast_rows):
    big = "é" * 60
    rows = [(5, "http://www.b.com/x", big), (3, "https://a.com/?q=1", big), (4, None, "small"), (6, "http://a.com/\r\nbad", "small"), (7, "http://z.org", None), (8, "http://c.org:81/p", "WARC/1.1\r\n\r\n" * 30), (None, "http://d.org", "n"), (9, "x", "\r\n\r\n" + big), (10, "http://long.org", "long " * 400_000)]
    rows += [(i, f"http://h{i % 7}.org/{i % 3}", f"page {i} " * 20) for i in range(20, 120)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    index = warc.archive_and_index(pages, str(tmp_path / "warc"), range_rows=9, file_bytes=3000, broadcast_rows=broadcast_rows).collect()
    assert len(index) == len(rows) and [r["position"] for r in index] == list(range(len(rows)))
    order = [(r["url_key"], r["timestamp"], r["page_id"] is not None, r["page_id"] or 0) for r in index]
    assert order == sorted(order) and len({r["timestamp"] for r in index}) == len(rows)
    by_id = {r["page_id"]: r for r in index}
    for number, _, text in rows:
        data = (text or "").encode()
        assert (by_id[number]["payload_bytes"], by_id[number]["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
    assert (by_id[5]["record_type"], by_id[5]["refers_to"]) == ("revisit", 3)
    assert {r["record_type"] for i, r in by_id.items() if i != 5} == {"response"}
    # a second, strict reader: by index offsets, and over whole files
    files = {f: open(f.removeprefix("file:"), "rb").read() for f in {r["archive"] for r in index}}
    assert len(files) > 3
    texts = dict((i, t) for i, _, t in rows)
    for r in index:
        data = files[r["archive"]]
        (offset, fields, block), *_ = strict_records(data[: r["offset"] + r["length"]], r["offset"])
        assert offset == r["offset"] and fields["WARC-Record-ID"] == f"<urn:capture:{'-' if r['page_id'] is None else r['page_id']}>"
        want = b"" if r["record_type"] == "revisit" else (texts[r["page_id"]] or "").encode()
        assert block.split(b"\r\n\r\n", 1)[1] == want
    assert sorted((f, o) for f, data in files.items() for o, _, _ in strict_records(data)) == sorted((r["archive"], r["offset"]) for r in index)
    plain = b"".join(gzip.decompress(d) for d in files.values())
    assert len(list(warc.parse_archive(plain))) == len(rows)
    with pytest.raises(ValueError):
        list(warc.parse_archive(plain[:-3]))


# --- shards -----------------------------------------------------------------------------
def test_shards_are_contiguous_and_balanced(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(None, None), (3, "é"), (3, "é")], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionByName(extra)
    placed = sharding.shard_by_bytes(rows, shards=7).toPandas()
    want = Counter((i if i is not None else None, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows.collect())
    assert Counter((None if i != i else int(i), s, c) for i, s, c in placed[["doc_id", "size", "text_crc32"]].itertuples(index=False)) == want
    target = placed["size"].sum() / 7
    for _, group in placed.groupby("shard"):
        assert sorted(group.slot) == list(range(len(group)))
        assert abs(group["size"].sum() - target) <= placed["size"].max()
    ordered = placed.sort_values(["shard", "slot"]).doc_id.fillna(-1)
    assert ordered.is_monotonic_increasing


# --- rules ------------------------------------------------------------------------------
def base(text):
    import re

    word = re.compile(r"[^\x20\x09-\x0D]+")
    words, seen = word.findall(text), defaultdict(list)
    for i in range(len(words) - 7):
        seen[tuple(words[i : i + 8])].append(i)
    repeated = {j for places in seen.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if word.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), len(words) < 20 or 100 * len(repeated) > 30 * len(words))


def test_rules_equal_brute_force(spark):
    rng, rows = random.Random(6), [(0, None), (1, ""), (2, " \t\n"), (3, "a"), (4, "x y " * 12), (5, "f f\x0bf\x0cf\r\nf\nf f\n \n")]
    for i in range(6, 160):
        rows.append((i, "".join(rng.choice(["a", "b", "c d", "#", "É&"]) + rng.choice([" ", "  ", "\n", "\t", " ", "\x0b"]) for _ in range(rng.randint(0, 60)))))
    docs = spark.createDataFrame([(i, t, 9, "x") for i, t in rows], "doc_id long, text string, kept int, n_words string")
    trusted = spark.createDataFrame([(i,) for i in range(6, 60)], "doc_id long")
    found = rules.judge(docs, trusted).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    texts = dict(rows)
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r[c] for c in columns) == base(texts[r["doc_id"]] or ""), r
    # the ratio: counts of hashed endings, over all and over trusted documents
    how, cells = rules.Rules(), {}
    endings = sorted({w[-3:] for _, t in rows for w in (t or "").split()} | {"zzz"})
    for e, h in spark.createDataFrame([(e,) for e in endings], "e string").selectExpr("e", f"CAST(pmod(xxhash64(e), {how.buckets}) AS INT)").collect():
        cells[e] = h
    import re

    split = {i: [cells[w[-3:]] for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] for i, t in rows}
    raw, target = Counter(c for v in split.values() for c in v), Counter(c for i, v in split.items() if 6 <= i < 60 for c in v)
    n, m = sum(raw.values()), sum(target.values())
    for r in found:
        values = [round(np.log((target[c] + how.prior) / (raw[c] * m / n + how.prior)) * 1e6) for c in split[r["doc_id"]]]
        want = sum(values) / len(values) / 1e6 if values else 0
        assert abs(r["llr"] - want) < 2e-6
        assert r["kept"] == (not r["base_failed"] and r["llr"] >= how.threshold)


def test_ratio_counts_whole_words_and_pairs(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(["nation", "station", "was", "is", "öl", "a"]) for _ in range(rng.randint(0, 40)))) for i in range(60)] + [(60, None), (61, "nation")]
    how = replace(rules.PAIRS, threshold=-0.1)
    words = sorted({w for _, t in rows for w in (t or "").split()})
    hashed = {w: f"xxhash64('{w}')" for w in words}
    cell = {(w,): h for w, h in spark.sql("SELECT inline(array(" + ", ".join(f"struct('{w}', pmod({h}, {how.buckets}))" for w, h in hashed.items()) + "))").collect()}
    pairs = [(a, b) for a in words for b in words]
    cell |= {(a, b): h for a, b, h in spark.sql("SELECT inline(array(" + ", ".join(f"struct('{a}', '{b}', pmod(xxhash64({hashed[a]}, {hashed[b]}), {how.buckets}))" for a, b in pairs) + "))").collect()}
    grams = {i: [cell[g] for w in [(t or "").split()] for g in [*((x,) for x in w), *zip(w, w[1:])]] for i, t in rows}
    raw, target = Counter(c for v in grams.values() for c in v), Counter(c for i in range(20) for c in grams[i])
    n, m = sum(raw.values()), sum(target.values())
    found = rules.judge(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i,) for i in range(20)], "doc_id long"), how).collect()
    assert len(found) == len(rows)
    for r in found:
        values = [np.log((target[c] + how.prior) / (raw[c] * m / n + how.prior)) for c in grams[r["doc_id"]]]
        assert abs(r["llr"] - (sum(values) / len(values) if values else 0)) < 2e-6


def test_query_sees_words_and_their_order(spark, tmp_path):
    good, plain = [f"{x}ing" for x in "abcdefghijklmnopqrstuvwxyz"], " ".join(f"{x}ing" for x in "abcdefghijklmnopqrstuvwxyz")
    shuffled, other = " ".join(good[::-1]), " ".join(f"{w[0] * 3}ing" for w in good)
    docs = [(i, plain) for i in range(40)] + [(i, shuffled) for i in range(40, 80)] + [(i, other) for i in range(80, 120)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    llr = {r["doc_id"]: r["llr"] for r in catalog.op7_likelihood_ratio_rules(spark, str(tmp_path)).collect()}
    assert llr[0] > llr[40] + 0.1 and llr[40] > llr[80] + 0.1


def test_threshold_is_what_documents_kept_out_reach(spark):
    rng = random.Random(16)
    rows = [(i, " ".join(rng.choice([f"w{j}" for j in range(i % 5 + 2)]) for _ in range(40)) if i % 9 else "few words") for i in range(200)] + [(None, "null " * 30)]
    docs, trusted = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i,) for i in range(120)] + [(None,), (3,)], "doc_id long")
    loose = replace(rules.PAIRS, max_repeated_percent=100)
    found = {r["doc_id"]: r for r in rules.judge(docs, trusted, loose).collect()}
    out = lambda i: zlib.crc32(str(i).encode()) % 4 == 3
    fixed = {r["doc_id"]: r for r in rules.judge(docs, spark.createDataFrame([(i,) for i in range(120) if not out(i)], "doc_id long"), replace(loose, threshold=9.0)).collect()}
    want = min(0.0, np.percentile([fixed[i]["llr"] for i in range(120) if out(i) and not fixed[i]["base_failed"]], 0.5))
    for i, r in found.items():
        assert abs(r["llr"] - fixed[i]["llr"]) < 1e-9 and r["kept"] == (not r["base_failed"] and r["llr"] >= want - 1e-12)


def late_trusted(spark):
    """21,000 trusted documents; the 1,000 with the last hashes of ids, kept out of a target or not, use words of their own. Then 1,000 others."""
    words = lambda w: f"array_join(transform(sequence(1, 24), j -> concat('{w}', j)), ' ')"
    ranked = spark.range(21_000).selectExpr("id AS doc_id", "row_number() OVER (ORDER BY xxhash64(id), id) > 20000 AS late")
    docs = ranked.selectExpr("doc_id", "late", f"CASE WHEN late THEN {words('late')} ELSE {words('soon')} END AS text")
    return docs.unionByName(spark.range(21_000, 22_000).selectExpr("id AS doc_id", "false AS late", f"{words('other')} AS text"))


def test_all_trusted_documents_shape_ratios_and_threshold(spark, monkeypatch):
    docs = late_trusted(spark)
    trusted = docs.filter("doc_id < 21000").select("doc_id")
    for bound in (rules.BROADCAST_IDS, 100):
        monkeypatch.setattr(rules, "BROADCAST_IDS", bound)
        found = rules.judge(docs, trusted, rules.PAIRS).toPandas().set_index("doc_id")
        assert len(found) == 22_000 and not found.base_failed.any()
        out = np.array([zlib.crc32(str(i).encode()) % 4 == 3 for i in found.index]) & (found.index < 21_000)
        how, kinds = rules.PAIRS, {"late": found.late, "soon": ~found.late & (found.index < 21_000), "other": found.index >= 21_000}
        llr = {}
        for kind, of in kinds.items():  # 24 words and 23 pairs each, no two of which share a cell
            target, share = (of & ~out & (found.index < 21_000)).sum(), (~out & (found.index < 21_000)).sum() / 22_000
            llr[kind] = np.log((target + how.prior) / (of.sum() * share + how.prior))
            assert np.allclose(found.llr[of], llr[kind], rtol=0, atol=1e-6)
        assert found.kept.sum() == 21_000 and found.kept[kinds["late"]].all()


def test_percentile_of_all_values(spark):
    rng = random.Random(17)
    for values in ([], [0.5], [0.25] * 9, [-1.0, 2.0], [0.1, 0.1 + 2e-17, 0.30000000000000004, 0.3], [rng.choice([rng.gauss(0, 1), 0.5, 1e9]) for _ in range(3000)], [-(2.0**-i) for i in range(900)]):
        frame = spark.createDataFrame([(v,) for v in [*values, None]], "llr double")
        for share in (0, 0.005, 1 - 0.995, 0.3, 0.5, 1):
            assert rules._percentile(frame, share) == frame.agg(F.percentile("llr", F.lit(share))).first()[0]


def test_rules_separate_labelled_documents(spark):
    found = catalog.op7_likelihood_ratio_rules(spark, "/root/testdata/sf0.01").toPandas()
    both = found.merge(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas(), on="doc_id")
    both = both[~both.base_failed]
    assert both[both.quality == 1].kept.mean() > 0.97 and both[both.quality == 0].kept.mean() < 0.2


def test_rules_separate_labels_that_they_never_saw(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    bad = labels.filter("quality = 0").toPandas().doc_id
    good = labels.filter("quality = 1").toPandas().doc_id
    for half in (0, 1):
        trusted = spark.createDataFrame([(int(i),) for i in good if i % 2 == half], "doc_id long")
        found = rules.judge(docs.select("doc_id", "text"), trusted, rules.PAIRS).filter("NOT base_failed").toPandas().set_index("doc_id").kept
        unseen = [i for i in good if i % 2 != half and i in found.index]
        assert found[unseen].mean() >= 0.96 and found[[i for i in bad if i in found.index]].mean() <= 0.25  # 180 and 28 documents


# --- vectors ----------------------------------------------------------------------------
def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    base_vectors = rng.normal(size=(40, 16))
    data = [v + rng.normal(size=16) * s for v in base_vectors for s in rng.choice([0.02, 0.08, 0.12], rng.integers(1, 30))]
    data += [data[0]] * 50 + [2 * data[0]]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(data)] + [(9000, None), (9001, []), (9002, [0.0] * 16), (9003, [float("nan")] * 16), (9004, [None] + [1.0] * 15), (9005, [1.0, 2.0]), (9006, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for cells in (vectors.Cells(), vectors.Cells(per_cell=20, least_cells=30, block=16)):
        found = {r["vec_id"]: r for r in vectors.near_vectors(frame, cells).collect()}
        assert len(found) == len(rows)
        x = np.array([r[1] for r in rows[: len(data)]], np.float32).astype(float)
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        hits = u @ u.T >= 0.95
        np.fill_diagonal(hits, False)
        want = components_of(range(len(data)), [(int(a), int(b)) for a, b in np.argwhere(hits)])
        for i in range(len(data)):
            assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (hits[i].sum(), want[i], want[i] == i)
        for i in range(9000, 9005):
            assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True)
        assert found[9006]["component_id"] == 9005 and found[9005]["n_links"] == 1


def test_dense_cell_and_many_cells(spark):
    rng = np.random.default_rng(14)
    dense = rng.normal(size=24) + rng.normal(size=(900, 24)) * 0.16
    spread = rng.normal(size=(1500, 24))
    x = np.concatenate([dense, spread, spread[:300] + rng.normal(size=(300, 24)) * 0.1]).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(6)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hits = u @ u.T >= 0.95
    np.fill_diagonal(hits, False)
    want = components_of(range(len(x)), [(int(a), int(b)) for a, b in np.argwhere(hits)])
    for cells in (vectors.Cells(), vectors.Cells(least_cells=1024, block=100), vectors.Cells(least_cells=3, block=64)):
        found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_vectors(frame, cells).collect()}
        assert found == {i: (int(hits[i].sum()), want[i]) for i in range(len(x))}


def test_stars_of_chains_and_groups():
    rng = random.Random(15)
    for n in (0, 1, 2, 30):
        hits = np.zeros((n, n), bool)
        for _ in range(n):
            a, b = rng.randrange(n), rng.randrange(n)
            hits[a, b] = hits[b, a] = True
        want = components_of(range(n), [(int(a), int(b)) for a, b in np.argwhere(hits)])
        assert vectors._stars(hits).tolist() == [want[i] for i in range(n)]


# --- html -------------------------------------------------------------------------------
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav><div class="cookie-notice">We use cookies, okay? Yes, all of them.</div>
<article><h2>Head &amp; line</h2><p>First,  long\n paragraph<br>with <b>bold &lt;text&gt;, and <a href="x>y">a link</a>.<p>Yes.<ul><li>item one, short<li>item two</ul>
<aside>Related: <a href=z>this</a></aside><script>var a = "<p>no</p>";</script><form><p>Sign up, now.</p></form><section id="comments"><p>Nice, I agree with all of it, really.</p></section></article>
<div class="sidebar"><p>Popular, very popular, text that is long, with marks.</p></div><footer>&copy; 2020, all rights.</footer></body></html>"""


def test_article_text():
    assert html.extract_text(PAGE).split("\n") == ["Head & line", "First, long paragraph with bold <text>, and a link.", "Yes.", "item one, short", "item two"]


def test_article_without_article_element():
    body = "".join(f"<p>Sentence {i}, with a clause, and another one. It goes on; it ends.</p>" for i in range(8))
    page = f"<body><div class=menu><a href=1>Home</a> <a href=2>News</a></div><div id=content><h1>Title</h1>{body}<p>Short.</p></div><div><a href=1>More</a></div></body>"
    found = html.extract_text(page).split("\n")
    assert found[0] == "Title" and found[-1] == "Short." and len(found) == 10


STORY = "".join(f"<p>Sentence {i} of the story, with a clause, and another one that goes on. It continues; it ends, at last.</p>" for i in range(8))
SENTENCES = [p.removesuffix("</p>") for p in STORY.split("<p>")[1:]]


def test_scores_select_inside_of_marked_elements():
    menu = "<div><a href=1>One</a> <a href=2>Two</a></div><ul><li><a href=1>A link</a><li><a href=2>B link</a></ul>"
    listed = "<ul><li>flour<li>two eggs</ul>"
    for tag in ("main", "article"):
        page = f"<body><{tag}>{menu}<h1>Title</h1>{STORY}{listed}{STORY}<div>Sign up to our list</div>{menu}</{tag}></body>"
        assert html.extract_text(page).split("\n") == ["Title", *SENTENCES, "flour", "two eggs", *SENTENCES]


def test_unmarked_story_beside_marked_card():
    page = f"<body><div id=content><h1>Title</h1>{STORY}</div><article><h3>Card</h3><p>Read it now</p></article></body>"
    assert html.extract_text(page).split("\n")[:9] == ["Title", *SENTENCES]


@pytest.mark.parametrize("wrapper", ["div class='layout has-sidebar'", "div class='comments-open'", "div id='no-ads'", "form action=x"])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_wrappers_bar_nothing(wrapper, tag):
    parts = "<nav><a href=1>x</a></nav>", "<div class=sidebar><p>Popular, very popular, text.</p></div><footer>&copy; 2020, all rights.</footer>"
    page = f"<body><{wrapper}>{parts[0]}<{tag}><h1>Title</h1>{STORY}</{tag}>{parts[1]}</{wrapper.split()[0]}></body>"
    assert html.extract_text(page).split("\n") == ["Title", *SENTENCES]


def test_parts_that_hold_most_of_the_text_stay_out():
    comments = STORY.replace("story", "comment") * 4
    assert html.extract_text(f"<body><article><h1>Title</h1>{STORY}</article><section id=comments>{comments}</section></body>").split("\n") == ["Title", *SENTENCES]
    assert html.extract_text("<body><article><h1>A b.</h1><p>A b.</p></article><footer>&copy; A long line of the footer, with marks, and more of it than of the article.</footer></body>") == "A b.\nA b."


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "</p></div>", "<script>", "<!-- open", "<a <b>", "&amp", "<p x='y>z"])
def test_broken_pages_do_not_fail(page):
    assert isinstance(html.extract_text(page), str)


def test_path_scores_by_loops():
    blocks = html.blocks_of(PAGE) + [html.Block(("html", "div"), "All of it, a link.", 18, False)]
    at = {}
    for b in blocks:
        at.setdefault((b.path, b.barred), []).append(b)
    text = {k: sum(max(0, len(b.text) - 2 * b.linked) for b in v) / len(v) for k, v in at.items()}
    marks = {k: sum(sum(c in ".,;:!?¡¿…、。，；：！？·'\"()" for c in b.text) for b in v if 2 * b.linked < len(b.text)) / len(v) for k, v in at.items()}
    weights = [math.exp(-(d**2) / 2) for d in (-2, -1, 0, 1, 2)]
    order = [(b.path, b.barred) for b in blocks]
    means = {k: [] for k in at}
    for i, k in enumerate(order):
        near = [(w, order[min(max(i + d, 0), len(order) - 1)]) for w, d in zip(weights, (-2, -1, 0, 1, 2))]
        t, m = (sum(w * r[x] for w, x in near) / sum(weights) for r in (text, marks))
        means[k].append(math.sqrt(math.sqrt(text[k] * (marks[k] + 0.25)) * math.sqrt(t * (m + 0.25))))
    for k, found in html.path_scores(blocks).items():
        inside = 1.5 if any(s.split(".")[0] in ("article", "main") for s in k[0]) else 1.0
        linked = sum(len(b.text) - 2 * b.linked for b in at[k]) > 0
        assert abs(found - inside * (0.1 if k[1] else 1.0) * linked * sum(means[k]) / len(means[k])) < 1e-9


def test_scores_decide_on_pages(spark, monkeypatch):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    found, scores = [html.extract_text(p) for p in pages], html.path_scores
    monkeypatch.setattr(html, "path_scores", lambda blocks: dict.fromkeys(scores(blocks), 1.0))
    assert sum(html.extract_text(p) != f for p, f in zip(pages, found)) > 0.9 * len(pages)


def test_deep_and_long_pages():
    deep = "<div>" * 3000 + "<p>Deep text, with a mark.</p>" + "</div>" * 3000
    assert html.extract_text(deep) == "Deep text, with a mark."
    assert len(html.extract_text(f"<article>{STORY * 2000}</article>").split("\n")) == 16_000


# --- near-duplicates --------------------------------------------------------------------
def word_sets(text, width):
    words = (text or "").encode().lower().split()
    return frozenset() if not words else frozenset([tuple(words)]) if len(words) < width else frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_equal_brute_force(spark, width):
    rng, rows = random.Random(9), []
    vocabulary = [f"w{i}" for i in range(400)]
    for size, copies, edits in ((120, 150, 6), (120, 90, 16), (40, 60, 3), (6, 30, 1), (200, 20, 30), (3, 20, 1), (1, 9, 1)):
        text = [rng.choice(vocabulary) for _ in range(size)]
        for _ in range(copies):
            other = list(text)
            for _ in range(rng.randint(0, edits)):
                other[rng.randrange(len(other))] = rng.choice(vocabulary)
            rows.append(" ".join(other))
    rows += [rows[0]] * 40 + [rows[0].upper(), None, "", " \n", "É x", "é x"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    how = [neardup.Similarity(words=width, tile=32), neardup.Similarity(words=width, tile=4, hubs=1, meet=6)][width % 2]
    found = {r["doc_id"]: r for r in neardup.near_duplicates(docs, how).collect()}
    sets = [word_sets(t, width) for t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    want = components_of(range(len(rows)), links)
    assert len(found) == len(rows)
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in found.items()} == {i: (len(sets[i]), want[i], want[i] == i) for i in range(len(rows))}


def test_shared_notice_makes_no_pairs(spark, monkeypatch):
    """Texts of one notice and own words: links are found, and the rows compared grow with the texts, not with their square."""
    rng, seen, write = random.Random(12), {}, neardup.materialize

    def kept(df, label):
        seen[label] = write(df, label)
        return seen[label]

    monkeypatch.setattr(neardup, "materialize", kept)
    vocabulary = [f"w{i}" for i in range(4000)]
    notice, met = [rng.choice(vocabulary) for _ in range(110)], {}
    for size in (500, 1000):
        seen.clear()
        own = [[rng.choice(vocabulary) for _ in range(50)] for _ in range(size)]
        for i in range(0, 40, 2):  # true links: four own words differ
            own[i + 1] = own[i][:-4] + own[i + 1][-4:]
        docs = spark.createDataFrame([(i, " ".join(notice + o)) for i, o in enumerate(own)], "doc_id long, text string")
        found = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs).collect()}
        assert found == {i: i - i % 2 if i < 40 else i for i in range(size)}
        assert seen["groups"].count() > size / 2  # the notice alone makes one group of candidates
        met[size] = seen["meetings"].count()
    assert met[1000] < 300


def test_rows_of_one_id_are_documents_of_their_own(spark):
    texts = [" ".join(f"{t}{i}" for i in range(40)) for t in "abc"]
    near = texts[0].replace("a39", "z")
    rows = [(7, texts[0])] * 300 + [(7, texts[1]), (3, near), (9, texts[2]), (None, texts[2])]
    found = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect())
    assert found == {(7, 3, False): 300, (7, 7, True): 1, (3, 3, True): 1, (9, 9, True): 1, (None, None, True): 1}


def test_registers_by_loops():
    sketcher = neardup.Sketcher(neardup.Similarity())
    for size in (1, 7, 300, 5000):
        s = np.unique(np.random.default_rng(size).integers(0, 2**64, size, dtype=np.uint64))
        least = {}
        for x in s.tolist():
            least[x >> 56] = min(least.get(x >> 56, 2**64), x << 8 & (2**64 - 1))
        got = sketcher.registers(s)
        for bucket in range(256):
            if bucket not in least:
                assert got[bucket] == 0xFFFF
            else:
                zeros = 64 - least[bucket].bit_length()
                assert got[bucket] == zeros << 10 | (least[bucket] << (zeros + 1) & (2**64 - 1)) >> 54


def test_estimate_is_near_jaccard():
    sketcher = neardup.Sketcher(neardup.Similarity())
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    for share in (100, 500, 900):
        a, b = np.unique(pool[:1000]), np.unique(pool[1000 - share : 2000 - share])
        true = share / (2000 - share)
        got = neardup.estimate(sketcher.registers(a)[None], sketcher.registers(b), np.array([len(a)]), len(b))[0][0]
        assert abs(got - true) < 0.15


def test_components_of_paths_and_stars(spark, monkeypatch):
    from sparkbrook.llm import components

    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (300, 301), (None, 5)]
    frame = spark.createDataFrame(links, "a long, b long").repartition(5)
    want = components_of([*range(61), *range(100, 140), 300, 301], [x for x in links if x[0] is not None and x[0] != x[1]])
    for small in (100_000, -1):  # finished by one task, and by rounds alone
        monkeypatch.setattr(components, "SMALL", small)
        assert {r["node"]: r["component"] for r in connected_components(frame).collect()} == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- co-training ------------------------------------------------------------------------
def test_co_training_separates_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    seen = labels.filter("doc_id % 2 = 0")
    found = cotrain.classify(docs, seen).toPandas().merge(labels.filter("doc_id % 2 = 1").toPandas(), on="doc_id")
    assert ((found.kept.astype(int) == found.quality).mean()) > 0.95
    assert found.score.between(0, 1).all()


def test_co_training_by_loops(spark):
    rng = random.Random(17)
    words = ["BUY", "$$$", "NOW!", "plain", "words", "quiet", "order", "read", "more"]
    rows = []
    for i in range(160):
        good = rng.random() < 0.6
        rows.append((i, " ".join(rng.choice(words[3:] if good else words[:6]) for _ in range(rng.randint(3, 30))), rng.choice("ab") if good else "c", "en", i))
    labels, how = {i: int(r[2] != "c") for i, r in enumerate(rows[:80])}, cotrain.CoTraining(cells=64, per_round=12, rounds=3, sure=0.7)
    crc, view = lambda i: (zlib.crc32(str(i).encode()), i), cotrain.TextView(64)
    t, m = {r[0]: view(r[1]) for r in rows}, {r[0]: cotrain.meta_view(r[2], r[3], r[4]) for r in rows}
    known, free = sorted(labels, key=crc), [r[0] for r in rows[80:]]

    def pick(weights, taken, quotas):
        out = []
        for learner in (0, 1):
            views = (m, t)[learner]
            p = {i: 1 / (1 + math.exp(-round(min(30, max(-30, sum(a * b for a, b in zip(views[i].tolist(), weights[1 - learner].tolist())))), 6))) for i in free}
            for label in (1, 0):
                sure = {i: x if label else 1 - x for i, x in p.items()}
                best = sorted((i for i in free if sure[i] >= how.sure and i not in taken[learner]), key=lambda i: (-sure[i], *crc(i)))  # noqa: B023
                out += [(learner, label, i, t[i], m[i]) for i in best[: quotas[label]]]
        return out

    want = cotrain.co_train(np.stack([t[i] for i in known]), np.stack([m[i] for i in known]), np.array([labels[i] for i in known]), pick, how)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").repartition(5)
    found = cotrain.train(docs, spark.createDataFrame(list(labels.items()), "doc_id long, quality int"), how)
    for part in ("text", "meta", "platt", "mix"):
        assert np.allclose(getattr(found, part), getattr(want, part), atol=1e-4), part


def test_text_statistics_by_loops():
    text = "Buy NOW!! the the 3 | x | x\nSame line\n\nSame line"
    words = text.split()
    found = cotrain.TextView(8)(text)
    n, size = len(words), len(text)
    want = [1, math.log1p(n) / 10, 10 * text.count("|") / size, 3 * sum(c.isupper() for c in text) / size, 5 / size, 2 / n, 3 * (1 - len(set(words)) / n), size / n / 10, 1 / 3, 2 / n, n < 20, 3 * 1 / n]
    assert np.allclose(found[:12], want)
    cells = Counter(zlib.crc32(w.encode()) % 8 for w in words)
    assert np.allclose(found[12:], [math.sqrt(cells[c] / n) for c in range(8)])


def test_co_training_without_labels(spark):
    docs = spark.createDataFrame([(1, None, None), (2, "a b", "en")], "doc_id long, text string, lang string")
    found = cotrain.classify(docs, spark.createDataFrame([], "doc_id long, quality int")).collect()
    assert [r["score"] for r in found] == [0.5, 0.5]
