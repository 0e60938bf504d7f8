"""Nulls, empty tables, repeated rows and clashing columns for every operator and stage."""

import pytest

pytest.importorskip("sparkbrook.llm")
pytest.importorskip("corpus_pipeline")

import corpus_pipeline  # noqa: E402
from oracle import spark_rows, sql_rows  # noqa: E402

from sparkbrook.llm import bpe, catalog, cotrain, html, langid, neardup, packing, rules, sharding, vectors, warc  # noqa: E402

SF = "/root/testdata/sf0.001"
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, grp int, band int, cell int, shard int, length int, start int, part int"
ROWS = [
    (1, "the same words again and again for all of us to read here", "en", "s", 5, "x", "y", 1, 1, 1, 1, 1, 1, 1),
    (1, "the same words again and again for all of us to read here", "en", "s", 5, "x", "y", 1, 1, 1, 1, 1, 1, 1),
    (2, None, None, None, None, None, None, None, None, None, None, None, None, None),
    (None, "", "en", "s", 0, "x", "y", 1, 1, 1, 1, 1, 1, 1),
    (3, "ß" * 50_000, "de", None, -1, "x", "y", 1, 1, 1, 1, 1, 1, 1),
]


def operators(spark):
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, None)], "doc_id long, quality int")
    profile = langid.Profile(dimensions=128)

    def language(docs):
        names, prototypes = langid.train_prototypes(docs.select("doc_id", "text", "lang"), profile)
        return langid.identify(docs.select("doc_id", "text"), names, prototypes, profile)

    return {
        "cotrain": lambda d: cotrain.classify(d, labels),
        "pack": packing.pack_documents,
        "bpe": lambda d: bpe.encode_digests(d, leaf=1000),
        "langid": language,
        "shards": sharding.shard_by_bytes,
        "rules": lambda d: rules.judge(d, labels.filter("quality = 1")),
        "neardup": neardup.near_duplicates,
    }


@pytest.mark.parametrize("name", ["cotrain", "pack", "bpe", "langid", "shards", "rules", "neardup"])
def test_document_operators(spark, name):
    run = operators(spark)[name]
    docs = spark.createDataFrame(ROWS, CLASHING)
    found = run(docs).collect()
    if name == "pack":
        assert {r["doc_id"] for r in found} == {1, 2, 3, None}
    else:
        assert len(found) == len(ROWS)
    assert run(docs.limit(0)).count() == 0


def test_whole_number_ids_of_any_type(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (2, "x")], "doc_id int, text string")
    assert sorted(r["doc_id"] for r in sharding.shard_by_bytes(docs, shards=2).collect()) == [1, 2, 2]
    for name in ("pack", "bpe", "neardup", "cotrain"):
        assert operators(spark)[name](docs).count() == 3, name


def test_many_equal_rows_are_packed_apart(spark):
    docs = spark.createDataFrame([(1, "same words")] * 3000 + [(2, "other")], "doc_id long, text string").repartition(3)
    pieces = packing.materialize(packing.tokenized_pieces(docs, "word_bpe_49k.json", 2048).selectExpr("*", "pmod(monotonically_increasing_id(), 4096) AS _salt"), "pieces")
    found = packing.pack_pieces(pieces, rows_per_bucket=100, salt="_salt").toPandas()
    assert len(found) == 3001 and "_salt" not in found.columns
    for _, group in found.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert (group.offset.values == group.length.cumsum().values - group.length.values).all() and group.length.sum() <= 2048


def test_page_operators(spark):
    pages = spark.createDataFrame([(1, None, None, "x", 1), (1, None, None, "x", 1), (None, "u", "<p>A, b.</p>", "x", 1)], "page_id long, url string, html string, text string, offset int")
    assert html.extract_pages(pages).count() == 3
    assert warc.archive_and_index(pages).count() == 3
    assert html.extract_pages(pages.limit(0)).count() == 0
    assert warc.archive_and_index(pages.limit(0)).count() == 0


def test_empty_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_vectors(empty).count() == 0
    columns = "vec_id long, embedding array<float>, cell int, key string, vector int, copies int, sid string"
    rest = (1, "k", 2, 3, "s")
    one = spark.createDataFrame([(None, [1.0, 0.0], *rest), (4, [1.0, 0.0], *rest), (4, [1.0, 0.0], *rest)], columns)
    assert sorted(map(str, map(tuple, vectors.near_vectors(one).collect()))) == ["(4, 1, 4, True)", "(4, 1, 4, True)", "(None, 0, None, True)"]


def test_stages_keep_columns_and_rows(spark):
    docs = spark.createDataFrame(ROWS, CLASHING)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0, name


def test_quality_rules_count_all_trusted_documents(spark, tmp_path):
    words = lambda w: f"array_join(transform(sequence(1, 24), j -> concat('{w}', j)), ' ')"
    ranked = spark.range(21_000).selectExpr("id AS doc_id", "row_number() OVER (ORDER BY xxhash64(id), id) > 20000 AS late")
    docs = ranked.selectExpr("*", f"CASE WHEN late THEN {words('late')} ELSE {words('soon')} END AS text")
    docs.selectExpr("doc_id", "1 AS quality").write.parquet(f"{tmp_path}/labels.parquet")
    others = spark.range(21_000, 22_000).selectExpr("id AS doc_id", "false AS late", f"{words('other')} AS text")
    found = corpus_pipeline.quality_rules(spark, docs.unionByName(others), str(tmp_path)).groupBy("late").count().collect()
    assert {r["late"]: r["count"] for r in found} == {True: 1000, False: 20_000}


def test_language_id_learns_from_all_labelled_documents(spark):
    # the half with the last hashes of ids writes its language in another script
    late = "pmod(xxhash64(7, id), 1 << 30) >= 1 << 29"
    docs = spark.range(4000).selectExpr("id AS doc_id", f"CASE WHEN {late} THEN 'всё это другие слова' ELSE 'all these are words' END AS text", "'xx' AS lang", f"{late} AS late")
    kinds = {r["late"]: r["count"] for r in docs.groupBy("late").count().collect()}
    assert min(kinds[True], kinds[False]) > 1900
    found = corpus_pipeline.language_id(spark, docs, SF).groupBy("late").count().collect()
    assert {r["late"]: r["count"] for r in found} == kinds
    trained = docs.filter(~langid.held_out())
    names, prototypes = langid.train_prototypes(trained.select("doc_id", "text", "lang"))
    sums = [langid.Encoder(langid.Profile()).bundles([langid.letters_only(t)])[0] for t in ("всё это другие слова", "all these are words")]
    n = trained.filter("late").count(), trained.filter("NOT late").count()
    want = sum(k * v / (v @ v) ** 0.5 for k, v in zip(n, sums))
    assert names == ["xx"] and abs(prototypes[0] - want / (want @ want) ** 0.5).max() < 1e-5


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").quality
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.quality_rules(spark, docs, SF).select("doc_id").collect()}
    good = [i for i in labels.index if labels[i] == 1 and len(texts[i].split()) >= 25]
    assert sum(i in kept for i in good) >= 0.9 * len(good)
    assert {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs.filter("length(text) > 200"), SF).collect()} == {i for i, t in texts.items() if len(t) > 200}

    def shingles(text):
        w = text.encode().lower().split()
        return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    left = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()}
    sets = {i: shingles(t) for i, t in texts.items()}
    linked = {(i, j) for i in sets for j in sets if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert not any(i in left and j in left for i, j in linked)
    assert all(i in left for i in sets if not any(i in pair for pair in linked))
    packed = corpus_pipeline.run(spark, SF).toPandas()
    assert set(packed.doc_id) <= left and packed.groupby("sequence_id").length.sum().max() <= 2048


def test_near_dedup_keeps_one_row_of_repeated_and_null_ids(spark):
    texts = [" ".join(f"{t}{i}" for i in range(30)) for t in "abcd"]
    rows = [(5, texts[0]), (5, texts[0]), (None, texts[0]), (None, texts[1]), (None, texts[1]), (9, texts[2]), (7, texts[3]), (7, texts[2]), (None, None), (None, None), (4, "")]
    for part in (1, 4):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(part)
        left = corpus_pipeline.near_dedup(spark, docs, SF).collect()
        want = [(5, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (None, None), (None, None), (4, "")]
        assert sorted(map(str, map(tuple, left))) == sorted(map(str, want))


@pytest.mark.parametrize("name", sorted(catalog.oracles()))
def test_query_equals_sql(spark, name):
    assert spark_rows(catalog.queries()[name](spark, SF)) == sql_rows(catalog.oracles()[name], SF)


def test_cotraining_counts_repeated_ids_once(spark):
    rows = [(i, "plain words in quiet order for us" if i % 3 else "BUY $$$ NOW !!!", "en", "s", 20) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(48)], "doc_id long, quality int")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    once, often = (cotrain.train(spark.createDataFrame(r, schema), labels) for r in (rows, rows + rows[:1] * 200))
    for part in ("text", "meta", "platt", "mix"):
        assert (getattr(once, part) == getattr(often, part)).all()


def test_cotraining_learns_from_every_unlabelled_document(spark):
    texts = ["BUY $$$ NOW !!!", "plain words in quiet order for us", "other words in quiet order for us"]
    rows = [(i, texts[min(1, i % 3)], "en", "s", 20) for i in range(60)] + [(i, texts[min(1, i % 3)], "en", "rare", 20) for i in range(60, 72)]
    order = [r["id"] for r in spark.range(60, 72).selectExpr("id", f"xxhash64({cotrain.CoTraining().seed}, id) AS h").orderBy("h").collect()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, la, "s" if i == order[0] else s, n) for i, t, la, s, n in rows for _ in range(9000 if i == order[0] else 1)], schema)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id long, quality int")
    model = cotrain.train(docs, labels)
    with_rare, without = cotrain.meta_view("rare", "en", 20), cotrain.meta_view("s", "en", 20)
    assert all(model.meta[(with_rare > without)] != 0)
