"""The golden fixture end to end, edge cases of the operators, and the table store."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkbrook import models
from sparkbrook.operators import combine_address, fill_defaults, fill_nulls, flatten, lowercase_strings, multiset_difference, split_required, strip_columns
from sparkbrook.session import object_store_conf
from sparkbrook.sources.files import read_csv, read_json, stream_json
from sparkbrook.sources.store import TableError, TableStore
from sparkbrook.streaming import Ingest, console, run_stream


def record(number, **changes):
    base = {
        "id": number,
        "name": "Grand HOTEL",
        "providerId": "P1",
        "geoCode": {"lat": "1.5", "long": "2.5"},
        "contact": {"address": {"line1": "1, Main St.", "city": {"name": "Rome"}, "country": {"code": "IT", "name": "Italy"}, "postalCode": "00-184"}, "phones": ["+39 1"]},
    }
    return base | changes


def address(**changes):
    return {"address": {"line1": "1, Main St.", "city": {"name": "Rome"}, "country": {"code": "IT", "name": "Italy"}, "postalCode": "00-184"} | changes}


H2 = record("H2", name=None)
DOCUMENTS = [
    {"hotels": [record("H1", category="", starRating=4), H2, record("H3", name="", contact=address(state={"name": "Lazio"}))]},
    {"hotels": []},
    {"curatedHotels": [{}]},
    {
        "hotels": [
            {"id": "H4", "name": "No Geo", "providerId": "P2", "contact": None},
            record("H5", name="Café Zoë", contact=address(line1="Rua São João #5", city={"name": "São Paulo"}, country={"code": "IT", "name": "Brasil"})),
            H2,
        ]
    },
]


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, document in enumerate(DOCUMENTS):
        (folder / f"{i}.json").write_text(json.dumps(document) + "\n")
    return str(folder)


def run(spark, source, tmp_path, **options):
    ingest = Ingest(TableStore(spark, str(tmp_path / "base"), "bronze"), **options)
    run_stream(stream_json(spark, source, models.document_schema(), max_files_per_trigger=1), ingest, str(tmp_path / "state"))
    return ingest


def test_golden_fixture_through_a_stream(spark, source, tmp_path):
    ingest = run(spark, source, tmp_path)
    assert sum(r.valid for r in ingest.reports) == 3 and sum(r.invalid for r in ingest.reports) == 5 and len(ingest.reports) == 4
    valid = {r["id"]: r for r in ingest.store.read("records").collect()}
    assert set(valid) == {"h1", "h3", "h5"}
    assert (valid["h1"]["combined_address"], valid["h1"]["name"], valid["h1"]["category"], valid["h1"]["starRating"]) == ("1 main st rome italy 00184", "grand hotel", "Unknown", "4")
    assert (valid["h1"]["contact_address_state_name"], valid["h1"]["contact_phones"]) == ("Unknown", ["+39 1"])
    assert (valid["h3"]["combined_address"], valid["h3"]["name"], valid["h3"]["contact_address_state_name"]) == ("1 main st rome lazio italy 00184", "", "lazio")
    assert (valid["h5"]["combined_address"], valid["h5"]["name"], valid["h5"]["contact_address_country_code"]) == ("rua so joo 5 so paulo brasil 00184", "café zoë", "it")
    assert '"id":"H1"' in valid["h1"]["original_message"]
    invalid = ingest.store.read("records_invalid").collect()
    assert sorted(r["id"] or "" for r in invalid) == ["", "", "H2", "H2", "H4"]
    assert [r["original_message"] for r in invalid if r["id"] == "H4"] == ['{"id":"H4","name":"No Geo","providerId":"P2"}']
    assert [r["original_message"] for r in invalid if r["id"] is None] == ["{}", "{}"]
    assert set(ingest.store.read("records").columns) == set(models.bronze_schema().names)
    again = run(spark, source, tmp_path)
    assert not again.reports and again.store.read("records").count() == 3


def test_a_batch_is_written_once(spark, source, tmp_path):
    ingest = Ingest(TableStore(spark, str(tmp_path / "base"), "bronze"))
    documents = spark.read.schema(models.document_schema()).json(source)
    for _ in range(2):
        ingest.run_batch(documents, "b-1")
    assert ingest.store.read("records").count() == 3 and ingest.store.read("records_invalid").count() == 5


def test_new_checkpoints_lose_nothing(spark, tmp_path):
    ingest = Ingest(TableStore(spark, str(tmp_path / "base"), "bronze"))
    for n, (folder, state) in enumerate((("a", "s1"), ("b", "s2"), ("b", "s3"))):  # two sources, then a checkpoint made anew
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / "d.json").write_text(json.dumps({"hotels": [record(f"{folder}1")]}) + "\n")
        for _ in range(2):  # a rerun adds nothing
            run_stream(stream_json(spark, str(tmp_path / folder), models.document_schema()), ingest, str(tmp_path / state))
        assert ingest.store.read("records").count() == n + 1
    assert len(ingest.reports) == 3 and not any(r.skipped for r in ingest.reports)
    assert len(ingest.store.manifest("records").streams) == 3 and not ingest.store.manifest("records").batches


def test_a_repeated_batch_is_reported(spark, source, tmp_path):
    ingest = Ingest(TableStore(spark, str(tmp_path / "base"), "bronze"))
    documents = spark.read.schema(models.document_schema()).json(source)
    reports = [ingest.run_batch(documents, ("s", n)) for n in (0, 0, 1)]
    assert [r.skipped for r in reports] == [(), ("records", "records_invalid"), ()]
    assert ingest.store.read("records").count() == 6


def test_empty_input_leaves_both_tables(spark, tmp_path):
    ingest = Ingest(TableStore(spark, str(tmp_path / "base"), "bronze"))
    assert ingest.run_batch(spark.createDataFrame([], models.document_schema()), "b") is None
    assert all(ingest.store.read(t).schema.names == models.bronze_schema().names for t in ("records", "records_invalid"))


def test_names_and_console(spark, tmp_path, capsys):
    store = TableStore(spark, str(tmp_path), "my schema", catalog="c`at")
    assert store.namespace() == "`c``at`.`my schema`" and store.identifier("t.x") == "`c``at`.`my schema`.`t.x`"
    console(spark.createDataFrame([("shown",)], "v string"))
    assert "shown" in capsys.readouterr().out


def test_failures_stop_or_are_reported(spark, source, tmp_path):
    documents = spark.read.schema(models.document_schema()).json(source)
    store = TableStore(spark, str(tmp_path / "base"), "bronze")
    store.create("records", schema=T._parse_datatype_string("id array<int>"))
    with pytest.raises(TableError):
        Ingest(store).run_batch(documents, "b")
    report = Ingest(store, lenient=True).run_batch(documents, "b")
    assert len(report.failures) == 1 and store.read("records_invalid").count() == 5


def test_flatten_edges(spark):
    deep = spark.createDataFrame([((1, ("x", [("p",), ("q",)])), None), (None, "y")], "a struct<n int, b struct<s string, c array<struct<v string>>>>, z string")
    assert flatten(deep).columns == ["z", "a_n", "a_b_s", "a_b_c"]
    rows = flatten(deep, explode=True).collect()
    assert sorted((r["z"] or "", r["a_b_c_v"] or "") for r in rows) == [("", "p"), ("", "q"), ("y", "")]
    assert flatten(deep, max_depth=1).columns == ["z", "a_n", "a_b"]
    odd = spark.createDataFrame([((1,),)], T.StructType([T.StructField("a.b c", T.StructType([T.StructField("d.e", T.IntegerType())]))]))
    assert flatten(odd).first()[0] == 1
    with pytest.raises(ValueError):
        flatten(spark.createDataFrame([(1, (2,))], "a_b int, a struct<b int>"))
    with pytest.raises(ValueError):
        flatten(spark.createDataFrame([(1,)], "raw int"), raw_column="raw")
    two = spark.createDataFrame([([(1,), (2,)], [(1,), (2,), (3,)])], "a array<struct<x int>>, b array<struct<y int>>")
    assert flatten(two, explode=True).count() == 6 and flatten(two).columns == ["a", "b"]


def test_cleaning_edges(spark):
    rows = spark.createDataFrame([(None, None, None, None), ("", "b", 1, ["Ä"]), (" ", "!", None, None)], "a string, b string, n int, l array<string>")
    assert [r[-1] for r in combine_address(rows, ["a", "b"], "c").collect()] == ["", " b", "  "]
    filled = fill_defaults(rows, keep=["b"]).collect()
    assert [(r["a"], r["b"], r["n"]) for r in filled] == [("Unknown", None, 0), ("Unknown", "b", 1), (" ", "!", 0)]
    assert lowercase_strings(rows, exclude=["b"]).collect()[1]["l"] == ["Ä"]
    assert [r["a"] for r in fill_nulls(rows, {"a": "x"}).collect()] == ["x", "", " "]
    with pytest.raises(ValueError):
        fill_nulls(rows, {"nope": 1})
    text = spark.createDataFrame([("a\t_é\nB",), (None,)], "t string")
    assert [r["t"] for r in strip_columns(text, ["t"]).collect()] == ["a\t\nB", None]
    typed = spark.createDataFrame([(None,) * 5], "i tinyint, d double, b boolean, day date, t timestamp")
    now = F.lit("2020-02-02 02:02:02").cast("timestamp")
    first = fill_defaults(typed, now=now)
    assert first.dtypes == typed.dtypes and list(first.first())[:3] == [0, 0.0, False] and str(first.first()["day"]) == "2020-02-02"


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from([None, "", "a"]), st.sampled_from([None, 1])), max_size=12))
def test_split_is_the_multiset_difference(spark, rows):
    frame = spark.createDataFrame(rows, "a string, b int")
    parts = split_required(frame, ["a", "b"])
    key = lambda df: sorted(map(str, df.collect()))
    assert key(parts.invalid) == key(multiset_difference(frame, parts.valid))
    assert parts.valid.count() + parts.invalid.count() == len(rows)


def test_store_lifecycle(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), "s")
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    store.write("t", one)
    assert store.read("t").count() == 2
    store.create("t", one)  # no effect on a table that is there
    store.write("t", spark.createDataFrame([(3, 1.5)], "K long, extra double"))
    assert store.read("t").columns == ["k", "v", "extra"] and store.read("t").dtypes[0][1] == "bigint" and store.read("t").count() == 3
    assert TableStore(spark, str(tmp_path), "s").read("t", version=2).count() == 2
    with pytest.raises(TableError):
        store.write("t", spark.createDataFrame([("x",)], "k string"))
    with pytest.raises(TableError):
        store.merge("t", spark.createDataFrame([(1, "x", 1.0), (1, "y", 1.0)], "k long, v string, extra double"), ["k"])
    source = spark.createDataFrame([(1, "new", 0.0), (9, "nine", 0.0)], "k long, v string, extra double")
    for _ in range(2):
        store.merge("t", source, ["k"])
    assert sorted((r["k"], r["v"]) for r in store.read("t").collect()) == [(1, "new"), (2, "b"), (3, None), (9, "nine")]
    store.delete("t", "extra > 1")
    assert store.read("t").count() == 3
    assert store.list_tables() == ["t"] and store.drop("t") and not store.exists("t") and not store.drop("t")
    with pytest.raises(TableError):
        store.create("e", schema=T.StructType([T.StructField("x", T.ArrayType(T.StructType([])))]))
    store.create("q`uote", comment="it's")
    assert store.read("q`uote").columns == ["id"]


def test_sources(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("x,y\n1,b\n")
    assert read_csv(spark, str(folder)).dtypes == [("x", "string"), ("y", "string")]
    assert read_csv(spark, str(folder), header=False).columns == ["_c0", "_c1"]
    pretty = tmp_path / "json" / "deep"
    pretty.mkdir(parents=True)
    (pretty / "a.json").write_text('{\n "b": 1,\n "a": "x"\n}')
    assert read_json(spark, str(tmp_path / "json"), multi_line=True).collect()[0].asDict() == {"a": "x", "b": 1}
    assert object_store_conf({"OBJECT_STORE_ENDPOINT": "http://x"}) == {"spark.hadoop.fs.s3a.endpoint": "http://x"}
