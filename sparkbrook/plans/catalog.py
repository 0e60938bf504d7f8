"""Every operator as a runnable query over the driver's tables, with SQL for comparison.

The tables hold no nulls and no nested values, so both are made by fixed expressions that
Spark and other SQL engines read alike (``FLAT``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkbrook import models
from sparkbrook.operators import clean
from sparkbrook.operators.chain import run_chain
from sparkbrook.operators.shape import explode_records, flatten
from sparkbrook.operators.split import has_all, multiset_difference, split_required
from sparkbrook.scratch import scratch_path
from sparkbrook.sources.files import read_csv, read_json, stream_json
from sparkbrook.sources.store import TableStore, write_path
from sparkbrook.streaming.ingest import Ingest, run_stream

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

#: Customers as flat contact records; every fifth has no contact at all, others lack single fields.
FLAT = """
SELECT c_custkey AS k, CAST(c_custkey AS STRING) AS id,
  CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN '' ELSE c_name END AS name,
  CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS segment,
  CASE WHEN c_custkey % 5 > 0 THEN concat(CAST(c_custkey AS STRING), ', Main-St. #', n_name) END AS line1,
  CASE WHEN c_custkey % 5 > 0 THEN concat(n_name, ' City') END AS city,
  CASE WHEN c_custkey % 5 > 0 AND c_custkey % 3 = 0 THEN r_name END AS state,
  CASE WHEN c_custkey % 5 > 0 THEN CAST(n_nationkey AS STRING) END AS code,
  CASE WHEN c_custkey % 5 > 0 THEN n_name END AS country,
  CASE WHEN c_custkey % 5 > 0 AND c_custkey % 2 = 0 THEN concat('00-', CAST(c_custkey AS STRING)) END AS postal,
  n_nationkey
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name."""

    def add(run: Query) -> Query:
        _QUERIES[run.__name__] = run
        if sql:
            _ORACLES[run.__name__] = sql
        return run

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = FLAT
    for name in ("customer", "nation", "region"):
        sql = sql.replace(f"FROM {name} ", f"FROM {{{name}}} ").replace(f"JOIN {name} ", f"JOIN {{{name}}} ")
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in ("customer", "nation", "region")})


def _address(present) -> F.Column:
    inner = F.struct(
        F.col("line1"),
        F.struct(F.col("city").alias("name")).alias("city"),
        F.struct(F.col("state").alias("name")).alias("state"),
        F.struct(F.col("code"), F.col("country").alias("name")).alias("country"),
        F.col("postal").alias("postalCode"),
    )
    return F.when(present, F.struct(inner.alias("address")))


def _nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, name, segment and a contact struct that is null for every fifth customer."""
    return _flat(spark, sf_dir).select("id", "name", "segment", _address(F.col("k") % 5 > 0).alias("contact"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the source format: each with customers of a nation as records, a thousand keys at most."""
    record = F.struct(
        F.col("id"),
        F.col("name"),
        F.lit("P1").alias("providerId"),
        F.col("segment").alias("category"),
        F.when(F.col("k") % 17 > 0, F.struct(F.lit("1.5").alias("lat"), F.lit("2.5").alias("long"))).alias("geoCode"),
        _address(F.col("k") % 5 > 0).alias("contact"),
    )
    return _flat(spark, sf_dir).groupBy("n_nationkey", F.floor(F.col("k") / 1000)).agg(F.collect_list(record).alias("hotels")).select("hotels")


_FLATTENED = "id, name, segment, line1 AS contact_address_line1, postal AS contact_address_postalCode, city AS contact_address_city_name, state AS contact_address_state_name, code AS contact_address_country_code, country AS contact_address_country_name"


# --- nested to flat ---------------------------------------------------------------------
@query("SELECT n_nationkey AS nation_key, n_name AS nation_name, r_regionkey AS region_info_key, r_name AS region_info_label_text FROM nation JOIN region ON n_regionkey = r_regionkey")
def flatten_struct(spark, sf_dir):
    region = table(spark, sf_dir, "region").select("r_regionkey", F.struct(F.col("r_regionkey").alias("key"), F.struct(F.col("r_name").alias("text")).alias("label")).alias("info"))
    joined = table(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return flatten(joined.select(F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name")).alias("nation"), F.struct("info").alias("region")))


@query(f"SELECT {_FLATTENED} FROM ({FLAT})")
def flatten_struct_null_parent(spark, sf_dir):
    return flatten(_nested(spark, sf_dir))


@query("SELECT id, line1, city, country FROM (" + FLAT + ")")
def flatten_one_level(spark, sf_dir):
    flat = flatten(_nested(spark, sf_dir), max_depth=1)
    a = F.col("contact_address")
    return flat.select("id", a["line1"].alias("line1"), a["city"]["name"].alias("city"), a["country"]["name"].alias("country"))


def _orders_with_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_partkey").alias("part"), F.col("l_linenumber").alias("no"), F.struct(F.col("l_quantity").alias("qty")).alias("amount"))).alias("lines"))
    return table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "o_orderstatus", "lines")


@query("SELECT l_partkey AS part, l_linenumber AS no, l_quantity AS amount_qty FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey")
def explode_records_outer(spark, sf_dir):
    return explode_records(_orders_with_lines(spark, sf_dir), "lines")


@query("SELECT o_orderkey, o_orderstatus, l_partkey AS lines_part, l_linenumber AS lines_no, l_quantity AS lines_amount_qty FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey")
def flatten_array_of_struct(spark, sf_dir):
    frame = _orders_with_lines(spark, sf_dir)
    empty = F.array().cast(frame.schema["lines"].dataType)
    return flatten(frame.withColumn("lines", F.coalesce("lines", empty)), explode=True)


@query("SELECT o_orderkey, o_orderstatus, CAST(count(l_orderkey) AS BIGINT) AS n_lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2")
def flatten_keep_arrays(spark, sf_dir):
    flat = flatten(_orders_with_lines(spark, sf_dir), explode=False)
    return flat.select("o_orderkey", "o_orderstatus", F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"))


@query("SELECT c_custkey, x AS a_x, y AS b_y FROM customer, (VALUES (1), (2)) t(x), (VALUES ('p'), ('q'), ('r')) u(y)")
def explode_two_arrays(spark, sf_dir):
    two = F.array(*[F.struct(F.lit(v).alias("x")) for v in (1, 2)]).alias("a")
    three = F.array(*[F.struct(F.lit(v).alias("y")) for v in "pqr"]).alias("b")
    return flatten(table(spark, sf_dir, "customer").select("c_custkey", two, three), explode=True)


@query("SELECT n_nationkey, n_name, CAST(json_merge_patch('{}', json_object('n_nationkey', n_nationkey, 'n_name', n_name)) AS VARCHAR) AS raw FROM (SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_name END AS n_name FROM nation)")
def raw_capture_json(spark, sf_dir):
    return flatten(table(spark, sf_dir, "nation").select("n_nationkey", F.expr("CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_name END").alias("n_name")), raw_column="raw")


@query("SELECT event_id, event_type, json_extract_string(props, '$.k') AS props_k FROM events")
def parse_event_props(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return flatten(events.select("event_id", "event_type", F.from_json("props", "k string").alias("props")))


# --- splitting --------------------------------------------------------------------------
@query(f"SELECT id, name, segment FROM ({FLAT}) WHERE name IS NOT NULL AND segment IS NOT NULL")
def required_valid(spark, sf_dir):
    return split_required(_flat(spark, sf_dir).select("id", "name", "segment"), ["name", "segment"]).valid


@query(f"SELECT id, name, segment FROM ({FLAT}) WHERE name IS NULL OR segment IS NULL")
def required_invalid(spark, sf_dir):
    return split_required(_flat(spark, sf_dir).select("id", "name", "segment"), ["name", "segment"]).invalid


@query("SELECT count(*) AS n_total, count(*) FILTER (WHERE o_orderstatus <> 'P') AS n_valid, count(*) FILTER (WHERE o_orderstatus = 'P') AS n_invalid FROM orders")
def required_split_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.expr("nullif(o_orderstatus, 'P')").alias("status"))
    ok = has_all(["status"])
    return orders.agg(F.count(F.lit(1)).alias("n_total"), F.count_if(ok).alias("n_valid"), F.count_if(~ok).alias("n_invalid"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_name END AS p_name FROM part WHERE p_partkey % 9 > 0")
def required_empty_string_passes(spark, sf_dir):
    part = table(spark, sf_dir, "part").selectExpr("p_partkey", "CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 4 = 0 THEN '' ELSE p_name END AS p_name")
    return split_required(part, ["p_name"]).valid


@query("SELECT o_orderstatus, o_orderpriority FROM orders EXCEPT ALL SELECT o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 2 = 0")
def multiset_difference_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    columns = ["o_orderstatus", "o_orderpriority"]
    return multiset_difference(orders.select(columns), orders.filter("o_orderkey % 2 = 0").select(columns))


# --- cleaning ---------------------------------------------------------------------------
_ADDRESS = ["line1", "city", "state", "country", "postal"]
_ADDRESS_SQL = "regexp_replace(concat_ws(' ', line1, city, state, country, postal), '[^a-zA-Z0-9\\s]', '', 'g')"


@query(f"SELECT id, {_ADDRESS_SQL} AS combined_address FROM ({FLAT})")
def combine_address(spark, sf_dir):
    return clean.combine_address(_flat(spark, sf_dir), _ADDRESS).select("id", "combined_address")


@query("SELECT p_partkey, lower(p_name) AS p_name, p_brand, lower(p_type) AS p_type, p_size, p_retailprice FROM part")
def lowercase_all_but(spark, sf_dir):
    return clean.lowercase_strings(table(spark, sf_dir, "part"), exclude=["p_brand"]).select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


@query("SELECT doc_id, lower(text) AS text, lower(lang) AS lang, lower(source) AS source FROM documents")
def lowercase_documents(spark, sf_dir):
    return clean.lowercase_strings(table(spark, sf_dir, "documents")).select("doc_id", "text", "lang", "source")


@query(f"SELECT id, name, coalesce(nullif(segment, ''), 'Unknown') AS segment, coalesce(nullif(state, ''), 'Unknown') AS state FROM ({FLAT})")
def default_strings(spark, sf_dir):
    return clean.fill_defaults(_flat(spark, sf_dir).select("id", "name", "segment", "state"), keep=["id", "name"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0.0::DOUBLE ELSE o_totalprice END AS price, CASE WHEN o_orderkey % 4 = 0 THEN 0::SMALLINT ELSE CAST(o_orderkey % 100 AS SMALLINT) END AS small FROM orders")
def default_numeric(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS price", "CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_orderkey % 100 AS SMALLINT) END AS small")
    return clean.fill_defaults(orders)


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN false ELSE c_acctbal > 0 END AS solvent FROM customer")
def default_boolean(spark, sf_dir):
    return clean.fill_defaults(table(spark, sf_dir, "customer").selectExpr("c_custkey", "CASE WHEN c_custkey % 3 > 0 THEN c_acctbal > 0 END AS solvent"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'N/A' ELSE p_name END AS p_name, CASE WHEN p_partkey % 5 = 0 THEN -1 ELSE p_size END AS p_size FROM part")
def default_custom_types(spark, sf_dir):
    part = table(spark, sf_dir, "part").selectExpr("p_partkey", "CASE WHEN p_partkey % 4 = 0 THEN '' WHEN p_partkey % 2 > 0 THEN p_name END AS p_name", "CASE WHEN p_partkey % 5 > 0 THEN p_size END AS p_size")
    return clean.fill_defaults(part, defaults={T.StringType: "N/A", T.IntegerType: -1})


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '2000-01-01 00:00:00' ELSE o_orderdate END AS o_orderdate FROM orders")
def default_timestamp_null_only(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate END AS o_orderdate")
    return clean.fill_defaults(orders, keep=["o_orderkey"], now=F.expr("TIMESTAMP_NTZ '2000-01-01 00:00:00'"))


@query(f"SELECT id, coalesce(name, 'nobody') AS name, coalesce(segment, '7') AS segment FROM ({FLAT})")
def fill_nulls_map(spark, sf_dir):
    return clean.fill_nulls(_flat(spark, sf_dir).select("id", "name", "segment"), {"name": "nobody", "segment": 7})


@query("SELECT doc_id, regexp_replace(text, '[^a-zA-Z0-9\\s]', '', 'g') AS text FROM documents")
def strip_special_documents(spark, sf_dir):
    return clean.strip_columns(table(spark, sf_dir, "documents"), ["text"]).select("doc_id", "text")


@query("SELECT page_id, regexp_replace(html, '[^a-zA-Z0-9\\s]', '', 'g') AS html FROM pages")
def strip_special_pages(spark, sf_dir):
    return clean.strip_columns(table(spark, sf_dir, "pages"), ["html"]).select("page_id", "html")


@query("SELECT o_orderkey, TIMESTAMP '2020-02-02 02:02:02' AS processing_time_utc FROM orders")
def stamp_processing_time(spark, sf_dir):
    return clean.stamp_time(table(spark, sf_dir, "orders").select("o_orderkey"), F.expr("TIMESTAMP_NTZ '2020-02-02 02:02:02'"))


_CHAIN_SQL = f"""SELECT lower(id) AS id, coalesce(nullif(lower(name), ''), 'Unknown') AS name, coalesce(nullif(lower(segment), ''), 'Unknown') AS segment,
 lower(line1) AS line1, coalesce(lower(city), 'Unknown') AS city, coalesce(lower(state), 'Unknown') AS state, coalesce(lower(country), 'Unknown') AS country,
 coalesce(lower(postal), 'Unknown') AS postal, coalesce(nullif(lower({_ADDRESS_SQL}), ''), 'Unknown') AS combined_address FROM ({FLAT})"""


@query(_CHAIN_SQL)
def chain_clean(spark, sf_dir):
    return run_chain(
        _flat(spark, sf_dir).select("id", "name", "segment", *_ADDRESS),
        (
            lambda df: clean.combine_address(df, _ADDRESS),
            clean.lowercase_strings,
            lambda df: clean.fill_defaults(df, keep=["line1"]),
        ),
    )


# --- the whole ingestion ----------------------------------------------------------------
_OUT = ["id", "name", "providerId", "category", "geoCode_lat", "geoCode_long", "contact_address_line1", "contact_address_city_name", "contact_address_state_name", "contact_address_country_code", "contact_address_country_name", "contact_address_postalCode"]
_OK = "k % 17 > 0 AND name IS NOT NULL AND k % 5 > 0"
_VALID_SQL = f"""SELECT id, lower(name) AS name, 'p1' AS providerId, coalesce(nullif(lower(segment), ''), 'Unknown') AS category, '1.5' AS geoCode_lat, '2.5' AS geoCode_long,
 lower(line1) AS contact_address_line1, lower(city) AS contact_address_city_name, coalesce(lower(state), 'Unknown') AS contact_address_state_name, code AS contact_address_country_code,
 lower(country) AS contact_address_country_name, coalesce(lower(postal), 'Unknown') AS contact_address_postalCode, lower({_ADDRESS_SQL}) AS combined_address FROM ({FLAT}) WHERE {_OK}"""


def _ingest(spark, **options) -> Ingest:
    return Ingest(TableStore(spark, scratch_path(spark, "store"), "bronze"), **options)


@query(_VALID_SQL)
def pipeline_valid(spark, sf_dir):
    return _ingest(spark).split(documents(spark, sf_dir)).valid.select(*_OUT, "combined_address")


@query(f"""SELECT id, name, 'P1' AS providerId, segment AS category, CASE WHEN k % 17 > 0 THEN '1.5' END AS geoCode_lat, CASE WHEN k % 17 > 0 THEN '2.5' END AS geoCode_long,
 line1 AS contact_address_line1, city AS contact_address_city_name, state AS contact_address_state_name, code AS contact_address_country_code,
 country AS contact_address_country_name, postal AS contact_address_postalCode FROM ({FLAT}) WHERE NOT ({_OK})""")
def pipeline_invalid(spark, sf_dir):
    return _ingest(spark).split(documents(spark, sf_dir)).invalid.select(*_OUT)


# --- sources ----------------------------------------------------------------------------
@query("SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation")
def read_csv_strings(spark, sf_dir):
    path = scratch_path(spark, "csv")
    table(spark, sf_dir, "nation").write.option("header", "true").csv(path)
    return read_csv(spark, path).select("n_nationkey", "n_name", "n_regionkey")


@query("SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation")
def read_json_inferred(spark, sf_dir):
    path = scratch_path(spark, "json")
    table(spark, sf_dir, "nation").write.json(f"{path}/deep/er")
    return read_json(spark, path).select("n_nationkey", "n_name", "n_regionkey")


def _streamed(spark, sf_dir, runs: int) -> TableStore:
    source, state = scratch_path(spark, "json"), scratch_path(spark, "state")
    documents(spark, sf_dir).repartition(3).write.json(source)
    ingest = _ingest(spark)
    for _ in range(runs):
        run_stream(stream_json(spark, source, models.document_schema(), max_files_per_trigger=1), ingest, state)
    return ingest.store


@query(_VALID_SQL)
def stream_json_ingest(spark, sf_dir):
    return _streamed(spark, sf_dir, 1).read("records").select(*_OUT, "combined_address")


@query(f"SELECT count(*) FILTER (WHERE {_OK}) AS n_valid, count(*) FILTER (WHERE NOT ({_OK})) AS n_invalid FROM ({FLAT})")
def stream_rerun_idempotent(spark, sf_dir):
    store = _streamed(spark, sf_dir, 2)
    n = lambda name, alias: store.read(name).agg(F.count(F.lit(1)).alias(alias))
    return n("records", "n_valid").join(n("records_invalid", "n_invalid"))


@query(f"SELECT count(*) FILTER (WHERE {_OK}) * 3 AS n_valid, count(*) FILTER (WHERE NOT ({_OK})) * 3 AS n_invalid FROM ({FLAT})")
def stream_two_sources(spark, sf_dir):
    """Two sources with a checkpoint each, and one of them again with a checkpoint made anew."""
    ingest = _ingest(spark)
    for _ in range(2):
        source = scratch_path(spark, "json")
        documents(spark, sf_dir).repartition(2).write.json(source)
        run_stream(stream_json(spark, source, models.document_schema()), ingest, scratch_path(spark, "state"))
    run_stream(stream_json(spark, source, models.document_schema()), ingest, scratch_path(spark, "state"))
    n = lambda name, alias: ingest.store.read(name).agg(F.count(F.lit(1)).alias(alias))
    return n("records", "n_valid").join(n("records_invalid", "n_invalid"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN '{\"hotels\": [' || n_name END AS original_message FROM nation WHERE n_nationkey % 3 = 0")
def stream_corrupt_lines(spark, sf_dir):
    """Lines that are no JSON end up, as they are, among the invalid records."""
    source = scratch_path(spark, "json")
    lines = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit('{"hotels": ['), F.col("n_name"))).otherwise(F.lit('{"hotels": [{"id": "x"}]}'))
    nation = table(spark, sf_dir, "nation")
    nation.select(lines.alias("value")).write.text(source)
    ingest = _ingest(spark, corrupt_column="_corrupt")
    run_stream(stream_json(spark, source, models.document_schema(), corrupt_column="_corrupt"), ingest, scratch_path(spark, "state"))
    bad = ingest.store.read("records_invalid").filter("id IS NULL").select("original_message")
    return bad.join(nation.select("n_nationkey", F.concat(F.lit('{"hotels": ['), F.col("n_name")).alias("original_message")), "original_message").select("n_nationkey", "original_message")


@query("SELECT * FROM (VALUES ('records', 0, 28), ('records_invalid', 0, 28)) t(table_name, n_rows, n_columns)")
def stream_empty_source(spark, sf_dir):
    """A source without a record leaves both tables, empty and with the bronze columns."""
    source = scratch_path(spark, "json")
    table(spark, sf_dir, "nation").limit(0).select(F.lit("").alias("value")).write.text(source)
    ingest = _ingest(spark)
    run_stream(stream_json(spark, source, models.document_schema()), ingest, scratch_path(spark, "state"))
    frames = [(name, ingest.store.read(name)) for name in ("records", "records_invalid")]
    return spark.createDataFrame([(name, f.count(), len(f.columns)) for name, f in frames], "table_name string, n_rows int, n_columns int")


# --- tables -----------------------------------------------------------------------------
def _store(spark) -> TableStore:
    return TableStore(spark, scratch_path(spark, "store"), "s")


@query("SELECT CAST(0 AS BIGINT) AS n_rows")
def table_create_empty(spark, sf_dir):
    store = _store(spark)
    store.create("region", schema=table(spark, sf_dir, "region").schema, comment="it's empty")
    return store.read("region").agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT s_suppkey, s_name, NULL::VARCHAR AS note FROM supplier UNION ALL SELECT s_suppkey, s_name, 'new' AS note FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, NULL, NULL FROM supplier WHERE s_suppkey % 3 = 0")
def table_append_evolve(spark, sf_dir):
    store, rows = _store(spark), table(spark, sf_dir, "supplier")
    store.write("t", rows.select("s_suppkey", "s_name"))
    store.write("t", rows.filter("s_suppkey % 2 = 0").select(F.lit("new").alias("note"), "S_NAME", "s_suppkey"))
    store.write("t", rows.filter("s_suppkey % 3 = 0").select("s_suppkey"))
    return store.read("t")


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1")
def table_overwrite(spark, sf_dir):
    store, rows = _store(spark), table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    store.write("t", rows.drop("n_regionkey"))
    store.write("t", rows.filter("n_regionkey = 1").drop("n_regionkey"), mode="overwrite")
    return store.read("t")


@query("""WITH target AS (SELECT o_orderkey AS k, o_orderstatus AS status FROM orders WHERE o_orderkey % 3 > 0), source AS (SELECT o_orderkey AS k, 'X' AS status FROM orders WHERE o_orderkey % 2 = 0)
 SELECT * FROM source UNION ALL SELECT * FROM target WHERE k NOT IN (SELECT k FROM source)""")
def table_merge_upsert(spark, sf_dir):
    store, orders = _store(spark), table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"))
    store.create("t", orders.filter("k % 3 > 0"))
    store.merge("t", orders.filter("k % 2 = 0").withColumn("status", F.lit("X")), ["k"])
    return store.read("t")


@query("""WITH c AS (SELECT CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_custkey END AS k, c_name AS name FROM customer)
 SELECT * FROM c UNION ALL SELECT * FROM c WHERE k IS NULL""")
def table_merge_null_keys(spark, sf_dir):
    store = _store(spark)
    rows = table(spark, sf_dir, "customer").selectExpr("CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_custkey END AS k", "c_name AS name")
    store.create("t", rows)
    store.merge("t", rows, ["k"])
    return store.read("t")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE (CASE WHEN l_linenumber % 2 = 0 THEN l_quantity > 25 END) IS NOT TRUE")
def table_delete_condition(spark, sf_dir):
    store = _store(spark)
    store.create("t", table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"))
    store.delete("t", "CASE WHEN l_linenumber % 2 = 0 THEN l_quantity > 25 END")
    return store.read("t")


@query("SELECT 'kept' AS table_name, true AS present UNION ALL SELECT 'gone', false")
def table_drop_list(spark, sf_dir):
    store, rows = _store(spark), table(spark, sf_dir, "region")
    store.create("kept", rows)
    store.create("gone", rows)
    store.drop("gone")
    listed = store.list_tables()
    return spark.createDataFrame([(name, name in listed) for name in ("kept", "gone")], "table_name string, present boolean")


@query("SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1")
def table_sql_select(spark, sf_dir):
    store = _store(spark)
    store.create("supplier_copy", table(spark, sf_dir, "supplier"))
    return spark.sql(f"SELECT s_nationkey, count(*) AS n FROM {store.register('supplier_copy')} GROUP BY s_nationkey")


@query("SELECT s_nationkey, count(*) AS n, count(note) AS noted FROM (SELECT s_nationkey, NULL AS note FROM supplier UNION ALL SELECT s_nationkey, 'x' FROM supplier WHERE s_suppkey % 2 = 0) GROUP BY 1")
def table_catalog_view(spark, sf_dir):
    """A table by its full name in the catalog, in a schema that is created on the way."""
    store = TableStore(spark, scratch_path(spark, "store"), f"s_{uuid.uuid4().hex[:12]}")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    store.create("supplier", rows)
    store.write("supplier", rows.filter("s_suppkey % 2 = 0").withColumn("note", F.lit("x")))
    return spark.sql(f"SELECT s_nationkey, count(*) AS n, count(note) AS noted FROM {store.publish('supplier')} GROUP BY s_nationkey")


@query("SELECT * FROM (VALUES ('catalogs', 'spark_catalog'), ('schemas', 's'), ('tables', 'a'), ('tables', 'b')) t(kind, name)")
def table_listings(spark, sf_dir):
    store, rows = _store(spark), table(spark, sf_dir, "region")
    for name in ("b", "a"):
        store.create(name, rows)
    listed = [store.listing(kind).select(F.lit(kind).alias("kind"), "name") for kind in ("schemas", "tables")]
    return store.listing("catalogs").filter("name = 'spark_catalog'").select(F.lit("catalogs").alias("kind"), "name").unionByName(listed[0]).unionByName(listed[1])


@query("SELECT n_nationkey, n_name, NULL::VARCHAR AS note FROM nation UNION ALL SELECT n_nationkey, NULL, 'second' FROM nation WHERE n_regionkey = 1")
def path_write_merge_schema(spark, sf_dir):
    path, nation = scratch_path(spark, "rows"), table(spark, sf_dir, "nation")
    write_path(nation.select("n_nationkey", "n_name"), path)
    write_path(nation.filter("n_regionkey = 1").select("n_nationkey", F.lit("second").alias("note")), path)
    return spark.read.option("mergeSchema", "true").parquet(path).select("n_nationkey", "n_name", "note")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 5 > 0 OR o_orderkey % 2 = 0")
def table_delete_by_folder(spark, sf_dir):
    """A delete that touches one of two folders leaves the other as it is."""
    store, orders = _store(spark), table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    store.write("t", orders.filter("o_orderkey % 2 = 0"))
    store.write("t", orders.filter("o_orderkey % 2 > 0"))
    before = {name for name, _ in store.manifest("t").folders}
    store.delete("t", "o_orderkey % 5 = 0 AND o_orderkey % 2 > 0")
    if len(before & {name for name, _ in store.manifest("t").folders}) != 1:
        raise AssertionError("a folder without hits was written anew")
    return store.read("t")
