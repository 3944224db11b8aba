"""Registered queries of the table layer over the driver's tables, each with the SQL it is held against."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.catalog import Catalog, Schema, Table
from tablekit.functions.predicate import Predicate, PredicateBuilder
from tablekit.functions.udf import Words, digit_sum, middle
from tablekit.operators.merge import merge_on_read
from tablekit.operators.relational import asof_join, interval_join, range_join
from tablekit.sources.types import arrow_schema
from tablekit.streaming.sink import write_stream
from tablekit.streaming.windows import distinct_within, drained, running_totals, sessions, windowed

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(sql: str | None = None):
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def _filtered(name: str, table: str, columns: str, make: Callable[[PredicateBuilder], Predicate], where: str, source: str | None = None, prepare: Callable[[DataFrame], DataFrame] = lambda d: d) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = prepare(_load(spark, sf_dir, table))
        return df.filter(make(PredicateBuilder(df.schema)).column(df.schema)).select(*columns.split(", "))

    _QUERIES[name] = run
    _SQL[name] = f"SELECT {columns} FROM {source or table} WHERE {where}"


_with_nulls = lambda d: d.withColumn("o_orderstatus", F.expr("nullif(o_orderstatus, 'P')"))
_NULLS = "(SELECT * REPLACE (nullif(o_orderstatus, 'P') AS o_orderstatus) FROM orders)"
_O = "o_orderkey, o_orderstatus, o_orderpriority"
_P = "p_partkey, p_name, p_brand, p_size"

_filtered("filter_eq", "orders", _O, lambda b: b.equal("o_orderpriority", "1-URGENT"), "o_orderpriority = '1-URGENT'")
_filtered("filter_ne", "orders", _O, lambda b: b.not_equal("o_orderpriority", "1-URGENT"), "o_orderpriority <> '1-URGENT'")
_filtered("filter_lt", "part", _P, lambda b: b.less_than("p_size", 10), "p_size < 10")
_filtered("filter_le", "part", _P, lambda b: b.less_or_equal("p_size", 10), "p_size <= 10")
_filtered("filter_gt", "part", _P, lambda b: b.greater_than("p_size", 40), "p_size > 40")
_filtered("filter_ge", "part", _P, lambda b: b.greater_or_equal("p_size", 40), "p_size >= 40")
_filtered("filter_is_null", "orders", _O, lambda b: b.is_null("o_orderstatus"), "o_orderstatus IS NULL", _NULLS, _with_nulls)
_filtered("filter_is_not_null", "orders", _O, lambda b: b.is_not_null("o_orderstatus"), "o_orderstatus IS NOT NULL", _NULLS, _with_nulls)
_filtered("filter_ne_null", "orders", _O, lambda b: b.not_equal("o_orderstatus", "F"), "o_orderstatus <> 'F'", _NULLS, _with_nulls)
_filtered("filter_notin_null", "orders", _O, lambda b: b.is_not_in("o_orderstatus", ["F"]), "o_orderstatus NOT IN ('F')", _NULLS, _with_nulls)
_filtered("filter_startswith", "part", _P, lambda b: b.startswith("p_name", "red"), "starts_with(p_name, 'red')")
_filtered("filter_endswith", "part", _P, lambda b: b.endswith("p_name", "bolt"), "suffix(p_name, 'bolt')")
_filtered("filter_contains", "part", _P, lambda b: b.contains("p_name", " w"), "contains(p_name, ' w')")
_filtered("filter_in", "part", _P, lambda b: b.is_in("p_size", [1, 7, 49]), "p_size IN (1, 7, 49)")
_filtered("filter_not_in", "part", _P, lambda b: b.is_not_in("p_size", [1, 7, 49]), "p_size NOT IN (1, 7, 49)")
_filtered("filter_between", "part", _P, lambda b: b.between("p_size", 5, 9), "p_size BETWEEN 5 AND 9")
_filtered("filter_and", "orders", _O, lambda b: b.and_predicates([b.equal("o_orderpriority", "1-URGENT"), b.greater_than("o_totalprice", 200000)]), "o_orderpriority = '1-URGENT' AND o_totalprice > 200000")
_filtered("filter_or", "orders", _O, lambda b: b.or_predicates([b.equal("o_orderpriority", "1-URGENT"), b.less_than("o_totalprice", 50000)]), "o_orderpriority = '1-URGENT' OR o_totalprice < 50000")
_filtered("filter_nested", "lineitem", "l_orderkey, l_linenumber, l_returnflag", lambda b: b.and_predicates([b.or_predicates([b.equal("l_returnflag", "A"), b.equal("l_linestatus", "O")]), b.between("l_quantity", 5, 20), b.is_not_in("l_linenumber", [1, 2]), b.is_not_null("l_suppkey")]), "(l_returnflag = 'A' OR l_linestatus = 'O') AND l_quantity BETWEEN 5 AND 20 AND l_linenumber NOT IN (1, 2) AND l_suppkey IS NOT NULL")
_typed = lambda d: d.select("p_partkey", F.col("p_size").cast("byte").alias("b"), F.col("p_size").cast("short").alias("s"), F.col("p_retailprice").cast("float").alias("f"), (F.col("p_size") > 25).alias("t"))
_filtered("filter_typed", "part", "p_partkey, b, s, t", lambda b: b.or_predicates([b.and_predicates([b.equal("t", True), b.less_than("b", 30)]), b.equal("s", 3), b.greater_than("f", 1999.5)]), "(t = true AND b < 30) OR s = 3 OR f > CAST(1999.5 AS FLOAT)", "(SELECT p_partkey, CAST(p_size AS TINYINT) AS b, CAST(p_size AS SMALLINT) AS s, CAST(p_retailprice AS FLOAT) AS f, p_size > 25 AS t FROM part)", _typed)


@_query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def limit_exact(spark, sf_dir):
    return _load(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").select("o_orderkey", "o_totalprice").limit(10)


# --- tables that are written and read back ------------------------------------------------------


def _folder(spark: SparkSession) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/tablekit"


def _table(spark: SparkSession, fields: T.StructType | pa.Schema, **schema) -> Table:
    """A new, empty table in the shared warehouse."""
    catalog = Catalog.create({"warehouse": _folder(spark)}, spark)
    catalog.create_database("queries", True)
    name = f"queries.t{uuid.uuid4().hex}"
    catalog.create_table(name, Schema(fields, **schema), False)
    return catalog.get_table(name)


def _again(table: Table, **options: str) -> Table:
    """The table as another session of a catalog with these options gets it."""
    warehouse, name = table.path.rsplit("/queries.db/", 1)
    return Catalog.create({"warehouse": warehouse} | options, table.spark).get_table(f"queries.{name}")


def _put(table: Table, df: DataFrame, sequence: str | None = None, kind: str | None = None, builder=None) -> Table:
    builder = builder or table.new_batch_write_builder()
    writer = builder.new_write()
    writer.write_dataframe(df, sequence, kind)
    builder.new_commit().commit(writer.prepare_commit())
    return table


def _roundtrip(name: str, source: str, kind: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _load(spark, sf_dir, source)
        return _put(_table(spark, df.schema, options={"file.format": kind}), df).to_df()

    _QUERIES[name], _SQL[name] = run, f"SELECT * FROM {source}"


_roundtrip("append_roundtrip_parquet", "nation", "parquet")
_roundtrip("append_roundtrip_orc", "customer", "orc")


@_query("SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS s_comment FROM supplier UNION ALL SELECT s_suppkey + 1000000, s_name, 'new' FROM supplier WHERE s_acctbal < 0")
def schema_evolution_nullfill(spark, sf_dir):
    df = _load(spark, sf_dir, "supplier")
    table = _put(_table(spark, df.select("s_suppkey", "s_name").schema), df)
    table.add_column("s_comment", "string")
    later = _again(table)
    return _put(later, df.filter("s_acctbal < 0").selectExpr("s_suppkey + 1000000 AS s_suppkey", "s_name", "'new' AS s_comment")).to_df()


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


@_query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def partition_inject(spark, sf_dir):
    df = _orders(spark, sf_dir)
    table = _put(_table(spark, df.schema, partition_keys=["o_orderstatus"]), df)
    rb = table.new_read_builder()
    return rb.with_filter(rb.new_predicate_builder().equal("o_orderstatus", "F")).to_df()


def _overwritten(name: str, sql: str, options: dict, static: dict | None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _orders(spark, sf_dir)
        table = _put(_table(spark, df.schema, partition_keys=["o_orderstatus"], options=options), df)
        new = df.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0))
        return _put(table, new, builder=table.new_batch_write_builder().overwrite(static)).to_df()

    _QUERIES[name], _SQL[name] = run, sql


_NEW = "SELECT o_orderkey, o_orderstatus, 0.0::DOUBLE AS o_totalprice FROM orders WHERE o_orderstatus = 'F'"
_KEPT = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F'"
_overwritten("overwrite_partition", f"{_KEPT} UNION ALL {_NEW}", {}, {"o_orderstatus": "F"})
_overwritten("overwrite_all", _NEW, {}, None)
_overwritten("overwrite_dynamic", f"{_KEPT} UNION ALL {_NEW}", {"dynamic-partition-overwrite": "true"}, None)


@_query("SELECT CAST(count(*) AS BIGINT) AS row_count FROM lineitem")
def split_metadata(spark, sf_dir):
    df = _load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    splits = _put(_table(spark, df.schema), df).new_read_builder().new_scan().plan().splits()
    return spark.createDataFrame([(sum(s.row_count() for s in splits),)], "row_count long")


# --- primary keys -------------------------------------------------------------------------------

_EVENT_COLUMNS = "event_id, user_id, event_type, value"
_LATEST = f"SELECT {_EVENT_COLUMNS} FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
_KINDS = "CASE event_type WHEN 'error' THEN 3 WHEN 'signup' THEN 1 ELSE 0 END"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _load(spark, sf_dir, "events")
    return e.select("event_id", "user_id", "event_type", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("seq"), F.expr(_KINDS).alias("kind"))


def _upserted(spark: SparkSession, sf_dir: str, keys: list[str], partition: list[str] | None = None, options: dict | None = None, kinds: bool = False) -> Table:
    df = _events(spark, sf_dir)
    fields = df.select("event_id", "user_id", "event_type", "value").schema
    table = _table(spark, fields, partition_keys=partition, primary_keys=keys, options={"bucket": "4"} | (options or {}))
    return _put(table, df, "seq", "kind" if kinds else None)


@_query(_LATEST)
def pk_upsert_latest(spark, sf_dir):
    return _upserted(spark, sf_dir, ["user_id"]).to_df()


@_query(f"SELECT * FROM ({_LATEST}) WHERE value > 50")
def pk_filter_nonkey(spark, sf_dir):
    rb = _upserted(spark, sf_dir, ["user_id"]).new_read_builder()
    return rb.with_filter(rb.new_predicate_builder().greater_than("value", 50)).to_df()


@_query(f"SELECT * FROM ({_LATEST}) WHERE user_id BETWEEN 3 AND 40")
def pk_filter_key(spark, sf_dir):
    rb = _upserted(spark, sf_dir, ["user_id"]).new_read_builder()
    return rb.with_filter(rb.new_predicate_builder().between("user_id", 3, 40)).to_df()


@_query(f"SELECT {_EVENT_COLUMNS} FROM (SELECT *, {_KINDS} AS kind FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1) WHERE kind = 0")
def pk_delete(spark, sf_dir):
    return _upserted(spark, sf_dir, ["user_id"], kinds=True).to_df()


@_query(f"SELECT {_EVENT_COLUMNS} FROM (SELECT *, {_KINDS} AS kind FROM events WHERE event_type <> 'error' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1) WHERE kind = 0")
def pk_ignore_delete(spark, sf_dir):
    return _upserted(spark, sf_dir, ["user_id"], options={"ignore-delete": "true"}, kinds=True).to_df()


@_query(f"SELECT {_EVENT_COLUMNS} FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC) = 1")
def pk_partitioned(spark, sf_dir):
    return _upserted(spark, sf_dir, ["event_type", "user_id"], ["event_type"]).to_df()


_REST = "l_shipdate, l_extendedprice, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus"


@_query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' DESC' for c in _REST.split(', '))}) = 1")
def pk_composite(spark, sf_dir):
    versions = _load(spark, sf_dir, "lineitem").withColumn("_KIND", F.lit(0))
    return merge_on_read(versions, ["l_orderkey", "l_linenumber"], order=_REST.split(", ")).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


# --- what SQL on views gives --------------------------------------------------------------------


def _view(name: str, sql: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
            if t in sql:
                _load(spark, sf_dir, t).createOrReplaceTempView(t)
        return spark.sql(sql)

    _QUERIES[name], _SQL[name] = run, sql


_view("sql_view_join", "SELECT n_name, CAST(count(*) AS BIGINT) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' GROUP BY n_name")
_view("sql_view_agg", "SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n, round(sum(l_quantity), 2) AS quantity, round(avg(l_discount), 6) AS discount, CAST(count(DISTINCT l_partkey) AS BIGINT) AS parts FROM lineitem GROUP BY l_returnflag, l_linestatus")
_view("sql_view_rollup", "SELECT o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
_view("sql_view_cube", "SELECT o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
_view("sql_view_window", "SELECT o_orderkey, o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS k FROM orders")
_view("sql_view_semi", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
_view("sql_view_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
_view("sql_view_except", "SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey AS k FROM supplier WHERE s_acctbal > 5000")
_view("sql_view_intersect", "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey AS k FROM supplier")


@_query("SELECT o.event_id, o.user_id, p.value AS last_value FROM (SELECT * FROM events WHERE event_type = 'error') o ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON o.user_id = p.user_id AND o.ts >= p.ts")
def join_asof(spark, sf_dir):
    e = _load(spark, sf_dir, "events")
    left = e.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    right = e.filter("event_type = 'purchase'").select("user_id", "ts", F.col("value").alias("last_value"))
    return asof_join(left, right, ["user_id"], "ts", "ts", ["last_value"]).select("event_id", "user_id", "last_value")


@_query("SELECT o_orderkey, b FROM orders JOIN (SELECT CAST(range AS BIGINT) AS b, range * 50000.0 AS low, range * 50000.0 + 70000.0 AS high FROM range(10)) r ON o_totalprice >= low AND o_totalprice < high")
def join_range(spark, sf_dir):
    bands = spark.range(10).select(F.col("id").alias("b"), (F.col("id") * 50000.0).alias("low"), (F.col("id") * 50000.0 + 70000.0).alias("high"))
    return range_join(_load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), bands, "o_totalprice", "low", "high", 50000.0).select("o_orderkey", "b")


@_query("SELECT e.event_id, p.value AS last_value FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS user_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts END AS ts FROM events WHERE event_type = 'error') e ASOF LEFT JOIN (SELECT CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END AS user_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE ts END AS ts, value FROM events WHERE event_type = 'purchase') p ON e.user_id = p.user_id AND e.ts >= p.ts")
def join_asof_nulls(spark, sf_dir):
    e = _load(spark, sf_dir, "events")
    left = e.filter("event_type = 'error'").selectExpr("event_id", "if(event_id % 7 = 0, null, user_id) AS user_id", "if(event_id % 5 = 0, null, ts) AS ts")
    right = e.filter("event_type = 'purchase'").selectExpr("if(event_id % 3 = 0, null, user_id) AS user_id", "if(event_id % 4 = 0, null, ts) AS ts", "value AS last_value")
    return asof_join(left, right, ["user_id"], "ts", "ts", ["last_value"], F.date_trunc("DAY", "__t")).select("event_id", "last_value")


@_query("SELECT a.event_id AS a, b.event_id AS b FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts BETWEEN a.ts - INTERVAL 10 MINUTE AND a.ts + INTERVAL 1 HOUR WHERE a.event_type = 'error' AND b.event_type = 'purchase'")
def join_interval(spark, sf_dir):
    e = _load(spark, sf_dir, "events")
    left = e.filter("event_type = 'error'").select(F.col("event_id").alias("a"), "user_id", F.col("ts").alias("t"))
    right = e.filter("event_type = 'purchase'").select(F.col("event_id").alias("b"), "user_id", F.col("ts").alias("u"))
    return interval_join(left, right, ["user_id"], "t", "u", "10 minutes", "1 hour").select("a", "b")


_view("sql_view_full_outer", "SELECT c_custkey, s_suppkey FROM (SELECT * FROM customer WHERE c_acctbal > 9000) c FULL OUTER JOIN (SELECT * FROM supplier WHERE s_acctbal > 5000) s ON c_custkey = s_suppkey")
_view("sql_view_left_join", "SELECT c_custkey, CAST(count(o_orderkey) AS BIGINT) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
_view("sql_view_broadcast_join", "SELECT /*+ BROADCAST(nation) */ s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
_view("sql_view_nested_loop", "SELECT r_name, n_name FROM region JOIN nation ON r_regionkey < n_regionkey AND length(r_name) > 4")
_view("sql_view_grouping_sets", "SELECT o_orderstatus, o_orderpriority, CAST(grouping(o_orderstatus) AS BIGINT) AS g, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")
_view("sql_view_having", "SELECT o_custkey, CAST(count(*) AS BIGINT) AS n, max(o_totalprice) AS most FROM orders GROUP BY o_custkey HAVING count(*) >= 15")
_view("sql_view_lag_lead", "SELECT event_id, value - lag(value) OVER w AS change, lead(value, 2) OVER w AS later, first_value(value) OVER w AS opening FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
_view("sql_view_frames", "SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING), 6) AS near, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS total FROM events")
_view("sql_view_rank", "SELECT p_partkey, CAST(rank() OVER w AS BIGINT) AS r, CAST(dense_rank() OVER w AS BIGINT) AS d, CAST(ntile(4) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS BIGINT) AS q, percent_rank() OVER w AS p FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_size)")
_view("sql_view_cte_subquery", "WITH big AS (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey) SELECT o_custkey FROM big WHERE total > (SELECT avg(total) FROM big)")
_view("sql_view_union_distinct", "SELECT n_regionkey AS k FROM nation UNION SELECT r_regionkey + 3 AS k FROM region")
_view("scalar_strings", "SELECT p_partkey, upper(p_name) AS u, CAST(length(p_name) AS BIGINT) AS n, substring(p_name, 2, 3) AS s, replace(p_name, 'e', '3') AS r, concat(p_brand, '/', p_type) AS c, lpad(p_brand, 12, '*') AS l, CAST(instr(p_name, 'o') AS BIGINT) AS i, reverse(p_type) AS v, trim(concat('  ', p_name, ' ')) AS t FROM part")
_view("scalar_math", "SELECT o_orderkey, abs(o_totalprice - 200000) AS a, CAST(ceil(o_totalprice) AS BIGINT) AS c, CAST(floor(o_totalprice) AS BIGINT) AS f, round(sqrt(o_totalprice), 6) AS q, round(ln(o_totalprice), 6) AS l, round(power(o_totalprice, 0.25), 6) AS p, CAST(o_orderkey % 7 AS BIGINT) AS m, CAST(sign(o_totalprice - 100000) AS BIGINT) AS s, greatest(o_totalprice, 1000.0) AS g FROM orders")
_view("scalar_dates", "SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m, CAST(dayofmonth(o_orderdate) AS BIGINT) AS d, CAST(quarter(o_orderdate) AS BIGINT) AS q, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR(10)) AS t, CAST(CAST(o_orderdate + INTERVAL 40 DAY AS DATE) AS VARCHAR(10)) AS later, CAST(last_day(CAST(o_orderdate AS DATE)) AS VARCHAR(10)) AS e FROM orders")
_view("scalar_conditional", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'owes' WHEN c_acctbal < 5000 THEN 'some' ELSE 'rich' END AS k, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS s, CAST(CAST(c_acctbal AS DECIMAL(12, 1)) AS VARCHAR(20)) AS d, c_acctbal IS NULL OR c_name LIKE '%7' AS b FROM customer")
_view("agg_statistics", "SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS sd, round(var_pop(l_quantity), 6) AS vp, round(corr(l_quantity, l_extendedprice), 6) AS co, min(l_shipdate) = max(l_shipdate) AS one, CAST(count(*) FILTER (WHERE l_discount > 0.05) AS BIGINT) AS n, CAST(sum(DISTINCT l_linenumber) AS BIGINT) AS sl, bool_or(l_tax > 0.07) AS o FROM lineitem GROUP BY l_returnflag")


@_query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, regexp_extract(props, '([0-9]+)', 1) AS digits, event_type IN ('error', 'signup') AS flagged FROM events")
def scalar_json(spark, sf_dir):
    return _load(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.regexp_extract("props", "([0-9]+)", 1).alias("digits"), F.col("event_type").isin("error", "signup").alias("flagged"))


@_query("SELECT event_type, TRUE AS near FROM events GROUP BY event_type")
def agg_approx_distinct(spark, sf_dir):
    found = _load(spark, sf_dir, "events").groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.02).alias("a"), F.count_distinct("user_id").alias("n"))
    return found.select("event_type", (F.abs(F.col("a") - F.col("n")) <= 0.1 * F.col("n")).alias("near"))


@_query("SELECT o_orderkey, CAST(list_sum(list_transform(string_split(CAST(o_orderkey AS VARCHAR), ''), lambda c: CAST(c AS INTEGER))) AS BIGINT) AS digits FROM orders")
def udf_vectorized(spark, sf_dir):
    return _load(spark, sf_dir, "orders").select("o_orderkey", digit_sum("o_orderkey").alias("digits"))


@_query("SELECT o_orderpriority, median(o_totalprice) AS price FROM orders GROUP BY o_orderpriority")
def udaf_median(spark, sf_dir):
    return _load(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(middle("o_totalprice").alias("price"))


@_query("SELECT p_partkey, CAST(i - 1 AS INTEGER) AS part, w[i] AS word FROM (SELECT p_partkey, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part))")
def udtf_words(spark, sf_dir):
    spark.udtf.register("tablekit_words", Words)
    _load(spark, sf_dir, "part").createOrReplaceTempView("tablekit_part")
    return spark.sql("SELECT p_partkey, part, word FROM tablekit_part, LATERAL tablekit_words(p_name)")


# --- the table interface ------------------------------------------------------------------------


def _nation(spark: SparkSession, sf_dir: str, **schema) -> Table:
    df = _load(spark, sf_dir, "nation")
    return _put(_table(spark, df.schema, **schema), df)


_NATION = "SELECT * FROM nation"


@_query("SELECT n_name, n_nationkey FROM nation WHERE n_regionkey >= 2")
def scan_project(spark, sf_dir):
    rb = _nation(spark, sf_dir).new_read_builder()
    return rb.with_filter(rb.new_predicate_builder().greater_or_equal("n_regionkey", 2)).with_projection(["n_name", "n_nationkey"]).to_df()


@_query("SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS columns FROM nation")
def scan_project_empty(spark, sf_dir):
    df = _nation(spark, sf_dir).new_read_builder().with_projection([]).to_df()
    return df.agg(F.count("*").alias("n")).withColumn("columns", F.lit(len(df.columns)).cast("long"))


@_query("SELECT * FROM (VALUES ('n_regionkey', 'int32'), ('n_name', 'string')) t(name, type)")
def read_type(spark, sf_dir):
    found = _nation(spark, sf_dir).new_read_builder().with_projection(["n_regionkey", "n_name"]).read_type().as_arrow()
    return spark.createDataFrame([(f.name, str(f.type)) for f in found], "name string, type string")


@_query("SELECT CAST(7 AS BIGINT) AS n")
def limit_table(spark, sf_dir):
    return _nation(spark, sf_dir).new_read_builder().with_limit(7).to_df().agg(F.count("*").alias("n"))


@_query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice > 400000")
def concat_splits(spark, sf_dir):
    """Each split read by itself, after it has been sent elsewhere and back."""
    df = _orders(spark, sf_dir)
    table = _put(_table(spark, df.schema, options={"source.split.target-size": "1kb"}), df.repartition(3))
    rb = table.new_read_builder()
    rb = rb.with_filter(rb.new_predicate_builder().greater_than("o_totalprice", 400000))
    splits = pickle.loads(pickle.dumps(rb.new_scan().plan().splits()))
    found = rb.new_read().to_df(splits[:1])
    for k in range(1, len(splits)):
        found = found.unionByName(rb.new_read().to_df(splits[k : k + 1]))
    return found


@_query("SELECT * FROM nation WHERE FALSE")
def empty_table(spark, sf_dir):
    return _table(spark, _load(spark, sf_dir, "nation").schema).to_df()


def _from_arrow(name: str, write: Callable[[Table, pa.Table], None]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _load(spark, sf_dir, "nation")
        table = _table(spark, arrow_schema(df.schema))
        write(table, df.toArrow())
        return table.to_df()

    _QUERIES[name], _SQL[name] = run, _NATION


def _committed(write: str, take: Callable[[pa.Table], object]) -> Callable[[Table, pa.Table], None]:
    def run(table: Table, rows: pa.Table) -> None:
        builder = table.new_batch_write_builder()
        writer = builder.new_write()
        for part in (rows.slice(0, 10), rows.slice(10)):
            getattr(writer, write)(take(part))
        builder.new_commit().commit(writer.prepare_commit())
        writer.close()

    return run


_from_arrow("write_arrow", _committed("write_arrow", lambda t: t))
_from_arrow("write_arrow_batch", _committed("write_arrow_batch", lambda t: t.combine_chunks().to_batches()[0]))
_from_arrow("write_pandas", _committed("write_pandas", lambda t: t.to_pandas()))


def _read_back(name: str, read: Callable[[Table], DataFrame], sql: str = _NATION, **options: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return read(_again(_nation(spark, sf_dir, partition_keys=["n_regionkey"]), **options))

    _QUERIES[name], _SQL[name] = run, sql


def _all(table: Table):
    rb = table.new_read_builder()
    return rb.new_read(), rb.new_scan().plan().splits()


_read_back("read_arrow", lambda t: t.spark.createDataFrame((r := _all(t))[0].to_arrow(r[1])))
_read_back("read_batches", lambda t: t.spark.createDataFrame((r := _all(t))[0].to_arrow_batch_reader(r[1], 4).read_all()))
_read_back("read_batches_parallel", lambda t: t.spark.createDataFrame((r := _all(t))[0].to_arrow_batch_reader(r[1]).read_all()), **{"max-workers": "2"})
_read_back("read_pandas", lambda t: t.spark.createDataFrame((r := _all(t))[0].to_pandas(r[1]), t.schema.fields))
_read_back("read_rows", lambda t: t.spark.createDataFrame(list((r := _all(t))[0].to_iterator(r[1])), t.schema.fields))
_read_back("read_duckdb", lambda t: t.spark.createDataFrame((r := _all(t))[0].to_duckdb(r[1], "n").execute("SELECT n_name, n_regionkey FROM n WHERE n_regionkey < 3").fetchall(), "n_name string, n_regionkey int"), "SELECT n_name, n_regionkey FROM nation WHERE n_regionkey < 3")


def _by_view(table: Table) -> DataFrame:
    read, splits = _all(table)
    read.to_view(splits, "tablekit_nation")
    return table.spark.sql("SELECT n_regionkey, count(*) AS n FROM tablekit_nation GROUP BY n_regionkey")


_read_back("read_view", _by_view, "SELECT n_regionkey, CAST(count(*) AS BIGINT) AS n FROM nation GROUP BY n_regionkey")


@_query("SELECT CAST(p_size AS TINYINT) AS a, CAST(p_size AS SMALLINT) AS b, p_size AS c, p_partkey AS d, CAST(p_size AS FLOAT) AS e, p_retailprice AS f, p_name AS g, p_size > 25 AS h FROM part")
def types_whitelist(spark, sf_dir):
    df = _load(spark, sf_dir, "part").selectExpr("CAST(p_size AS TINYINT) AS a", "CAST(p_size AS SMALLINT) AS b", "p_size AS c", "p_partkey AS d", "CAST(p_size AS FLOAT) AS e", "p_retailprice AS f", "p_name AS g", "p_size > 25 AS h")
    return _put(_table(spark, arrow_schema(df.schema)), df).to_df()


@_query("SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS s, o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0.0::DOUBLE ELSE o_totalprice END AS price FROM orders WHERE o_orderstatus <> 'P' OR o_orderkey % 2 = 0")
def overwrite_null_partition(spark, sf_dir):
    df = _load(spark, sf_dir, "orders").selectExpr("nullif(o_orderstatus, 'P') AS s", "o_orderkey", "o_totalprice AS price")
    table = _put(_table(spark, df.schema, partition_keys=["s"]), df)
    new = df.filter("s IS NULL AND o_orderkey % 2 = 0").withColumn("price", F.lit(0.0))
    return _put(table, new, builder=table.new_batch_write_builder().overwrite({"s": None})).to_df()


@_query(_LATEST)
def pk_sort_engines(spark, sf_dir):
    """Whatever engine a table names, its versions are merged alike."""
    one, other = (_upserted(spark, sf_dir, ["user_id"], options={"sort-engine": e}).to_df() for e in ("min-heap", "loser-tree"))
    return one.intersect(other)


@_query(f"SELECT {_EVENT_COLUMNS}, CASE kind WHEN 0 THEN '+I' WHEN 1 THEN '-U' WHEN 3 THEN '-D' END AS _row_kind FROM (SELECT *, {_KINDS} AS kind FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)")
def pk_row_kind(spark, sf_dir):
    """The changes of one commit, deletes among them."""
    df = _events(spark, sf_dir)
    table = _table(spark, df.select("event_id", "user_id", "event_type", "value").schema, primary_keys=["user_id"], options={"bucket": "4"})
    for rows in (df.limit(0), df):
        _put(table, rows, "seq", "kind")
    return table.new_read_builder().between_snapshots(1, 2).with_row_kind().to_df()


def _two_commits(spark: SparkSession, sf_dir: str, **schema) -> Table:
    df = _events(spark, sf_dir)
    fields = df.select("event_id", "user_id", "event_type", "value").schema
    table, sequence = _table(spark, fields, **schema), "seq" if schema.get("primary_keys") else None
    for half in ("event_id % 2 = 0", "event_id % 2 = 1"):
        _put(table, df.filter(half), sequence)
    return table


@_query(f"SELECT {_EVENT_COLUMNS} FROM events WHERE event_id % 2 = 0")
def time_travel(spark, sf_dir):
    return _two_commits(spark, sf_dir).new_read_builder().at_snapshot(1).to_df()


@_query(f"SELECT {_EVENT_COLUMNS} FROM events WHERE event_id % 2 = 1")
def incremental_read(spark, sf_dir):
    return _two_commits(spark, sf_dir).new_read_builder().between_snapshots(1, 2).to_df()


_TWO = "SELECT event_id, user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id % 2 DESC, ts DESC) = 1"


@_query(_TWO)
def pk_compaction(spark, sf_dir):
    table = _two_commits(spark, sf_dir, primary_keys=["user_id"], options={"bucket": "4"})
    table.compact()
    table.expire_snapshots(1)
    return _again(table).to_df()


@_query(f"SELECT {_EVENT_COLUMNS} FROM events")
def append_compaction(spark, sf_dir):
    table = _two_commits(spark, sf_dir, partition_keys=["event_type"])
    table.compact()
    return table.to_df()


@_query(f"SELECT * FROM ({_TWO}) WHERE user_id = 7")
def pk_bucket_pruning(spark, sf_dir):
    rb = _two_commits(spark, sf_dir, primary_keys=["user_id"], options={"bucket": "4"}).new_read_builder()
    return rb.with_filter(rb.new_predicate_builder().equal("user_id", 7)).to_df()


# --- streams ------------------------------------------------------------------------------------

_EPOCH = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"


def _timed(rows: DataFrame) -> DataFrame:
    return rows.selectExpr("event_id", "user_id", "event_type", "value", f"timestamp_micros({_EPOCH}) AS time")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream over a folder, as a stream's source must be."""
    rows, folder = _load(spark, sf_dir, "events"), f"{_folder(spark)}/streams/{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    return _timed(spark.readStream.schema(rows.schema).parquet(folder))


def _drained(spark: SparkSession, stream: DataFrame, mode: str = "append") -> DataFrame:
    found = drained(stream, f"{_folder(spark)}/streams/{uuid.uuid4().hex}", mode)
    instants = [f.name for f in found.schema if isinstance(f.dataType, T.TimestampType)]
    return found.withColumns({c: F.unix_micros(c) for c in instants})


_HOURS = "SELECT event_type, epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS window_start, epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) + 3600000000 AS window_end, CAST(count(*) AS BIGINT) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL"


def _sums() -> list[Column]:
    return [F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total")]


@_query(_HOURS)
def stream_tumbling(spark, sf_dir):
    return _drained(spark, windowed(_event_stream(spark, sf_dir), "time", "1 hour", ["event_type"], _sums()), "complete")


@_query(f"SELECT * FROM ({_HOURS}) WHERE window_end <= (SELECT epoch_us(max(ts)) - 600000000 FROM events)")
def stream_watermark(spark, sf_dir):
    """Only the windows that the watermark, ten minutes behind the latest event, has closed."""
    return _drained(spark, windowed(_event_stream(spark, sf_dir), "time", "1 hour", ["event_type"], _sums(), delay="10 minutes"))


@_query("SELECT epoch_us(time_bucket(INTERVAL 30 MINUTE, ts)) - k * 1800000000 AS window_start, epoch_us(time_bucket(INTERVAL 30 MINUTE, ts)) - k * 1800000000 + 3600000000 AS window_end, CAST(count(*) AS BIGINT) AS n FROM events, (SELECT unnest([0, 1]) AS k) GROUP BY ALL")
def stream_sliding(spark, sf_dir):
    return _drained(spark, windowed(_event_stream(spark, sf_dir), "time", "1 hour", [], [F.count("*").alias("n")], "30 minutes"), "complete")


@_query("SELECT user_id, epoch_us(min(ts)) AS window_start, epoch_us(max(ts)) + 1800000000 AS window_end, CAST(count(*) AS BIGINT) AS n FROM (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s")
def stream_sessions(spark, sf_dir):
    return _drained(spark, sessions(_event_stream(spark, sf_dir), "time", "30 minutes", ["user_id"], [F.count("*").alias("n")]), "complete")


@_query("SELECT DISTINCT user_id, event_type FROM events")
def stream_distinct(spark, sf_dir):
    return _drained(spark, distinct_within(_event_stream(spark, sf_dir), "time", ["user_id", "event_type"], "1000 days").select("user_id", "event_type"))


@_query("SELECT user_id, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total FROM events GROUP BY user_id")
def stream_state(spark, sf_dir):
    return _drained(spark, running_totals(_event_stream(spark, sf_dir), "user_id", "value"), "update").withColumn("total", F.round("total", 4))


@_query("SELECT event_id, c_mktsegment FROM events JOIN customer ON user_id = c_custkey")
def stream_static_join(spark, sf_dir):
    return _drained(spark, _event_stream(spark, sf_dir).join(_load(spark, sf_dir, "customer"), F.col("user_id") == F.col("c_custkey")).select("event_id", "c_mktsegment"))


@_query("SELECT a.event_id AS a, b.event_id AS b FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 1 HOUR WHERE a.event_type = 'error' AND b.event_type = 'purchase'")
def stream_stream_join(spark, sf_dir):
    e = _event_stream(spark, sf_dir)
    a = e.filter("event_type = 'error'").select(F.col("event_id").alias("a"), F.col("user_id").alias("u"), F.col("time").alias("t")).withWatermark("t", "1 hour")
    b = e.filter("event_type = 'purchase'").select(F.col("event_id").alias("b"), F.col("user_id").alias("v"), F.col("time").alias("s")).withWatermark("s", "1 hour")
    return _drained(spark, a.join(b, F.expr("u = v AND s >= t AND s <= t + INTERVAL 1 HOUR")).select("a", "b"))


@_query(_LATEST)
def stream_upserts(spark, sf_dir):
    stream = _event_stream(spark, sf_dir).withColumn("seq", F.unix_micros("time"))
    table = _table(spark, stream.select("event_id", "user_id", "event_type", "value").schema, primary_keys=["user_id"], options={"bucket": "4"})
    write_stream(stream, table, f"{_folder(spark)}/streams/{uuid.uuid4().hex}", "seq").trigger(availableNow=True).start().awaitTermination()
    return table.to_df()


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
