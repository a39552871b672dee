"""Each operator over the driver's tables, with DuckDB SQL for the same rows.

Names follow the operators; ``AS_OF`` stands for the day that reports refer to.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import checks, claims, folds, linking, merge, multiset, nested, pick
from ..session import Scratch, table
from ..sources import sinks
from . import calendar, harvest, warehouse

AS_OF = "1998-01-01"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _big(*columns: str) -> list[Column]:
    return [F.col(c).cast("bigint").alias(c) for c in columns]


def _day(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd")


def _as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


# --- the relational layer over orders (documents), parts (products) and lines (claims, entries) --

# Document classes by order number; the seventh has none.
_CLASSES = ["kvalitetsdeklaration", "beskrivning av statistiken", "statistikens framställning", "scbdok", "metaplus", "kvalitetsdeklaration"]

_LAYER = f"""
WITH doc AS (SELECT CAST(o_orderkey AS VARCHAR) AS url, o_orderpriority AS title, ({_CLASSES!r})[o_orderkey % 7 + 1] AS doc_type, strftime(o_orderdate, '%Y') AS year FROM orders),
claim AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS url, CAST(l_partkey AS VARCHAR) AS product_code, CASE l_returnflag WHEN 'N' THEN 'harvest_candidate' WHEN 'R' THEN 'harvest_filename' ELSE 'metaplus_query' END AS origin FROM lineitem),
conf AS (SELECT * FROM claim JOIN doc USING (url) WHERE origin <> 'harvest_candidate'),
entry AS (SELECT CAST(l_partkey AS VARCHAR) AS product_code, strftime(l_shipdate, '%Y-%m-%d') AS publish_date FROM lineitem),
product AS (SELECT CAST(p_partkey AS VARCHAR) AS product_code, p_name AS name, p_size % 30 AS agency_id, p_size < 25 AS in_workbook, p_brand AS publication_status, p_type AS periodicity FROM part),
counts AS (SELECT product_code, count(DISTINCT url) AS documents, {", ".join(f"count(DISTINCT CASE WHEN doc_type = '{c}' THEN url END) AS {n}_documents" for n, c in (("kd", _CLASSES[0]), ("bas", _CLASSES[1]), ("staf", _CLASSES[2]), ("scbdok", _CLASSES[3])))},
 count(DISTINCT CASE WHEN doc_type = 'metaplus' OR origin = 'metaplus_query' THEN url END) AS metaplus_documents,
 max(CASE WHEN doc_type = '{_CLASSES[0]}' THEN year END) AS kd_latest_year, max(CASE WHEN doc_type = '{_CLASSES[2]}' THEN year END) AS staf_latest_year FROM conf GROUP BY 1)
"""


def _documents(spark, d):
    kind = F.get(F.array(*map(F.lit, _CLASSES)), (F.col("o_orderkey") % 7).cast("int"))
    return table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("url"), F.col("o_orderpriority").alias("title"), kind.alias("doc_type"), F.date_format("o_orderdate", "yyyy").alias("year"))


def _claims(spark, d):
    flag = F.col("l_returnflag")
    origin = F.when(flag == "N", warehouse.CANDIDATE).when(flag == "R", "harvest_filename").otherwise("metaplus_query")
    return table(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("url"), F.col("l_partkey").cast("string").alias("product_code"), origin.alias("origin")).distinct()


def _entries(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("product_code"), _day("l_shipdate").alias("publish_date"))


def _products(spark, d):
    null = F.lit(None).cast("string")
    return table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("product_code"), F.col("p_name").alias("name"), (F.col("p_size") % 30).alias("agency_id"), (F.col("p_size") < 25).alias("in_workbook"), F.col("p_brand").alias("publication_status"), F.col("p_type").alias("periodicity"),
        null.alias("subject_area"), null.alias("statistics_area"), F.lit(True).alias("in_calendar"), F.lit(False).alias("has_product_page"), null.alias("next_publication_date"))


def _agencies(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_nationkey").alias("agency_id"), F.col("n_name").alias("canonical_name"), F.col("r_name").alias("registry_org_nr"))


def _counts(spark, d):
    return warehouse.v_document_counts(_claims(spark, d), _documents(spark, d))


@query(_LAYER + f"""
SELECT product_code, name, n_name AS agency, in_workbook, publication_status, periodicity, CAST(NULL AS VARCHAR) AS subject_area, CAST(NULL AS VARCHAR) AS statistics_area, true AS in_calendar,
 (SELECT max(publish_date) FROM entry e WHERE e.product_code = p.product_code AND publish_date <= '{AS_OF}') AS last_publish_date,
 (SELECT min(publish_date) FROM entry e WHERE e.product_code = p.product_code AND publish_date > '{AS_OF}') AS next_publish_date, CAST(NULL AS VARCHAR) AS product_page_next_publication_date, false AS has_product_page,
 {", ".join(f"coalesce({c}, 0) AS {c}" for c in ("documents", "kd_documents", "bas_documents", "staf_documents", "scbdok_documents", "metaplus_documents"))}, kd_latest_year, staf_latest_year
FROM product p LEFT JOIN nation ON n_nationkey = agency_id LEFT JOIN counts USING (product_code)""")
def product_overview(spark, d):
    """Products with agency, document counts and the dates around the report day."""
    return warehouse.v_product_overview(_products(spark, d), _agencies(spark, d), _entries(spark, d), _counts(spark, d), F.lit(AS_OF))


@query(_LAYER + "SELECT product_code, documents, kd_documents, kd_latest_year, bas_documents, staf_documents, staf_latest_year, scbdok_documents, metaplus_documents FROM counts")
def document_counts(spark, d):
    """Distinct documents per code in all and by kind, candidates left out."""
    return _counts(spark, d)


@query(_LAYER + """
SELECT n_nationkey AS agency_id, n_name AS agency, r_name AS registry_org_nr, product_code, name, in_workbook, publication_status, (SELECT count(*) FROM entry e WHERE e.product_code = p.product_code) AS calendar_entries, coalesce(documents, 0) AS documents
FROM nation JOIN region ON r_regionkey = n_regionkey JOIN product p ON agency_id = n_nationkey LEFT JOIN counts USING (product_code)""")
def agency_products(spark, d):
    return warehouse.v_agency_products(_products(spark, d), _agencies(spark, d), _entries(spark, d), warehouse.confirmed_documents(_claims(spark, d), _documents(spark, d)))


@query(_LAYER + """,
g AS (SELECT product_code, doc_type, url, title, year, string_agg(DISTINCT origin, ',' ORDER BY origin) AS claim_origins FROM conf WHERE doc_type IS NOT NULL GROUP BY ALL)
SELECT product_code, doc_type, url, title, year, claim_origins FROM (SELECT *, row_number() OVER (PARTITION BY product_code, doc_type ORDER BY CAST(year AS INT) DESC, url) AS n FROM g) WHERE n = 1""")
def latest_with_origins(spark, d):
    return warehouse.v_document_latest(_claims(spark, d), _documents(spark, d))


@query(_LAYER + """
SELECT url, title, count(DISTINCT product_code) AS distinct_codes, string_agg(DISTINCT product_code, ',' ORDER BY product_code) AS product_codes,
 string_agg(DISTINCT product_code || ':' || origin, '; ' ORDER BY product_code || ':' || origin) AS claims FROM conf GROUP BY 1, 2 HAVING count(DISTINCT product_code) > 1""")
def code_conflicts(spark, d):
    return warehouse.v_document_code_conflicts(_claims(spark, d), _documents(spark, d))


@query(_LAYER + """
SELECT 'document_product_claim' AS table_name, 'product_code' AS column_name, 'conflicting_claim' AS issue, url AS raw_value, count(DISTINCT product_code) AS row_count FROM claim WHERE origin <> 'harvest_candidate' GROUP BY url HAVING count(DISTINCT product_code) > 1""")
def claim_issues(spark, d):
    return warehouse.claim_issues(_claims(spark, d))


# --- counts and rollups -------------------------------------------------------

@query("""
SELECT o_custkey, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses, """ + ", ".join(f"""
 count(*) FILTER (o_orderstatus = '{s}') AS n_{s.lower()}, strftime(max(o_orderdate) FILTER (o_orderstatus = '{s}'), '%Y-%m-%d') AS latest_{s.lower()},
 max_by(o_orderkey, (o_orderdate, o_orderkey)) FILTER (o_orderstatus = '{s}') AS key_{s.lower()}""" for s in "FOP") + " FROM orders GROUP BY 1")
def entity_rollup_pivot(spark, d):
    """Fixed-kind pivot: count, latest date and its key per kind in one aggregate."""
    aggs = [claims.sorted_text("o_orderstatus", ",").alias("statuses")]
    for s in "FOP":
        here = F.col("o_orderstatus") == s
        newest = F.max(F.when(here, F.struct("o_orderdate", "o_orderkey")))
        aggs += [F.count_if(here).alias(f"n_{s.lower()}"), F.date_format(newest["o_orderdate"], "yyyy-MM-dd").alias(f"latest_{s.lower()}"), newest["o_orderkey"].alias(f"key_{s.lower()}")]
    return table(spark, d, "orders").groupBy("o_custkey").agg(*aggs)


# --- choosing rows -----------------------------------------------------------

@query("""
SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
 ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders) WHERE n = 1""")
def latest_per_group(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice", "o_orderdate")
    return pick.first_wins(rows, ["o_custkey", "o_orderpriority"], [F.desc("o_orderdate"), F.asc("o_orderkey")]).drop("o_orderdate")


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1")
def first_wins_dedupe(spark, d):
    return pick.first_wins(table(spark, d, "events").select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], [F.asc("ts"), F.asc("event_id")]).drop("ts")


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def last_wins_upsert(spark, d):
    return pick.last_wins(table(spark, d, "events").select("user_id", "event_id", "event_type", "value", "ts"), ["user_id"], ["ts", "event_id"]).drop("ts")


@query("SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS occurrence, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) - 1 AS position FROM events")
def occurrence_numbering(spark, d):
    rows = pick.occurrence(table(spark, d, "events").select("event_id", "user_id", "event_type"), ["user_id", "event_type"], [F.asc("event_id")])
    return rows.withColumn("position", F.col("occurrence") - 1)


@query("""
SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY
 CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '5-LOW' THEN 1 ELSE 2 END, o_orderkey) AS n FROM orders) WHERE n = 1""")
def priority_order_pick(spark, d):
    rank = F.when(F.col("o_orderpriority") == "1-URGENT", 0).when(F.col("o_orderpriority") == "5-LOW", 1).otherwise(2)
    return pick.first_wins(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority"), ["o_custkey"], [rank, F.asc("o_orderkey")])


@query("SELECT l_orderkey, CASE WHEN count(DISTINCT l_suppkey) = 1 THEN min(l_suppkey) END AS supplier FROM lineitem GROUP BY 1")
def unique_or_null(spark, d):
    return pick.unique_or_null(table(spark, d, "lineitem").select("l_orderkey", "l_suppkey"), ["l_orderkey"], "l_suppkey", "supplier")


@query("""
WITH e AS (SELECT event_id, user_id, CASE WHEN event_type = 'purchase' THEN 'AM' || lpad(CAST(user_id % 10000 AS VARCHAR), 4, '0') WHEN event_type = 'error' THEN 'BE' || lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0') END AS code FROM events),
u AS (SELECT user_id, CASE WHEN count(DISTINCT code) = 1 THEN min(code) END AS c FROM e GROUP BY 1)
SELECT event_id, user_id, coalesce(code, c) AS code, CASE WHEN code IS NOT NULL THEN 'code' WHEN c IS NOT NULL THEN 'block' ELSE '' END AS product_match FROM e JOIN u USING (user_id)""")
def block_inherit(spark, d):
    """Rows without a code take their block's, if the block has only one."""
    pad = lambda c: F.lpad((F.col(c) % 10000).cast("string"), 4, "0")
    code = F.when(F.col("event_type") == "purchase", F.concat(F.lit("AM"), pad("user_id"))).when(F.col("event_type") == "error", F.concat(F.lit("BE"), pad("event_id")))
    rows = table(spark, d, "events").select("event_id", "user_id", code.alias("code"), code.isNotNull().alias("own"))
    out = pick.inherit_unique(rows, ["user_id"], "code")
    return out.select("event_id", "user_id", "code", F.when(F.col("own"), "code").when(F.col("code").isNotNull(), "block").otherwise("").alias("product_match"))


@query(f"""SELECT o_custkey, strftime(max(CASE WHEN o_orderdate <= TIMESTAMP '{AS_OF}' THEN o_orderdate END), '%Y-%m-%d') AS last_value,
 strftime(min(CASE WHEN o_orderdate > TIMESTAMP '{AS_OF}' THEN o_orderdate END), '%Y-%m-%d') AS next_value, count(*) AS entries FROM orders GROUP BY 1""")
def first_last_around(spark, d):
    rows = pick.first_last_around(table(spark, d, "orders").select("o_custkey", "o_orderdate"), "o_custkey", "o_orderdate", _as_of())
    return rows.select("o_custkey", _day("last_value").alias("last_value"), _day("next_value").alias("next_value"), "entries")


# --- multisets and claims ---------------------------------------------------

@query("""
WITH c AS (SELECT user_id, hour(ts) % 2 AS v, event_type, count(*) AS n FROM events GROUP BY ALL), m AS (SELECT user_id, event_type, max(n) AS n FROM c GROUP BY ALL)
SELECT user_id, event_type, unnest(range(1, n + 1)) AS copy FROM m""")
def multiset_max_union(spark, d):
    rows = table(spark, d, "events").select("user_id", (F.hour("ts") % 2).alias("v"), "event_type")
    return multiset.multiset_union(rows, ["user_id"], ["v"], ["event_type"])


@query("SELECT l_orderkey, bool_and(l_returnflag = 'N') AS candidate_only FROM lineitem GROUP BY 1")
def candidate_only(spark, d):
    return claims.all_candidates(table(spark, d, "lineitem").select("l_orderkey", "l_returnflag"), ["l_orderkey"], "l_returnflag", "N")


@query("""
WITH p AS (SELECT DISTINCT l_suppkey, o_orderpriority, l_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
g AS (SELECT l_suppkey, o_orderpriority, count(*) AS support FROM p GROUP BY ALL)
SELECT l_suppkey, o_orderpriority, support FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY support DESC, o_orderpriority) AS n FROM g) WHERE n = 1""")
def short_long_mapping(spark, d):
    l, o = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey"), table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return claims.mapping_by_support(l.join(o, l.l_orderkey == o.o_orderkey), "l_suppkey", "o_orderpriority", "l_orderkey")


# --- links ------------------------------------------------------------------

@query("""
WITH c AS (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
SELECT 'orders' AS table_name, 'o_custkey' AS column_name, 'unknown_agency' AS issue, CAST(o_custkey AS VARCHAR) AS raw_value, count(*) AS row_count
FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM c) GROUP BY o_custkey""")
def soft_link_issues(spark, d):
    dim = table(spark, d, "customer").where("c_acctbal >= 0").select("c_custkey", F.col("c_custkey").alias("id"))
    resolved = linking.resolve_soft(table(spark, d, "orders").select("o_custkey"), "o_custkey", dim, "c_custkey", "id")
    return linking.issues(resolved, "orders", "o_custkey", "unknown_agency", "ambiguous_agency")


@query("""
WITH k AS (SELECT p_partkey AS code, p_partkey - 1 AS alias_of FROM part WHERE p_size = 5)
SELECT DISTINCT b.p_partkey AS code, a.p_partkey AS alias_of FROM part a JOIN part b USING (p_brand, p_type, p_size) WHERE a.p_partkey < b.p_partkey
 AND NOT EXISTS (SELECT 1 FROM k WHERE k.code = b.p_partkey AND k.alias_of = a.p_partkey OR k.code = a.p_partkey AND k.alias_of = b.p_partkey)""")
def alias_self_join(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    known = part.where("p_size = 5").select(F.col("p_partkey").alias("code"), (F.col("p_partkey") - 1).alias("alias_of"))
    return linking.alias_pairs(part, ["p_brand", "p_type", "p_size"], "p_partkey", known)


@query("""
WITH f AS (SELECT o_custkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders WHERE o_orderstatus = 'F') WHERE n = 1),
l AS (SELECT o_custkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n FROM orders WHERE o_orderstatus = 'O') WHERE n = 1)
SELECT c_custkey, coalesce(f.o_orderpriority, l.o_orderpriority, c_mktsegment) AS name, f.o_custkey IS NOT NULL AS in_workbook, l.o_custkey IS NOT NULL AS in_calendar
FROM customer LEFT JOIN f ON f.o_custkey = c_custkey LEFT JOIN l ON l.o_custkey = c_custkey""")
def derived_n1_left_join(spark, d):
    """Precedence chain over the first row of one source and the last of another."""
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus")
    first = pick.first_wins(orders.where("o_orderstatus = 'F'"), ["o_custkey"], [F.asc("o_orderkey")]).select(F.col("o_custkey").alias("fk"), F.col("o_orderpriority").alias("fp"))
    last = pick.last_wins(orders.where("o_orderstatus = 'O'"), ["o_custkey"], ["o_orderkey"]).select(F.col("o_custkey").alias("lk"), F.col("o_orderpriority").alias("lp"))
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    rows = c.join(first, c.c_custkey == first.fk, "left").join(last, c.c_custkey == last.lk, "left")
    return rows.select("c_custkey", F.coalesce("fp", "lp", "c_mktsegment").alias("name"), F.col("fk").isNotNull().alias("in_workbook"), F.col("lk").isNotNull().alias("in_calendar"))


@query("SELECT l_partkey AS code, count(*) AS row_count FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25) AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_retailprice > 1500) GROUP BY 1")
def known_unknown_codes(spark, d):
    part = table(spark, d, "part")
    known = [part.where(c).select(F.col("p_partkey").alias("code")) for c in ("p_size < 25", "p_retailprice > 1500")]
    return linking.unknown_codes(table(spark, d, "lineitem").select(F.col("l_partkey").alias("code")), known, "code")


@query("""
SELECT code, bool_or(s = 's') AS in_supplier, bool_or(s = 'c') AS in_customer, bool_or(s = 'n') AS in_nation FROM (
 SELECT s_nationkey AS code, 's' AS s FROM supplier UNION ALL SELECT c_nationkey, 'c' FROM customer WHERE c_acctbal < 0 UNION ALL SELECT n_nationkey, 'n' FROM nation WHERE n_regionkey < 3) GROUP BY 1""")
def code_union_dimension(spark, d):
    parts = {"supplier": table(spark, d, "supplier").select(F.col("s_nationkey").alias("code")), "customer": table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_nationkey").alias("code")), "nation": table(spark, d, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("code"))}
    return linking.code_union(parts, "code")


_TOKENS = "list_distinct(list_transform(list_filter(string_split_regex(lower({0}), '[^a-z]+'), lambda x: len(x) >= 4), lambda x: x[1:6]))"


@query("""
WITH u AS (SELECT s_suppkey AS alias, s_suppkey AS id, 0 AS r FROM supplier UNION ALL SELECT CAST(s_nationkey AS BIGINT), s_suppkey, 1 FROM supplier)
SELECT alias, id AS s_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY alias ORDER BY id, r) AS n FROM u) WHERE n = 1""")
def alias_lookup(spark, d):
    """Two key columns as aliases of one row; the first row to register an alias keeps it."""
    rows = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").cast("bigint").alias("nation"))
    return linking.alias_lookup(rows, ["s_suppkey", "nation"], "s_suppkey", ["s_suppkey"])


@query("""
WITH l AS (SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))
SELECT o_orderpriority, o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS n FROM l) WHERE n = 1""")
def index_recovery(spark, d):
    """Index rows that nothing covers, one for each key."""
    covered = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return linking.recover_from_index(table(spark, d, "orders").select("o_orderpriority", "o_custkey", "o_orderkey"), covered, "o_custkey", "o_orderpriority", ["o_orderkey"])


# --- state ------------------------------------------------------------------

@query("""
WITH doc AS (SELECT DISTINCT o_custkey AS key FROM orders WHERE year(o_orderdate) = 1996), seen AS (SELECT DISTINCT o_custkey AS key FROM orders WHERE year(o_orderdate) = 1997),
fail AS (SELECT DISTINCT o_custkey AS key, 'timeout' AS error FROM orders WHERE o_orderstatus = 'P'), old AS (SELECT DISTINCT o_custkey AS key FROM orders WHERE year(o_orderdate) = 1995),
d AS (SELECT key FROM doc UNION SELECT key FROM seen UNION SELECT key FROM fail), a AS (SELECT key FROM d UNION SELECT key FROM old)
SELECT a.key, CASE WHEN doc.key IS NOT NULL AND error IS NULL THEN 'fresh' WHEN d.key IS NULL THEN 'no_longer_listed' WHEN old.key IS NOT NULL THEN 'retained' ELSE 'failed' END AS status, error
FROM a LEFT JOIN d USING (key) LEFT JOIN doc USING (key) LEFT JOIN fail USING (key) LEFT JOIN old USING (key)""")
def status_merge(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("key"), F.year("o_orderdate").alias("y"), "o_orderstatus")
    of = lambda y: orders.where(F.col("y") == y).select("key").distinct()
    failures = orders.where("o_orderstatus = 'P'").select("key").distinct().withColumn("error", F.lit("timeout"))
    return merge.status_merge(of(1996), of(1997), failures, of(1995), "key", True)


@query("""
WITH f AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1996), h AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1995)
SELECT * FROM f UNION ALL SELECT * FROM h WHERE o_custkey NOT IN (SELECT o_custkey FROM f)""")
def refresh_merge(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("y"))
    return merge.refresh_merge(orders.where("y = 1996").drop("y"), orders.where("y = 1995").drop("y"), ["o_custkey"])


@query(f"SELECT o_custkey, strftime(max(o_orderdate), '%Y-%m-%d') AS last_date, max(o_orderdate)::DATE >= DATE '{AS_OF}' - 366 AS active FROM orders GROUP BY 1")
def activity_flag(spark, d):
    rows = table(spark, d, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("m"))
    return rows.select("o_custkey", _day("m").alias("last_date"), X.is_active(F.to_date("m"), F.lit(AS_OF).cast("date")).alias("active"))


@query("""
WITH t AS (SELECT strftime(o_orderdate, '%Y-%m') AS m, count(*) AS expected FROM orders GROUP BY 1),
p AS (SELECT strftime(o_orderdate, '%Y-%m') AS m, CASE WHEN o_orderpriority = '5-LOW' AND month(o_orderdate) < 7 THEN NULL ELSE count(*) END AS n FROM orders GROUP BY ALL, o_orderpriority, month(o_orderdate)),
s AS (SELECT m, coalesce(sum(n), 0) AS r, count(*) FILTER (n IS NULL) AS b FROM p GROUP BY 1)
SELECT m AS month, expected, CAST(r AS BIGINT) AS retrieved, CAST(CASE WHEN b = 1 AND expected >= r THEN expected - r END AS BIGINT) AS inferred, expected = r AND b = 0 AS balanced FROM t JOIN s USING (m)""".replace("GROUP BY ALL, o_orderpriority, month(o_orderdate)", "GROUP BY strftime(o_orderdate, '%Y-%m'), o_orderpriority, month(o_orderdate)"))
def reconcile_totals(spark, d):
    orders = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderpriority", F.month("o_orderdate").alias("mm"))
    totals = orders.groupBy("month").agg(F.count("*").alias("expected"))
    parts = orders.groupBy("month", "o_orderpriority", "mm").agg(F.count("*").alias("c")).select("month", F.when(~((F.col("o_orderpriority") == "5-LOW") & (F.col("mm") < 7)), F.col("c")).alias("n"))
    return checks.reconcile(totals, parts, "month", "expected", "n")


@query("""
SELECT CASE WHEN l.doc_id IS NULL THEN 'unlabelled' WHEN quality = 0 THEN 'low_quality' WHEN toxic = 1 THEN 'toxic' ELSE 'ok' END AS issue, count(*) AS row_count, count(*) FILTER (lang = 'en') AS english
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""")
def issue_histogram(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left")
    issue = F.when(F.col("quality").isNull(), "unlabelled").when(F.col("quality") == 0, "low_quality").when(F.col("toxic") == 1, "toxic").otherwise("ok")
    return rows.groupBy(issue.alias("issue")).agg(F.count("*").alias("row_count"), F.count_if(F.col("lang") == "en").alias("english"))


@query("""
WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS c FROM lineitem GROUP BY ALL), r AS (
SELECT CASE WHEN c > 1 THEN 'duplicate_key' WHEN l_discount > 0.08 THEN 'discount_range' WHEN l_returnflag NOT IN ('A', 'N') THEN 'returnflag_enum' ELSE 'ok' END AS reason FROM lineitem JOIN k USING (l_orderkey, l_linenumber))
SELECT reason, count(*) AS rows FROM r GROUP BY 1""")
def quarantine_split(spark, d):
    """Every row ends up as good or as rejected with a reason."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_returnflag")
    twice = checks.check_unique(rows, ["l_orderkey", "l_linenumber"])
    rows = rows.join(twice, ["l_orderkey", "l_linenumber"], "left")
    judged = checks.rules(rows, {"duplicate_key": F.col("n").isNull(), "discount_range": F.col("l_discount") <= 0.08, "returnflag_enum": checks.enum("l_returnflag", ["A", "N"])})
    return judged.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("rows"))


# --- folds and nesting --------------------------------------------------------

@query("""
WITH g AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM events)
SELECT user_id, CAST(g AS BIGINT) AS group_no, count(*) AS n, min(event_id) AS first_event FROM g GROUP BY ALL""")
def ordered_fold_groups(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    out = folds.continuation_groups(rows, ["user_id"], [F.asc("ts"), F.asc("event_id")], F.col("event_type") == "error")
    return out.groupBy("user_id", "group_no").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query("""SELECT user_id, event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS carried FROM events""")
def carry_forward(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("carried"))
    return folds.carry_forward(rows, ["user_id"], [F.asc("ts"), F.asc("event_id")], ["carried"]).drop("ts")


@query("""SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS ordinal, o_orderstatus FROM orders""")
def nested_orders(spark, d):
    """Orders nested under customers in order, and taken apart again with ordinals."""
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    packed = nested.to_nested(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderstatus"], "orders")
    return nested.with_ordinals(packed, "orders", "o").select("o_custkey", F.col("o.o_orderkey").alias("o_orderkey"), "ordinal", F.col("o.o_orderstatus").alias("o_orderstatus"))


@query("""
SELECT o_orderkey, nullif('{' || concat_ws(',', CASE WHEN o_orderstatus <> 'P' THEN '"status":"' || o_orderstatus || '"' END, CASE WHEN o_orderkey % 3 <> 0 THEN '"customer":' || o_custkey END) || '}', '{}') AS doc FROM orders""")
def sparse_json(spark, d):
    status = nested.non_empty(F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")), "text")
    return table(spark, d, "orders").select("o_orderkey", nested.compact_json({"status": status, "customer": F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey"))}).alias("doc"))


# --- text ---------------------------------------------------------------------

_MIXED = "upper(substr(url, 1, 12)) || substr(url, 13)"


@query(f"""
WITH u AS (SELECT page_id, regexp_replace({_MIXED}, '#.*$', '') AS b FROM pages),
p AS (SELECT page_id, b, lower(regexp_extract(b, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*)([^?]*)(\\?.*)?$', 1)) AS s, lower(regexp_extract(b, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*)([^?]*)(\\?.*)?$', 2)) AS h,
 regexp_extract(b, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*)([^?]*)(\\?.*)?$', 3) AS q, regexp_extract(b, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*)([^?]*)(\\?.*)?$', 4) AS r FROM u),
c AS (SELECT page_id, s || '://' || h || CASE WHEN q = '' THEN '/' ELSE q END || CASE WHEN r = '?' THEN '' ELSE r END AS canonical FROM p)
SELECT page_id, canonical, sha256(canonical) AS url_key FROM c""")
def canonical_url(spark, d):
    mixed = F.concat(F.upper(F.substring("url", 1, 12)), F.expr("substring(url, 13)"))
    return table(spark, d, "pages").select("page_id", X.canonical_url(mixed).alias("canonical"), X.url_key(mixed).alias("url_key"))


@query(r"""
SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
 nullif(regexp_extract('&' || regexp_extract(url, '\?([^#]*)', 1), '&id=([^&]*)', 1), '') AS id,
 CASE WHEN regexp_matches(url, '(?i)\.(pdf|docx?|xlsx?|zip|odt|ods|rtf)([?#]|$)') THEN 'file' WHEN regexp_extract(url, '\?([^#]*)', 1) <> '' THEN 'query' WHEN contains(url, '#') THEN 'anchor' ELSE 'page' END AS kind FROM pages""")
def url_parts_class(spark, d):
    u = F.col("url")
    kind = F.when(u.rlike(r"(?i)\.(pdf|docx?|xlsx?|zip|odt|ods|rtf)([?#]|$)"), "file").when(X.url_query(u) != "", "query").when(u.contains("#"), "anchor").otherwise("page")
    return table(spark, d, "pages").select("page_id", X.url_host(u).alias("host"), X.url_path(u).alias("path"), X.query_param(u, "id").alias("id"), kind.alias("kind"))


@query(r"""
WITH f AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'kd_1990_' || strftime(o_orderdate, '%Y') || '.pdf' ELSE 'kd.pdf' END AS file, CASE WHEN o_orderkey % 3 < 2 THEN 'avser ' || strftime(o_orderdate, '%Y') || ' till 2030' ELSE 'utan' END AS label FROM orders)
SELECT o_orderkey, coalesce(regexp_extract_all(file, '((19|20)[0-9]{2})', 1)[-1], regexp_extract_all(label, '((19|20)[0-9]{2})', 1)[1]) AS year FROM f""")
def text_year(spark, d):
    """Last year of the file name, else first year of the label."""
    y, k = F.date_format("o_orderdate", "yyyy"), F.col("o_orderkey") % 3
    file = F.when(k == 0, F.concat(F.lit("kd_1990_"), y, F.lit(".pdf"))).otherwise("kd.pdf")
    label = F.when(k < 2, F.concat(F.lit("avser "), y, F.lit(" till 2030"))).otherwise("utan")
    return table(spark, d, "orders").select("o_orderkey", X.find_year(file, label).alias("year"))


@query(r"""
WITH s AS (SELECT p_partkey, trim(regexp_replace(lower(p_brand || ' ' || p_type), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM part)
SELECT p_partkey, slug || CASE WHEN row_number() OVER (PARTITION BY slug ORDER BY p_partkey) > 1 THEN '_' || row_number() OVER (PARTITION BY slug ORDER BY p_partkey) ELSE '' END AS slug FROM s""")
def slug_names(spark, d):
    rows = table(spark, d, "part").select("p_partkey", X.slug(F.concat_ws(" ", "p_brand", "p_type")).alias("slug"))
    rows = pick.occurrence(rows, ["slug"], [F.asc("p_partkey")], "_n")
    return rows.select("p_partkey", F.when(F.col("_n") > 1, F.concat("slug", F.lit("_"), F.col("_n").cast("string"))).otherwise(F.col("slug")).alias("slug"))


@query("""
WITH a AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM orders WHERE o_orderstatus = 'O')
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.p, b.p) AS pos, a.o_orderkey AS left_key, b.o_orderkey AS right_key FROM a FULL JOIN b ON a.o_custkey = b.o_custkey AND a.p = b.p""")
def ordinal_zip(spark, d):
    """Two lists side by side by position, neither cut to the other's length."""
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    one = lambda s, n: pick.occurrence(orders.where(F.col("o_orderstatus") == s), ["o_custkey"], [F.asc("o_orderkey")], "pos").select("o_custkey", "pos", F.col("o_orderkey").alias(n))
    return one("F", "left_key").join(one("O", "right_key"), ["o_custkey", "pos"], "full_outer")


@query("""SELECT o_orderpriority, o_orderstatus, count(*) AS n, CAST(sum(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS even_keys FROM orders GROUP BY ALL""")
def value_counts(spark, d):
    return table(spark, d, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"), F.sum(F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(0)).alias("even_keys"))


# --- HTML and folds without SQL ---------------------------------------------------

@query()
def page_links(spark, d):
    """Links of every page as absolute addresses."""
    from ..sources import html

    rows = html.explode_rows(table(spark, d, "pages").select("page_id", "url", "html"), "html", html.page_links, html.LINKS)
    return rows.select("page_id", "ordinal", X.absolute_url(F.col("url"), F.col("href")).alias("target"), "text").where("target IS NOT NULL")


@query()
def page_sections(spark, d):
    """Headings, paragraphs and link counts of every page."""
    from ..sources import html

    rows = html.explode_rows(table(spark, d, "pages").select("page_id", "html"), "html", html.sections, html.SECTIONS)
    return rows.select("page_id", "ordinal", F.array_join("heading_path", " > ").alias("heading_path"), F.size("paragraphs").cast("bigint").alias("paragraphs"), F.size("links").cast("bigint").alias("links"))


@query("""
SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'rejected' WHEN o_orderkey % 7 = 0 THEN 'rejected' ELSE 'ok' END AS state, count(*) AS n, count(DISTINCT CASE WHEN o_orderkey % 10 <> 0 AND o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END) AS days FROM orders GROUP BY 1""")
def html_rows(spark, d):
    """Calendar rows built from orders, parsed or rejected with a reason; no row is lost."""
    from ..sources import html

    day = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(F.col("o_orderkey") % 10 == 0, "x").otherwise(""))
    cell = lambda *c: F.concat(F.lit("<td>"), *c, F.lit("</td>"))
    cells = [cell(F.lit("<a href='/p/am"), F.lpad((F.col("o_custkey") % 10000).cast("string"), 4, "0"), F.lit("/'>P</a>")), cell(F.lit("period")), cell(F.lit("A<br>B")), cell(day), cell(F.lit("X, Y"))]
    last = F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(cell(F.lit("X")))
    rows = table(spark, d, "orders").select(F.concat(F.lit("<tr>"), *cells, last, F.lit("</tr>")).alias("html"))
    parsed = html.with_rows(rows, "html", html.calendar_row, html.CALENDAR_ROW)
    return parsed.groupBy(F.when(F.col("row.error").isNull(), "ok").otherwise("rejected").alias("state")).agg(F.count("*").alias("n"), F.count_distinct("row.publish_date").alias("days"))


@query("""
WITH RECURSIVE w AS (SELECT l_suppkey AS page, l_returnflag AS text, l_quantity AS x0, l_orderkey * 1.5::DOUBLE AS top FROM lineitem),
t AS (SELECT page, min(top) AS top, CAST(0 AS BIGINT) AS line_no FROM w GROUP BY page UNION ALL SELECT t.page, min(w.top), t.line_no + 1 FROM t JOIN w ON w.page = t.page AND w.top > t.top + 2 GROUP BY t.page, t.line_no)
SELECT t.page, line_no, t.top, coalesce(string_agg(text, ' ' ORDER BY x0, w.top, text) FILTER (x0 < 20), '') AS cell_0, coalesce(string_agg(text, ' ' ORDER BY x0, w.top, text) FILTER (x0 >= 20 AND x0 < 40), '') AS cell_1, coalesce(string_agg(text, ' ' ORDER BY x0, w.top, text) FILTER (x0 >= 40), '') AS cell_2
FROM t JOIN w ON w.page = t.page AND w.top BETWEEN t.top AND t.top + 2 GROUP BY ALL""")
def line_clusters(spark, d):
    """Words of a page as lines of cells, folded page by page; a supplier's rows are a page."""
    rows = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("page"), F.col("l_returnflag").alias("text"), F.col("l_quantity").alias("x0"), (F.col("l_orderkey") * 1.5).cast("double").alias("top"))
    return folds.cluster_lines(rows, ["page"], [0.0, 20.0, 40.0])


# --- library plans and expressions ---------------------------------------------------

@query("""
WITH t AS (SELECT CAST(n_nationkey AS VARCHAR) AS subject_code, n_name AS title FROM nation),
w AS (SELECT CAST(s_suppkey AS VARCHAR) AS product_code, ' ' || upper(n_name) || ' ' AS a, s_name AS area FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey)
SELECT DISTINCT product_code, subject_code, a AS subject, area, 'workbook' AS origin FROM w LEFT JOIN t ON lower(trim(a)) = lower(title)
UNION SELECT CAST(c_custkey AS VARCHAR), subject_code, title, c_mktsegment, 'subject_page' FROM customer JOIN t ON subject_code = CAST(c_nationkey AS VARCHAR)
UNION SELECT CAST(r_regionkey AS VARCHAR), subject_code, r_name, r_name, 'harvest' FROM region LEFT JOIN t ON lower(r_name) = lower(title)""")
def subject_claims_union(spark, d):
    """Three sources mapped to one schema and joined on a computed key."""
    s, c, n, r = (table(spark, d, t) for t in ("supplier", "customer", "nation", "region"))
    text = lambda c: F.col(c).cast("string")
    workbook = s.join(n, s.s_nationkey == n.n_nationkey, "left").select(text("s_suppkey").alias("product_code"), F.concat(F.lit(" "), F.upper("n_name"), F.lit(" ")).alias("subject_area"), F.col("s_name").alias("statistics_area"))
    cards = c.select(text("c_custkey").alias("product_code"), text("c_nationkey").alias("subject_code"), F.col("c_mktsegment").alias("area_label"))
    rows = r.select(text("r_regionkey").alias("product_code"), F.col("r_name").alias("subject_area"), F.col("r_name").alias("statistics_area"))
    return warehouse.subject_claims(workbook, cards, rows, n.select(text("n_nationkey").alias("subject_code"), F.col("n_name").alias("title")))


@query("""
WITH r AS (SELECT floor(c_acctbal / 5) AS k, count(*) AS n, min(c_custkey) AS c_custkey FROM customer GROUP BY 1)
SELECT s_suppkey, CASE WHEN n = 1 THEN c_custkey END AS c_custkey, CASE WHEN n IS NULL THEN 'no_match' WHEN n > 1 THEN 'ambiguous' ELSE 'matched' END AS match_state FROM supplier LEFT JOIN r ON k = floor(s_acctbal / 5)""")
def unique_match_only(spark, d):
    """Suppliers to customers of about the same balance, whole tables."""
    band = lambda c: F.floor(F.col(c) / 5).alias("band")
    left, right = table(spark, d, "supplier").select("s_suppkey", band("s_acctbal")), table(spark, d, "customer").select(band("c_acctbal"), "c_custkey")
    return linking.unique_match(left, right, "band", "c_custkey").select("s_suppkey", "c_custkey", "match_state")


_WORDS = "list_distinct(list_transform(list_filter(string_split(regexp_replace(lower({0}), '[^a-zåäö0-9]+', ' ', 'g'), ' '), lambda x: len(x) >= 4 AND NOT list_contains(" + repr(list(X.STOP_WORDS)) + ", x) AND NOT regexp_matches(x, '^[0-9]+$')), lambda x: x[1:6]))"


@query(f"""
WITH i AS (SELECT doc_id, unnest({_WORDS.format("text")}) AS t FROM documents),
r0 AS (SELECT item_id, {_WORDS.format("text")} AS ts FROM benchmark), r AS (SELECT item_id, len(ts) AS size, unnest(ts) AS t FROM r0),
p AS (SELECT doc_id, item_id, count(*) AS s, any_value(size) AS size FROM i JOIN r USING (t) GROUP BY ALL),
q AS (SELECT *, rank() OVER (PARTITION BY doc_id ORDER BY s * 1.0 / size DESC, size DESC) AS k FROM p WHERE s * 1.0 / size >= 0.5),
b AS (SELECT doc_id, CASE WHEN count(*) = 1 THEN min(item_id) END AS item_id FROM q WHERE k = 1 GROUP BY 1)
SELECT d.doc_id, b.item_id FROM documents d LEFT JOIN b USING (doc_id)""")
def token_overlap_match(spark, d):
    """Best item per document by shared word stems of whole texts, NULL on a tie."""
    items = table(spark, d, "documents").select("doc_id", X.tokens(F.col("text")).alias("t"))
    refs = table(spark, d, "benchmark").select("item_id", X.tokens(F.col("text")).alias("t"))
    scratch = Scratch(spark)
    return scratch.kept(linking.overlap_match(items, refs, [], "t", "doc_id", "item_id", 0.5, scratch.path), "matches")


@query("SELECT event_id, props->>'$.k' AS k, CAST(NULL AS VARCHAR) AS town FROM events")
def json_lift(spark, d):
    fields = F.transform(F.map_entries(F.from_json("props", "map<string,string>")), lambda e: F.struct(e["key"].alias("label"), e["value"].alias("value")))
    return table(spark, d, "events").withColumn("f", fields).select("event_id", *nested.lift_labels("f", {"k": "k", "Ort": "town"}))


@query("""
WITH s AS (SELECT p_partkey, string_split(p_brand || ', ' || p_type || ',x, , ' || p_brand, ', ') AS l FROM part), u AS (SELECT p_partkey, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM s)
SELECT p_partkey, row_number() OVER (PARTITION BY p_partkey ORDER BY i) AS ordinal, trim(x) AS publisher FROM u WHERE trim(x) <> ''""")
def split_publishers(spark, d):
    names = F.concat("p_brand", F.lit(", "), "p_type", F.lit(",x, , "), "p_brand")
    return calendar.publishers(table(spark, d, "part").select(F.col("p_partkey").alias("entry_id"), names.alias("published_at"))).select(F.col("entry_id").alias("p_partkey"), "ordinal", F.col("name").alias("publisher"))


@query(r"""
WITH f AS (SELECT p_partkey, 'am' || lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0') || '_kd_' || (2000 + p_size) || CASE WHEN p_partkey % 4 = 0 THEN '_be' || lpad(CAST(p_size AS VARCHAR), 4, '0') ELSE '' END || '.pdf' AS file FROM part),
c AS (SELECT *, list_distinct(list_transform(regexp_extract_all(file, '(^|_)([a-z]{2}[0-9]{4})', 2), lambda x: upper(x))) AS l FROM f)
SELECT p_partkey, array_to_string(list_sort(l), ',') AS codes, CASE WHEN len(l) = 1 THEN l[1] END AS code FROM c""")
def text_codes(spark, d):
    """All codes of a file name, and the code if there is only one."""
    pad = lambda c: F.lpad(c.cast("string"), 4, "0")
    size = F.col("p_size")
    file = F.concat(F.lit("am"), pad(F.col("p_partkey") % 10000), F.lit("_kd_"), (size + 2000).cast("string"), F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("_be"), pad(size))).otherwise(""), F.lit(".pdf"))
    return table(spark, d, "part").select("p_partkey", F.array_join(F.array_sort(X.codes_in(file)), ",").alias("codes"), X.find_code(F.concat(F.lit("https://x.se/files/"), file), F.lit("BE0101")).alias("code"))


_NOTICES = [
    "Ny produkt införs från och med 2024-01-01.", "Variabel tas bort, vi vill avveckla den", "Produkten är inaktiv fr.o.m. 2023-05-01", "Avslutad produkt", "Produkten upphör", "Undersökningen har en period",
    "Namnändring: produktnamn ändras, gäller fr. o. m. 2022-02-30", "Tabellerna slogs 2020 ihop; periodicitet ändras och vi planerar mer", "Ändringen gäller fr.o.m.2021-03-04 och har utökats", "Produktstatus: är officiell statistik", "ÄNDRING AV PRODUKT. Kommer att flyttas", "",
]


@query(f"""
WITH t AS (SELECT o_orderkey, lower(({_NOTICES!r})[o_orderkey % {len(_NOTICES)} + 1]) AS t FROM orders),
k AS (SELECT *, list_filter([{", ".join(f"CASE WHEN regexp_matches(t, '{p}') THEN '{name}' END" for name, p in X.CHANGES)}], lambda x: x IS NOT NULL) AS l, regexp_matches(t, '{X.PLANNED}') AS p, regexp_matches(t, '{X.EFFECTIVE}') AS e FROM t)
SELECT o_orderkey, CASE WHEN len(l) = 0 THEN 'other' ELSE array_to_string(l, ',') END AS kinds, CASE WHEN p AND e THEN 'mixed' WHEN p THEN 'planned' WHEN e THEN 'source_claimed_effective' ELSE 'unclear' END AS timing,
 CAST(try_cast(nullif(regexp_extract(t, '{X.EFFECTIVE_DAY}', 1), '') AS DATE) AS VARCHAR) AS effective FROM k""")
def kind_classifier(spark, d):
    """Kinds of a change, which may be several, a four-way state, and the day of the change."""
    t = F.get(F.array(*map(F.lit, _NOTICES)), (F.col("o_orderkey") % len(_NOTICES)).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", F.array_join(X.change_kinds(t), ",").alias("kinds"), X.timing(t).alias("timing"), X.effective_date(t).cast("string").alias("effective"))


_FILES = [("kd_am0101_2020.pdf", "Kvalitet", "kvalitetsdeklaration"), ("x.pdf", "Beskrivning av statistiken", "beskrivning av statistiken"), ("staf.pdf", "", "statistikens framställning"), ("do_2020.pdf", "", "scbdok"), ("y.pdf", "MetaPlus", "metaplus"), ("z.pdf", "Kvalitetsrapport", "kvalitetsrapport"), ("w.pdf", "Tabell", None)]


@query(f"""
SELECT p_partkey, {[k or "" for _, _, k in _FILES]!r}[p_partkey % 7 + 1] AS kind, CASE WHEN p_partkey % 7 = 6 THEN 'statistikens framställning' ELSE {[k or "" for _, _, k in _FILES]!r}[p_partkey % 7 + 1] END AS with_heading FROM part""")
def document_kinds(spark, d):
    """The class of a document by file name and text, and by its heading where these do not tell."""
    at = (F.col("p_partkey") % 7).cast("int")
    url, text = (F.get(F.array(*(F.lit(f[k]) for f in _FILES)), at) for k in (0, 1))
    url = F.concat(F.lit("https://x.se/a/"), url)
    return table(spark, d, "part").select("p_partkey", F.coalesce(X.kind(url, text), F.lit("")).alias("kind"), X.kind(url, text, F.lit("Framställning")).alias("with_heading"))


_TAILS = [".PDF", ".csv?x=1", "/contentassets/b", "/dokument/c", ".html", "?f=a.pdf", ".pptx#p", ".zip", "#x.pdf", ""]


@query(rf"""
WITH u AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') || ({_TAILS!r})[page_id % 10 + 1] AS url FROM pages),
p AS (SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)) AS path, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS host FROM u)
SELECT page_id, regexp_matches(path, '\.(pdf|docx?|xlsx?|csv|zip|txt|pptx?)$') OR contains(path, '/contentassets/') OR host = 'metadata.scb.se' AS document FROM p""")
def document_urls(spark, d):
    tail = F.get(F.array(*map(F.lit, _TAILS)), (F.col("page_id") % 10).cast("int"))
    return table(spark, d, "pages").select("page_id", X.is_document_url(F.concat(F.regexp_replace("url", r"[?#].*$", ""), tail)).alias("document"))


@query(r"""
WITH s AS (SELECT s_suppkey AS id, CASE s_suppkey % 3 WHEN 0 THEN 'Statistikansvarig myndighet:  ' ELSE '  ' END || upper(s_name) || '  X' || CASE WHEN s_suppkey % 2 = 0 THEN ' (ABC)' ELSE ' (en alltför lång förkortning)' END AS n FROM supplier)
SELECT id, trim(regexp_replace(regexp_replace(lower(regexp_replace(n, '\s*\([^()]{1,15}\)\s*$', '')), '^\s*statistikansvarig\s+myndighet\s*:\s*', ''), '\s+', ' ', 'g')) AS norm, nullif(regexp_extract(n, '\(([^()]{1,15})\)\s*$', 1), '') AS abbreviation FROM s""")
def norm_names(spark, d):
    name = F.concat(F.when(F.col("s_suppkey") % 3 == 0, "Statistikansvarig myndighet:  ").otherwise("  "), F.upper("s_name"), F.lit("  X"), F.when(F.col("s_suppkey") % 2 == 0, " (ABC)").otherwise(" (en alltför lång förkortning)"))
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), X.norm_agency(name).alias("norm"), X.abbreviation(name).alias("abbreviation"))


@query("""
SELECT count(*) AS documents, count(*) FILTER (value < 10) AS review_candidates, count(*) FILTER (event_type LIKE 'c%') AS scb, count(*) FILTER (event_type LIKE 'p%') AS siris, count(*) FILTER (event_type NOT LIKE 'c%' AND event_type NOT LIKE 'p%') AS sam, (SELECT count(*) FROM part) AS products FROM events""")
def parse_metrics(spark, d):
    kind = F.col("event_type")
    source = F.concat(F.when(kind.startswith("c"), "scb").when(kind.startswith("p"), "siris").otherwise("sam/"), kind)
    return harvest.metrics(table(spark, d, "events").select((F.col("value") < 10).alias("review_required"), source.alias("source")), table(spark, d, "part"))


@query("""
SELECT 'table' AS part, 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'table', 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'table', 'pages', count(*) FROM pages
UNION ALL SELECT 'issue', o_orderpriority, count(*) FROM orders GROUP BY 2""")
def build_report(spark, d):
    """Row count of each table and the histogram of issues, as the report file has them."""
    issues = table(spark, d, "orders").select(F.col("o_orderpriority").alias("issue"))
    report = sinks.table_report({name: table(spark, d, name) for name in ("orders", "lineitem", "pages")}, issues)
    rows = [("table", k, n) for k, n in report["tables"].items()] + [("issue", k, n) for k, n in report["issues"].items()]
    return spark.createDataFrame(rows, "part string, name string, n bigint")


@query("""
WITH e AS (SELECT *, '[' || concat_ws(', ', to_json(strftime(DATE '2020-01-01' + p_size, '%Y-%m-%d')), CASE WHEN p_size % 3 = 0 THEN 'null' ELSE to_json('AM01' || lpad(CAST(p_size AS VARCHAR), 2, '0')) END, to_json(p_type || CASE WHEN p_partkey % 2 = 0 THEN '-x "y"' ELSE '' END),
 'null', to_json(p_brand), '[' || to_json(p_brand) || ', "Tabell"]', to_json(p_name), 'null', to_json('/p/' || p_partkey)) || ']' AS k FROM part)
SELECT p_partkey, row_number() OVER (ORDER BY k) AS entry_id, 1 AS occurrence FROM e""")
def calendar_numbers(spark, d):
    """Entries numbered in file order: by the JSON text of all fields."""
    null = F.lit(None).cast("string")
    rows = table(spark, d, "part").select(
        F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), F.col("p_size")), "yyyy-MM-dd").alias("publish_date"), F.when(F.col("p_size") % 3 != 0, F.concat(F.lit("AM01"), F.lpad(F.col("p_size").cast("string"), 2, "0"))).alias("product_code"),
        F.concat("p_type", F.when(F.col("p_partkey") % 2 == 0, '-x "y"').otherwise("")).alias("product_name"), null.alias("reporting_round"), F.col("p_brand").alias("reference_period"), F.array("p_brand", F.lit("Tabell")).alias("forms"), F.col("p_name").alias("published_at"), null.alias("responsible_agency"), F.concat(F.lit("/p/"), "p_partkey").alias("product_url"))
    scratch = Scratch(spark)
    return scratch.kept(calendar.numbered(rows, scratch.path).select(F.substring("product_url", 4, 20).cast("bigint").alias("p_partkey"), "entry_id", "occurrence"), "numbers")


@query("""
WITH r AS (SELECT strftime(o_orderdate, '%Y') AS y, o_orderpriority AS h, o_orderstatus AS v, count(*) AS n FROM orders GROUP BY ALL), m AS (SELECT y, h, max(n) AS n FROM r GROUP BY ALL)
SELECT y AS "from", y AS "to", CAST(1000 AS BIGINT) AS expected, CAST(sum(n) AS BIGINT) AS retrieved FROM m GROUP BY y HAVING sum(n) <> 1000""")
def calendar_gaps(spark, d):
    """Ranges whose stated total differs from their merged rows; three listings of each year."""
    year = F.date_format("o_orderdate", "yyyy")
    pages = table(spark, d, "orders").groupBy(year.alias("from"), year.alias("to"), (F.col("o_orderstatus") == "F").alias("newest_first"), F.ascii("o_orderstatus").alias("form")).agg(F.collect_list("o_orderpriority").alias("rows")).withColumn("total", F.lit(1000).cast("bigint"))
    return calendar.gaps(pages)


@query("""
WITH s AS (SELECT DISTINCT CASE o_orderkey % 6 WHEN 0 THEN 'scb' WHEN 1 THEN 'siris' WHEN 2 THEN 'sam/A' WHEN 3 THEN 'sam/B' WHEN 4 THEN 'sam/C' ELSE 'other' END AS source FROM orders)
SELECT source, CASE WHEN source IN ('siris', 'sam/C', 'other', 'sam/B') THEN 'retained' ELSE 'fresh' END AS status FROM s""")
def source_states(spark, d):
    """Whether a source's rows are of this run: failed, not attempted and not selected ones are retained."""
    k = F.col("o_orderkey") % 6
    source = F.when(k == 0, "scb").when(k == 1, "siris").when(k == 2, "sam/A").when(k == 3, "sam/B").when(k == 4, "sam/C").otherwise("other")
    state = {"last_failures": ["siris", "sam/C"], "attempted_sources": ["scb", "siris", "sam"], "selected_agencies": ["A", "C"]}
    return table(spark, d, "orders").select(source.alias("source")).distinct().select("source", X.source_status(F.col("source"), state).alias("status"))
