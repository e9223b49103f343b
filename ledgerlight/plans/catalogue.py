"""All queries of this library over the driver tables, each with the SQL that it is held against where SQL can say it.

Doubles are rounded to 6 places and orders are total. Tables stand in for rolls: parts for names, customers for records.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlight.functions import devanagari, normalize, scorers
from ledgerlight.operators import audit, build, evaluate, layout, search, sequences
from ledgerlight.operators.distinctmap import fill_latin, map_distinct
from ledgerlight.sources import parts as part_ids
from ledgerlight.sources.rolls import DelimitedSource, GlyphPartSource, RuledPartSource

from .legacy_words import PAIRS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _long(name: str):
    return F.count("*").cast("long").alias(name)


# search and verification -------------------------------------------------------------------------------------------

_BRANDS = ["Brand#11", "Brand#12", "Brand#21", "Brand#32", "Brand#43"]
_IN = ", ".join(f"'{b}'" for b in _BRANDS)


@query(f"""
SELECT p_partkey, p_name, p_brand, round(100 * jaro_winkler_similarity('red plate', lower(p_name)), 6) AS score
FROM part WHERE p_brand IN ({_IN}) AND p_size BETWEEN 10 AND 40
QUALIFY score >= 70 AND row_number() OVER (ORDER BY 100 * jaro_winkler_similarity('red plate', lower(p_name)) DESC, p_partkey) <= 20""")
def search_jw_topk(spark, sf_dir):
    rows = _read(spark, sf_dir, "part").where(search.one_of(F.col("p_brand"), _BRANDS) & search.about(F.col("p_size"), 25, 15))
    hits = search.top_scored(rows.select("p_partkey", "p_name", "p_brand"), ["Red Plate"], ["p_name"], "p_partkey", "jaro_winkler")
    return hits.withColumn("score", F.round("score", 6))


@query("""
WITH s AS (SELECT p_partkey, (jaro_winkler_similarity('green pin', lower(p_name)) + jaro_winkler_similarity('small', lower(p_type))) * 50 AS score FROM part)
SELECT p_partkey, round(score, 6) AS score FROM s QUALIFY score >= 60 AND row_number() OVER (ORDER BY round(score, 9) DESC, p_partkey) <= 25""")
def search_two_field_mean(spark, sf_dir):
    rows = _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    scored = rows.withColumn("score", F.round(scorers.mean_score(["green pin", "small"], [F.col("p_name"), F.col("p_type")], "jaro_winkler"), 9))
    best = scored.orderBy(F.desc("score"), "p_partkey").limit(25).where("score >= 60")
    return best.select("p_partkey", F.round("score", 6).alias("score"))


@query()
def search_wratio_topk(spark, sf_dir):
    rows = _read(spark, sf_dir, "part").select("p_partkey", "p_name")
    return search.top_scored(rows, ["plate red"], ["p_name"], "p_partkey").withColumn("score", F.round("score", 6))


@query()
def search_wratio_all(spark, sf_dir):
    """Composite score of every name; held against the scalar definition in the tests."""
    rows = _read(spark, sf_dir, "part").select("p_partkey", "p_name")
    return rows.withColumn("score", F.round(scorers.score(F.col("p_name"), "Red Plate"), 6))


@query("""
SELECT o_orderkey, o_orderstatus, round(100.0 * 2 * (CASE WHEN contains('of', lower(o_orderstatus)) THEN 1 ELSE 0 END) / 3, 6)::DOUBLE AS score FROM orders""")
def short_candidate_branch(spark, sf_dir):
    """One-letter values are scored by plain ratio, not as abbreviations that the query contains."""
    rows = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return rows.withColumn("score", F.round(scorers.score(F.col("o_orderstatus"), "of"), 6))


_Q = "blue ring"
@query(f"""
WITH RECURSIVE names AS (SELECT DISTINCT lower(p_name) AS name FROM part),
steps(name, i, best) AS (
  SELECT name, 0, list_transform(range(0, {len(_Q) + 1}), lambda x: 0) FROM names
  UNION ALL
  SELECT name, i + 1, list_reduce(list_transform(range(1, {len(_Q) + 1}), lambda j: [j::INTEGER]), lambda acc, x: list_append(acc, greatest(
      acc[x[1]], best[x[1] + 1], CASE WHEN substr('{_Q}', x[1], 1) = substr(name, i + 1, 1) THEN best[x[1]] + 1 ELSE 0 END)::INTEGER), [0::INTEGER])
  FROM steps WHERE i < length(name)),
done AS (SELECT name, best[{len(_Q) + 1}] AS lcs FROM steps WHERE i = length(name))
SELECT p_partkey, round(200.0 * lcs / (length(name) + {len(_Q)}), 6) AS score FROM part JOIN done ON lower(p_name) = name""")  # fmt: skip
def indel_ratio(spark, sf_dir):
    rows = _read(spark, sf_dir, "part")
    return rows.select("p_partkey", F.round(scorers.score(F.col("p_name"), _Q, "ratio"), 6).alias("score"))


@query("""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey = 0 AND c_acctbal BETWEEN 500 AND 6500""")
def filter_in_between(spark, sf_dir):
    rows = _read(spark, sf_dir, "customer")
    wanted = search.one_of(F.col("c_mktsegment"), ["BUILDING", "MACHINERY"]) & (F.col("c_nationkey") == 0) & search.about(F.col("c_acctbal"), 3500, 3000)
    return rows.where(wanted).select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("""
WITH one AS (SELECT * FROM customer WHERE c_custkey = (SELECT min(c_custkey) + 6 FROM customer)),
same AS (
  SELECT c.c_custkey, c.c_name, c.c_acctbal, 100 * jaro_winkler_similarity(lower(replace(o.c_name, '#', ' ')), lower(replace(c.c_name, '#', ' '))) AS score
  FROM customer c JOIN one o ON c.c_mktsegment = o.c_mktsegment AND c.c_acctbal BETWEEN o.c_acctbal - 1500 AND o.c_acctbal + 1500 AND c.c_custkey <> o.c_custkey)
SELECT c_custkey, c_name, c_acctbal, round(score, 6) AS score FROM same
QUALIFY score >= 60 AND row_number() OVER (ORDER BY round(score, 9) DESC, c_custkey) <= 10""")
def verify_one_record(spark, sf_dir):
    """One record's best matches by name among those of its segment and balance band."""
    rows = _read(spark, sf_dir, "customer")
    key = rows.agg(F.min("c_custkey")).first()[0] + 6
    one = rows.where(F.col("c_custkey") == key).first()
    same = rows.where((F.col("c_mktsegment") == one.c_mktsegment) & search.about(F.col("c_acctbal"), one.c_acctbal, 1500) & (F.col("c_custkey") != key))
    scored = same.select("c_custkey", "c_name", "c_acctbal", F.round(scorers.score(F.col("c_name"), one.c_name, "jaro_winkler"), 9).alias("score"))
    best = scored.orderBy(F.desc("score"), "c_custkey").limit(10).where(F.col("score") >= search.VERIFY_MIN_SCORE)
    return best.withColumn("score", F.round("score", 6))


# normalisation -----------------------------------------------------------------------------------------------------

_SEGMENTS = {"BUILDING": "B", "MACHINERY": "M", "HOUSEHOLD": "H"}


@query("""
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' WHEN 'HOUSEHOLD' THEN 'H' ELSE c_mktsegment END AS code,
       CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN '' ELSE 'unrecognized segment: ''' || c_mktsegment || '''' END AS remark
FROM customer""")
def normalize_map_remark(spark, sf_dir):
    code, remark = normalize.lookup(F.col("c_mktsegment"), _SEGMENTS, "segment")
    return _read(spark, sf_dir, "customer").select("c_custkey", code.alias("code"), normalize.remarks(remark).alias("remark"))


@query("""
WITH p AS (SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS head, split_part(o_orderpriority, '-', 2) AS tail FROM orders)
SELECT o_orderkey, CASE WHEN regexp_matches(trim(head), '^[+-]?[0-9]+$') THEN trim(head)::INTEGER END AS head_no,
       CASE WHEN regexp_matches(trim(tail), '^[+-]?[0-9]+$') THEN trim(tail)::INTEGER END AS tail_no,
       concat_ws('; ', CASE WHEN trim(head) <> '' AND NOT regexp_matches(trim(head), '^[+-]?[0-9]+$') THEN 'non-numeric head: ''' || trim(head) || '''' END,
                 CASE WHEN trim(tail) <> '' AND NOT regexp_matches(trim(tail), '^[+-]?[0-9]+$') THEN 'non-numeric tail: ''' || trim(tail) || '''' END) AS remark
FROM p""")
def safe_int_remark(spark, sf_dir):
    rows = _read(spark, sf_dir, "orders").select("o_orderkey", F.split("o_orderpriority", "-").alias("p"))
    (head, r1), (tail, r2) = (normalize.integer(F.coalesce(F.get("p", i), F.lit("")), name) for i, name in ((0, "head"), (1, "tail")))
    return rows.select("o_orderkey", head.alias("head_no"), tail.alias("tail_no"), normalize.remarks(r1, r2).alias("remark"))


@query("""
SELECT c.c_custkey, coalesce(nullif(n.n_name, ''), c.c_mktsegment, '') AS place, (n.n_nationkey IS NOT NULL) AS known
FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) n ON n.n_nationkey = c.c_nationkey""")
def authority_override_join(spark, sf_dir):
    meta = _read(spark, sf_dir, "nation").where("n_regionkey < 3")
    rows = _read(spark, sf_dir, "customer").join(meta, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.select("c_custkey", normalize.authority(F.col("n_name"), F.col("c_mktsegment")).alias("place"), F.col("n_nationkey").isNotNull().alias("known"))


@query("""
WITH side AS (SELECT p_partkey, arg_max(p_name, p_size) AS url FROM part WHERE p_size > 25 GROUP BY p_partkey)
SELECT l.l_orderkey, l.l_linenumber, coalesce(s.url, '') AS url FROM lineitem l LEFT JOIN side s ON s.p_partkey = l.l_partkey""")
def side_table_default(spark, sf_dir):
    side = _read(spark, sf_dir, "part").where("p_size > 25").groupBy("p_partkey").agg(F.max_by("p_name", "p_size").alias("url"))
    rows = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return rows.join(side, F.col("l_partkey") == F.col("p_partkey"), "left").select("l_orderkey", "l_linenumber", F.coalesce("url", F.lit("")).alias("url"))


@query("SELECT p_partkey, upper(p_type) || ':' || length(p_type) AS mapped FROM part")
def distinct_map_join(spark, sf_dir):
    rows = _read(spark, sf_dir, "part").select("p_partkey", "p_type")
    out = map_distinct(rows, {"p_type": "mapped"}, lambda v: F.concat(F.upper(v), F.lit(":"), F.length(v).cast("string")))
    return out.select("p_partkey", "mapped")


# build and catalogues ----------------------------------------------------------------------------------------------


@query("""
WITH files AS (SELECT n.n_nationkey, n.n_regionkey, max(CASE WHEN s.s_acctbal > 5000 THEN 1 ELSE 0 END) AS has FROM nation n JOIN supplier s ON s.s_nationkey = n.n_nationkey GROUP BY ALL),
per AS (SELECT n_regionkey, count(*) AS digitized, sum(has) AS w FROM files GROUP BY ALL),
tot AS (SELECT n_regionkey, count(*) AS total FROM nation GROUP BY ALL)
SELECT t.n_regionkey, t.total::BIGINT AS total, coalesce(digitized, 0)::BIGINT AS digitized,
       CASE WHEN coalesce(w, 0) = 0 THEN 'none' WHEN w = digitized THEN 'full' ELSE 'partial' END AS locality_coverage
FROM tot t LEFT JOIN per USING (n_regionkey)""")
def coverage_status(spark, sf_dir):
    nation = _read(spark, sf_dir, "nation")
    rows = _read(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    rows = rows.select("n_nationkey", "n_regionkey", F.when(F.col("s_acctbal") > 5000, "x").otherwise("").alias("locality"))
    index = build.area_index(rows, rows, ["n_regionkey", "n_nationkey"])
    return build.coverage(index, "n_regionkey", nation.groupBy("n_regionkey").agg(_long("total")))


@query("""
SELECT c_nationkey, c_mktsegment, count(*)::BIGINT AS row_count, max(CASE WHEN c_acctbal > 9000 THEN 1 ELSE 0 END)::INTEGER AS has_locality
FROM customer GROUP BY ALL""")
def ac_index(spark, sf_dir):
    rows = _read(spark, sf_dir, "customer").withColumn("locality", F.when(F.col("c_acctbal") > 9000, F.col("c_name")).otherwise(""))
    return build.area_index(rows, rows, ["c_nationkey", "c_mktsegment"])


@query("SELECT DISTINCT p_brand, p_type FROM part WHERE p_type <> ''")
def catalog_distinct(spark, sf_dir):
    return build.locality_catalog(_read(spark, sf_dir, "part"), ["p_brand"], "p_type")


@query("""
WITH top AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL ORDER BY n DESC, l_suppkey, l_returnflag LIMIT 5)
SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag FROM lineitem SEMI JOIN top USING (l_suppkey, l_returnflag)""")
def largest_groups_semi(spark, sf_dir):
    rows = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")
    keys = ["l_suppkey", "l_returnflag"]
    return build.only_groups(rows, build.largest_groups(rows, keys, 5), keys).select("l_orderkey", "l_linenumber", *keys)


@query("""
SELECT n_nationkey, n_name FROM nation WHERE (n_regionkey = 0 AND n_nationkey = 0) OR (n_regionkey = 1 AND n_nationkey = 1) OR (n_regionkey = 2 AND n_nationkey = 7)""")
def pair_filter(spark, sf_dir):
    rows = _read(spark, sf_dir, "nation")
    return rows.where(search.pairs_filter(F.col("n_regionkey"), F.col("n_nationkey"), [(0, 0), (1, 1), (2, 7)])).select("n_nationkey", "n_name")


@query("SELECT count(*)::BIGINT AS n, count(DISTINCT c_nationkey)::BIGINT AS areas, sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END)::BIGINT AS building FROM customer")
def global_counts(spark, sf_dir):
    rows = _read(spark, sf_dir, "customer")
    return rows.agg(_long("n"), F.count_distinct("c_nationkey").cast("long").alias("areas"), F.count_if(F.col("c_mktsegment") == "BUILDING").cast("long").alias("building"))


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, row_number() OVER (ORDER BY o_orderpriority, o_orderkey)::BIGINT AS id FROM orders""")
def row_ordinal(spark, sf_dir):
    rows = _read(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return sequences.ordinal(rows, ["o_orderpriority", "o_orderkey"]).drop("o_orderpriority")


@query("""
SELECT 'nation' AS kind, n_nationkey::BIGINT AS key, n_name AS name FROM nation UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier
UNION ALL SELECT 'customer', c_custkey, c_name FROM customer""")
def union_states(spark, sf_dir):
    part = lambda t, k, n: _read(spark, sf_dir, t).select(F.lit(t).alias("kind"), F.col(k).cast("long").alias("key"), F.col(n).alias("name"))
    tables = {"nation": part("nation", "n_nationkey", "n_name"), "supplier": part("supplier", "s_suppkey", "s_name"), "customer": part("customer", "c_custkey", "c_name")}
    return build.union_states(tables, ["nation", "supplier", "customer"])


@query("SELECT n_nationkey FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000)")
def set_difference_unknown(spark, sf_dir):
    used = _read(spark, sf_dir, "supplier").where("s_acctbal > 8000").select(F.col("s_nationkey").alias("n_nationkey"))
    return _read(spark, sf_dir, "nation").select("n_nationkey").join(used, "n_nationkey", "left_anti")


# audit -------------------------------------------------------------------------------------------------------------

_KINDS = """
  SELECT l_orderkey, l_linenumber, unnest(list_filter([
    CASE WHEN l_quantity > 45 THEN 'large_quantity' END, CASE WHEN l_discount = 0 THEN 'no_discount' END,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'odd_status' END, CASE WHEN l_tax > 0.07 THEN 'high_tax' END], lambda x: x IS NOT NULL)) AS kind
  FROM lineitem"""


def _kinds(spark, sf_dir):
    rows = _read(spark, sf_dir, "lineitem")
    odd = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    found = F.array(F.when(F.col("l_quantity") > 45, "large_quantity"), F.when(F.col("l_discount") == 0, "no_discount"), F.when(odd, "odd_status"), F.when(F.col("l_tax") > 0.07, "high_tax"))
    return rows.select("l_orderkey", "l_linenumber", F.filter(found, lambda k: k.isNotNull()).alias("kinds"))


@query(f"SELECT kind, count(*)::BIGINT AS n FROM ({_KINDS}) GROUP BY kind")
def audit_kinds(spark, sf_dir):
    return audit.kind_counts(_kinds(spark, sf_dir))


@query(f"SELECT kind, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY kind ORDER BY l_orderkey, l_linenumber) AS place FROM ({_KINDS}) QUALIFY place <= 8")
def audit_samples(spark, sf_dir):
    return audit.samples(_kinds(spark, sf_dir), ["l_orderkey", "l_linenumber"], [])


@query("""
WITH c AS (SELECT source AS file, lang AS value, count(*) AS n FROM documents GROUP BY ALL)
SELECT file, count(*)::BIGINT AS n_values, string_agg(value || '=' || n, ',' ORDER BY value) AS histogram FROM c GROUP BY file HAVING count(*) > 1""")
def audit_multivalue(spark, sf_dir):
    counts = audit.value_counts(_read(spark, sf_dir, "documents").select("source", "lang"), "source", {"lang": F.col("lang")})
    found = audit.many_valued(counts, "lang")
    entries = F.transform(F.map_entries("values"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return found.select("file", F.size("values").cast("long").alias("n_values"), F.array_join(entries, ",").alias("histogram"))


# layout and sequences ----------------------------------------------------------------------------------------------


@query("""
WITH e AS (SELECT user_id, epoch_us(ts) / 1e6 AS t FROM events),
f AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) > 3600 THEN 1 ELSE 0 END AS s FROM e),
g AS (SELECT user_id, t, sum(s) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS island FROM f)
SELECT user_id, island::BIGINT AS island, count(*)::BIGINT AS n, round(min(t), 3) AS first_t, round(max(t), 3) AS last_t FROM g GROUP BY ALL""")
def cluster_chained(spark, sf_dir):
    rows = _read(spark, sf_dir, "events").select("user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"))
    got = sequences.islands(rows, ["user_id"], "t", 3600.0)
    return got.groupBy("user_id", "island").agg(_long("n"), F.round(F.min("t"), 3).alias("first_t"), F.round(F.max("t"), 3).alias("last_t"))


@query("""
WITH RECURSIVE v AS (SELECT s_nationkey AS g, s_acctbal AS x, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS k FROM supplier),
c AS (SELECT g, x, k, x AS anchor, 1 AS cluster FROM v WHERE k = 1
      UNION ALL SELECT v.g, v.x, v.k, CASE WHEN v.x - c.anchor <= 900 THEN c.anchor ELSE v.x END, CASE WHEN v.x - c.anchor <= 900 THEN c.cluster ELSE c.cluster + 1 END
      FROM c JOIN v ON v.g = c.g AND v.k = c.k + 1)
SELECT g AS s_nationkey, cluster::INTEGER AS cluster, count(*)::BIGINT AS n, round(min(x), 6) AS anchor FROM c GROUP BY ALL""")
def cluster_anchored(spark, sf_dir):
    rows = _read(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list("s_acctbal")).alias("xs"))
    got = rows.select("s_nationkey", F.posexplode(sequences.anchored(F.col("xs"), 900.0)).alias("cluster", "members"))
    return got.select("s_nationkey", (F.col("cluster") + 1).alias("cluster"), F.size("members").cast("long").alias("n"), F.round(F.get("members", 0), 6).alias("anchor"))


@query("""
WITH p AS (SELECT user_id, ts, max(event_id) AS purchase FROM events WHERE event_type = 'purchase' GROUP BY ALL)
SELECT e.event_id, p.purchase FROM events e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts >= p.ts""")
def asof_latest(spark, sf_dir):
    events = _read(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    bought = events.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("event_id").alias("purchase"))
    return sequences.asof_latest(events.select("event_id", "user_id", "ts"), bought, "user_id", "ts", "purchase", "purchase").select("event_id", "purchase")


_RULES = [0.0, 12.5, 25.0, 40.0, 60.0]


@query(f"""
WITH r AS (SELECT {_RULES}::DOUBLE[] AS rules)
SELECT l_orderkey, l_linenumber, list_max(list_filter(rules, lambda x: x <= l_quantity)) AS lo, list_min(list_filter(rules, lambda x: x > l_quantity)) AS hi
FROM lineitem, r WHERE list_max(list_filter(rules, lambda x: x <= l_quantity)) IS NOT NULL AND list_min(list_filter(rules, lambda x: x > l_quantity)) IS NOT NULL""")
def asof_bounds(spark, sf_dir):
    rows = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    found = sequences.surrounding(F.array(*[F.lit(x) for x in _RULES]), F.col("l_quantity"))
    return rows.withColumn("s", found).where("s IS NOT NULL").select("l_orderkey", "l_linenumber", "s.lo", "s.hi")


_BOUNDS = [1000.0, 10000.0, 30000.0, 60000.0]


@query("""
SELECT (CASE WHEN l_extendedprice < 1000 THEN 0 WHEN l_extendedprice < 10000 THEN 1 WHEN l_extendedprice < 30000 THEN 2 WHEN l_extendedprice < 60000 THEN 3 ELSE 4 END)::INTEGER AS bucket,
       count(*)::BIGINT AS n, round(min(l_extendedprice), 6) AS lo, round(max(l_extendedprice), 6) AS hi FROM lineitem GROUP BY 1""")
def range_bucket(spark, sf_dir):
    rows = _read(spark, sf_dir, "lineitem").select(sequences.bucket(F.col("l_extendedprice"), _BOUNDS).alias("bucket"), "l_extendedprice")
    return rows.groupBy("bucket").agg(_long("n"), F.round(F.min("l_extendedprice"), 6).alias("lo"), F.round(F.max("l_extendedprice"), 6).alias("hi"))


@query("""
SELECT p_partkey, (CASE WHEN p_size >= 5 AND p_size < 20 THEN 0 WHEN p_size >= 15 AND p_size < 30 THEN 1 WHEN p_size >= 30 AND p_size < 45 THEN 2 END)::INTEGER AS place FROM part""")
def range_first_match(spark, sf_dir):
    ranges = F.array(*[F.struct(F.lit(a).alias("lo"), F.lit(b).alias("hi")) for a, b in ((5, 20), (15, 30), (30, 45))])
    return _read(spark, sf_dir, "part").select("p_partkey", sequences.first_range(F.col("p_size"), ranges).alias("place"))


@query("""
SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_bought
FROM events""")
def ffill_last_value(spark, sf_dir):
    rows = _read(spark, sf_dir, "events").withColumn("bought", F.when(F.col("event_type") == "purchase", F.col("value")))
    return sequences.fill_forward(rows, ["user_id"], ["ts", "event_id"], "bought", "last_bought").select("event_id", "last_bought")


@query("""
WITH f AS (SELECT user_id, arg_min(value, (epoch_us(ts), event_id)) AS first_bought FROM events WHERE event_type = 'purchase' AND value IS NOT NULL GROUP BY user_id)
SELECT e.event_id, f.first_bought FROM events e LEFT JOIN f USING (user_id)""")
def first_value_broadcast(spark, sf_dir):
    rows = _read(spark, sf_dir, "events").withColumn("bought", F.when(F.col("event_type") == "purchase", F.col("value")))
    return sequences.first_known(rows, ["user_id"], ["ts", "event_id"], "bought", "first_bought").select("event_id", "first_bought")


@query("""
WITH g AS (SELECT user_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events),
l AS (SELECT user_id, list_sort(list(gap)) AS gaps FROM g WHERE gap IS NOT NULL GROUP BY user_id)
SELECT user_id, (gaps[len(gaps) // 2 + 1] / 1e6)::DOUBLE AS upper_median FROM l""")
def upper_median_gap(spark, sf_dir):
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gaps = _read(spark, sf_dir, "events").select("user_id", ((F.unix_micros(F.col("ts").cast("timestamp")) - F.lag(F.unix_micros(F.col("ts").cast("timestamp"))).over(order)) / 1e6).alias("gap")).where("gap IS NOT NULL")
    return gaps.groupBy("user_id").agg(F.collect_list("gap").alias("gaps")).select("user_id", sequences.upper_median(F.col("gaps")).alias("upper_median"))


@query("""
WITH s AS (SELECT s_nationkey, (s_acctbal / 100)::INTEGER AS lo, (s_acctbal / 100)::INTEGER + 4 AS hi FROM supplier),
xs AS (SELECT DISTINCT s_nationkey, unnest(range(0, 101)) AS x FROM supplier),
o AS (SELECT xs.s_nationkey, xs.x, count(s.lo) AS n FROM xs LEFT JOIN s ON s.s_nationkey = xs.s_nationkey AND xs.x BETWEEN s.lo AND s.hi GROUP BY ALL),
r AS (SELECT *, sum(CASE WHEN n > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY s_nationkey ORDER BY x) AS ink, sum(CASE WHEN n > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY s_nationkey) AS al FROM o),
b AS (SELECT s_nationkey, ink, min(x) AS a, max(x) + 1 AS b FROM r WHERE n = 0 AND ink > 0 AND ink < al GROUP BY ALL),
best AS (SELECT s_nationkey, (a + b - 1) / 2.0 AS centre FROM b QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY b - a DESC, a) = 1),
low AS (SELECT s_nationkey, x::DOUBLE AS x FROM o QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY n, x) = 1)
SELECT low.s_nationkey, coalesce(best.centre, low.x)::DOUBLE AS centre FROM low LEFT JOIN best USING (s_nationkey)""")
def occupancy_widest_gap(spark, sf_dir):
    spans = _read(spark, sf_dir, "supplier").select("s_nationkey", F.bround(F.col("s_acctbal") / 100).cast("int").alias("lo"))
    return sequences.widest_gap(sequences.occupancy(spans.withColumn("hi", F.col("lo") + 4), ["s_nationkey"], "lo", "hi", 0, 100), ["s_nationkey"])


@query("""
WITH l AS (SELECT l_suppkey, list_distinct(list(lpad(l_linenumber::VARCHAR, 4, '0') || CASE WHEN l_linenumber % 3 = 0 THEN 'A' ELSE '' END)) AS listed,
             max(CASE WHEN l_linenumber % 3 > 0 THEN l_linenumber END) AS plain FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey, array_to_string(list_sort(list_distinct(list_concat(list_transform(range(1, plain + 1), lambda x: lpad(x::VARCHAR, 4, '0')), listed))), ',') AS parts FROM l""")
def part_candidates(spark, sf_dir):
    """Line numbers as part ids, those divisible by three with a suffix: the padded ids to try."""
    part = F.concat(F.lit(" "), F.col("l_linenumber").cast("string"), F.when(F.col("l_linenumber") % 3 == 0, "A").otherwise(""))
    per = _read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.collect_set(part).alias("listed"))
    return per.select("l_suppkey", F.array_join(part_ids.candidates(F.col("listed")), ",").alias("parts"))


@query()
def near_dup_drop(spark, sf_dir):
    """Events of a user as characters on one line, without those struck twice: equal texts less than half a point apart."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = _read(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_type").alias("text"), (F.pmod(at, F.lit(5_000_000)) / 1e4).alias("x0"), (F.pmod(F.col("event_id"), F.lit(3)) / 4).alias("top"))
    return layout.without_double_strikes(rows, ["user_id"], "event_id")


# part documents ----------------------------------------------------------------------------------------------------

#: Customers as rows of part documents, one part for each nation, in the order of their keys.
_PART_ROWS = "SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r FROM customer"


def _part_rows(spark, sf_dir):
    return _read(spark, sf_dir, "customer").withColumn("r", F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")))


def _words(rows: DataFrame, *words) -> DataFrame:
    """Words (text, x0, x1, top) of each row, with their places."""
    items = F.filter(F.array(*[F.struct(text.alias("text"), x0.alias("x0"), (x0 + 40).alias("x1"), top.alias("top")) for text, x0, top in words]), lambda w: w["text"] != "")
    return rows.select("part_id", "page_no", "r", F.posexplode(items).alias("k", "w")).select(
        "part_id", "page_no", (F.col("r") * 100 + F.col("k")).alias("word_idx"), "w.text", F.col("w.x0").cast("double").alias("x0"), F.col("w.x1").cast("double").alias("x1"), F.col("w.top").cast("double").alias("top"),
        (F.col("w.top") + 8).cast("double").alias("bottom"), F.lit("Plain").alias("fontname"),
    )


@query(f"""
WITH c AS ({_PART_ROWS})
SELECT c_nationkey + 1 AS part_no, r::INTEGER AS serial_no, 'H' || c_custkey AS local_ref, c_name AS full_name, c_mktsegment AS full_relative_name, CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'zz' END AS relation_code,
       CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, CASE WHEN c_custkey % 10 <> 0 THEN (20 + c_custkey % 60)::INTEGER END AS age,
       CASE WHEN c_nationkey % 3 = 0 THEN 'Village' ELSE 'Tehsil' END || c_nationkey AS locality,
       concat_ws('; ', CASE WHEN c_nationkey % 2 = 1 THEN 'unrecognized relation_code: ' || chr(39) || 'zz' || chr(39) END, CASE WHEN c_custkey % 10 = 0 THEN 'non-numeric age: ' || chr(39) || 'x' || chr(39) END) AS remark
FROM c""")
def ruled_part_records(spark, sf_dir):
    """Words and ruling lines of part documents, put into columns, rows and records, with the locality of the cover."""
    rows = _part_rows(spark, sf_dir).withColumns({"part_id": F.format_string("HR01.zip/part%04d.pdf", F.col("c_nationkey") + 1), "page_no": (2 + F.floor((F.col("r") - 1) / 25)).cast("int")})
    top = 100 + 12 * ((F.col("r") - 1) % 25)
    text = lambda c: c.cast("string")
    age = F.when(F.col("c_custkey") % 10 == 0, "x").otherwise(text(20 + F.col("c_custkey") % 60))
    cells = [text(F.col("r")), F.concat(F.lit("H"), text(F.col("c_custkey"))), F.col("c_name"), F.when(F.col("c_nationkey") % 2 == 0, "पि").otherwise("zz"), F.col("c_mktsegment"), F.when(F.col("c_custkey") % 2 == 0, "पु").otherwise("म"), age, F.lit("")]
    words = _words(rows, *[(cell, F.lit(60 * (i + 1)), top) for i, cell in enumerate(cells)])
    sheets = rows.select("part_id", "page_no").distinct().withColumn("r", F.lit(0))
    words = words.unionByName(_words(sheets, *[(F.lit(f"[{i}]"), F.lit(60 * i), F.lit(50)) for i in range(1, 9)]))
    covers = rows.select("part_id", "c_nationkey").distinct().withColumns({"page_no": F.lit(1), "r": F.lit(0)})
    label = [F.when(F.col("c_nationkey") % 3 == 0, x).otherwise("") for x in "ग्राम / शहर का नाम".split()]
    village = F.when(F.col("c_nationkey") % 3 == 0, F.concat(F.lit("Village"), text(F.col("c_nationkey")))).otherwise("")
    lines = [(word, F.lit(310 + 20 * i), F.lit(180)) for i, word in enumerate([*label, village])]
    words = words.unionByName(_words(covers, *lines, (F.lit("तहसील"), F.lit(310), F.lit(200)), (F.concat(F.lit("Tehsil"), text(F.col("c_nationkey"))), F.lit(360), F.lit(200))))
    edges = sheets.select("part_id", "page_no", F.explode(F.array(*[F.lit(60.0 * i - 10) for i in range(1, 10)])).alias("x0"), F.lit("v").alias("orientation"))
    area = spark.createDataFrame(pa.table({"ac_code": ["HR01"], "ac_name": ["Area"], "district": ["Reference"]}))
    return RuledPartSource("haryana").from_pages(words, edges, area, 2002).select("part_no", "serial_no", "local_ref", "full_name", "full_relative_name", "relation_code", "gender", "age", "locality", "remark")


@query(f"""
WITH c AS ({_PART_ROWS})
SELECT c_nationkey + 1 AS part_no, r::INTEGER AS serial_no, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'E' || c_custkey END AS local_ref, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_name END AS full_name,
       CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment END AS full_relative_name, CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE '' END AS relation_code, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
       (20 + c_custkey % 60)::INTEGER AS age, CASE WHEN c_nationkey % 3 = 0 THEN 'Road' || c_nationkey ELSE '' END AS locality,
       concat_ws('; ', CASE WHEN c_custkey % 7 = 0 THEN 'name in Bengali script: source font carries no ToUnicode map, so the name columns are not decodable yet' END,
         CASE WHEN c_nationkey % 2 = 1 THEN 'unrecognized relation_code in Bengali script: gid 41-42' END, CASE WHEN c_custkey % 5 = 0 THEN 'unreadable EPIC no: E?' END,
         CASE WHEN c_custkey % 3 = 0 THEN 'non-numeric age: ' || chr(39) || (20 + c_custkey % 60) || 'y' || chr(39) END) AS remark
FROM c""")
def glyph_part_records(spark, sf_dir):
    """Characters of part documents without ruling lines: numbered columns, gutters, geometry carried from page to page."""
    rows = _part_rows(spark, sf_dir).withColumns({"part_id": F.format_string("AC001.zip/part %03d.pdf", F.col("c_nationkey") + 1), "page_no": (1 + F.floor((F.col("r") - 1) / 20)).cast("int")})
    text = lambda c: c.cast("string")
    every = lambda n, yes, no: F.when(F.col("c_custkey") % n == 0, yes).otherwise(no)
    cells = [
        text(F.col("r")), F.lit("h"), every(7, F.lit("\ue050\ue051"), F.col("c_name")), F.when(F.col("c_nationkey") % 2 == 0, "\ue0c2\ue07c\ue057\ue082\ue0c1").otherwise("\ue041\ue042"), F.col("c_mktsegment"),
        every(2, F.lit("\ue07c\ue0c6\ue0d2"), F.lit("F")), F.concat(text(20 + F.col("c_custkey") % 60), every(3, F.lit("y"), F.lit(""))), every(5, F.lit("E\ue060"), F.concat(F.lit("E"), text(F.col("c_custkey")))),
    ]
    top = (100 + 12 * ((F.col("r") - 1) % 20)).cast("double")
    runs = rows.select("part_id", "page_no", F.explode(F.array(*[F.struct(F.lit(100.0 * (i + 1)).alias("x"), top.alias("top"), cell.alias("run")) for i, cell in enumerate(cells)])).alias("c")).select("part_id", "page_no", "c.*")
    covers = rows.select("part_id", "c_nationkey").distinct()
    heads = [F.struct(F.lit(100.0 * (i + 1) + 40).alias("x"), F.lit(80.0).alias("top"), F.lit(str(i + 1)).alias("run")) for i in range(8)]
    place = F.when(F.col("c_nationkey") % 3 == 0, F.concat(F.lit("Road"), text(F.col("c_nationkey")))).otherwise("\ue070")
    heads += [F.struct(F.lit(100.0).alias("x"), F.lit(30.0).alias("top"), F.lit("Village / Area / Road").alias("run")), F.struct(F.lit(300.0).alias("x"), F.lit(30.0).alias("top"), place.alias("run"))]
    runs = runs.unionByName(covers.select("part_id", F.lit(1).alias("page_no"), F.explode(F.array(*heads)).alias("c")).select("part_id", "page_no", "c.*"))
    chars = runs.select("part_id", "page_no", "x", "top", F.posexplode(F.filter(F.split("run", ""), lambda c: c != "")).alias("k", "text"))
    chars = chars.select("part_id", "page_no", (F.col("top") * 10_000 + F.col("x") + F.col("k")).cast("long").alias("char_idx"), "text", (F.col("x") + 4.0 * F.col("k")).alias("x0"), (F.col("x") + 4.0 * F.col("k") + 4).alias("x1"), "top")
    area = spark.createDataFrame(pa.table({"ac_code": ["AC001"], "ac_name": ["Area"], "district": ["Reference"]}))
    return GlyphPartSource("west_bengal").from_pages(chars, area, 2002).select("part_no", "serial_no", "local_ref", "full_name", "full_relative_name", "relation_code", "gender", "age", "locality", "remark")


@query("""
WITH r AS (SELECT c_custkey, c_nationkey, c_mktsegment, c_custkey % 11 = 0 AS short FROM customer),
k AS (
  SELECT unnest(list_filter(CASE WHEN short THEN ['too_few_cols_3'] ELSE [
    CASE WHEN c_custkey % 5 = 0 THEN 'extra_nonempty_cols_14' END, CASE WHEN c_custkey % 7 <> 0 THEN 'ac_code_mismatch' END, CASE WHEN c_custkey % 4 = 0 THEN 'district_mismatch' END, CASE WHEN c_custkey % 3 = 0 THEN 'empty_first_name' END,
    'empty_part_no', CASE WHEN c_custkey % 2 = 0 THEN 'non_numeric_age' ELSE 'empty_age' END, CASE WHEN c_mktsegment <> 'BUILDING' THEN 'unknown_relation_code' END, CASE WHEN c_nationkey % 3 = 2 THEN 'unknown_gender' END] END, lambda x: x IS NOT NULL)) AS kind FROM r)
SELECT kind, count(*)::BIGINT AS n FROM k GROUP BY kind""")
def audit_anomalies(spark, sf_dir):
    """Anomalies of customers written as ragged rows, by kind."""
    key, text, none = F.col("c_custkey"), lambda c: c.cast("string"), F.lit("")
    relation = F.when(F.col("c_mktsegment") == "BUILDING", "f").otherwise(F.col("c_mktsegment"))
    gender = F.element_at(F.array(F.lit("m"), F.lit("F"), F.lit("X")), (F.col("c_nationkey") % 3 + 1).cast("int"))
    cols = F.array(F.when(key % 4 == 0, "else").otherwise(" reference "), text(key % 7), none, none, text(key), none, F.when(key % 3 == 0, "").otherwise(F.col("c_name")), none, none, none, relation, F.when(key % 2 == 0, F.concat(F.lit("x"), text(key))).otherwise(" NULL"), gender)
    cols = F.when(key % 11 == 0, F.slice(cols, 1, 3)).when(key % 5 == 0, F.concat(cols, F.array(F.lit("tail")))).otherwise(cols)
    rows = _read(spark, sf_dir, "customer").select(F.lit("A000.csv").alias("file"), key.alias("line"), cols.alias("cols"))
    meta = spark.createDataFrame(pa.table({"ac_code": ["A000"], "ac_name": ["Area"], "district": ["Reference"]}))
    return audit.kind_counts(audit.anomalies(rows, meta))


@query("""
WITH i AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL)
SELECT c_nationkey, count(*)::BIGINT AS areas, sum(n)::BIGINT AS rows_n FROM i GROUP BY c_nationkey""")
def state_totals(spark, sf_dir):
    """Rows and areas of each state, from the index of its areas."""
    rows = _read(spark, sf_dir, "customer").withColumn("locality", F.lit(""))
    return build.totals(build.area_index(rows, rows, ["c_nationkey", "c_mktsegment"]), "c_nationkey")


@query("""
SELECT p_partkey, p_brand, round(100 * jaro_winkler_similarity('green pin', lower(p_name)), 6) AS score FROM part""")
def grouped_scores(spark, sf_dir):
    """Scores by group: those of the flat batch, with each group's time beside them."""
    rows = _read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    return search.score_by_group(rows, ["green pin"], ["p_name"], ["p_brand"], "jaro_winkler").select("p_partkey", "p_brand", F.round("score", 6).alias("score"))


# evaluation --------------------------------------------------------------------------------------------------------


@query("""
WITH q AS (SELECT vec_id AS query, embedding, label FROM embeddings WHERE vec_id % 100 = 0),
s AS (SELECT q.query, e.vec_id AS position, list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS score FROM q JOIN embeddings e ON e.vec_id <> q.query)
SELECT query, position, round(score, 6) AS score FROM s QUALIFY row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, position) <= 10""")
def cosine_topk(spark, sf_dir):
    """Ten nearest of every stated query vector; candidates are thinned in each task before they meet."""
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = evaluate.nearest(rows, rows.where("vec_id % 100 = 0"), "vec_id", "embedding", 10)
    return found.select("query", "position", F.round("score", 6).alias("score"))


@query("""
WITH names AS (SELECT DISTINCT p_name FROM part),
pools AS (SELECT p_name AS true_name, list(p_name) OVER (PARTITION BY split_part(p_name, ' ', 1) ORDER BY p_name ROWS BETWEEN 10 PRECEDING AND 9 FOLLOWING) AS candidates FROM names),
c AS (SELECT true_name, unnest(candidates) AS candidate, unnest(range(0, len(candidates))) AS position FROM pools),
s AS (SELECT *, jaro_winkler_similarity(lower(true_name[1:1] || true_name[3:]), lower(candidate)) AS score FROM c),
r AS (SELECT true_name, candidate, row_number() OVER (PARTITION BY true_name ORDER BY round(score, 9) DESC, position) AS rank FROM s)
SELECT round(avg((rank <= 1)::INT), 6) AS recall_at_1, round(avg((rank <= 3)::INT), 6) AS recall_at_3, round(avg((rank <= 5)::INT), 6) AS recall_at_5, round(avg(1.0 / rank), 6) AS mrr, count(*)::BIGINT AS n
FROM r WHERE candidate = true_name""")
def recall_mrr(spark, sf_dir):
    """How often a name that lost its second letter finds itself in a pool of at most 20 names with its first word."""
    names = _read(spark, sf_dir, "part").select("p_name").distinct()
    near = Window.partitionBy(F.substring_index("p_name", " ", 1)).orderBy("p_name").rowsBetween(-10, 9)
    cases = names.select(F.concat(F.substring("p_name", 1, 1), F.expr("substring(p_name, 3)")).alias("query"), F.col("p_name").alias("true_name"), F.collect_list("p_name").over(near).alias("candidates"))
    out = evaluate.evaluate(cases, lambda q, c: F.round(scorers.pair_score(q, c, "jaro_winkler"), 7))
    return out.select(*[F.round(c, 6).alias(c) for c in ("recall_at_1", "recall_at_3", "recall_at_5", "mrr")], "n")


@query("""
WITH names AS (SELECT DISTINCT p_name FROM part)
SELECT p_name AS name FROM names UNION SELECT p_name[1:1] || p_name[3:] FROM names""")
def names_to_encode(spark, sf_dir):
    """Queries and candidates of an evaluation, each name once."""
    names = _read(spark, sf_dir, "part").select("p_name").distinct()
    cases = names.select(F.concat(F.substring("p_name", 1, 1), F.expr("substring(p_name, 3)")).alias("query"), F.array("p_name").alias("candidates"))
    return evaluate.distinct_names(cases)


# text --------------------------------------------------------------------------------------------------------------


@query("""
SELECT doc_id, regexp_matches(text, '[\\x{0900}-\\x{097F}]') AS has_devanagari, (text <> '' AND NOT regexp_matches(text, '[\\x{0900}-\\x{097F}]')) AS latin_query FROM documents""")
def script_predicates(spark, sf_dir):
    rows = _read(spark, sf_dir, "documents")
    return rows.select("doc_id", devanagari.has_devanagari(F.col("text")).alias("has_devanagari"), devanagari.is_latin_query(F.col("text")).alias("latin_query"))


@query("""
SELECT p_partkey, lpad((p_partkey % 1000)::VARCHAR, greatest(4, length((p_partkey % 1000)::VARCHAR))::INTEGER, '0') AS padded,
       'AC' || lpad((p_size)::VARCHAR, 3, '0') || '/' || lpad((p_partkey % 97)::VARCHAR, 2, '0') || '.csv' AS url, to_base64(encode(p_name)) AS key FROM part""")
def zip_urls_format(spark, sf_dir):
    number = (F.col("p_partkey") % 1000).cast("string")
    url = F.format_string("AC%03d/%02d.csv", F.col("p_size"), F.col("p_partkey") % 97)
    return _read(spark, sf_dir, "part").select("p_partkey", normalize.filled(number, 4).alias("padded"), url.alias("url"), F.base64(F.encode("p_name", "UTF-8")).alias("key"))


_KNOWN_WORDS = ", ".join(f"('{code}', '{word}', 0, NULL)" for code, word in PAIRS)


@query(f"SELECT * FROM (VALUES {_KNOWN_WORDS}, ('bc', chr(65533), 1, 'undecodable glyph(s) 0xbc in column 2')) t(code, text, n_unknown, remark)")
def dkraj_decode(spark, sf_dir):
    """Legacy words with their decoded form and unknown codes, against all words that are known."""
    rows = spark.createDataFrame(pa.table({"code": [*[code for code, _ in PAIRS], "bc"]})).withColumn("raw", F.decode(F.unhex("code"), "ISO-8859-1"))
    return rows.select("code", devanagari.decode(F.col("raw")).alias("text"), F.size(devanagari.unknown(F.col("raw"))).alias("n_unknown"), devanagari.unknown_remark(F.col("raw"), 2).alias("remark"))


@query("""
SELECT * FROM (VALUES ('सुभाष', 'subhASha'), ('Ravi', 'Ravi'), ('राम', 'rAma'), ('कमला देवी', 'kamalA devI')) t(name, latin)""")
def romanize_names(spark, sf_dir):
    """Latin forms of names, made once per distinct name."""
    rows = spark.createDataFrame(pa.table({"full_name": ["सुभाष", "Ravi", "राम", "कमला देवी"]})).withColumns({"state": F.lit("haryana"), "full_relative_name": F.lit("")})
    filled = fill_latin(rows.withColumns({"full_name_latin": F.lit(None).cast("string"), "full_relative_name_latin": F.lit(None).cast("string")}))
    return filled.select(F.col("full_name").alias("name"), F.col("full_name_latin").alias("latin"))


@query("""
SELECT c_custkey::BIGINT AS line, c_name || ' ' || c_mktsegment AS full_name, c_nationkey::INTEGER AS part_no,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'F' ELSE c_mktsegment END AS relation_code,
       CASE WHEN c_nationkey % 3 = 0 THEN 'M' WHEN c_nationkey % 3 = 1 THEN 'F' ELSE 'X' END AS gender, 'Reference' AS district,
       concat_ws('; ', CASE WHEN c_custkey % 5 = 0 THEN 'malformed row: 14 columns with non-empty trailing data' END,
         CASE WHEN c_custkey % 7 <> 0 THEN 'source row listed ac_code ''' || (c_custkey % 7) || '''; using A000 (from filename)' END,
         CASE WHEN c_custkey % 2 = 0 THEN 'non-numeric age: ''x' || c_custkey || '''' END, CASE WHEN c_mktsegment <> 'BUILDING' THEN 'unrecognized relation_code: ''' || c_mktsegment || '''' END,
         CASE WHEN c_nationkey % 3 = 2 THEN 'unrecognized gender: ''X''' END) AS remark
FROM customer""")
def normalized_records(spark, sf_dir):
    """Customers written as ragged rows and read as records, with remarks in order."""
    key, text = F.col("c_custkey"), lambda c: c.cast("string")
    relation = F.when(F.col("c_mktsegment") == "BUILDING", " tamde. ").otherwise(F.col("c_mktsegment"))
    gender = F.element_at(F.array(F.lit("GAN"), F.lit("female"), F.lit("X")), (F.col("c_nationkey") % 3 + 1).cast("int"))
    age = F.when(key % 2 == 0, F.concat(F.lit("x"), text(key))).otherwise(F.lit(" NULL"))
    none = F.lit("")
    cols = F.array(F.lit("own"), text(key % 7), none, text(F.col("c_nationkey")), text(key), none, F.col("c_name"), F.col("c_mktsegment"), none, none, relation, age, gender)
    rows = _read(spark, sf_dir, "customer").select(F.lit("A000.csv").alias("file"), key.alias("line"), F.when(key % 5 == 0, F.concat(cols, F.array(F.lit("tail")))).otherwise(cols).alias("cols"))
    area = spark.createDataFrame(pa.table({"ac_code": ["A000"], "ac_name": ["Area"], "district": ["Reference"]}))
    return DelimitedSource("karnataka").normalized(rows, area, 2002).select("line", "full_name", "part_no", "relation_code", "gender", "district", "remark")
