"""Ranking quality of a scorer: recall at k and mean reciprocal rank."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fixed value: ranks at which recall is reported.
AT = (1, 3, 5)


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size)


def nearest(rows: DataFrame, queries: DataFrame, key: str, vector: str, k: int, block_bytes: int = 4 << 20) -> DataFrame:
    """(query, position, score): the k rows nearest to each query row by cosine, itself left out, ties by key.

    Queries are cut into blocks of about block_bytes, each normalised once and sent to all tasks, which multiply their
    rows with it and keep k rows a query; what the tasks keep meets by query. A pass over rows for each block; the driver
    holds one block. Scores are rounded to 9 places. Vectors that are null or zero have no score and don't appear.
    """
    asked = queries.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    size = asked.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    blocks = max(1, -(-size.n * (size.dim or 0) * 8 // block_bytes))
    parts = []
    for b in range(blocks):
        ids, unit = _units(asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).toArrow())
        parts.append(rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).mapInArrow(_nearest(rows.sparkSession.sparkContext.broadcast((ids, unit)), k), "query long, position long, score double"))
    place = Window.partitionBy("query").orderBy(F.desc("score"), "position")
    return reduce(DataFrame.unionByName, parts).withColumn("k", F.row_number().over(place)).where(F.col("k") <= k).drop("k")


def _units(rows: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids and unit vectors of the rows that have one."""
    ids, vectors = rows.column(0).to_numpy(), [np.asarray(v, float) if v is not None and None not in v else None for v in rows.column(1).to_pylist()]
    good = [i for i, v in enumerate(vectors) if v is not None and np.isfinite(v).all() and v.any()]
    if not good:
        return np.empty(0, np.int64), np.empty((0, 0))
    unit = np.stack([vectors[i] for i in good])
    return ids[good].astype(np.int64), unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))


def _nearest(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, asked = shared.value
        best = np.full((len(queries), k), -np.inf)
        who = np.full((len(queries), k), np.iinfo(np.int64).max)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                ids, unit = _units(batch.slice(lo, 512))
                if not len(ids) or not len(queries):
                    continue
                score = np.round(asked @ unit.T, 9)
                score[queries[:, None] == ids[None, :]] = -np.inf
                all_scores, all_ids = np.hstack([best, score]), np.hstack([who, np.broadcast_to(ids, score.shape)])
                order = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
                best, who = np.take_along_axis(all_scores, order, 1), np.take_along_axis(all_ids, order, 1)
        row, col = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(queries[row]), pa.array(who[row, col]), pa.array(best[row, col])], ["query", "position", "score"])

    return run


def ranks(scored: DataFrame, query: str | list[str], true: Column) -> DataFrame:
    """(query, rank) of the true candidate among rows(query, position, score); ties keep the candidates' positions."""
    keys = [query] if isinstance(query, str) else query
    place = Window.partitionBy(*keys).orderBy(F.desc("score"), "position")
    return scored.withColumn("rank", F.row_number().over(place)).where(true).select(*keys, "rank")


def quality(ranked: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """recall_at_k, mrr and the number of queries, per key."""
    parts = [F.avg(F.when(F.col("rank") <= k, 1.0).otherwise(0.0)).alias(f"recall_at_{k}") for k in AT]
    return ranked.groupBy(*(keys or [])).agg(*parts, F.avg(1.0 / F.col("rank")).alias("mrr"), F.count("*").alias("n"))


def evaluate(cases: DataFrame, score) -> DataFrame:
    """quality() of cases(query, true_name, candidates) under score(query Column, candidate Column)."""
    rows = cases.select("query", "true_name", F.posexplode("candidates").alias("position", "candidate"))
    scored = rows.withColumn("score", score(F.col("query"), F.col("candidate")))
    case = ["query", "true_name"]
    first = ranks(scored, case, F.col("candidate") == F.col("true_name")).groupBy(*case).agg(F.min("rank").alias("rank"))
    return quality(first)


def distinct_names(cases: DataFrame) -> DataFrame:
    """(name) of all queries and candidates, each once: what an encoder has to see."""
    return cases.select(F.col("query").alias("name")).union(cases.select(F.explode("candidates"))).distinct()


def verdict(metrics: DataFrame, baselines: list[str]) -> DataFrame:
    """metrics(name, mrr) with wins: strictly above the best baseline."""
    best = metrics.where(F.col("name").isin(baselines)).agg(F.max("mrr").alias("best_baseline"))
    return metrics.crossJoin(best).withColumn("wins", ~F.col("name").isin(baselines) & (F.col("mrr") > F.col("best_baseline")))


def corruptions(name: Column) -> Column:
    """Nine typing and spelling variants of a name, one for each habit; those that change nothing are dropped."""
    first = lambda old, new: F.regexp_replace(name, f"^(.*?){old}", f"$1{new}")
    middle = F.floor(F.length(name) / 2).cast("int")
    deleted = F.concat(F.substring(name, F.lit(1), middle), F.substring(name, middle + 2, F.length(name)))
    swapped = F.concat(F.substring(name, F.lit(1), middle - 1), F.substring(name, middle + 1, F.lit(1)), F.substring(name, middle, F.lit(1)), F.substring(name, middle + 2, F.length(name)))
    vw = F.when(F.contains(name, F.lit("v")), first("v", "w")).otherwise(first("w", "v"))
    mn = F.when(F.contains(name, F.lit("m")), first("m", "n")).otherwise(first("n", "m"))
    made = F.array(vw, first("i", "y"), first("th", "t"), first("ph", "f"), first("a", "aa"), mn, first(" ", ""), F.when(F.length(name) > 3, deleted).otherwise(name), F.when(F.length(name) > 3, swapped).otherwise(name))
    return F.array_distinct(F.filter(made, lambda x: x != name))


#: First and last names of the evaluation set, its queries, and the size and hard part of a pool.
FIRST = "Aarav Ananya Bharath Chitra Deepak Divya Gautham Geetha Harish Indira Jyothi Karthik Kavitha Lakshmi Mahesh Meena Mohan Nagaraj Nandini Prakash Priya Rajesh Ramya Sanjay Shobha Suresh Thippesh Uma Vinith Yashoda".split()
LAST = "Bhat Chandra Desai Gowda Hegde Iyengar Joshi Kamath Murthy Nayak Prabhu Rao Shetty Upadhya Varma".split()
QUERIES, POOL, HARD = 150, 20, 10


def dataset(spark: SparkSession, seed: int = 42) -> DataFrame:
    """QUERIES rows (query, true_name, candidates): a corrupted name and a pool of POOL names with the true one.

    At most HARD of the others share its first or last name. Everything is drawn by hash, so a seed gives one set.
    """
    names = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in FIRST])).alias("first"), F.array(*[F.lit(x) for x in LAST]).alias("l")).select("first", F.explode("l").alias("last"))
    names = names.withColumn("name", F.concat_ws(" ", "first", "last"))
    draw = lambda *of: F.xxhash64(*of, F.lit(seed))
    variants = names.withColumn("v", corruptions(F.lower("name"))).where(F.size("v") > 0)
    asked = variants.orderBy(draw("name"), "name").limit(QUERIES)
    asked = asked.select("first", "last", F.col("name").alias("true_name"), F.get("v", F.pmod(draw("name", F.lit("v")), F.size("v").cast("long")).cast("int")).alias("query"))
    other = names.select(F.col("first").alias("f"), F.col("last").alias("l"), F.col("name").alias("other"))
    pairs = asked.join(other, F.col("true_name") != F.col("other"))  # a closed list of names on both sides
    pairs = pairs.withColumn("hard", (F.col("first") == F.col("f")) | (F.col("last") == F.col("l")))
    order = Window.partitionBy("true_name", "hard").orderBy(draw("true_name", "other"), "other")
    pairs = pairs.withColumn("k", F.row_number().over(order)).where(F.when(F.col("hard"), F.col("k") <= HARD).otherwise(F.col("k") <= POOL))
    ranked = pairs.withColumn("place", F.row_number().over(Window.partitionBy("true_name").orderBy(F.desc("hard"), "k"))).where(F.col("place") < POOL)
    pools = ranked.groupBy("query", "true_name").agg(F.collect_list("other").alias("others"))
    shuffled = F.transform(F.array_sort(F.transform(F.concat("others", F.array("true_name")), lambda n: F.struct(F.xxhash64(n, F.col("true_name"), F.lit(seed)).alias("d"), n.alias("n")))), lambda x: x["n"])
    return pools.select("query", "true_name", shuffled.alias("candidates"))
