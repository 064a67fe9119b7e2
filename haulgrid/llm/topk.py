"""Exact top-k inner products by a three-phase uniform threshold over vertical score lists.

The components of the vectors are dealt to ``lists`` nodes by blocks of dimensions, so a node sees
a part of every score. Phase one gathers the highest parts of each node; the exact scores of what
they name give a cutoff, the k-th highest, that the k-th best score cannot lie below. Phase two
sends the cutoff back, divided by the number of nodes: whatever reaches it in no node is below it
in sum, so the entries at or above it suffice. Phase three drops what cannot reach the cutoff with
the parts it lacks, and resolves the remaining scores exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from haulgrid.llm.common import stored, table

K = 5
LISTS = 2
#: Queries and vectors that one task multiplies at a time.
QUERY_BLOCK = 512
VECTOR_BLOCK = 4096
#: Salts by which the rows of one much repeated vector are reduced before they meet.
SALTS = 16


def scaled(vector: str) -> Column:
    """floor(256 x) of each component; NULL if the vector or a component is NULL or not finite."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(
        F.coalesce(whole, F.lit(False)),
        F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("long")),
    )


def _first_ids(rows: DataFrame, most: int) -> DataFrame:
    """The vectors, each once, with their ``most`` smallest ids; the first names the vector."""
    rows = rows.distinct().withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    for keys in (("vector", "salt"), ("vector",)):
        window = W.partitionBy(*keys).orderBy("vec_id")
        rows = rows.withColumn("n", F.row_number().over(window)).where(F.col("n") <= most)
    return rows.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("vid"), "ids", "vector"
    )


def _lists(rows: DataFrame, name: str, lists: int, width: int) -> DataFrame:
    """One row per node: the part of the vector that the node holds, of ``width`` dimensions."""
    part = F.struct(F.col("node"), F.slice("vector", F.col("node") * width + 1, width).alias("part"))
    rows = rows.withColumn("node", F.explode(F.sequence(F.lit(0), F.lit(lists - 1))))
    return rows.withColumn("part", part["part"]).drop("vector")


def _matrix(parts: pd.Series) -> np.ndarray:
    """Rows of numbers; those of fewer components end in zeros."""
    width = max(map(len, parts), default=0)
    out = np.zeros((len(parts), width), np.int64)
    for at, part in enumerate(parts):
        out[at, : len(part)] = part
    return out


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in floats only where no sum can lose a digit."""
    width = min(queries.shape[1], vectors.shape[1])
    queries, vectors = queries[:, :width], vectors[:, :width]
    if not queries.size or not vectors.size:
        return np.zeros((len(queries), len(vectors)), np.int64)
    bound = float(np.abs(queries.astype(float)).max()) * float(np.abs(vectors.astype(float)).max()) * width
    if bound < 2.0**53:
        return (queries.astype(float) @ vectors.T.astype(float)).astype(np.int64)
    if bound < 2.0**62:
        return queries @ vectors.T
    exact = queries.astype(object) @ vectors.T.astype(object)
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _dealt(queries: DataFrame, vectors: DataFrame, blocks: tuple[int, int], lists: int, width: int):
    """Both sides cogrouped by (node, block of queries, block of vectors)."""
    many_queries, many_vectors = blocks

    def over(rows: DataFrame, key: str, own: str, mine: int, other: str, others: int) -> DataFrame:
        return _lists(rows, key, lists, width).withColumns({
            own: F.pmod(F.xxhash64(key), F.lit(mine)).cast("int"),
            other: F.explode(F.sequence(F.lit(0), F.lit(others - 1))),
        }).groupBy("node", "qblock", "vblock")

    return over(queries, "qid", "qblock", many_queries, "vblock", many_vectors).cogroup(
        over(vectors.drop("ids"), "vid", "vblock", many_vectors, "qblock", many_queries)
    )


def _highest(rows: DataFrame, keys: list[str], order: list[Column], most: int) -> DataFrame:
    window = W.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("n", F.row_number().over(window)).where(F.col("n") <= most).drop("n")


def _resolved(pairs: DataFrame, queries: DataFrame, vectors: DataFrame) -> DataFrame:
    """Exact scores of (qid, vid) pairs."""
    left = F.zip_with("qv", "vector", lambda a, b: F.coalesce(a * b, F.lit(0).cast("long")))
    return (
        pairs.join(vectors.select("vid", "vector"), "vid")
        .join(queries.select("qid", F.col("vector").alias("qv")), "qid")
        .select("qid", "vid", F.aggregate(left, F.lit(0).cast("long"), lambda a, b: a + b).alias("score"))
    )


def best(queries: DataFrame, vectors: DataFrame, k: int, lists: int) -> DataFrame:
    """(qid, vid, score): the k highest scores of each query, ties to the smaller vid.

    ``queries`` has qid and vector, ``vectors`` has vid and vector, whole numbers, each vid once.
    """
    number, longest = vectors.agg(F.count("*"), F.max(F.size("vector"))).first()
    blocks = (max(1, -(-queries.count() // QUERY_BLOCK)), max(1, -(-number // VECTOR_BLOCK)))
    # One width for all, so that a node holds the same dimensions of every vector. What a query has
    # beyond the longest vector meets nothing.
    width = max(1, -(-(longest or 0) // lists))

    def leaders(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"qid": [], "node": [], "vid": [], "part": []}, dtype="int64")
        right = right.sort_values("vid")
        parts = products(_matrix(left["part"]), _matrix(right["part"]))
        order = np.argsort(-parts, axis=1, kind="stable")[:, :k]
        return pd.DataFrame({
            "qid": np.repeat(left["qid"].to_numpy(), order.shape[1]),
            "node": int(left["node"].iloc[0]),
            "vid": right["vid"].to_numpy()[order].ravel(),
            "part": np.take_along_axis(parts, order, axis=1).ravel(),
        })

    def above(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"qid": [], "vid": [], "part": []}, dtype="int64")
        parts = products(_matrix(left["part"]), _matrix(right["part"]))
        at, of = np.nonzero(parts >= left["cutoff"].to_numpy()[:, None])
        return pd.DataFrame({
            "qid": left["qid"].to_numpy()[at], "vid": right["vid"].to_numpy()[of], "part": parts[at, of]
        })

    # Phase one: each node's highest parts name candidates, whose scores give the cutoff.
    first = _dealt(queries, vectors, blocks, lists, width).applyInPandas(
        leaders, "qid long, node int, vid long, part long"
    )
    first = _highest(first, ["qid", "node"], [F.desc("part"), F.asc("vid")], k)
    scored = _resolved(first.select("qid", "vid").distinct(), queries, vectors)
    ordered = F.reverse(F.array_sort(F.collect_list("score")))
    cutoffs = stored(
        scored.groupBy("qid").agg(ordered.alias("scores")).select(
            "qid",
            # Fewer than k candidates: there are fewer than k vectors, and all of them count.
            F.when(F.size("scores") >= k, F.col("scores")[k - 1]).otherwise(F.lit(-(2**62))).alias("least"),
        ),
        "cutoffs",
    )
    # Phase two: entries that reach the node's even share of the cutoff, in whole numbers.
    even = F.expr(f"(least - pmod(least, {lists})) div {lists}")
    share = cutoffs.select("qid", "least", even.alias("cutoff"))
    entries = _dealt(queries.join(share.select("qid", "cutoff"), "qid"), vectors, blocks, lists, width)
    entries = entries.applyInPandas(above, "qid long, vid long, part long")
    # Phase three: known parts plus less than a share for each part that is missing.
    known = entries.groupBy("qid", "vid").agg(F.sum("part").alias("known"), F.count("*").alias("parts"))
    most = F.col("known") + (F.lit(lists) - F.col("parts")) * F.col("cutoff")
    able = known.join(share, "qid").where((F.col("parts") == lists) | (most >= F.col("least")))
    able = stored(able.select("qid", "vid", "known", "parts"), "able")
    whole = able.where(F.col("parts") == lists).select("qid", "vid", F.col("known").alias("score"))
    rest = _resolved(able.where(F.col("parts") < lists).select("qid", "vid"), queries, vectors)
    return _highest(whole.union(rest), ["qid"], [F.desc("score"), F.asc("vid")], k)


def top_k(
    rows: DataFrame, is_query: Column, k: int = K, vector: str = "embedding", lists: int = LISTS
) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k highest scores among all other rows.

    ``rows`` has vec_id and the vector column; is_query marks the queries. The score is the inner
    product of the scaled vectors; ties go to the smaller vec_id. A vector that is NULL or holds a
    NULL or a number that is not finite takes no part, nor does a row without a vec_id. Vectors of
    different lengths are as if they ended in zeros. Repeated rows count once; rows of one vec_id
    with different vectors are rows of their own, but none is an answer to a query of that id. A
    query has fewer than k answers if there are fewer other rows. Equal vectors are searched once.
    """
    rows = rows.where(F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), scaled(vector).alias("vector"), is_query.alias("query")
    ).where("vector is not null")
    # k answers besides the query's own row are among the first k + 1 rows, and those are among
    # the first k + 1 ids of the k + 1 best vectors.
    vectors = stored(_first_ids(rows.select("vec_id", "vector"), k + 1), "vectors")
    asked = stored(
        rows.where("query").select("vec_id", "vector").distinct()
        .join(vectors.select("vector", F.col("vid").alias("qid")), "vector"), "asked",
    )
    queries = stored(asked.select("qid", "vector").distinct(), "queries")
    found = best(queries, vectors, k + 1, lists)
    found = found.join(vectors.select("vid", "ids"), "vid").select("qid", "score", F.explode("ids").alias("vec_id"))
    found = _highest(found, ["qid"], [F.desc("score"), F.asc("vec_id")], k + 1)
    answers = asked.select(F.col("vec_id").alias("query_id"), "qid").join(found, "qid").where("vec_id <> query_id")
    window = W.partitionBy("query_id", "qid").orderBy(F.desc("score"), "vec_id")
    return (
        answers.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors for every vector whose id is divisible by 50."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


SQL = f"""
WITH v AS (
  SELECT DISTINCT CAST(vec_id AS BIGINT) AS vec_id,
    [CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT) FOR x IN embedding] AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), p AS (
  SELECT q.vec_id AS query_id, v.vec_id AS vec_id, coalesce(CAST(list_sum(
    [coalesce(z[1] * z[2], 0) FOR z IN list_zip(q.vector, v.vector)]) AS BIGINT), 0) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p
) WHERE rank <= {K}
"""
