"""Exact top-k inner products by norm buckets.

Vectors are grouped by length. A query with a lower bound `least` of its k-th
score needs, in a bucket of vectors of length `longest` at most, a cosine of
least / (|query| * longest). Above 1 the whole bucket is left out. Under
BY_COORDINATES any angle will do, so vectors are pruned by length: sorted by
it, those under least / |query| are a tail. From there on the angle decides:
of the vectors that are long enough, the product over the first coordinates,
plus the most that the lengths of the rest allow, leaves out single ones. Full
products decide among those that stay.

Queries meet candidates in blocks of both: a block of candidates goes to each
block of queries, whose bounds it may meet, in vectors of whole numbers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowscribe.llm.common import checkpointed, pick

#: Vectors in a block of candidates and in one of queries, about, and queries multiplied at once.
BLOCK, QUERY_BLOCK, QUERIES = 8192, 8192, 512
#: Buckets for each doubling of the length.
BUCKETS = 8
#: The local cosine threshold of a query from which on a bucket is pruned by coordinates, not by
#: length alone; and what is granted to rounding.
BY_COORDINATES, SLACK = 0.5, 1e-9
#: Long vectors, about, whose products with all queries give the first bounds.
PROBE = 2048
#: Products of this size at most are exact in doubles.
_EXACT = 2.0**53


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as double; null if the vector is null or
    has a null or non-finite component. Outside a long's range it is the nearest long."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(~bad, F.transform(doubles, lambda x: F.floor(x * scale)))


def best_of(queries: np.ndarray, candidates: np.ndarray, own: np.ndarray, ids: np.ndarray, least: np.ndarray, k: int):
    """(query row, candidate id, score) of the k best of a block for each query, ties to
    the smaller id; those under `least` may be missing. own: the id each query leaves out."""
    dim = queries.shape[1]
    norm_q, norm_c = (np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) for x in (queries, candidates))
    longest = float(norm_c.max(initial=0))
    if float(norm_q.max(initial=0)) * longest >= _EXACT / 2:
        return _best_of_large(queries, candidates, own, ids, k)
    order = np.lexsort((ids, -norm_c))
    q, c = queries.astype(np.float64), candidates[order].astype(np.float64)
    ids, norm_c = ids[order], norm_c[order]
    head = max(1, dim // 4)
    rest_q, rest_c = (np.sqrt((x[:, head:] ** 2).sum(axis=1)) for x in (q, c))
    out_q, out_id, out_score = [], [], []
    for i in range(len(q)):
        cosine = least[i] / (norm_q[i] * longest) if norm_q[i] and longest else -1.0
        if cosine > 1 + SLACK:
            continue
        near, scores = ids, None
        if cosine > 0:
            # Vectors are sorted by length: those that are too short for any angle end the list.
            long = int(np.searchsorted(-norm_c, -least[i] / norm_q[i] * (1 - SLACK), side="right"))
            near = ids[:long]
            if cosine >= BY_COORDINATES:
                reach = c[:long, :head] @ q[i, :head] + rest_c[:long] * rest_q[i]
                stay = np.flatnonzero(reach >= least[i] - 1e-6 * max(1.0, abs(least[i])))
                near, scores = ids[stay], c[stay] @ q[i]
            else:
                scores = c[:long] @ q[i]
        else:
            scores = c @ q[i]
        scores[near == own[i]] = -np.inf
        best = np.arange(len(scores))
        if len(scores) > k:
            best = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        best = best[np.lexsort((near[best], -scores[best]))][:k]
        best = best[np.isfinite(scores[best])]
        out_q += [i] * len(best)
        out_id += near[best].tolist()
        out_score += scores[best].astype(np.int64).tolist()
    return out_q, out_id, out_score


def _best_of_large(queries, candidates, own, ids, k):
    """As best_of, for numbers whose products doubles can't hold: whole products in Python."""
    out_q, out_id, out_score = [], [], []
    rows = [[int(x) for x in row] for row in candidates]
    for i, query in enumerate([[int(x) for x in row] for row in queries]):
        products = [(sum(a * b for a, b in zip(query, row)), int(j)) for row, j in zip(rows, ids) if j != own[i]]
        for score, j in sorted((-max(-(2**63), min(2**63 - 1, p)), j) for p, j in products)[:k]:
            out_q.append(i)
            out_id.append(j)
            out_score.append(-score)
    return out_q, out_id, out_score


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.int64) for v in vectors]) if len(vectors) else np.zeros((0, 0), np.int64)


def _long_vectors(vectors: DataFrame, buckets: DataFrame) -> DataFrame:
    """(vec_id, v, dim): the vectors of the longest buckets, about PROBE of them, of the last of these
    buckets those whose hashes are under a limit set by its size."""
    n, before = F.col("n"), F.coalesce(F.sum("n").over(Window.orderBy(F.col("bucket").desc(), "dim").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = buckets.withColumn("before", before).where(F.col("before") < PROBE)
    share = F.least(F.lit(1.0), (PROBE - F.col("before")) / n).alias("share")
    limited = vectors.join(F.broadcast(chosen.select("dim", "bucket", share)), ["dim", "bucket"])
    place = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30)) / float(1 << 30)
    return limited.where(place < F.col("share")).select("vec_id", "v", "dim")


def top_k(df: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query.

    Queries are the rows whose id is divisible by `every`; candidates are all
    rows of the same dimension but those with the query's id; the score is the
    inner product of whole numbers, ties go to the smaller id. Rows that repeat
    an id and a vector count once. A row with a null id, a null vector, or a
    null or non-finite component takes no part. Numbers and scores beyond a long's
    range are the nearest long. Other columns are left out.
    """
    spark = df.sparkSession
    numbers = pick(df, vec_id=vec_id, v=vector).select(F.col("vec_id").cast("long").alias("vec_id"), whole_numbers(F.col("v")).alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    vectors = (
        numbers.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
        .distinct()
        .select("vec_id", "v", F.size("v").alias("dim"), F.sqrt(squares).alias("norm"))
        .withColumn("bucket", F.floor(F.log2(F.col("norm") + 1) * BUCKETS).cast("int"))
    )
    vectors = checkpointed(vectors)
    # Buckets are cut into blocks of about equal size by a hash. A dimension has at most some
    # seven hundred buckets, as lengths are doubles of whole numbers of 64 bits.
    buckets = vectors.groupBy("dim", "bucket").agg(F.count("*").alias("n"), F.max("norm").alias("longest"))
    buckets = checkpointed(buckets.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")))
    probe = _long_vectors(vectors, buckets).toPandas()
    groups = {int(d): (_matrix(g["v"]), g["vec_id"].to_numpy(np.int64)) for d, g in probe.groupby("dim")}
    sent = spark.sparkContext.broadcast(groups)

    def bounds(frames):
        for frame in frames:
            least = np.full(len(frame), -np.inf)
            for dim, rows in frame.groupby("dim").indices.items():
                if int(dim) not in sent.value:
                    continue
                matrix, ids = sent.value[int(dim)]
                for part in np.array_split(rows, len(rows) // QUERIES + 1):
                    own = frame["vec_id"].to_numpy(np.int64)[part]
                    at, _, scores = best_of(_matrix(frame["v"].iloc[part]), matrix, own, ids, np.full(len(part), -np.inf), k)
                    found = pd.Series(scores, dtype="float64").groupby(pd.Series(at, dtype="int64")).agg(["min", "size"])
                    found = found[found["size"] == k]
                    least[part[found.index.to_numpy(np.int64)]] = found["min"].to_numpy()
            yield frame.assign(least=least)

    queries = (
        vectors.where(F.col("vec_id") % every == 0)
        .select("vec_id", "v", "dim", "norm")
        .mapInPandas(bounds, "vec_id long, v array<long>, dim int, norm double, least double")
    )
    queries = checkpointed(queries)
    # Queries are cut into blocks as well. A bucket that no query of a dimension can reach is left
    # out; the others meet each block of queries, block by block.
    asking = queries.groupBy("dim").agg(
        F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("parts"),
        F.min(F.when(F.col("norm") > 0, F.col("least") / F.col("norm")).otherwise(float("-inf"))).alias("shortest"),
    )
    reached = buckets.join(F.broadcast(asking), "dim").where(F.col("longest") * (1 + SLACK) >= F.col("shortest"))
    reached = checkpointed(reached.select("dim", "bucket", "blocks", "longest", "parts"))
    numbers = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    dealt = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.col(n)).cast("int")
    key = ["dim", "bucket", "block", "part"]
    blocks = (
        vectors.join(F.broadcast(reached), ["dim", "bucket"])
        .withColumn("block", dealt("blocks"))
        .select("dim", "bucket", "block", F.explode(numbers("parts")).alias("part"), "vec_id", "v")
    )
    # Each query goes to the buckets of its dimension that can still hold one of its best.
    asked = (
        queries.join(F.broadcast(reached), "dim")
        .where(F.col("norm") * F.col("longest") * (1 + SLACK) >= F.col("least"))
        .withColumn("part", dealt("parts"))
        .select(*(F.col(c).alias(c) for c in ("dim", "bucket")), F.explode(numbers("blocks")).alias("block"), "part", "vec_id", "v", "least")
    )

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        candidates, ids = _matrix(left["v"]), left["vec_id"].to_numpy(np.int64)
        for at in range(0, len(right), QUERIES) if len(left) else ():
            part = right.iloc[at : at + QUERIES]
            own = part["vec_id"].to_numpy(np.int64)
            rows, found, scores = best_of(_matrix(part["v"]), candidates, own, ids, part["least"].to_numpy(), k)
            out.append(pd.DataFrame({"query_id": own[rows] if rows else [], "vec_id": found, "score": scores}, dtype="int64"))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    found = (
        blocks.groupBy(*key)
        .cogroup(asked.groupBy(*key))
        .applyInPandas(meet, "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
