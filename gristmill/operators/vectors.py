"""Exact vector search, tie-aware ranks, k-means pruning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.plans.store import materialize


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def search(corpus: DataFrame, queries: list[tuple], k: int, block: int = 512) -> DataFrame:
    """(query_id, id, score, rank): exact cosine top-k of a stated list of (query_id, vector).

    Queries go out in blocks of bounded size; each partition passes on its k best per query alone.
    """
    import numpy as np
    import pyarrow as pa

    kind = corpus.schema["id"].dataType.simpleString()
    out = None
    for at in range(0, max(len(queries), 1), block):
        part = queries[at : at + block]
        ids = [q for q, _ in part]
        m = np.array([v for _, v in part], np.float64).reshape(len(part), -1)
        m = m / np.maximum(np.sqrt((m * m).sum(1, keepdims=True)), 1e-300)

        def run(batches, ids=ids, m=m):
            best_i, best_s = [np.zeros(0, np.int64)] * len(ids), [np.zeros(0)] * len(ids)
            for batch in batches:
                have = [i for i, v in enumerate(batch.column(1)) if v.is_valid and len(v) == m.shape[1]]
                if not have:
                    continue
                some = batch.take(pa.array(have))
                x = some.column(1).flatten().to_numpy().astype(np.float64).reshape(len(have), -1)
                x = x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-300)
                key, s = some.column(0).to_numpy(zero_copy_only=False), m @ x.T
                for q in range(len(ids)):
                    i, v = np.concatenate([best_i[q], key]), np.concatenate([best_s[q], s[q]])
                    o = np.lexsort((i, -v))[:k]
                    best_i[q], best_s[q] = i[o], v[o]
            for q, name in enumerate(ids):
                yield pa.RecordBatch.from_pydict({"query_id": [name] * len(best_i[q]), "id": best_i[q], "score": best_s[q]}, schema=pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())]))

        found = corpus.select("id", "vector").mapInArrow(run, f"query_id long, id {kind}, score double")
        out = found if out is None else out.unionByName(found)
    return topk(out, k)


def search_rows(corpus: DataFrame, queries: DataFrame, k: int, block: int = 512) -> DataFrame:
    """:func:`search` for the rows (id, vector) of ``queries``; they come to the driver a block at a time and each block's result is written."""
    from itertools import islice

    rows, out = queries.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).select("id", "vector").toLocalIterator(), None
    while part := [(r["id"], list(r["vector"])) for r in islice(rows, block)]:
        one = materialize(search(corpus, part, k, block), "searched")
        out = one if out is None else out.unionByName(one)
    return out if out is not None else search(corpus, [], k, block)


def topk(scored: DataFrame, k: int) -> DataFrame:
    """The k best of each query, ties to the smaller id; a group limit cuts each partition's rows before the shuffle."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def pessimistic_rank(scored: DataFrame, targets: DataFrame) -> DataFrame:
    """(query_id, rank): a target's worst place among equal scores; null if it is not there."""
    t = scored.join(targets, (scored.query_id == targets.q) & (scored.id == targets.target), "inner").select(scored.query_id, F.col("score").alias("_t"))
    return scored.join(t, "query_id").groupBy("query_id").agg(F.count_if(F.col("score") >= F.col("_t")).alias("rank"))


def prune_clusters(vectors: DataFrame, share: float, k: int = 8, seed: int = 0, id_col: str = "id") -> DataFrame:
    """(id, cluster, kept): spherical k-means, then the max(1, m(1 - share)) rows nearest each centre stay, ties by id."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = vectors.where(F.col("vector").isNotNull()).withColumn("features", array_to_vector(F.col("vector").cast("array<double>")))
    model = KMeans(k=k, seed=seed, maxIter=20, distanceMeasure="cosine").fit(v)
    centres = F.array(*(F.array(*(F.lit(float(x)) for x in c)) for c in model.clusterCenters()))
    d = model.transform(v).withColumn("near", dot(vector_to_array("features"), F.get(centres, F.col("prediction"))))
    size = d.groupBy("prediction").agg(F.greatest(F.lit(1), F.floor(F.count("*") * (1 - share))).alias("quota"))
    w = Window.partitionBy("prediction").orderBy(F.desc("near"), id_col)
    return d.withColumn("r", F.row_number().over(w)).join(F.broadcast(size), "prediction").select(id_col, F.col("prediction").alias("cluster"), (F.col("r") <= F.col("quota")).alias("kept"))
