"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

Equal vectors are one node (its smallest id), with the smallest ids of its rows: a query never
needs more than k + 1 of them. The graph starts from blocks: for each of a few sets of random
projections the nodes are range-partitioned by the signs and then by one more projection, and
blocks of ``leaf`` neighbours in that order are compared. Rounds of NN-descent follow, at every
size: a node's neighbours and reverse neighbours are brought together by Spark joins, pairs of
which at least one is new to the node are measured, and what they learn of each other replaces
worse neighbours. Rounds go on until one changes fewer than ``settled`` of all neighbours. A query
starts at its own node and expands the nearest unexpanded nodes of its beam, all queries one hop at
a time, until none is left (a node that falls out of a beam never returns, so this ends). The beam is
then measured exactly, in double precision, on the original vectors.

Lists are cut to their nearest entries in each task before they are shuffled, so a hub that is
neighbour to very many nodes is never gathered whole. The graph and the search use vectors of
one signed byte a component and a scale.

Edge cases: vectors that are null, zero, or hold null or not finite components take no part, as
queries or candidates; null ids neither; vectors of different lengths have no distance, so each
length is searched by itself; copies of a query's vector are candidates at distance 0; ties go to
the smaller id; fewer candidates than k are all returned; a repeated id counts once; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gristmill.plans.store import discard, materialize, release

NEIGHBOURS = 32
REVERSE = 32
TABLES = 4
LEAF = 256
SETTLED = 0.01
BEAM = 256
EXPAND = 64
TOLD = 16  # neighbours that a member learns of in one meeting
NEAR = "array<struct<d:float,id:long,new:boolean>>"
_AT_ONCE = 512
_HELD = 400_000


def encoded(x: np.ndarray) -> list[bytes]:
    """Vectors as a scale and signed bytes."""
    scale = (np.abs(x).max(1) / 127).astype(np.float32)
    scale[scale == 0] = np.finfo(np.float32).tiny
    whole = np.rint(x / scale[:, None].astype(np.float64)).clip(-127, 127).astype(np.int8)
    return [s.tobytes() + w.tobytes() for s, w in zip(scale, whole, strict=True)]


def decoded(codes: list[bytes]) -> np.ndarray:
    """Codes of one length as a matrix."""
    raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
    return raw[:, 4:].view(np.int8) * raw[:, :4].copy().view(np.float32)


def by_length(column: pa.Array) -> Iterator[np.ndarray]:
    """Row numbers of values of equal length."""
    size = (pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length)(column).to_numpy(zero_copy_only=False)
    for n in np.unique(size):
        yield np.flatnonzero(size == n)


def nodes_of(vectors: DataFrame, key: str, vector: str, keep: int) -> DataFrame:
    """(node, vec, code, ids): distinct usable vectors as doubles and as codes, with the ``keep`` smallest ids of each."""
    v = F.col(vector).cast("array<double>")
    usable = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), v.alias("v"))
    usable = usable.where((F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))

    def local(batches):
        for batch in batches:
            groups: dict[bytes, list[int]] = {}
            ids = batch.column(0).to_numpy()
            for rows in by_length(batch.column(1)):
                x = batch.column(1).take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), -1) + 0.0
                for i in np.argsort(ids[rows], kind="stable").tolist():
                    own = groups.setdefault(x[i].tobytes(), [])
                    if len(own) < keep:
                        own.append(int(ids[rows[i]]))
            yield pa.RecordBatch.from_arrays([pa.array(groups.keys(), pa.binary()), pa.array(groups.values(), pa.list_(pa.int64()))], ["vec", "ids"])

    few = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids")
    part = usable.mapInArrow(local, "vec binary, ids array<long>").groupBy("vec", F.pmod(F.xxhash64("ids"), F.lit(64)).alias("salt")).agg(few)  # a common vector comes from every batch
    merged = part.groupBy("vec").agg(few)
    named = merged.select(F.element_at("ids", 1).alias("node"), "vec", "ids")

    def coded(batches):
        for batch in batches:
            raw, codes = batch.column(1).to_pylist(), [b""] * batch.num_rows
            for rows in by_length(batch.column(1)):
                for i, c in zip(rows, encoded(np.frombuffer(b"".join(raw[i] for i in rows), np.float64).reshape(len(rows), -1)), strict=True):
                    codes[i] = c
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.binary()), batch.column(2)], ["node", "vec", "code", "ids"])

    return named.mapInArrow(coded, "node long, vec binary, code binary, ids array<long>")


# ---------------------------------------------------------------- lists of neighbours


def best(owner: np.ndarray, d: np.ndarray, ids: np.ndarray, new: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The ``k`` nearest distinct entries of each owner, nearest first; an entry that is known is not new."""
    order = np.lexsort((d, new, ids, owner))
    owner, d, ids, new = owner[order], d[order], ids[order], new[order]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (ids[1:] != ids[:-1])
    owner, d, ids, new = owner[first], d[first], ids[first], new[first]
    order = np.lexsort((ids, d, owner))
    owner, d, ids, new = owner[order], d[order], ids[order], new[order]
    begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    rank = np.arange(len(owner)) - np.repeat(begin, np.diff(np.append(begin, len(owner))))
    few = rank < k
    return owner[few], d[few], ids[few], new[few]


def _lists(owner: np.ndarray, d: np.ndarray, ids: np.ndarray, new: np.ndarray) -> pa.RecordBatch:
    """(node, near) from entries in the order of their owners."""
    begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    values = pa.StructArray.from_arrays([pa.array(d.astype(np.float32)), pa.array(ids.astype(np.int64)), pa.array(new.astype(bool))], ["d", "id", "new"])
    return pa.RecordBatch.from_arrays([pa.array(owner[begin].astype(np.int64)), pa.ListArray.from_arrays(pa.array(np.append(begin, len(owner)).astype(np.int32)), values)], ["node", "near"])


def _bare(nodes: np.ndarray) -> pa.RecordBatch:
    """Nodes without neighbours."""
    return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array([[]] * len(nodes), pa.list_(pa.struct([("d", pa.float32()), ("id", pa.int64()), ("new", pa.bool_())])))], ["node", "near"])


def _entries(near: pa.Array) -> tuple[np.ndarray, ...]:
    """(row, d, id, new) of a column of lists."""
    size = pc.list_value_length(near).fill_null(0).to_numpy(zero_copy_only=False)
    d, ids, new = (c.to_numpy(zero_copy_only=False) for c in near.flatten().flatten())
    return np.repeat(np.arange(len(near)), size), d, ids, new


def _combined(found: Iterator[tuple[np.ndarray, ...]], k: int) -> Iterator[pa.RecordBatch]:
    """Entries (owner, d, id, new) as lists, the k nearest of each owner within what is held at a time."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for entries in found:
        held.append(entries)
        size += len(entries[0])
        if size > _HELD:
            held = [best(*(np.concatenate(c) for c in zip(*held, strict=True)), k)]
            size = len(held[0][0])
            if size > _HELD // 2:
                yield _lists(*held[0])
                held, size = [], 0
    if size:
        yield _lists(*best(*(np.concatenate(c) for c in zip(*held, strict=True)), k))


def merge_lists(lists: DataFrame, k: int) -> DataFrame:
    """(node, near): the k nearest of all lists of a node."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, _AT_ONCE):
                part = batch.slice(at, _AT_ONCE)
                many = pc.list_value_length(part.column(1)).to_numpy(zero_copy_only=False)
                inner, d, ids, new = _entries(part.column(1).flatten())
                row = np.repeat(np.arange(part.num_rows), many)[inner]
                got = best(part.column(0).to_numpy()[row], d, ids, new, k)
                yield _lists(*got)
                bare = np.setdiff1d(part.column(0).to_numpy(), got[0])
                if len(bare):
                    yield _bare(bare)

    return lists.groupBy("node").agg(F.collect_list("near").alias("lists")).mapInArrow(run, f"node long, near {NEAR}")


# ---------------------------------------------------------------- the graph


def blocks(nodes: DataFrame, table: int, bits: int, leaf: int, k: int, parts: int) -> DataFrame:
    """(node, near) from one set of projections."""

    def project(batches):
        for batch in batches:
            raw = batch.column(1).to_pylist()
            for rows in by_length(batch.column(1)):
                x = decoded([raw[i] for i in rows])
                p = x @ np.random.default_rng([table, x.shape[1]]).normal(size=(x.shape[1], bits + 1)).astype(np.float32)
                sign = ((p[:, :bits] > 0) * (1 << np.arange(bits))).sum(1).astype(np.int64) if bits else np.zeros(len(x), np.int64)
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(np.full(len(x), x.shape[1], np.int32)), pa.array(sign), pa.array(p[:, bits])], ["node", "code", "dim", "sign", "p"])

    def compare(batches):
        def out(t: pa.Table):
            codes, all_ids = t["code"].to_pylist(), t["node"].to_numpy()
            for rows in by_length(t["code"].combine_chunks()):
                x, ids = decoded([codes[i] for i in rows]), all_ids[rows]
                sq = (x * x).sum(1)
                d = np.maximum(sq[:, None] + sq[None] - 2 * (x @ x.T), 0)
                np.fill_diagonal(d, np.inf)
                few = min(k, len(x) - 1)
                near = np.argpartition(d, few - 1, axis=1)[:, :few] if few else np.zeros((len(x), 0), np.int64)
                if not few:
                    yield _bare(ids)
                    continue
                yield _lists(np.repeat(ids, few), np.take_along_axis(d, near, 1).ravel(), ids[near].ravel(), np.ones(near.size, bool))

        rest = None
        for batch in batches:
            t = pa.concat_tables(([rest] if rest is not None else []) + [pa.Table.from_batches([batch.select(["node", "code"])])])
            at = 0
            while t.num_rows - at >= leaf:
                yield from out(t.slice(at, leaf))
                at += leaf
            rest = t.slice(at)
        if rest is not None and rest.num_rows:
            yield from out(rest)

    keyed = nodes.select("node", "code").mapInArrow(project, "node long, code binary, dim int, sign long, p float")
    dealt = keyed.repartitionByRange(parts, "dim", "sign", "p", "node").sortWithinPartitions("dim", "sign", "p", "node")
    return dealt.mapInArrow(compare, f"node long, near {NEAR}")


def reverse(graph: DataFrame, most: int) -> DataFrame:
    """(node, near): the ``most`` nearest nodes that have it as a neighbour."""

    def turned(batches):
        def entries():
            for batch in batches:
                row, d, ids, new = _entries(batch.column(1))
                yield ids, d, batch.column(0).to_numpy()[row], new

        yield from _combined(entries(), most)

    return merge_lists(graph.select("node", "near").mapInArrow(turned, f"node long, near {NEAR}"), most)


def around(graph: DataFrame, most: int) -> DataFrame:
    """(node, near): a node's neighbours and its ``most`` nearest reverse neighbours."""
    back = reverse(graph, most).select("node", F.col("near").alias("back"))
    return graph.join(back, "node", "left").select("node", F.concat("near", F.coalesce("back", F.array().cast(NEAR))).alias("near"))


def descend(graph: DataFrame, nodes: DataFrame, k: int, back: int) -> DataFrame:
    """One round: neighbours of a node get to know each other. Entries that are found now are ``new``."""
    worst = graph.select(F.col("node").alias("member"), F.when(F.size("near") < k, F.lit(float("inf"))).otherwise(F.element_at("near", -1)["d"]).cast("float").alias("worst"))
    known = nodes.select(F.col("node").alias("member"), "code").join(worst, "member")
    lively = around(graph, back).where(F.exists("near", lambda e: e["new"]))
    own = F.array(F.struct(F.col("node").alias("id"), F.lit(False).alias("new")))
    met = lively.select("node", F.explode(F.concat(F.transform("near", lambda e: F.struct(e["id"].alias("id"), e["new"].alias("new"))), own)).alias("e"))
    met = met.select("node", F.col("e.id").alias("member"), F.col("e.new").alias("new")).join(known, "member")
    groups = met.groupBy("node").agg(F.collect_list(F.struct("member", "new", "worst", "code")).alias("group"))

    def meeting(ids, new, worst, x):
        ids, first, where = np.unique(ids, return_index=True, return_inverse=True)
        fresh = np.zeros(len(ids), bool)
        np.logical_or.at(fresh, where, new)
        x, worst = x[first], worst[first]
        sq = (x * x).sum(1)
        d = np.maximum(sq[:, None] + sq[None] - 2 * (x @ x.T), 0)
        np.fill_diagonal(d, np.inf)
        d[(d >= worst[:, None]) | ~(fresh[:, None] | fresh[None])] = np.inf
        if d.shape[1] > TOLD:
            j = np.argpartition(d, TOLD - 1, axis=1)[:, :TOLD]
            d = np.take_along_axis(d, j, 1)
        else:
            j = np.broadcast_to(np.arange(len(ids)), d.shape)
        a, b = np.nonzero(np.isfinite(d))
        return ids[a], d[a, b], ids[j[a, b]], np.ones(len(a), bool)

    def meet(batches):
        def found():
            for batch in batches:
                for at in range(0, batch.num_rows, _AT_ONCE):
                    lists = batch.column(1).slice(at, _AT_ONCE)
                    ids, new, worst, code = lists.flatten().flatten()
                    ids, new, worst, code = ids.to_numpy(), new.to_numpy(zero_copy_only=False), worst.to_numpy(), code.to_pylist()
                    cuts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).tolist()
                    alike = len({len(c) for c in code}) == 1
                    x = decoded(code) if alike else None
                    for lo, hi in zip(cuts, cuts[1:], strict=False):
                        yield meeting(ids[lo:hi], new[lo:hi], worst[lo:hi], x[lo:hi] if alike else decoded(code[lo:hi]))

        yield from _combined(found(), k)

    news = groups.mapInArrow(meet, f"node long, near {NEAR}")
    old = graph.select("node", F.transform("near", lambda e: F.struct(e["d"].alias("d"), e["id"].alias("id"), F.lit(False).alias("new"))).alias("near"))
    return merge_lists(old.unionByName(news), k)


def build(nodes: DataFrame, k: int = NEIGHBOURS, back: int = REVERSE, tables: int = TABLES, leaf: int = LEAF, settled: float = SETTLED) -> DataFrame:
    """(node, near): the neighbour graph."""
    n = nodes.count()
    bits = min(60, max(0, int(np.ceil(np.log2(max(n, 1) / leaf)))))
    parts = max(1, min(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // (4 * leaf)))
    start = None
    for table in range(tables):
        one = blocks(nodes, table, bits, leaf, k, parts)
        start = one if start is None else start.unionByName(one)
    graph = materialize(merge_lists(start, k), "graph")
    while n > 1:
        better = materialize(descend(graph, nodes, k, back), "graph")
        discard(graph)
        graph = better
        release(nodes.sparkSession)
        changed = graph.agg(F.sum(F.size(F.filter("near", lambda e: e["new"]))).alias("n")).first()["n"] or 0
        if changed <= settled * n * k:
            break
    return graph


def search(nodes: DataFrame, graph: DataFrame, queries: DataFrame, back: int = REVERSE, beam: int = BEAM, expand: int = EXPAND) -> DataFrame:
    """(query, beam array<struct<d, id, new>>): the beam of each query node, nearest first. ``queries`` has node."""
    links = materialize(around(graph, back).select("node", F.array_distinct(F.transform("near", lambda e: e["id"])).alias("all")), "around")
    codes = nodes.select("node", "code")
    start = F.array(F.struct(F.lit(0.0).cast("float").alias("d"), F.col("node").alias("id"), F.lit(True).alias("new")))
    state = materialize(queries.select("node").distinct().join(codes, "node").select(F.col("node").alias("query"), "code", start.alias("beam")), "beam")

    def advance(batches):
        for batch in batches:
            rows = []
            for code, old, found in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                d, ids, new = (c.to_numpy(zero_copy_only=False) for c in old.values.flatten())
                fresh = np.flatnonzero(new)
                new = new.copy()
                new[fresh[:expand]] = False  # these have been expanded now
                if found.is_valid:
                    more, codes = found.values.flatten()
                    more = more.to_numpy()
                    take = ~np.isin(more, ids)
                    x = decoded(codes.to_pylist())[take]
                    d = np.concatenate([d, ((x - decoded([code.as_py()])) ** 2).sum(1)])
                    ids, new = np.concatenate([ids, more[take]]), np.concatenate([new, np.ones(int(take.sum()), bool)])
                order = np.lexsort((ids, d))[:beam]
                rows.append((np.full(len(order), len(rows)), d[order], ids[order], new[order]))
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _lists(*(np.concatenate(c) for c in zip(*rows, strict=True))).column(1)], ["query", "code", "beam"])

    while state.where(F.exists("beam", lambda e: e["new"])).take(1):
        front = F.slice(F.filter("beam", lambda e: e["new"]), 1, expand)
        step = state.select("query", F.explode(F.transform(front, lambda e: e["id"])).alias("node")).join(links, "node").select("query", F.explode("all").alias("node")).distinct()
        found = step.join(codes, "node").groupBy("query").agg(F.collect_list(F.struct("node", "code")).alias("found"))
        after = materialize(state.join(found, "query", "left").select("query", "code", "beam", "found").mapInArrow(advance, f"query long, code binary, beam {NEAR}"), "beam")
        discard(state)
        state = after
    return state.select("query", "beam")


def nearest(vectors: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = 10, **options) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found to each row that ``is_query`` holds for."""
    nodes = materialize(nodes_of(vectors, key, vector, k + 1), "nodes")
    graph = build(nodes, **options)
    asked = vectors.where(is_query & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("v"))

    def packed(batches):
        for batch in batches:
            raw = [None if v is None or None in v else (np.array(v, np.float64) + 0.0).tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["query_id", "vec"])

    asked = materialize(asked.mapInArrow(packed, "query_id long, vec binary").distinct().join(nodes.select("vec", "node"), "vec").select("query_id", "vec", "node"), "queries")
    beams = search(nodes, graph, asked).select(F.col("query").alias("node"), F.explode("beam").alias("e")).select("node", F.col("e.id").alias("near"))
    pairs = asked.join(beams, "node").select("query_id", "vec", "near").join(nodes.select(F.col("node").alias("near"), F.col("vec").alias("other"), "ids"), "near")

    def measure(batches):
        for batch in batches:
            a, b, score = batch.column(1).to_pylist(), batch.column(2).to_pylist(), np.zeros(batch.num_rows)
            for rows in by_length(batch.column(1)):
                x, y = (np.frombuffer(b"".join(v[i] for i in rows), np.float64).reshape(len(rows), -1) for v in (a, b))
                score[rows] = np.sqrt(((x - y) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), batch.column(3)], ["query_id", "score", "ids"])

    measured = pairs.select("query_id", "vec", "other", "ids").mapInArrow(measure, "query_id long, score double, ids array<long>")
    each = measured.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op10_nndescent(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % 100 == 0)
