"""MinHash near-duplicates of texts, and greedy selection over links."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions.buffers import pieces
from gristmill.operators.graph import connected_components
from gristmill.plans.store import discard, materialize

_WINDOWS_AT_ONCE = 1 << 13


def hash_family(num_perm: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and shifts of ``num_perm`` multiply-shift hashes of 4-byte windows."""
    rng = np.random.default_rng([seed, num_perm])
    return rng.integers(0, 1 << 63, (num_perm, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 64, (num_perm, 1), dtype=np.uint64)


def signatures(texts: DataFrame, id_col: str = "id", text: str = "text", num_perm: int = 80, prefix_bytes: int | None = None, seed: int = 42) -> DataFrame:
    """(id, sig array<int>) over the 4-byte windows of each whole text, or of its first ``prefix_bytes`` bytes. Texts are read as bytes where Arrow holds them."""
    factor, shift = hash_family(num_perm, seed)

    @F.arrow_udf("array<int>")
    def sign(column: pa.Array) -> pa.Array:
        out = np.empty((len(column), num_perm), np.int32)
        for at, _, data, offsets in pieces(column):
            for i, (lo, hi) in enumerate(zip(offsets[:-1], offsets[1:])):
                raw = data[lo:hi][:prefix_bytes]
                raw = np.pad(raw, (0, max(0, 4 - len(raw))))
                low = np.full(num_perm, np.uint64((1 << 64) - 1))
                for cut_at in range(0, len(raw) - 3, _WINDOWS_AT_ONCE):
                    cut = raw[cut_at : cut_at + _WINDOWS_AT_ONCE + 3]
                    window = np.unique(np.lib.stride_tricks.sliding_window_view(cut, 4).copy().view("<u4").ravel())
                    hashed = window.astype(np.uint64) * factor
                    hashed += shift
                    low = np.minimum(low, hashed.min(1))
                out[at + i] = low >> np.uint64(33)
        return pa.ListArray.from_arrays(np.arange(len(column) + 1, dtype=np.int32) * num_perm, out.ravel())

    return texts.select(F.col(id_col).alias("id"), sign(F.col(text)).alias("sig"))


def _distinct_signatures(sigs: DataFrame, bands: int) -> tuple[DataFrame, DataFrame]:
    """(members, keyed): ids with the least id of their equal signatures, and (rep, bucket) of buckets that several share."""
    n = (sigs.agg(F.max(F.size("sig")).alias("n")).first()["n"] or bands) // bands
    heads = sigs.groupBy("sig").agg(F.min("id").alias("rep"))
    keys = F.array(*(F.xxhash64(F.lit(i), F.slice("sig", i * n + 1, n)) for i in range(bands)))
    keyed = heads.select("rep", F.explode(keys).alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    return sigs.join(heads, "sig").select("id", "rep"), materialize(keyed.join(shared, "bucket"), "buckets")


def near_links(sigs: DataFrame, bands: int = 8, threshold: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """(members, links): members maps ids to the least id of equal signatures; links (src, dst, jaccard) connect all that verify.

    A bucket's members are compared with its least one. Where a bucket then still holds several
    components, members outside its largest one are compared with those of the others; pairs inside a
    component need no link, so a crowded bucket is never compared pair by pair.
    """
    members, keyed = _distinct_signatures(sigs, bands)
    heads = sigs.groupBy("sig").agg(F.min("id").alias("rep"))
    same = F.size(F.filter(F.zip_with("a", "b", lambda x, y: x == y), lambda x: x)) / F.size("a").cast("double")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        both = pairs.distinct().join(heads.select(F.col("rep").alias("src"), F.col("sig").alias("a")), "src").join(heads.select(F.col("rep").alias("dst"), F.col("sig").alias("b")), "dst")
        return materialize(both.select("src", "dst", same.alias("jaccard")).where(F.col("jaccard") >= threshold), name)

    least = keyed.groupBy("bucket").agg(F.min("rep").alias("src"))
    stars = materialize(keyed.join(least, "bucket").where("src <> rep").select("bucket", "src", "rep"), "stars")
    first = verified(stars.select("src", F.col("rep").alias("dst")), "links")
    part = connected_components(first)
    placed = keyed.join(part.withColumnRenamed("node", "rep"), "rep", "left").select("bucket", "rep", F.coalesce("component", "rep").alias("component"))
    main = placed.groupBy("bucket", "component").agg(F.count("*").alias("n")).groupBy("bucket").agg(F.max(F.struct("n", "component"))["component"].alias("main"), F.count("*").alias("parts"))
    mixed = materialize(placed.join(main.where("parts > 1"), "bucket"), "mixed")
    stray = mixed.where("component <> main").select("bucket", F.col("rep").alias("s"), F.col("component").alias("c"))
    met = stray.join(mixed, "bucket").where("c <> component and (component = main or s < rep)").select(F.least("s", "rep").alias("src"), F.greatest("s", "rep").alias("dst"))
    second = verified(met.distinct().join(stars.select("src", F.col("rep").alias("dst")), ["src", "dst"], "left_anti"), "links")
    return members, first.unionByName(second)


def greedy_buckets(keyed: DataFrame) -> DataFrame:
    """(rep, kept) for (rep, bucket): going by rep, whoever shares a bucket with a kept one is dropped.

    Each round keeps those that are the least open one of all their buckets and drops their bucket-mates.
    """
    said, open_ = None, keyed
    while open_.take(1):
        least = open_.groupBy("bucket").agg(F.min("rep").alias("least"))
        seen = materialize(open_.join(least, "bucket"), "greedy")
        keep = seen.groupBy("rep").agg(F.bool_and(F.col("rep") == F.col("least")).alias("kept")).where("kept")
        drop = seen.where("rep <> least").join(keep.select(F.col("rep").alias("least")), "least", "left_semi").select("rep").distinct()
        now = materialize(keep.unionByName(drop.withColumn("kept", F.lit(False))), "greedy-said")
        said = now if said is None else said.unionByName(now)
        before, open_ = open_, materialize(seen.join(now, "rep", "left_anti").select("rep", "bucket"), "greedy-open")
        discard(seen)
        if before is not keyed:
            discard(before)
    return said if said is not None else keyed.select("rep", F.lit(True).alias("kept"))


def greedy_duplicates(texts: DataFrame, id_col: str = "id", text: str = "text", bands: int = 16, num_perm: int = 128) -> DataFrame:
    """(id, kept): in order of id, a text that collides in a band with a kept one is dropped; no collision is verified."""
    sigs = materialize(signatures(texts, id_col, text, num_perm), "signatures")
    members, keyed = _distinct_signatures(sigs, bands)
    reps = greedy_buckets(keyed)
    found = members.join(reps, "rep", "left")
    return found.select("id", (F.coalesce("kept", F.lit(True)) & (F.col("id") == F.col("rep"))).alias("kept"))


def near_duplicates(texts: DataFrame, id_col: str = "id", text: str = "text", bands: int = 8, threshold: float = 0.7, **options) -> DataFrame:
    """(id, duplicate_of): connected components of verified links keep their smallest id."""
    sigs = materialize(signatures(texts, id_col, text, **options), "signatures")
    members, links = near_links(sigs, bands, threshold)
    parts = connected_components(links)
    return members.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select("id", F.coalesce("component", "rep").alias("duplicate_of"))


def greedy_keep(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, kept): the set that keeping in order of id and dropping what links to a kept one gives.

    Each round keeps every undecided node without an undecided smaller neighbour and drops the larger neighbours of those,
    so each settles the least undecided node at least.
    """
    edges = materialize(links.select(F.least("src", "dst").alias("lo"), F.greatest("src", "dst").alias("hi")).where("lo <> hi").distinct(), "greedy-links")
    state = materialize(nodes.select("id", F.lit(None).cast("boolean").alias("kept")), "greedy")
    while True:
        open_ = state.where("kept is null").select("id")
        live = edges.join(open_.withColumnRenamed("id", "lo"), "lo", "left_semi").join(open_.withColumnRenamed("id", "hi"), "hi", "left_semi")
        keep = open_.join(live.select(F.col("hi").alias("id")).distinct(), "id", "left_anti")
        drop = live.join(keep.withColumnRenamed("id", "lo"), "lo", "left_semi").select(F.col("hi").alias("id")).distinct()
        said = keep.withColumn("now", F.lit(True)).unionByName(drop.withColumn("now", F.lit(False)))
        new = materialize(state.join(said, "id", "left").select("id", F.coalesce("kept", "now").alias("kept")), "greedy")
        discard(state)
        state = new
        if not state.where("kept is null").take(1):
            return state
