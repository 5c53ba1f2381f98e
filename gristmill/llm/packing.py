"""Best-fit packing of texts into fixed-size sequences, under conflicts.

A sequence (bin) takes at most one text of each source and at most one of each cluster of
duplicates. Texts longer than a bin are cut: full pieces are bins of their own, the rest is packed
like a short text. Pieces are dealt by a hash of their text's id to shards of about
``shard_docs`` texts, so neither a source nor a cluster meets in one task; a shard packs its rests
in order of falling size. Bins hang in a tree ordered by residual room; every bin, and every
subtree, carries a bitmap of the sources and clusters that it (all of its bins) holds, so the search
for the tightest bin with enough room passes over subtrees that conflict throughout and goes on
until it finds a compatible one, or opens a bin.

Edge cases: a null or empty text has one token, its end, and is packed; a null source or cluster
conflicts with nothing; ties go to the smaller id, then the earlier bin; repeated rows are pieces
of their own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CAPACITY = 2048
SHARD_DOCS = 4096


class Bins:
    """Open bins by residual room, as a segment tree over the room whose nodes hold the bitmap common to all their bins."""

    def __init__(self, capacity: int):
        self.size = 1 << max(1, math.ceil(math.log2(capacity + 1)))
        self.common: list[int | None] = [None] * (2 * self.size)  # None: no bin below
        self.rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bitmap: list[int] = []
        self.room: list[int] = []

    def _refresh(self, room: int) -> None:
        value: int | None = None
        for b in self.rooms[room]:
            value = self.bitmap[b] if value is None else value & self.bitmap[b]
            if not value:
                break
        i = self.size + room
        common = self.common
        common[i] = value
        while i > 1:
            i //= 2
            left, right = common[2 * i], common[2 * i + 1]
            common[i] = right if left is None else left if right is None else left & right

    def tightest(self, need: int, mask: int) -> int | None:
        """The compatible bin of least room >= need, the earliest of equals."""
        common, size = self.common, self.size
        stack = []  # subtrees to the right, nearest on top
        i = size + need
        stack = [i]
        while i > 1:
            if not i & 1:
                stack.append(i + 1)
            i //= 2
        stack.reverse()
        while stack:
            i = stack.pop()
            value = common[i]
            if value is None or value & mask:
                continue
            if i < size:
                stack += (2 * i + 1, 2 * i)
                continue
            for b in self.rooms[i - size]:
                if not self.bitmap[b] & mask:
                    return b
        return None

    def place(self, need: int, mask: int, capacity: int) -> tuple[int, int]:
        """(bin, where in it the piece begins)."""
        b = self.tightest(need, mask)
        if b is None:
            b = len(self.bitmap)
            self.bitmap.append(0)
            self.room.append(capacity)
        else:
            self.rooms[self.room[b]].remove(b)
            self._refresh(self.room[b])
        at = capacity - self.room[b]
        self.bitmap[b] |= mask
        self.room[b] -= need
        if self.room[b] > 0:
            rest = self.rooms[self.room[b]]
            rest.append(b)
            rest.sort()
            self._refresh(self.room[b])
        return b, at


def pack_shard(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Pack one shard: columns id, source, cluster, n_tokens; one row per piece comes back."""
    rows = rows.sort_values(["n_tokens", "id"], ascending=[False, True], kind="stable")
    twice = set(rows["cluster"][rows["cluster"].notna() & rows["cluster"].duplicated(keep=False)])
    bits: dict[tuple[str, object], int] = {}

    def bit(kind: str, value: object) -> int:
        if value is None or value is pd.NA or value != value or (kind == "cluster" and value not in twice):
            return 0
        return 1 << bits.setdefault((kind, value), len(bits))

    out, full, rests = [], 0, []
    for key, source, cluster, n in zip(rows["id"], rows["source"], rows["cluster"], rows["n_tokens"].tolist(), strict=True):
        pieces = n // capacity
        for p in range(pieces):
            out.append((key, p, full, p * capacity, capacity, 0))
            full += 1
        if n % capacity:
            rests.append((n % capacity, key, pieces, bit("source", source) | bit("cluster", cluster)))
    bins = Bins(capacity)
    rests.sort(key=lambda r: -r[0])
    for need, key, piece, mask in rests:
        b, at = bins.place(need, mask, capacity)
        out.append((key, piece, full + b, piece * capacity, need, at))
    return pd.DataFrame(out, columns=["id", "piece", "bin", "from_token", "n_tokens", "at"])


def token_count(text: str = "text"):
    """White-space separated words and one end."""
    return F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1


def cluster_hash(text: str = "text"):
    """Copies, up to case and white space, share this hash; null for texts without a word."""
    plain = F.trim(F.regexp_replace(F.lower(F.col(text).cast("string")), r"[\x20\x09-\x0D]+", " "))
    return F.when(plain != "", F.xxhash64(plain, F.length(plain)))


def pack(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """(key, piece, shard, bin, from_token, n_tokens, at): where each piece of each text lies."""
    kind = docs.schema[key].dataType.simpleString()
    shards = max(1, math.ceil(docs.count() / shard_docs))
    slim = docs.select(F.col(key).alias("id"), F.col(source).cast("string").alias("source"), cluster_hash(text).cast("string").alias("cluster"), token_count(text).cast("long").alias("n_tokens"))
    dealt = slim.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(shards)).cast("int"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        return pack_shard(rows, capacity).assign(shard=shard)

    packed = dealt.groupBy("shard").applyInPandas(run, f"id {kind}, piece int, shard int, bin int, from_token long, n_tokens int, at int")
    return packed.select(F.col("id").alias(key), "piece", "shard", "bin", "from_token", "n_tokens", "at")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text"))
