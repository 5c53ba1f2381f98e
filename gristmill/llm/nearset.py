"""Near-duplicates by SimHash anchor-point covering, verified by the Jaccard similarity of word shingles.

A text is the set of its five-word shingles (lower-cased ASCII, split at ASCII white space, as in
:mod:`gristmill.llm.simhash`). Its SimHash sums have 512 coordinates, each the number of shingles
whose hash has that bit set less that of those whose has not; a fingerprint is their signs.

Two sets of similarity 0.8 differ in 15 % of such signs, 10 of 64, too many for the covering of
``op4_simhash`` (2 bits), which would need all its anchors within 10 bits. So there are further
anchor tables: the sums are turned at random into blocks of 24 coordinates, and a set is at home at
the nearest point of the (extended, binary) Golay code in each block, by the sums and not by their
signs alone, which keeps what is known of how near each coordinate is to turning. A table's anchor
is a pair of such points. Two sets of similarity 0.8 have the same nearest point in 27 % of the
blocks (simulated). Blocks go in 66 threes, and each two of a three are a table, so 198 tables miss
a pair of 0.8 with a probability of 2 in a million. Within an anchor the fingerprints are compared: a
set with no other within 46 of 128 bits leaves it (6 standard deviations from the mean at 0.8).
All other candidates are measured on the whole sets. Equal sets are one vertex, so copies never
multiply. Sets that have nothing in common meet in one table of 16,777,216 anchors by chance, which
are few candidates a set up to some million sets, and grow with the square of their number.

Candidates come in two steps, so that a large group is not compared pair by pair. First each
vertex is compared with the pivot of each of its anchors, the set that meets most others among all
that the anchor's members meet; nearly all anchors of a group have the same (:func:`stars`).
Then members of different components around one pivot are compared by what is known of them: which
of the pivot's shingles each holds, as bits, and its shingles outside the pivot. Two sets that are
similar by s share at least s / (1 + s) of both their sizes together. What two members share within
the pivot and outside it is counted exactly, so no link is lost and no pair that is none is handed
on. (Lists of shingles outside may be cut to the first (1 - s) * n + 1: similar sets that share one
outside share one of these. The most possible is then assumed.)
This is done by matrix products over blocks of members, so that no pair is written that cannot be a
link; the work in one group still grows with the square of its size.

Edge cases: null and empty texts and texts without a word are one empty set and equal; fewer words
than a shingle's make one shingle; rows without an id are left out of components and kept by
:func:`keep_one`; an empty table gives an empty result.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.simhash import _LOWER, _WORDS, syndrome
from gristmill.operators.graph import connected_components
from gristmill.plans.store import discard, materialize

SHINGLE = 5
SIMILARITY = 0.8
SUMS, THREES, BLOCK = 512, 66, 24
FAR, CROWD = 46, 4096  # differing bits of 128; sets at an anchor up to which these are compared
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 4096  # members of a pivot, and shingles outside it of each, that are compared at once
_AT_ONCE = 255
_rng = np.random.default_rng(42)
_FLIP, _TIMES = (_rng.integers(0, 1 << 64, SUMS // 64, dtype=np.uint64) for _ in range(2))
_TIMES = _TIMES | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted set of the text's shingles, as 64-bit hashes."""
    words = _WORDS.findall((text or "").encode().translate(_LOWER))
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - shingle + 1)
    out = np.full(n, min(len(words), shingle), np.uint64)
    for i in range(min(len(words), shingle)):
        out = (out ^ h[i : i + n]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def sums(found: np.ndarray) -> np.ndarray:
    """The SimHash sums of a set."""
    out = np.zeros(SUMS, np.int64)
    for at in range(0, len(found), _AT_ONCE):
        h = (found[at : at + _AT_ONCE, None] ^ _FLIP) * _TIMES
        h ^= h >> np.uint64(32)
        h *= _MIX
        h ^= h >> np.uint64(29)
        out += np.unpackbits(h.view(np.uint8), axis=1).sum(0, dtype=np.uint8)
    return 2 * out - len(found)


@functools.cache
def _points() -> tuple[np.ndarray, np.ndarray]:
    """(the random turns, one of each two opposite points of the extended Golay code)."""
    turns = np.random.default_rng(24).standard_normal((SUMS, THREES * 3 * BLOCK), np.float32)
    words = np.arange(2048, dtype=np.int64) << 11
    words ^= syndrome(words)
    signs = 2.0 * (words[:, None] >> np.arange(BLOCK - 1) & 1) - 1
    return turns, np.concatenate([signs, signs.prod(1, keepdims=True)], 1).astype(np.float32).T


def anchors(totals: np.ndarray) -> np.ndarray:
    """An anchor per table for each row of SimHash sums."""
    turns, points = _points()
    blocks = (totals.astype(np.float32) @ turns).reshape(-1, BLOCK)
    nearest = np.empty(len(blocks), np.int64)
    for at in range(0, len(blocks), 1024):
        part = blocks[at : at + 1024] @ points
        best = np.abs(part).argmax(1)
        nearest[at : at + 1024] = 2 * best + (part[np.arange(len(part)), best] < 0)
    nearest = nearest.reshape(len(totals), THREES, 3)
    pairs = np.stack([nearest[:, :, i] << 12 | nearest[:, :, j] for i, j in ((0, 1), (0, 2), (1, 2))], 2).reshape(len(totals), -1)
    return (pairs | np.arange(3 * THREES) << 24).astype(np.uint32).view(np.int32)


def prints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(key, node, low, high, anchors array<int>): node is a digest of the set, low and high are fingerprint bits; the empty set has no anchor."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingles(t.as_py(), shingle) for t in part.column(1)]
                totals = np.stack([sums(s) for s in sets])
                signs = np.packbits(totals[:, :128] > 0, axis=1).view(np.int64)
                starts = np.cumsum([0, *(3 * THREES * (len(s) > 0) for s in sets)])
                homes = anchors(totals[[len(s) > 0 for s in sets]]).reshape(-1)
                columns = [pa.array([_digest(s) for s in sets], pa.int64()), pa.array(signs[:, 0]), pa.array(signs[:, 1])]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns, pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(homes))], [key, "node", "low", "high", "anchors"])

    return docs.select(F.col(key), F.col(text).cast("string").alias("text")).mapInArrow(run, f"{key} {kind}, node long, low long, high long, anchors array<int>")


def meeting(found: DataFrame) -> DataFrame:
    """(bucket, node) of the anchors at which several distinct sets are at home."""

    def run(batches):
        bucket, node, first = np.zeros(0, np.int32), np.zeros(0, np.int64), True
        for batch in batches:  # the last row waits for the next, with whether it is the first of its bucket
            bucket, node = (np.concatenate([x, batch.column(i).to_numpy()]) for i, x in enumerate((bucket, node)))
            if not len(bucket):
                continue
            new = np.concatenate([[first], bucket[1:] != bucket[:-1]])
            yes = ~new[:-1] | ~new[1:]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[:-1][yes]), pa.array(node[:-1][yes])], ["bucket", "node"])
            bucket, node, first = bucket[-1:], node[-1:], bool(new[-1])
        if not first:
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(node)], ["bucket", "node"])

    homes = found.dropDuplicates(["node"]).select(F.explode("anchors").alias("bucket"), "node")
    return homes.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "bucket int, node long")


def _close(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of one anchor's fingerprints have another within FAR bits."""
    if len(low) > CROWD:
        return np.ones(len(low), bool)
    differ = np.bitwise_count(low[:, None] ^ low) + np.bitwise_count(high[:, None] ^ high)
    return (differ <= FAR).sum(1) > 1  # itself is one


def close(met: DataFrame, found: DataFrame) -> DataFrame:
    """The (bucket, node) of ``met`` whose fingerprint is near another's at the same anchor; all of an anchor with over CROWD sets."""

    def run(batches):
        held = None

        def done(rows: pa.RecordBatch) -> pa.RecordBatch:
            bucket = rows.column("bucket").to_numpy()
            low, high = (rows.column(k).to_numpy().view(np.uint64) for k in ("low", "high"))
            cut = np.flatnonzero(np.diff(bucket)) + 1
            starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(bucket)]])
            yes = np.zeros(len(bucket), bool)
            two = starts[ends - starts == 2]
            yes[two] = yes[two + 1] = np.bitwise_count(low[two] ^ low[two + 1]) + np.bitwise_count(high[two] ^ high[two + 1]) <= FAR
            for a, b in zip(*(x[ends - starts > 2].tolist() for x in (starts, ends)), strict=True):
                yes[a:b] = _close(low[a:b], high[a:b])
            return rows.select(["bucket", "node"]).filter(pa.array(yes))

        for batch in batches:  # the last anchor waits for the next batch
            if not batch.num_rows:
                continue
            rows = pa.concat_batches([held, batch]) if held is not None else batch
            bucket = rows.column("bucket").to_numpy()
            last = int(np.searchsorted(bucket, bucket[-1]))
            if last:
                yield done(rows.slice(0, last))
            held = rows.slice(last)
        if held is not None:
            yield done(held)

    bits = found.groupBy("node").agg(F.min("low").alias("low"), F.min("high").alias("high"))
    return met.join(bits, "node").select("bucket", "node", "low", "high").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "bucket int, node long")


def _digest(found: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).astype(np.int64))


def sets_of(docs: DataFrame, wanted: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """(node, shingles binary) of the ``wanted`` (key, node); made anew from the texts, as the sets of all would be larger than those."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingles(t.as_py(), shingle) for t in part.column(1)]
                right = pa.array([_digest(s) == n.as_py() for s, n in zip(sets, part.column(0), strict=True)], pa.bool_())  # a repeated key may have another text
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"]).filter(right)

    texts = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).join(wanted, "key").select("node", "text")
    return texts.mapInArrow(run, "node long, shingles binary").groupBy("node").agg(F.first("shingles").alias("shingles"))


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sorted sets are at least so similar."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared >= similarity * (len(both) - shared)


def _with_sets(pairs: DataFrame, sets) -> tuple[DataFrame, DataFrame]:
    """``pairs`` with the sets of both ends as a and b, and the written table of these sets; ``sets`` gives (node, shingles) of a table of nodes."""
    known = materialize(sets(pairs.select(F.explode(F.array("src", "dst")).alias("node")).distinct()), "candidate-sets")
    joined = pairs.join(known.select(F.col("node").alias("src"), F.col("shingles").alias("a")), "src").join(known.select(F.col("node").alias("dst"), F.col("shingles").alias("b")), "dst")
    return joined.select("src", "dst", "a", "b"), known


def verified(pairs: DataFrame, sets, similarity: float) -> DataFrame:
    """The distinct (src, dst) of ``pairs`` that are similar."""
    joined, known = _with_sets(materialize(pairs.distinct(), "candidates"), sets)

    def run(batches):
        for batch in batches:
            yes = [similar(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64), similarity) for a, b in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select(["src", "dst"]).filter(pa.array(yes, pa.bool_()))

    out = materialize(joined.mapInArrow(run, "src long, dst long"), "verified-links")
    discard(known)
    return out


def measured(pairs: DataFrame, sets, similarity: float) -> DataFrame:
    """(src, dst, linked, size, common, outside, holds) of the distinct ``pairs``: dst's size, what it shares with src, its shingles that src lacks, and a bit for each of src's shingles that it holds."""
    joined, known = _with_sets(materialize(pairs.distinct(), "candidates"), sets)

    def run(batches):
        for batch in batches:
            rows = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                lacks = np.setdiff1d(b, a, assume_unique=True)
                holds = np.packbits(np.isin(a, b, assume_unique=True)).tobytes()
                rows.append((similar(a, b, similarity), len(b), len(b) - len(lacks), lacks.view(np.int64), holds))
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["src", "dst", "linked", "size", "common", "outside", "holds"])

    out = materialize(joined.mapInArrow(run, "src long, dst long, linked boolean, size long, common long, outside array<long>, holds binary"), "measured-pairs")
    discard(known)
    return out


def _together(parts: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many values each two of the sets share."""
    n = len(parts)
    out = np.zeros((n, n), np.float32)
    member = np.repeat(np.arange(n), [len(p) for p in parts])
    if not len(member):
        return out
    _, first, place, many = np.unique(np.concatenate(parts), return_index=True, return_inverse=True, return_counts=True)
    keep = many[place] > 1
    member, place = member[keep], first[place[keep]]  # values in the order of their first member, so that those of one few members lie together
    _, place = np.unique(place, return_inverse=True)
    order = np.argsort(place, kind="stable")
    member, place = member[order], place[order]
    for at in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        own = slice(*np.searchsorted(place, [at, at + width]))
        rows, row = np.unique(member[own], return_inverse=True)
        grid = np.zeros((len(rows), width), np.float32)
        grid[row, place[own] - at] = 1
        out[np.ix_(rows, rows)] += grid @ grid.T
    return out


def _both_hold(holds: list[bytes], width: int = 512) -> np.ndarray:
    """How many of the pivot's shingles each two members share, from their bits."""
    bits = np.frombuffer(b"".join(holds), np.uint8).reshape(len(holds), -1)
    out = np.zeros((len(holds), len(holds)), np.float32)
    for at in range(0, bits.shape[1], width):
        grid = np.unpackbits(bits[:, at : at + width], axis=1).astype(np.float32)
        out += grid @ grid.T
    return out


def _meetings(part: dict[str, list], similarity: float) -> list[tuple[int, int]]:
    """(row, row) of the members of one pivot that may be links of different components; of links that are certain, those of a spanning forest."""
    size, common = (np.array(part[k], np.float32) for k in ("size", "common"))
    outside = [np.array(x, np.int64) for x in part["outside"]]
    _, component = np.unique(np.array(part["component"], np.int64), return_inverse=True)
    block = np.array(part["block"], np.int64)
    rest = size - common
    listed = np.array([len(x) for x in outside]) == rest
    certain = listed[:, None] & listed & ("holds" in part)
    shared = _together(outside)
    most = np.where(listed[:, None] & listed, shared, np.where(shared > 0, np.minimum(rest[:, None], rest), 0))
    del shared
    most += _both_hold(part["holds"]) if "holds" in part else np.minimum(common[:, None], common)
    need = similarity / (1 + similarity) * (size[:, None] + size)
    certain &= most >= need * (1 + 1e-6)
    yes = most >= need * (1 - 1e-6) - 1e-2
    yes &= component[:, None] != component
    if len(set(part["low"] + part["high"])) > 1:
        yes &= block[:, None] != block
    yes = np.triu(yes)
    root = list(range(len(size)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    i, j = np.nonzero(yes & certain)
    _, one = np.unique(component[i] * len(size) + component[j], return_index=True)
    for i, j in zip(i[one].tolist(), j[one].tolist(), strict=True):
        if (a := find(component[i])) != (b := find(component[j])):
            root[a] = b
            out.append((i, j))
    whole = np.array([find(c) for c in component])
    i, j = np.nonzero(yes & ~certain & (whole[:, None] != whole))
    return out + list(zip(i.tolist(), j.tolist(), strict=True))


def possible(around: DataFrame, similarity: float, rows: int = BLOCK_ROWS) -> DataFrame:
    """(src, dst) that may be links of different components among the members of each pivot and connect all that are.

    ``around`` is (pivot, node, component, linked, size, common, outside), with the bits ``holds``
    where known; outside are all shingles that the pivot lacks, or the first (1 - s) * n + 1. The members of a pivot are compared in blocks of about ``rows``, each two blocks in a task.
    """
    loads = around.groupBy("pivot").agg(F.greatest(F.count("*") / rows, F.sum(F.size("outside")) / (rows * BLOCK_SHINGLES)).alias("load"))
    dealt = around.join(loads.select("pivot", F.ceil("load").cast("int").alias("blocks")), "pivot").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.greatest(F.col("blocks"), F.lit(1)) - 1)))
    names = ["component", "size", "common", "outside", "block", "low", "high", *(["holds"] if "holds" in around.columns else [])]
    pairs = pairs.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).select("pivot", "node", *names)

    def run(table: pa.Table) -> pa.Table:
        node = table.column("node").to_pylist()
        part = {k: table.column(k).to_pylist() for k in names if k != "outside"}
        outside = table.column("outside").combine_chunks()
        part["outside"] = np.split(outside.flatten().to_numpy(), np.cumsum(outside.value_lengths().to_numpy())[:-1])
        found = _meetings(part, similarity)
        ends = [sorted((node[i], node[j])) for i, j in found]
        return pa.table([pa.array([e[k] for e in ends], pa.int64()) for k in (0, 1)], ["src", "dst"])

    return pairs.groupBy("pivot", "low", "high").applyInArrow(run, "src long, dst long").distinct()


def stars(met: DataFrame) -> DataFrame:
    """(src, dst): the pivot of each anchor of ``met`` with every other member of it, once.

    The heaviest set meets most others. A member's home is the heaviest of all it meets, an anchor's
    pivot the heaviest of its members' homes, which need not be at home there itself. So the anchors
    of one group nearly all have one pivot, where each of them having its own heaviest member as
    pivot would pair a set with most of those that it meets.
    """
    sizes = met.groupBy("bucket").agg(F.count("*").alias("n"))
    weights = met.join(sizes, "bucket").groupBy("node").agg(F.sum("n").alias("weight"))
    tops = met.join(weights, "node").groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("top"))
    homes = met.join(tops, "bucket").groupBy("node").agg(F.max("top").alias("home"))
    pivots = met.join(homes, "node").groupBy("bucket").agg(F.max("home")["node"].alias("src"))
    return met.join(pivots, "bucket").where("src <> node").select("src", F.col("node").alias("dst")).distinct()


def links(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(src, dst): verified links between distinct sets that connect all that are similar. ``found`` is :func:`prints` of ``docs``."""
    if similarity < SIMILARITY:
        raise ValueError(f"the anchor tables are made for a similarity of {SIMILARITY} or more")
    heads = found.groupBy("node").agg(F.min(key).alias("key"))

    def sets(nodes: DataFrame) -> DataFrame:
        return sets_of(docs, materialize(heads.join(nodes, "node", "left_semi").select("key", "node"), "wanted"), key, text, shingle)

    met = materialize(meeting(found), "anchor-meetings")
    shared = materialize(close(met, found), "near-meetings")
    discard(met)
    near = measured(stars(shared), sets, similarity)
    first = near.where("linked").select("src", "dst")
    part = connected_components(first)
    placed = near.join(part.withColumnRenamed("node", "dst"), "dst", "left").select(F.col("src").alias("pivot"), F.col("dst").alias("node"), F.coalesce("component", "dst").alias("component"), "linked", "size", "common", "outside", "holds")
    placed = materialize(placed, "placed-pairs")
    several = placed.groupBy("pivot").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("pivot")
    met = possible(materialize(placed.join(several, "pivot"), "around-pivots"), similarity)
    done = near.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    second = verified(met.join(done, ["src", "dst"], "left_anti"), sets, similarity)
    return first.unionByName(second)


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(key, node, component_id): component_id is the smallest key that is reachable over links."""
    found = materialize(prints(docs.where(F.col(key).isNotNull()), key, text, shingle), "set-prints")
    groups = connected_components(links(docs, found, key, text, shingle, similarity))
    first = found.groupBy("node").agg(F.min(key).alias("first"))
    labelled = materialize(first.join(groups, "node", "left").select("node", "first", F.coalesce("component", "node").alias("component")), "near-sets")
    least = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    return found.select(key, "node").join(labelled.join(least, "component").select("node", "component_id"), "node").select(key, "node", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that stand for their component: those with its smallest key, once each, and rows without a key."""
    kept = components(docs, key, **options).where(F.col(key) == F.col("component_id")).select(key).distinct()
    whole = docs.where(F.col(key).isNotNull()).join(kept, key, "left_semi").dropDuplicates([key])
    return whole.unionByName(docs.where(F.col(key).isNull())).select(docs.columns)
