"""SimHash near-duplicate detection by anchor-point covering.

Fingerprints are 64 bits wide. Two blocks of 23 bits are each covered by the perfect binary
Golay code (12 bits of information, covering radius 3: every 23-bit word is within 3 bits of
exactly one code word), so the anchors are pairs of code words. A fingerprint is at home at
its nearest anchor, and is replicated to every anchor that a fingerprint within the threshold
could be at home at: for a difference of d1 bits in the first block and d2 in the second that
means code words within 3 + d1 and 3 + d2 bits, d1 + d2 <= threshold, and where a block does
not differ its nearest code word alone. Two fingerprints that link therefore always meet at
each other's home anchor, and only there they are compared.

Equal fingerprints are one vertex, so copies never multiply. An anchor with more than
``ANCHOR_ROWS`` visitors is not compared in one task: its fingerprints are linked through the
points within half the threshold instead (two fingerprints that share such a point link, and
two that link share one), as an aggregate that is combined before the shuffle. Both ways are
exact; within an anchor only a spanning forest of the links is passed on.

Edge cases: null and empty texts and texts without a word have fingerprint zero and link like
any other; fewer words than the shingle's make one shingle; repeated rows are equal
fingerprints; rows without an id are left out of components; an empty table gives an empty
result; extra columns are ignored by :func:`components` and kept by :func:`keep_one`.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.operators.graph import connected_components
from gristmill.plans.store import materialize

ANCHOR_ROWS = 20_000
BLOCK = 23
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The text's fingerprint as an unsigned number."""
    raw = (text or "").encode().translate(_LOWER)
    words = _WORDS.findall(raw)
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - shingle + 1
    bits = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, n, _SHINGLES_AT_ONCE):
        to = min(n, at + _SHINGLES_AT_ONCE)
        hashes = b"".join([digest(joined[a:b], seed) for a, b in zip(starts[at:to].tolist(), ends[at + shingle - 1 : to + shingle - 1].tolist(), strict=True)])
        bits += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > n).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(key, fp): fp holds the 64 bits as a signed long."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], [key, "fp"])

    return docs.select(F.col(key), F.col(text).cast("string").alias("text")).mapInArrow(run, f"{key} {kind}, fp long")


@functools.cache
def golay() -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(syndromes' leaders, per extra distance e = 0, 1, 2: starts by syndrome and the differences to code words within 3 + e bits)."""
    poly = 0b101011100011  # generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1

    words = np.zeros(1, np.int64)
    for i in range(12):
        words = np.concatenate([words, words ^ (poly << i)])
    light = words[np.bitwise_count(words) <= 8]  # a leader has 3 bits at most, so no heavier one comes within 5
    leaders = np.zeros(2048, np.int64)
    masks = [0, *(1 << i for i in range(BLOCK))]
    masks += [1 << i | 1 << j for i in range(BLOCK) for j in range(i)]
    masks += [1 << i | 1 << j | 1 << k for i in range(BLOCK) for j in range(i) for k in range(j)]
    leaders[syndrome(np.array(masks))] = masks
    lists = []
    for e in range(3):
        rows = [light[np.bitwise_count(light ^ leader) <= 3 + e] ^ leader for leader in leaders] if e else [leaders[i : i + 1] for i in range(2048)]
        lists.append((np.concatenate([[0], np.cumsum([len(r) for r in rows])]), np.concatenate(rows)))
    return leaders, lists


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit polynomials by the generator."""
    rest = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, 0b101011100011 << (bit - 11), 0)
    return rest


def _visits(block: np.ndarray, e: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, code word) for each row's code words within 3 + e bits; at e = 0 the nearest."""
    starts, differences = golay()[1][e]
    s = syndrome(block)
    many = starts[s + 1] - starts[s]
    rows = np.repeat(np.arange(len(block)), many)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many)
    return rows, block[rows] ^ differences[starts[s][rows] + within]


def anchors(fp: np.ndarray, threshold: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, is home) of every anchor that each fingerprint is at home at or visits."""
    bits = fp.view(np.uint64).astype(np.uint64)
    a = (bits & np.uint64((1 << BLOCK) - 1)).astype(np.int64)
    b = (bits >> np.uint64(BLOCK) & np.uint64((1 << BLOCK) - 1)).astype(np.int64)
    rows, found = [], []
    for d1 in range(threshold + 1):
        d2 = threshold - d1
        ra, ca = _visits(a, min(d1, 2))
        rb, cb = _visits(b, min(d2, 2))
        many = np.bincount(rb, minlength=len(fp))
        first = np.cumsum(many) - many
        pick = np.repeat(np.arange(len(ra)), many[ra])
        within = np.arange(len(pick)) - np.repeat(np.cumsum(many[ra]) - many[ra], many[ra])
        rows.append(ra[pick])
        found.append(ca[pick] << BLOCK | cb[first[ra[pick]] + within])
    rows, found = np.concatenate(rows), np.concatenate(found)
    order = np.lexsort((found, rows))
    rows, found = rows[order], found[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (found[1:] != found[:-1])
    rows, found = rows[new], found[new]
    home = _visits(a, 0)[1] << BLOCK | _visits(b, 0)[1]
    return rows, found, found == home[rows]


def forest(fps: np.ndarray, homes: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between fingerprints of one anchor, by way of those at home."""
    parent = list(range(len(fps)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    own = np.flatnonzero(homes)
    step = max(1, (1 << 20) // len(fps))
    for at in range(0, len(own), step):
        part = own[at : at + step]
        near = np.bitwise_count(fps[part][:, None] ^ fps[None, :]) <= threshold
        for i, j in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
            i = int(part[i])
            if i != j and (a := root(i)) != (b := root(j)):
                parent[a] = b
                out.append((i, j))
    return out


def links(distinct: DataFrame, threshold: int = 2, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """(src, dst): links between distinct fingerprints that connect all that link, and nothing else. ``distinct`` has fp."""
    if threshold not in (0, 2):
        raise ValueError("the threshold is 2 differing bits, or 0")

    def replicate(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy()
            for at in range(0, len(fp), 4096):
                rows, anchor, home = anchors(fp[at : at + 4096], threshold)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fp[at : at + 4096][rows]), pa.array(home)], ["anchor", "fp", "home"])

    def compare(batches):
        anchor, fp, home = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

        def done(anchor, fp, home):
            cut = np.flatnonzero(np.diff(anchor)) + 1
            starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(anchor)]])
            seen = np.concatenate([[0], np.cumsum(home)])
            pairs = []
            for a, b in zip(*(x[(ends - starts > 1) & (seen[ends] > seen[starts])].tolist() for x in (starts, ends)), strict=True):
                pairs += [(fp[a + i], fp[a + j]) for i, j in forest(fp[a:b].view(np.uint64), home[a:b], threshold)]
            src, dst = zip(*pairs, strict=True) if pairs else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], ["src", "dst"])

        for batch in batches:
            anchor, fp, home = (np.concatenate([x, batch.column(i).to_numpy(zero_copy_only=False)]) for i, x in enumerate((anchor, fp, home)))
            last = int(np.searchsorted(anchor, anchor[-1])) if len(anchor) else 0
            if last:
                yield done(anchor[:last], fp[:last], home[:last])
                anchor, fp, home = anchor[last:], fp[last:], home[last:]
        if len(anchor):
            yield done(anchor, fp, home)

    spark = distinct.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    visits = distinct.select("fp").repartition(parts, "fp").mapInArrow(replicate, "anchor long, fp long, home boolean")
    loads = visits.groupBy("anchor").count().where(F.col("count") > anchor_rows).select("anchor")
    hot = materialize(loads, "hot-anchors")
    edges = (
        visits.join(hot, "anchor", "left_anti").repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(compare, "src long, dst long")
        if hot.take(1)
        else visits.repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(compare, "src long, dst long")
    )
    if hot.take(1):
        crowded = visits.join(hot, "anchor", "left_semi").select("fp").distinct()
        flips = F.array(F.lit(0).cast("long"), *(F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64))) if threshold else F.array(F.lit(0).cast("long"))
        points = crowded.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
        least = points.groupBy("point").agg(F.min("fp").alias("src"), F.max("fp").alias("top")).where("src < top").select("point", "src")
        edges = edges.unionByName(points.join(least, "point").select("src", F.col("fp").alias("dst")).where("src <> dst").distinct())
    return edges


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, threshold: int = 2, seed: int = 42, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """(key, fp, component_id): component_id is the smallest key that is reachable over links."""
    fps = materialize(fingerprints(docs.where(F.col(key).isNotNull()), key, text, shingle, seed), "fingerprints")
    distinct = materialize(fps.groupBy("fp").agg(F.min(key).alias("first")), "distinct-fingerprints")
    groups = connected_components(links(distinct, threshold, anchor_rows))
    labelled = distinct.join(groups, distinct.fp == groups.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    least = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    by_fp = labelled.join(least, "component").select("fp", "component_id")
    return fps.join(by_fp, "fp").select(key, "fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that stand for their component: those with its smallest key, once each, and rows without a key."""
    kept = components(docs, key, **options).where(F.col(key) == F.col("component_id")).select(key).distinct()
    whole = docs.where(F.col(key).isNotNull()).join(kept, key, "left_semi").dropDuplicates([key])
    return whole.unionByName(docs.where(F.col(key).isNull())).select(docs.columns)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = components(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
