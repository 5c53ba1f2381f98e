"""Training-set production: splits, leakage, decontamination, corruption for tests, routing and lineage."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import uniform
from gristmill.operators.dedup import signatures
from gristmill.operators.evaluate import hash_fraction
from gristmill.plans.store import materialize


NEAR_ROWS = 8  # minima a table of near leaks: 93 tables at 0.8


def split(key: Column, val: float = 0.1, test: float = 0.1) -> Column:
    """train, val or test, fixed by the key."""
    u = hash_fraction(key)
    return F.when(u < val, "val").when(u < val + test, "test").otherwise("train")


def cross_leaks(df: DataFrame, id_col: str, text: str, split_col: str) -> DataFrame:
    """(digest, splits, n): equal texts that lie in more than one split. Digests are counted before the shuffle."""
    g = df.groupBy(F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest")).agg(F.array_sort(F.collect_set(split_col)).alias("splits"), F.count(id_col).alias("n"))
    return g.where(F.size("splits") > 1)


def _sketched(reps: DataFrame, num_perm: int, rows: int, threshold: float, miss: float) -> tuple[DataFrame, list[str]]:
    """``reps`` with a sketch (the lowest two bits of all minima, as longs) and ``wide``, a bucket in each of several tables; and the sketch's columns.

    A table's bucket is of ``rows`` minima, parts of shuffled ones; there are so many tables that a pair
    at ``threshold`` is missed with a probability of at most ``miss``.
    """
    tables = math.ceil(math.log(miss) / math.log1p(-(threshold**rows)))
    rng = np.random.default_rng([num_perm, rows])
    parts = num_perm // rows
    picks = np.concatenate([rng.permutation(num_perm)[: parts * rows].reshape(parts, rows) for _ in range(-(-tables // parts))])[:tables]
    factor = rng.integers(0, 1 << 63, picks.shape, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    salt = rng.integers(0, 1 << 64, tables, dtype=np.uint64)
    longs = -(-num_perm // 64)
    names = [f"bits{lane}_{i}" for lane in (0, 1) for i in range(longs)]

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                sig = part["sig"].flatten().to_numpy().reshape(len(part), num_perm)
                bits = np.zeros((2, len(part), longs * 64), np.uint8)
                bits[:, :, :num_perm] = sig & 1, sig >> 1 & 1
                sketch = np.packbits(bits, axis=2).view(np.int64)
                wide = np.stack([(sig[:, p].astype(np.uint64) * f).sum(1) + x for p, f, x in zip(picks, factor, salt)], 1)
                ends = np.arange(len(part) + 1, dtype=np.int32) * tables
                yield pa.RecordBatch.from_arrays([part["rep"], part["sig"], *(pa.array(c) for c in np.concatenate(sketch.transpose(0, 2, 1))), pa.ListArray.from_arrays(ends, wide.view(np.int64).ravel())], names=["rep", "sig", *names, "wide"])

    kind = reps.schema["rep"].dataType.simpleString()
    return reps.select("rep", "sig").mapInArrow(run, f"rep {kind}, sig array<int>, {', '.join(f'{c} long' for c in names)}, wide array<long>"), names


def _meet(held: DataFrame, known: DataFrame, bits: list[str], most: int) -> DataFrame:
    """(rep, item) that share a bucket and whose sketches ``bits`` differ in at most ``most`` places, judged within the join."""
    half = len(bits) // 2
    lanes = ([F.col(f"h.{x}").bitwiseXOR(F.col(f"k.{x}")) for x in part] for part in (bits[:half], bits[half:]))
    apart = sum((F.bit_count(x.bitwiseOR(y)) for x, y in zip(*lanes)), F.lit(0))
    return held.alias("h").join(known.alias("k"), (F.col("h.bucket") == F.col("k.bucket")) & (apart <= most)).select("rep", "item")


def near_matches(held: DataFrame, known: DataFrame, threshold: float, bands: int = 32, num_perm: int = 128, wide_rows: int = 4) -> DataFrame:
    """(id, item, score): every row of ``held`` that is near some row of ``known``, with one such row. Both have id and text.

    Near is a share of equal minima of at least ``threshold``, over whole texts. Equal signatures are
    one vertex, and each is first compared with the least known one of its buckets; only what is near
    none of these meets all others, so large groups of copies are settled in one step. With 32
    bands of 4 a pair of 0.8 is missed with a probability of 4 in 10^8, one of 0.65 with 0.2 per
    cent. The others are met in tables of ``wide_rows`` minima, as many as miss no more; more minima
    bring fewer unlike texts together and take more tables. Who meets is compared within the join by
    two bits of each minimum: where they differ the minima do, so that a pair with more such places than a
    near one can have never leaves it. Null and empty texts are equal to each other, null ids take no
    part, and an empty side gives an empty result.
    """
    rows = num_perm // bands
    miss = (1 - threshold**rows) ** bands
    most = num_perm - next(n for n in range(num_perm + 1) if n / num_perm >= threshold)
    hsig, ksig = (materialize(signatures(d.where("id is not null"), num_perm=num_perm), "signatures") for d in (held, known))
    (hrep, bits), (krep, _) = (_sketched(d.groupBy("sig").agg(F.min("id").alias("rep")), num_perm, wide_rows, threshold, miss) for d in (hsig, ksig))
    hrep, krep = materialize(hrep, "reps"), materialize(krep.withColumnRenamed("rep", "item"), "reps")
    keys = F.explode(F.array(*(F.xxhash64(F.lit(i), F.slice("sig", i * rows + 1, rows)) for i in range(bands)))).alias("bucket")
    wide = F.explode("wide").alias("bucket")
    same = F.size(F.filter(F.zip_with("a", "b", lambda x, y: x == y), lambda x: x)) / F.lit(float(num_perm))

    def near(hkey: DataFrame, kkey: DataFrame) -> DataFrame:
        pairs = _meet(hkey, kkey, bits, most).distinct()
        a, b = hrep.select("rep", F.col("sig").alias("a")), krep.select("item", F.col("sig").alias("b"))
        return materialize(pairs.join(a, "rep").join(b, "item").select("rep", "item", same.alias("score")).where(F.col("score") >= threshold), "near")

    least = krep.select("item", *bits, keys).groupBy("bucket").agg(F.min(F.struct("item", *bits)).alias("m")).select("bucket", "m.*")
    first = near(hrep.select("rep", *bits, keys), least)
    unsettled = hrep.join(first.select("rep").distinct(), "rep", "left_anti")
    second = near(unsettled.select("rep", *bits, wide), krep.select("item", *bits, wide))
    best = first.unionByName(second).groupBy("rep").agg(F.min(F.struct((-F.col("score")).alias("less"), "item")).alias("m"))
    heads = hrep.select("rep", "sig")
    return hsig.join(heads, "sig").join(best, "rep").select("id", F.col("m.item").alias("item"), (-F.col("m.less")).alias("score"))


def near_leaks(df: DataFrame, id_col: str, text: str, split_col: str, train: str = "train", threshold: float = 0.8) -> DataFrame:
    """(id, split, item, score): rows outside ``train`` that are near a train row (see :func:`near_matches`), equal texts included. A null split is outside."""
    named = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"), F.col(split_col).alias("split"))
    inside = F.col("split").eqNullSafe(train)
    found = near_matches(named.where(~inside), named.where(inside), threshold, wide_rows=NEAR_ROWS)
    return named.where(~inside).select("id", "split").distinct().join(found.distinct(), "id").select("id", "split", "item", "score")


def decontaminate(incoming: DataFrame, benchmark: DataFrame, threshold: float = 0.65, min_chars: int = 8) -> DataFrame:
    """(id, item, method, score) for incoming rows that equal or nearly equal a benchmark item; exact matches come first.

    Both have id and text. Benchmark texts of fewer than ``min_chars`` characters match only as equal texts.
    """
    h = F.md5(F.coalesce(F.col("text"), F.lit("")))
    items = benchmark.groupBy(h.alias("h")).agg(F.min("id").alias("item"))
    exact = incoming.select("id", h.alias("h")).join(items, "h").select("id", "item", F.lit("exact").alias("method"), F.lit(1.0).alias("score"))
    near = near_matches(incoming, benchmark.where(F.length("text") >= min_chars), threshold).select("id", "item", F.lit("minhash").alias("method"), "score")
    both = exact.unionByName(near)
    return both.groupBy("id").agg(F.max_by(F.struct("item", "method", "score"), F.struct((F.col("method") == "exact").cast("int"), "score", F.col("item").cast("string"))).alias("m")).select("id", "m.*")


# ---------------------------------------------------------------- corruption with known truth

CORRUPTIONS = {
    "truncate_text": lambda t, u: F.substring(t, F.lit(1), F.greatest(F.lit(1), (F.length(t) * (0.1 + 0.3 * u)).cast("int"))),
    "paragraph_repeat": lambda t, u: F.concat_ws("\n", F.array_repeat(F.element_at(F.split(t, "\n"), 1), 4), t),
    "boilerplate_inject": lambda t, u: F.concat(t, F.lit("\n转载请注明出处。免责声明。")),
    "pii_inject": lambda t, u: F.concat(t, F.lit(" 138"), F.lpad((u * 99999999).cast("long").cast("string"), 8, "0")),
    "whitespace_pad": lambda t, u: F.regexp_replace(t, " ", "   "),
    "exact_duplicate": lambda t, u: t,
}


def contaminate(df: DataFrame, rate: float, kinds: tuple[str, ...] = tuple(CORRUPTIONS), seed: int = 0, id_col: str = "id", text: str = "text") -> DataFrame:
    """``df`` and, for a hash-chosen share of its rows, a corrupted copy: id ``<id>::<kind>``, ``dirty`` names the kind (null: clean)."""
    clean = df.select(F.col(id_col).cast("string").alias("id"), F.col(text).alias("text"), F.lit(None).cast("string").alias("dirty"))
    chosen = clean.where(uniform(F.col("id"), f"pick{seed}") < rate).withColumn("_k", F.floor(uniform(F.col("id"), f"kind{seed}") * len(kinds)).cast("int")).withColumn("_u", uniform(F.col("id"), f"amount{seed}"))
    body = F.col("text")
    for i, k in enumerate(kinds):
        body = F.when(F.col("_k") == i, CORRUPTIONS[k](F.col("text"), F.col("_u"))).otherwise(body)
    kind = F.get(F.array(*(F.lit(k) for k in kinds)), F.col("_k"))
    bad = chosen.select(F.concat_ws("::", "id", kind).alias("id"), body.alias("text"), kind.alias("dirty"))
    return clean.unionByName(bad)


def recall_by_kind(df: DataFrame, dropped: str = "dropped", dirty: str = "dirty") -> DataFrame:
    """(kind, n, caught, recall); clean rows appear as kind ``clean`` with what was wrongly dropped."""
    return df.groupBy(F.coalesce(dirty, F.lit("clean")).alias("kind")).agg(F.count("*").alias("n"), F.count_if(dropped).alias("caught"), F.round(F.avg(F.col(dropped).cast("double")), 6).alias("recall"))


# ---------------------------------------------------------------- routing and lineage

COSTS = {"rule": 1, "perceptual": 5, "model": 20, "llm": 50}  # fixed values: cost weights of the tiers


def route(score: Column, low: float, high: float) -> Column:
    """The most expensive tier is asked only where the cheap score is undecided; null is undecided."""
    return F.when(score.isNull() | ((score >= low) & (score < high)), F.lit("llm")).otherwise(F.lit("rule"))


def cost_estimate(df: DataFrame, tier: str) -> DataFrame:
    """(n, cost, full_cost, saved): against asking the llm for every row."""
    weights = F.create_map(*(x for k, v in COSTS.items() for x in (F.lit(k), F.lit(v))))
    c = df.agg(F.count("*").alias("n"), F.sum(F.lit(COSTS["rule"]) + F.when(F.col(tier) != "rule", F.element_at(weights, F.col(tier))).otherwise(0)).alias("cost"))
    full = F.col("n") * (COSTS["rule"] + COSTS["llm"])
    return c.select("n", "cost", full.alias("full_cost"), F.round(1 - F.try_divide("cost", full), 6).alias("saved"))


def lineage(verdicts: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of a verdict ledger: a job per operator, a verdict per row of it, used and wasGeneratedBy edges."""
    name = F.concat_ws(":", F.lit("verdict"), F.col(id_col).cast("string"), F.col("seq").cast("string"))
    entity, job = F.concat(F.lit("entity:"), F.col(id_col).cast("string")), F.concat(F.lit("op:"), F.col("op"))
    pair = lambda k, n: F.struct(F.lit(k).alias("kind"), n.alias("node"))
    nodes = verdicts.select(F.explode(F.array(pair("entity", entity), pair("job", job), pair("verdict", name))).alias("x")).select("x.*").distinct()
    edge = lambda a, k, b: F.struct(a.alias("src"), F.lit(k).alias("kind"), b.alias("dst"))
    return nodes, verdicts.select(F.explode(F.array(edge(job, "used", entity), edge(name, "wasGeneratedBy", job))).alias("x")).select("x.*").distinct()


__all__ = ["CORRUPTIONS", "contaminate", "cost_estimate", "cross_leaks", "decontaminate", "lineage", "recall_by_kind", "route", "split"]
