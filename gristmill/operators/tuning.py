"""Rows for tuning: facts and their corruption, variants, preference pairs, synthesis, mixing, tokens, blocks, budgets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions.buffers import flat_bytes
from gristmill.functions.text import _text, bound, strip
from gristmill.operators.evaluate import hash_fraction

# What makes a sentence a fact and a line a detail, where sentences end, how much of a text is looked at.
FACT = r"[\d%]|「[^」]+」|“[^”]+”"
DETAIL = r"[\d%「」“”]"
SENTENCE_END = r"(?<=[。！？])"
SOURCE_CHARS = 500
FACT_CHARS = 15
# Lead-ins of a paraphrase and marks that may end a text.
LEADS = ("该条目：", "具体而言，", "概述：")
END_MARKS = "。．.!?！？：:;"
_BLOCKS_AT_ONCE = 1024


def facts(text: Column) -> Column:
    """Sentences of the text's first characters, without its first line, that are long enough and hold a number, a percentage or a quotation."""
    lines = F.split(F.substring(_text(text), 1, SOURCE_CHARS), "\n")
    rest = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    said = F.transform(F.flatten(F.transform(rest, lambda x: F.split(x, SENTENCE_END))), strip)
    return F.filter(said, lambda s: (F.length(s) >= FACT_CHARS) & s.rlike(FACT))


def swap_number(sentence: Column) -> Column:
    """The first number with another last digit: the same length, never the same value."""
    digit = F.regexp_extract(sentence, r"^\D*\d*(\d)", 1)
    head = F.regexp_extract(sentence, r"(?s)^(\D*\d*)\d", 1)
    tail = F.substring(sentence, F.length(head) + 2, F.length(sentence))
    return F.when(digit == "", sentence).otherwise(F.concat(head, F.pmod(digit.cast("int") + 1, F.lit(10)).cast("string"), tail))


def corrupt_facts(rows: DataFrame, key: str, column: str, seed: int = 0) -> DataFrame:
    """``rows`` with (kind, corrupted): by hash one of number_swap, hallucinate (a fact of another row) and omit.

    The foreign fact is that of the next row with facts in the order of hashes within 256 hash groups, the group's first for its last.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    d = rows.where(F.size(column) > 0).withColumn("_h", h).withColumn("_g", F.substring("_h", 1, 2))
    w = Window.partitionBy("_g").orderBy("_h", key)
    first = F.get(F.col(column), F.lit(0))
    d = d.withColumn("_next", F.coalesce(F.lead(first).over(w), F.first(first).over(w)))
    pick = F.pmod(F.conv(F.substring("_h", 3, 6), 16, 10).cast("int"), F.lit(3))
    kind = F.get(F.array(F.lit("number_swap"), F.lit("hallucinate"), F.lit("omit")), pick)
    changed = F.when(pick == 0, F.transform(column, lambda x, i: F.when(i == 0, swap_number(x)).otherwise(x))).when(pick == 1, F.concat(F.array("_next"), column)).otherwise(F.slice(column, F.lit(1), F.greatest(F.size(column) - 1, F.lit(1))))
    return d.select(*rows.columns, kind.alias("kind"), changed.alias("corrupted"))


def variants(text: Column) -> Column:
    """A struct (s, f): title and lead against the whole text; null without three lines or a detail after the lead."""
    return bound(F.filter(F.split(_text(text), "\n"), lambda x: strip(x) != ""), lambda x: F.when((F.size(x) >= 3) & F.exists(F.slice(x, F.lit(3), F.greatest(F.size(x), F.lit(1))), lambda p: p.rlike(DETAIL)), F.struct(F.concat(F.get(x, F.lit(0)), F.lit("\n\n"), F.get(x, F.lit(1))).alias("s"), _text(text).alias("f"))))


def placed_pairs(pairs: DataFrame, key: str, good: str, bad: str, seed: int = 0) -> DataFrame:
    """(key, a, b, chosen): the better one stands first or second, half and half by hash."""
    first = hash_fraction(F.concat(F.lit(f"{seed}:place:"), F.col(key).cast("string"))) < 0.5
    return pairs.select(key, F.when(first, F.col(good)).otherwise(F.col(bad)).alias("a"), F.when(first, F.col(bad)).otherwise(F.col(good)).alias("b"), F.when(first, "a").otherwise("b").alias("chosen"))


def preference_split(pairs: DataFrame, key: str, holdout: float = 0.25, controls: float = 0.1, least: int = 80, seed: int = 0) -> DataFrame:
    """``pairs`` with split (train or eval) and is_control, by hash; too few pairs raise."""
    if pairs.count() < least:
        raise ValueError(f"fewer than {least} pairs")
    u = lambda what: hash_fraction(F.concat(F.lit(f"{seed}:{what}:"), F.col(key).cast("string")))
    split = F.when(u("split") < holdout, "eval").otherwise("train")
    return pairs.withColumn("split", split).withColumn("is_control", (u("control") < controls) & (F.col("split") == "train"))


def paraphrase(text: Column, lead: Column) -> Column:
    """Clauses between commas moved on by one place, behind a lead-in (the one that is there, else ``lead``); texts of one clause only lose outer space."""
    t = strip(text)
    tail = F.regexp_extract(t, f"[{END_MARKS}]*$", 0)
    body = F.substring(t, F.lit(1), F.length(t) - F.length(tail))
    there = F.regexp_extract(body, "^(" + "|".join(LEADS) + ")", 1)
    rest = F.substring(body, F.length(there) + 1, F.length(body))
    clauses = F.filter(F.transform(F.split(rest, "[，,]"), strip), lambda x: x != "")
    return bound(clauses, lambda c: F.when(F.size(c) >= 2, F.concat(F.when(there == "", lead).otherwise(there), F.array_join(F.concat(F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(1))), F.slice(c, F.lit(1), F.lit(1))), "，"), tail)).otherwise(F.concat(rest, tail)))


def synthesise(df: DataFrame, kinds: dict[str, tuple[float, object]], coverage: float, each: int, key: str = "id", text: str = "text", seed: int = 0) -> DataFrame:
    """Originals and, of a hash-chosen share, ``each`` variants: (id, text, synthesized_by, source_id); variants that change nothing are left out.

    ``kinds`` maps names to (weight, expression of the text); a variant's kind is drawn by weight.
    """
    base = df.select(F.col(key).cast("string").alias("id"), F.col(text).alias("text"))
    u = lambda *what: hash_fraction(F.concat_ws(":", F.lit(str(seed)), *what))
    chosen = base.where(u(F.lit("pick"), F.col("id")) < coverage).select("*", F.explode(F.sequence(F.lit(0), F.lit(each - 1))).alias("i"))
    total, upto, kind, body = sum(w for w, _ in kinds.values()), 0.0, None, None
    draw = u(F.lit("kind"), F.col("id"), F.col("i").cast("string"))
    for name, (weight, make) in kinds.items():
        upto += weight / total
        here = draw < upto if upto < 1 - 1e-9 else F.lit(True)
        kind = F.when(here, F.lit(name)) if kind is None else kind.when(here, F.lit(name))
        body = F.when(here, make(F.col("text"))) if body is None else body.when(here, make(F.col("text")))
    made = chosen.select(F.concat_ws("::", "id", kind, F.col("i").cast("string")).alias("id"), body.alias("new"), kind.alias("synthesized_by"), F.col("id").alias("source_id"), "text")
    made = made.where(~F.col("new").eqNullSafe(F.col("text"))).select("id", F.col("new").alias("text"), "synthesized_by", "source_id")
    none = F.lit(None).cast("string")
    return base.select("id", "text", none.alias("synthesized_by"), none.alias("source_id")).unionByName(made)


def mix(df: DataFrame, source: str, weights: dict[str, float], key: str, size: int | None = None) -> DataFrame:
    """Rows of the named sources in the ratio of ``weights``: as many as the scarcest source allows (or ``size``), chosen by hash.

    Only the sources' counts reach the driver. A threshold on the hash, from exact counts of its first
    digits, leaves about the wanted rows before they are ranked, so a large source is not ranked whole.
    """
    have = {r[0]: r[1] for r in df.where(F.col(source).isin(*weights)).groupBy(source).count().collect()}
    total = sum(weights.values())
    most = min((have.get(s, 0) * total / w for s, w in weights.items() if w > 0), default=0)
    n = int(min(most, size) if size is not None else most)
    want = {s: int(n * w / total) for s, w in weights.items()}
    h = F.md5(F.concat(F.lit("mix:"), F.col(key).cast("string")))
    d = df.withColumn("_h", h).where(F.col(source).isin(*weights))
    quota = F.create_map(*(x for s, k in want.items() for x in (F.lit(s), F.lit(k))))
    digits = d.groupBy(source, F.substring("_h", 1, 3).alias("_p")).agg(F.count("*").alias("c"))  # 4096 rows a source
    upto = digits.withColumn("_before", F.sum("c").over(Window.partitionBy(source).orderBy("_p")) - F.col("c"))
    near = upto.where(F.col("_before") < F.element_at(quota, F.col(source))).select(source, "_p", "_before")
    d = d.withColumn("_p", F.substring("_h", 1, 3)).join(F.broadcast(near), [source, "_p"])
    rank = F.row_number().over(Window.partitionBy(source, "_p").orderBy("_h", key)) + F.col("_before")
    return d.withColumn("_r", rank).where(F.col("_r") <= F.element_at(quota, F.col(source))).select(*df.columns)


def byte_tokens(text: Column, most: int) -> Column:
    """The text's first ``most`` bytes as numbers: the tokenizer that is always there. No other bytes reach Python."""

    @F.arrow_udf("array<int>")
    def tokens(column: pa.Array) -> pa.Array:
        data, offsets = flat_bytes(column)
        at = offsets[0]
        return pa.ListArray.from_arrays((offsets - at).astype(np.int32), data[at : offsets[-1]].astype(np.int32))

    return tokens(F.substring(text.cast("string").cast("binary"), 1, most))


def pack_blocks(rows: DataFrame, key: str, tokens: str, split: str, block: int, eos: int, shard_rows: int = 20_000) -> DataFrame:
    """(split, shard, block_id, input_ids, loss_mask, n_real): next-fit with an end after each text, never across splits.

    A longer sequence closes the open block, is cut into whole blocks, and its rest is
    left out; the last block of a shard is padded with ``eos`` under a mask of 0. A shard holds about
    ``shard_rows`` texts in the order of their keys, null last, and equal keys in that of their tokens. Shards
    are sorted by Spark and pass through Python as they come: it holds a batch, the open block and
    ``_BLOCKS_AT_ONCE`` closed ones.
    """
    shards = max(1, -(-rows.count() // shard_rows))
    d = rows.select(F.col(key).cast("string").alias("key"), F.col(tokens).alias("tokens"), F.col(split).alias("split")).withColumn("shard", F.pmod(F.xxhash64("key", F.lit(3)), F.lit(shards)).cast("int"))
    end = np.array([eos], np.int32)

    def table(done: list) -> pa.RecordBatch:
        real = np.array([len(ids) for *_, ids in done], np.int32)
        ids = np.full((len(done), block), eos, np.int32)
        for row, (*_, own) in zip(ids, done):
            row[: len(own)] = own
        mask = (np.arange(block) < real[:, None]).astype(np.int32)
        ends = np.arange(len(done) + 1, dtype=np.int32) * block
        lists = (pa.ListArray.from_arrays(ends, x.ravel()) for x in (ids, mask))
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int32()), pa.array([x[2] for x in done], pa.int32()), *lists, pa.array(real)], names=["split", "shard", "block_id", "input_ids", "loss_mask", "n_real"])

    def run(batches):
        group, cur, size, n, done = None, [], 0, 0, []

        def close(ids):
            nonlocal n
            done.append((*group, n, ids))
            n += 1

        for batch in batches:
            column = batch["tokens"]
            lengths = column.value_lengths().fill_null(0).to_numpy()
            values, to = column.flatten().to_numpy().astype(np.int32, copy=False), np.cumsum(lengths)
            for now, lo, hi in zip(zip(batch["split"].to_pylist(), batch["shard"].to_pylist()), to - lengths, to):
                if now != group:
                    if cur:
                        close(np.concatenate(cur))
                    group, cur, size, n = now, [], 0, 0
                seq = np.concatenate([values[lo:hi], end])
                if cur and size + len(seq) > block:
                    close(np.concatenate(cur))
                    cur, size = [], 0
                if len(seq) > block:
                    for i in range(0, len(seq) - block + 1, block):
                        close(seq[i : i + block])
                else:
                    cur.append(seq)
                    size += len(seq)
                while len(done) >= _BLOCKS_AT_ONCE:
                    yield table(done[:_BLOCKS_AT_ONCE])
                    del done[:_BLOCKS_AT_ONCE]
        if cur:
            close(np.concatenate(cur))
        if done:
            yield table(done)

    by_shard = d.repartition("split", "shard").sortWithinPartitions("split", "shard", F.col("key").asc_nulls_last(), "tokens")
    return by_shard.select("split", "shard", "tokens").mapInArrow(run, "split string, shard int, block_id int, input_ids array<int>, loss_mask array<int>, n_real int")


def running_total(df: DataFrame, order: str, cost: str, ranges: int = 64) -> DataFrame:
    """``df`` with spent_before: the sum of ``cost`` over all rows before, by ranges of the order and their totals, so that no task orders all rows."""
    edges = sorted(set(df.approxQuantile(order, [i / ranges for i in range(1, ranges)], 0.25 / ranges)))
    d = df.withColumn("_range", F.array_size(F.filter(F.array(*(F.lit(e) for e in edges)), lambda e: e <= F.col(order)))) if edges else df.withColumn("_range", F.lit(0))
    sums = d.groupBy("_range").agg(F.sum(cost).alias("s"))
    before = sums.select("_range", (F.sum("s").over(Window.orderBy("_range")) - F.col("s")).alias("_before"))  # ``ranges`` rows
    own = F.sum(cost).over(Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return d.join(F.broadcast(before), "_range").withColumn("spent_before", F.col("_before") + F.coalesce(own, F.lit(0))).drop("_range", "_before")


def degrade(df: DataFrame, order: str, cost: str, budget: int) -> DataFrame:
    """``df`` with spent_before and asked: a row is asked while what all rows before it wanted leaves room for it (the cumulative reading of the budget)."""
    return running_total(df, order, cost).withColumn("asked", F.col("spent_before") + F.col(cost) <= budget)
