"""Language-model scores by context-tree weighting, beside a smoothed word-count base.

Every byte is eight binary decisions, each with a tree of its own over the preceding bytes.
A node keeps the Krichevsky-Trofimov estimate of its bits; a node's weighted probability is
half its own estimate and half the product of its children's, so all depths up to ``DEPTH``
are mixed. Counts come from every training text: each task counts byte strings of DEPTH + 1 and
Spark sums them, and every context that occurs is a node, so the model grows with the corpus.

The tree is weighted where its counts lie: they are dealt by the last two bytes of the context, each
task weights the subtrees of its contexts, the driver mixes the two levels above (65,793 contexts at
most), and a second pass brings the mixture down again. The result is a written table: for each
string that occurs the logarithm of its last byte's probability, and for each node the probability
where a deeper context has not been seen. The ``FREQUENT_STRINGS`` most frequent strings are
broadcast; the places of a text whose string is not among them meet the table in joins, and strings
that never occurred are put together from the deepest nodes that know them. A text is scored as its
bytes, A-Z lower-cased, and an end; ``bits_per_byte`` is its code length over these.

The base is a sum over tokens of log10((c + 1) / (N + V + 1)). Counts of the ``FREQUENT_WORDS``
most frequent words are broadcast; the other tokens meet their counts in a join.

Edge cases: a null text is an empty text: one token, the end; very long texts are scored in pieces
of one text each; with no training text at all every bit is 1/2 and c, N and V are 0; rows without
an id are scored, and learned from (crc32 of null is not 2); repeated rows score alike; strings and
words of equal frequency are broadcast together or not at all; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.buffers import lower_ascii, pieces
from gristmill.plans.store import discard, materialize

DEPTH = 5
FREQUENT_STRINGS = 1 << 20
FREQUENT_WORDS = 150_000
END = 0xFF  # occurs in no UTF-8 text; also stands before a text's first byte
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_COUNT_BYTES = 1 << 22

# ---------------------------------------------------------------- counting


def keys_of(data: np.ndarray, offsets: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """For each byte and end of the texts: the ``depth`` bytes before it and itself, as one number."""
    n = len(offsets) - 1
    marks = np.full(len(data) + (depth + 1) * n, END, np.uint8)
    marks[np.arange(len(data)) + np.repeat(np.arange(n) * (depth + 1) + depth, np.diff(offsets))] = lower_ascii(data)
    count = len(marks) - depth
    keys = np.zeros(max(count, 0), np.uint64)
    for d in range(depth + 1):
        keys <<= np.uint64(8)
        keys |= marks[d : d + count]
    inside = np.ones(len(keys), bool)
    first = offsets[1:-1] + np.arange(1, n) * (depth + 1)
    for d in range(1, depth + 1):  # strings that straddle two texts
        inside[first - d] = False
    return keys[inside]


def byte_counts(docs: DataFrame, text: str = "text", depth: int = DEPTH) -> DataFrame:
    """(key, n) over all texts."""

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged():
            return summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))

        for batch in batches:
            for _, _, data, offsets in pieces(batch.column(0), _COUNT_BYTES):
                held.append(np.unique(keys_of(data, offsets, depth), return_counts=True))
                if len(held) > 1 and sum(len(k) for k, _ in held) > 3_000_000:
                    held = [merged()]
                    if len(held[0][0]) > 2_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(held[0][0].astype(np.int64)), pa.array(held[0][1].astype(np.int64))], ["key", "n"])
                        held = []
        if held:
            keys, counts = merged()
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(counts.astype(np.int64))], ["key", "n"])

    return docs.select(F.col(text).cast("string")).mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Values added up by key, keys in order."""
    if not len(key):
        return key, *values
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], *(np.add.reduceat(v[order], first) for v in values)


# ---------------------------------------------------------------- weighting


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x > 0: Stirling's series after a shift to x >= 8."""
    x = np.asarray(x, np.float64)
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        small = y < 8
        shift[small] += np.log(y[small])
        y[small] += 1
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y - shift


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a zeros and b ones."""
    out = np.zeros(a.shape)
    some = a + b > 0
    a, b = a[some], b[some]
    out[some] = log_gamma(a + 0.5) + log_gamma(b + 0.5) - 2 * 0.5723649429247001 - log_gamma(a + b + 1.0)  # ln gamma(1/2)
    return out


_LN2 = 0.6931471805599453
_TOP = 2  # bytes of context by which the tree is dealt


def _gathered(code: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """(distinct codes, place of each in them, sums of values)."""
    codes, place = np.unique(code, return_inverse=True)
    return codes, place, *(np.bincount(place, v, len(codes)) for v in values)


def _parent(code: np.ndarray, depth: int) -> np.ndarray:
    """The code (context and bit node) of the context that is a byte shorter than ``depth``."""
    return (code >> 8 & ((1 << 8 * (depth - 1)) - 1)) << 8 | code & 0xFF


class Level:
    """The bit nodes of all contexts of one length: counts, estimate, weight, and each one's parent."""

    def __init__(self, depth: int, code: np.ndarray, a: np.ndarray, b: np.ndarray, below: np.ndarray | None):
        self.depth, self.code, self.one = depth, code, (b + 0.5) / (a + b + 1)
        kt = log_kt(a, b)
        self.weighted = kt if below is None else np.logaddexp(kt, below) - _LN2
        self.own = np.ones(len(code)) if below is None else np.exp(kt - _LN2 - self.weighted)
        self.a, self.b = a, b

    def above(self) -> Level:
        code, self.place, a, b, below = _gathered(_parent(self.code, self.depth), self.a, self.b, self.weighted)
        return Level(self.depth - 1, code, a, b, below)

    def open(self, mixed: np.ndarray, left: np.ndarray, full: int) -> np.ndarray:
        """The probability of a one where what is deeper is unknown, from the mixture above and the weight left."""
        rest = self.one if self.depth == full else self.own * self.one + (1 - self.own) * 0.5
        return mixed + left * rest

    def deeper(self, mixed: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return mixed + left * self.own * self.one, left * (1 - self.own)


def bit_nodes(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code of context and bit node, bit) of each of the eight decisions, all first ones first."""
    byte, context = key & 0xFF, key >> 8
    bits = np.arange(8)[:, None]
    node = (1 << bits) | (byte[None] >> (8 - bits))
    return (context[None] << 8 | node).ravel(), (byte[None] >> (7 - bits) & 1).ravel()


def subtree(key: np.ndarray, n: np.ndarray, depth: int, top: int) -> tuple[list[Level], np.ndarray, np.ndarray]:
    """(levels from ``depth`` up to ``top``, place of each decision in the first, bits) of counted strings."""
    code, one = bit_nodes(key)
    many = np.tile(n.astype(np.float64), 8)
    codes, place, a, b = _gathered(code, many * (1 - one), many * one)
    levels = [Level(depth, codes, a, b, None)]
    while levels[-1].depth > top:
        levels.append(levels[-1].above())
    return levels, place, one


class Strings:
    """Logarithms of probabilities by string, in an open-addressed table."""

    def __init__(self, key: np.ndarray, value: np.ndarray):
        self.bits = max(8, int(np.ceil(np.log2(max(len(key), 1) * 2))))
        self.slot, self.value, self.probes = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.float64), 0
        at, left = self._slot(key), np.arange(len(key))
        while len(left):  # one round per probe
            self.probes += 1
            _, first = np.unique(at, return_index=True)
            wins = np.zeros(len(at), bool)
            wins[first] = True
            wins &= self.slot[at] < 0
            self.slot[at[wins]], self.value[at[wins]] = key[left[wins]], value[left[wins]]
            left, at = left[~wins], (at[~wins] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, places of the keys that are not there)."""
        at = self._slot(key)
        seen = self.slot[at]
        out = self.value[at]
        open_ = np.flatnonzero(seen != key)
        out[open_] = 0
        missing = [open_[seen[open_] < 0]]
        open_ = open_[seen[open_] >= 0]
        for _ in range(self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            seen = self.slot[at[open_]]
            same = seen == key[open_]
            out[open_[same]] = self.value[at[open_[same]]]
            missing.append(open_[seen < 0])
            open_ = open_[~same & (seen >= 0)]
        return out, np.sort(np.concatenate([*missing, open_]))


STRING, NODE = 0, 1


def node_key(depth: int, code):
    return depth << 48 | code


def train(docs: DataFrame, text: str = "text", depth: int = DEPTH) -> DataFrame:
    """(kind, key, value, n): a STRING's key is its bytes, its value ln of its last byte's probability and n its count; a NODE's value is the probability of a one."""
    spark = docs.sparkSession
    top = min(_TOP, depth)
    counts = byte_counts(docs, text, depth)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(counts.repartition(parts, F.shiftright("key", 8).bitwiseAND((1 << 8 * top) - 1)).select("key", "n", F.spark_partition_id().alias("part")), "byte-counts")
    def whole(t: pd.DataFrame):
        return subtree(t["key"].to_numpy(), t["n"].to_numpy(), depth, top)

    def upward(t: pd.DataFrame) -> pd.DataFrame:
        last = whole(t)[0][-1]
        return pd.DataFrame({"code": last.code, "a": last.a, "b": last.b, "weighted": last.weighted})

    met = dealt.groupBy("part").applyInPandas(upward, "code long, a double, b double, weighted double").toPandas()  # bit nodes of 65,536 contexts at most
    met = met.sort_values("code")
    level = Level(top, *(met[c].to_numpy() for c in ("code", "a", "b")), met["weighted"].to_numpy())
    level.weighted = met["weighted"].to_numpy()
    levels = [level]
    while levels[-1].depth > 0:
        levels.append(levels[-1].above())
    root = levels[-1]
    mixed, left, nodes = np.zeros(len(root.code)), np.ones(len(root.code)), []
    for lower, level in zip([*levels[-2::-1], None], levels[::-1], strict=True):
        if lower is None:
            break
        nodes += zip(node_key(level.depth, level.code).tolist(), level.open(mixed, left, depth).tolist(), strict=True)
        mixed, left = level.deeper(mixed, left)
        mixed, left = mixed[lower.place], left[lower.place]
    shared = spark.sparkContext.broadcast((levels[0].code, mixed, left))  # of the dealt level

    def downward(t: pd.DataFrame) -> pd.DataFrame:
        levels, place, one = whole(t)
        codes, mixed, left = shared.value
        at = np.searchsorted(codes, levels[-1].code)
        mixed, left, out = mixed[at], left[at], []
        for i in range(len(levels) - 1, -1, -1):
            level = levels[i]
            p = level.open(mixed, left, depth)
            out.append((np.full(len(p), NODE), node_key(level.depth, level.code), p, np.zeros(len(p), np.int64)))
            mixed, left = level.deeper(mixed, left)
            if i:
                mixed, left = mixed[levels[i - 1].place], left[levels[i - 1].place]
        p = p[place]
        value = np.log(np.where(one, p, 1 - p)).reshape(8, -1).sum(0)
        out.append((np.full(len(value), STRING), t["key"].to_numpy(), value, t["n"].to_numpy()))
        kind, key, value, n = (np.concatenate(c) for c in zip(*out, strict=True))
        return pd.DataFrame({"kind": kind, "key": key, "value": value, "n": n})

    found = dealt.groupBy("part").applyInPandas(downward, "kind int, key long, value double, n long")
    upper = spark.createDataFrame([(NODE, k, v, 0) for k, v in nodes], "kind int, key long, value double, n long")
    model = materialize(found.unionByName(upper), "context-tree")
    discard(dealt)
    return model


def frequent(model: DataFrame, most: int) -> Strings:
    """The strings from the frequency level on that keeps them within ``most``."""
    strings = model.where(F.col("kind") == STRING)
    level = F.floor(F.log2("n") * 16)
    total, least = 0, None
    for r in strings.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        total += r["count"]
        if total > most:
            break
        least = r["level"]
    t = strings.where(level >= F.lit(least)).select("key", "value").toArrow() if least is not None else None  # ``most`` rows at most
    return Strings(np.zeros(0, np.int64), np.zeros(0)) if t is None else Strings(t.column(0).to_numpy(), t.column(1).to_numpy())


def rare_values(model: DataFrame, wanted: DataFrame, depth: int) -> DataFrame:
    """(string, value) for each distinct string of ``wanted``: its own value, or if it never occurred that of the deepest nodes that know its decisions."""
    known = wanted.join(model.where(F.col("kind") == STRING).select(F.col("key").alias("string"), "value"), "string", "left")
    known = materialize(known, "strings-met")
    context, byte = F.shiftright("string", 8), F.col("string").bitwiseAND(0xFF)
    decisions = F.array(*(F.struct(F.lit(d).alias("depth"), F.lit(bit).alias("bit"), F.shiftright(byte, 7 - bit).bitwiseAND(1).alias("one"), F.lit(node_key(d, 0)).bitwiseOR(F.shiftleft(context.bitwiseAND((1 << 8 * d) - 1), 8)).bitwiseOR(F.lit(1 << bit).bitwiseOR(F.shiftright(byte, 8 - bit))).alias("key")) for d in range(depth + 1) for bit in range(8)))
    asked = known.where("value is null").select("string", F.explode(decisions).alias("x")).select("string", "x.*")
    nodes = model.where(F.col("kind") == NODE).select("key", F.col("value").alias("p"))
    deepest = asked.join(nodes, "key", "left").groupBy("string", "bit", "one").agg(F.max_by("p", F.when(F.col("p").isNotNull(), F.col("depth"))).alias("p"))
    p = F.coalesce("p", F.lit(0.5))
    never = deepest.groupBy("string").agg(F.sum(F.log(F.when(F.col("one") == 1, p).otherwise(1 - p))).alias("value"))
    return known.where("value is not null").unionByName(never)


# ---------------------------------------------------------------- base


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, c) over all texts, words as lower-cased text."""
    lowered = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = docs.select(F.explode(F.split(lowered, r"[\x20\x09-\x0D]+")).alias("word")).where("word <> ''")
    return words.groupBy("word").agg(F.count("*").alias("c"))


def scores(docs: DataFrame, may_learn: Column, key: str = "doc_id", text: str = "text", frequent_words: int = FREQUENT_WORDS, frequent_strings: int = FREQUENT_STRINGS, depth: int = DEPTH) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for every row."""
    spark = docs.sparkSession
    learned = docs.where(may_learn)
    model = train(learned, text, depth)
    counts = materialize(word_counts(learned, text), "word-counts")
    ends = learned.count()
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = sums["n"] + ends, sums["v"] + (ends > 0)
    level = F.floor(F.log2("c") * 16)
    levels = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    total, least = 0, None
    for row in levels:
        total += row["count"]
        if total > frequent_words:
            break
        least = row["level"]
    common = {} if least is None else {r["word"].encode(): float(np.log10(r["c"] + 1)) for r in counts.where((level >= least) & (F.octet_length("word") <= 64)).select("word", "c").collect()}
    shared = spark.sparkContext.broadcast((frequent(model, frequent_strings), common))  # both bounded by the parameters
    per_token = float(np.log10(tokens + distinct + 1))
    end_value = float(np.log10(ends + 1))
    kind = docs.schema[key].dataType.simpleString()

    names = [key, "row", "word", "string", "times", "n_tokens", "n_known", "base", "score", "size"]

    def run(batches):
        strings, common = shared.value
        get = common.get
        for batch in batches:
            n_tokens, n_known, base, rare_word, rare_row, odd = [], [], [], [], [], []
            score, size = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for at, end, data, offsets in pieces(batch.column(2), 1 << 18):
                keys = keys_of(data, offsets, depth).astype(np.int64)
                each, missing = strings.find(keys)
                starts = offsets[:-1] + np.arange(len(offsets) - 1)
                score[at:end], size[at:end] = np.add.reduceat(each, starts), np.diff(offsets) + 1
                if len(missing):
                    order = np.lexsort((keys[missing], row := np.searchsorted(starts, missing, "right") - 1))
                    row, string = row[order], keys[missing][order]
                    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (string[1:] != string[:-1])]))
                    odd.append((row[first] + at, string[first], np.diff(np.append(first, len(row)))))
                raw = data.tobytes().translate(_LOWER)
                for i in range(at, end):
                    words = _WORDS.findall(raw[offsets[i - at] : offsets[i - at + 1]])
                    values = list(map(get, words))
                    missing = values.count(None)
                    if missing:
                        rare_word.extend(w for w, v in zip(words, values, strict=True) if v is None)
                        rare_row.extend([i] * missing)
                        values = [v for v in values if v is not None]
                    n_tokens.append(len(words) + 1)
                    n_known.append(len(values) + (ends > 0))
                    base.append(sum(values) + end_value - (len(words) + 1) * per_token)
            rows = batch.num_rows
            order = pa.array(rare_row, pa.int64())
            if odd:
                row, string, times = (np.concatenate(c) for c in zip(*odd, strict=True))
                of, none = pa.array(row), lambda t, n=len(row): pa.nulls(n, t)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), none(pa.string()), pa.array(string), pa.array(times), none(pa.int64()), none(pa.int64()), none(pa.float64()), none(pa.float64()), none(pa.int64())], names)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column(0), batch.column(0).take(order)]),
                    pa.concat_arrays([batch.column(1), batch.column(1).take(order)]),
                    pa.array([None] * rows + [w.decode() for w in rare_word], pa.string()),
                    *(pa.nulls(rows + len(rare_row), pa.int64()) for _ in range(2)),
                    *(pa.concat_arrays([pa.array(x, t), pa.nulls(len(rare_row), t)]) for x, t in ((n_tokens, pa.int64()), (n_known, pa.int64()), (base, pa.float64()), (score, pa.float64()), (size, pa.int64()))),
                ],
                names,
            )

    numbered = docs.select(F.col(key), F.monotonically_increasing_id().alias("row"), F.col(text).cast("string").alias("text"))
    judged = materialize(numbered.mapInArrow(run, f"{key} {kind}, row long, word string, string long, times long, n_tokens long, n_known long, base double, score double, size long"), "judged")
    rare = judged.where("word is not null").groupBy("word", "row").agg(F.count("*").alias("seen"))
    found = rare.join(counts, "word").groupBy("row").agg(F.sum("seen").alias("more"), F.sum(F.col("seen") * F.log10(F.col("c") + 1)).alias("gain"))
    odd = judged.where("string is not null").select("row", "string", "times")
    values = materialize(rare_values(model, odd.select("string").distinct(), depth), "string-values")
    rest = odd.join(values, "string").groupBy("row").agg(F.sum(F.col("times") * F.col("value")).alias("rest"))
    score = (F.col("score") + F.coalesce("rest", F.lit(0.0))) / F.lit(float(np.log(10)))
    return judged.where("n_tokens is not null").join(found, "row", "left").join(rest, "row", "left").select(
        key,
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("gain", F.lit(0.0))).alias("base_score"),
        score.alias("score"),
        (-score / F.lit(float(np.log10(2))) / F.col("size")).alias("bits_per_byte"),
    )


def held_out(key: str = "doc_id") -> Column:
    """Whether the row is kept from learning: crc32 of its id as text, modulo 7, is 2."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 7 == 2, F.lit(False))


def op9_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scores(docs, ~held_out()).select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
