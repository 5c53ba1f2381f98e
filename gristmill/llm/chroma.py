"""Media columns: chroma audio fingerprints and their alignment.

Audio (16-bit mono WAV bytes) is cut into overlapping frames; each frame's spectrum is folded onto
the twelve pitch classes. Sixteen filters, rectangles compared by way of an integral image over
frames and pitch classes, are quantised to two bits each, Gray-coded and packed into one 32-bit
integer per step. Recordings are aligned by an inverted index of these integers: matches vote for
an offset, and at the offset with most votes the share of differing bits decides. The queries are
indexed in blocks of bounded size, against which every recording is held.

Recordings with equal fingerprints are one class, so copies never multiply in the index; an
alignment is between a query's class and another, with the members beside it.

Edge cases: null, empty or undecodable audio has no fingerprint (an empty array) and aligns with
nothing; audio shorter than a filter has none either; silences of any length fingerprint alike and
align, as do held tones; of offsets with equally many votes the one nearest to 0, then the smaller,
counts; of alignments with equal errors the one with the smaller class is the nearest; very long
recordings are fingerprinted 256 frames at a time; repeated rows are members of one class; rows
without an id take no part; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import io
import wave

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.plans.store import materialize

RATE = 4000
FRAME = 1024
HOP = 256
WIDTH = 8  # steps under a filter
MIN_VOTES = 3
MAX_ERROR = 0.3
BLOCK_STEPS = 500_000
_ROWS = 256
_POSTINGS = 1 << 21
_LOW, _HIGH = 60.0, 1800.0


def _filters() -> list[tuple[int, int, int, int, int]]:
    """(kind, first pitch class, classes, first step, steps): plain sums, halves compared over time or pitch, and thirds."""
    out = []
    for i in range(16):
        kind = i % 4
        high = 2 + 2 * (i // 4 % 3)
        out.append((kind, (5 * i) % (12 - high + 1), high, 0, (4, 8, 8, 6)[kind]))
    return out


FILTERS = _filters()
THRESHOLDS = (-0.1, 0.0, 0.1)


def decode_wav(raw: bytes | None) -> tuple[np.ndarray, int]:
    """(samples in -1..1, rate); no samples where the bytes are no 16-bit WAV."""
    if not raw:
        return np.zeros(0), RATE
    try:
        with wave.open(io.BytesIO(raw)) as w:
            if w.getsampwidth() != 2:
                return np.zeros(0), RATE
            x = np.frombuffer(w.readframes(w.getnframes()), "<i2").astype(np.float64) / 32768
            return x.reshape(-1, w.getnchannels()).mean(1), w.getframerate()
    except (wave.Error, EOFError, ValueError):
        return np.zeros(0), RATE


def encode_wav(samples: np.ndarray, rate: int = RATE) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def chroma(samples: np.ndarray, rate: int) -> np.ndarray:
    """(frames, 12) energies by pitch class, each frame of unit length (silence: zero)."""
    if len(samples) < FRAME:
        return np.zeros((0, 12))
    frequency = np.fft.rfftfreq(FRAME, 1 / rate)
    use = (frequency >= _LOW) & (frequency <= _HIGH)
    fold = np.zeros((use.sum(), 12))
    fold[np.arange(use.sum()), np.round(12 * np.log2(frequency[use] / 440)).astype(int) % 12] = 1
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP]
    out = []
    for at in range(0, len(frames), 256):
        spectrum = np.abs(np.fft.rfft(frames[at : at + 256] * np.hanning(FRAME), axis=1))[:, use]
        out.append((spectrum**2) @ fold)
    c = np.concatenate(out)
    size = np.sqrt((c * c).sum(1, keepdims=True))
    return np.where(size > 1e-6, c / np.maximum(size, 1e-12), 0)


def fingerprint(samples: np.ndarray, rate: int = RATE) -> np.ndarray:
    """One packed 32-bit integer per step."""
    c = chroma(samples, rate)
    steps = len(c) - WIDTH + 1
    if steps <= 0:
        return np.zeros(0, np.uint32)
    image = np.zeros((len(c) + 1, 13))
    image[1:, 1:] = c.cumsum(0).cumsum(1)
    at = np.arange(steps)

    def area(t: int, dt: int, p: int, dp: int) -> np.ndarray:
        return (image[at + t + dt, p + dp] - image[at + t, p + dp] - image[at + t + dt, p] + image[at + t, p]) / (dt * dp)

    out = np.zeros(steps, np.uint32)
    for kind, p, dp, t, dt in FILTERS:
        if kind == 0:
            value = area(t, dt, p, dp) - area(t, dt, 0, 12)
        elif kind == 1:
            value = area(t, dt // 2, p, dp) - area(t + dt // 2, dt // 2, p, dp)
        elif kind == 2:
            value = area(t, dt, p, dp // 2) - area(t, dt, p + dp // 2, dp // 2)
        else:
            value = area(t + dt // 3, dt // 3, p, dp) - (area(t, dt // 3, p, dp) + area(t + 2 * dt // 3, dt // 3, p, dp)) / 2
        level = np.digitize(value, THRESHOLDS).astype(np.uint32)
        out = out << np.uint32(2) | (level ^ level >> np.uint32(1))
    return out


def best_offset(a: np.ndarray, b: np.ndarray) -> tuple[int, int, float]:
    """(offset of b against a, votes, share of differing bits over the overlap) at the offset with most equal integers."""
    shared = np.intersect1d(a, b)
    if not len(shared):
        return 0, 0, 1.0
    size = len(a) + len(b) - 1
    votes = np.zeros(size, np.int64)
    ia, ib = np.flatnonzero(np.isin(a, shared)), np.flatnonzero(np.isin(b, shared))
    ia, ib = ia[np.argsort(a[ia], kind="stable")], ib[np.argsort(b[ib], kind="stable")]
    cut = lambda x: np.append(np.searchsorted(x, shared), len(x)).tolist()
    ca, cb = cut(a[ia]), cut(b[ib])
    for k in range(len(shared)):
        i, j = ia[ca[k] : ca[k + 1]], ib[cb[k] : cb[k + 1]]
        if len(i) * len(j) <= 64 * size:
            for at in range(0, len(i), max(1, (1 << 20) // len(j))):
                np.add.at(votes, (j[None] - i[at : at + max(1, (1 << 20) // len(j)), None] + len(a) - 1).ravel(), 1)
        else:  # held long on both sides: a correlation, not all pairs
            x, y = np.zeros(len(a)), np.zeros(len(b))
            x[len(a) - 1 - i], y[j] = 1, 1
            votes += np.rint(np.fft.irfft(np.fft.rfft(x, 2 * size) * np.fft.rfft(y, 2 * size), 2 * size)[:size]).astype(np.int64)
    offsets = np.flatnonzero(votes == votes.max()) - (len(a) - 1)
    at = int(offsets[np.argmin(np.abs(offsets))])
    return at, int(votes.max()), error_at(a, b, at)


def error_at(a: np.ndarray, b: np.ndarray, at: int) -> float:
    x, y = a[max(0, -at) :], b[max(0, at) :]
    n = min(len(x), len(y))
    return float(np.bitwise_count(x[:n] ^ y[:n]).sum() / (32 * n)) if n else 1.0


def fingerprints(media: DataFrame, key: str, audio: str) -> DataFrame:
    """(key, print array<int>) of WAV bytes."""
    kind = media.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                prints = [fingerprint(*decode_wav(x.as_py())).view(np.int32) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints, pa.list_(pa.int32()))], [key, "print"])

    return media.select(F.col(key), F.col(audio).cast("binary")).mapInArrow(run, f"{key} {kind}, print array<int>")


def align(prints: DataFrame, is_query, key: str, min_votes: int = MIN_VOTES, max_error: float = MAX_ERROR) -> DataFrame:
    """Per recording: (key, class_id, n_steps, is_query, links): its class, and how many other classes align with the class.

    The classes of the query rows are aligned against all classes. :func:`pairs` gives the alignments.
    """
    classes, found = _classes_and_pairs(prints, is_query, key, min_votes, max_error)
    links = found.groupBy(F.col("a").alias("class_id")).agg(F.count("*").alias("links"), F.min(F.struct("error", "b", "offset")).alias("best"))
    return classes.join(links, "class_id", "left").select(key, "class_id", F.size("print").alias("n_steps"), "is_query", F.coalesce("links", F.lit(0)).alias("links"), F.col("best.b").alias("nearest_class"), F.col("best.offset").alias("offset"), F.col("best.error").alias("bit_error"))


def pairs(prints: DataFrame, is_query, key: str, min_votes: int = MIN_VOTES, max_error: float = MAX_ERROR) -> DataFrame:
    """(a, b, offset, votes, error): aligned classes, a being a query's."""
    return _classes_and_pairs(prints, is_query, key, min_votes, max_error)[1]


class Block:
    """A bounded block of query classes: the inverted index of their integers and their fingerprints."""

    def __init__(self, ids: list, prints: list[np.ndarray]):
        self.ids, self.prints = ids, prints
        size = [len(p) for p in prints]
        value, owner = np.concatenate([np.zeros(0, np.uint32), *prints]), np.repeat(np.arange(len(prints)), size)
        both, self.n = np.unique(value.astype(np.int64) << 24 | owner, return_counts=True)  # fewer than 2^24 classes a block
        self.owner = both & ((1 << 24) - 1)
        self.value, first = np.unique(both >> 24, return_index=True)
        self.first = np.append(first, len(both))

    def likely(self, value: np.ndarray, owner: np.ndarray, rows: int, min_votes: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, query) that can have ``min_votes`` votes at one offset: there a value votes at most as often as it occurs on either side."""
        at = np.searchsorted(self.value, value)
        known = np.flatnonzero((at < len(self.value)) & (self.value[np.minimum(at, max(len(self.value) - 1, 0))] == value)) if len(self.value) else np.zeros(0, np.int64)
        both, n = np.unique(at[known] << 32 | owner[known], return_counts=True)
        at, owner = both >> 32, both & ((1 << 32) - 1)
        many = self.first[at + 1] - self.first[at]
        bound = np.zeros(rows * len(self.ids), np.int64)
        step = max(1, int(np.searchsorted(np.cumsum(many), _POSTINGS)))
        for lo in range(0, len(at), step):
            m = many[lo : lo + step]
            post = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(self.first[at[lo : lo + step]], m)
            np.add.at(bound, np.repeat(owner[lo : lo + step], m) * len(self.ids) + self.owner[post], np.minimum(self.n[post], np.repeat(n[lo : lo + step], m)))
        return np.divmod(np.flatnonzero(bound >= min_votes), max(1, len(self.ids)))


def _classes_and_pairs(prints: DataFrame, is_query, key: str, min_votes: int, max_error: float, block_steps: int = BLOCK_STEPS) -> tuple[DataFrame, DataFrame]:
    """Classes, and the alignments of the query classes with all others, a block of queries at a time.

    A block holds about ``block_steps`` integers and is broadcast; every recording passes it once, so
    a value that very many recordings hold is looked up once in each and never joined. All pairs that
    can reach ``min_votes`` are measured.
    """
    spark = prints.sparkSession
    rows = materialize(prints.where(F.col(key).isNotNull()).select(key, "print", is_query.alias("is_query"), F.sha2(F.array_join("print", ","), 256).alias("sum")), "prints")
    heads = rows.groupBy("sum").agg(F.min(key).alias("class_id"), F.max("is_query").alias("asked"), F.first("print").alias("print"))
    heads = materialize(heads.where(F.size("print") > 0), "classes")
    classes = rows.join(heads.select("sum", "class_id"), "sum", "left").select(key, F.coalesce("class_id", F.col(key)).alias("class_id"), "print", "is_query")
    asked = heads.where("asked")
    many = max(1, -(-(asked.agg(F.coalesce(F.sum(F.size("print")), F.lit(0)).alias("n")).first()["n"]) // block_steps))
    kind = prints.schema[key].dataType.simpleString()
    found = None
    for at in range(many):
        part = asked.where(F.pmod(F.xxhash64("class_id", F.lit(7)), F.lit(many)) == at).select("class_id", "print").toArrow()  # about block_steps integers
        shared = spark.sparkContext.broadcast(Block(part.column(0).to_pylist(), [x.values.to_numpy().view(np.uint32) for x in part.column(1)]))

        def measure(batches, shared=shared):
            block = shared.value
            for batch in batches:
                for lo in range(0, batch.num_rows, _ROWS):
                    here = batch.slice(lo, _ROWS)
                    own = [x.values.to_numpy().view(np.uint32) for x in here.column(1)]
                    value, owner = np.concatenate(own).astype(np.int64), np.repeat(np.arange(len(own)), [len(x) for x in own])
                    ids, out = here.column(0).to_pylist(), []
                    for row, query in zip(*block.likely(value, owner, len(own), min_votes), strict=True):
                        if block.ids[query] != ids[row]:
                            offset, votes, error = best_offset(block.prints[query], own[row])
                            if votes >= min_votes and error <= max_error:
                                out.append((block.ids[query], ids[row], offset, votes, error))
                    if out:
                        a, b, offset, votes, error = zip(*out, strict=True)
                        yield pa.RecordBatch.from_arrays([pa.array(a, here.column(0).type), pa.array(b, here.column(0).type), pa.array(offset, pa.int32()), pa.array(votes, pa.int32()), pa.array(error, pa.float64())], ["a", "b", "offset", "votes", "error"])

        one = materialize(heads.select("class_id", "print").mapInArrow(measure, f"a {kind}, b {kind}, offset int, votes int, error double"), "aligned")
        shared.destroy()
        found = one if found is None else found.unionByName(one)
    return classes, found


def sonify(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", tone: int = 512) -> DataFrame:
    """(key, audio): each vector as a melody in WAV: a component's value is a note's pitch, ``tone`` samples long."""
    kind = vectors.schema[key].dataType.simpleString()

    def run(batches):
        t = np.arange(tone) / RATE
        bell = np.hanning(tone)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                audio = []
                for v in part.column(1):
                    v = v.as_py()
                    if v is None:
                        audio.append(None)
                        continue
                    x = np.nan_to_num(np.array([0.0 if y is None else y for y in v], np.float64))
                    pitch = 220 * 2 ** (np.round(np.clip(x, -0.4, 0.4) * 30) / 12)
                    audio.append(encode_wav((0.6 * np.sin(2 * np.pi * pitch[:, None] * t) * bell).ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(audio, pa.binary())], [key, "audio"])

    return vectors.select(key, F.col(vector).cast("array<double>")).mapInArrow(run, f"{key} {kind}, audio binary")


def op7_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no audio, so every row of ``embeddings`` is played as a melody; rows divisible by 50 are the queries."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return align(fingerprints(sonify(vectors), "vec_id", "audio"), F.col("vec_id") % 50 == 0, "vec_id")
