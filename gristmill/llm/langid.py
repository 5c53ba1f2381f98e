"""Language identification by a byte convolutional network.

Filters of several widths run over byte embeddings of fixed-length windows; the maximum over
positions feeds a softmax over the languages. The network is trained in numpy on the driver,
on windows of a bounded, hash-chosen sample of labelled documents (``max_train_docs``, shared
evenly by the languages), and then applied to every window of every text, in batches. A text's
probabilities are its windows' mean, weighted by their length.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; rows with a null
language or null id are not learned from but are predicted; with nothing to learn from all
texts are ``und``; ties go to the language that sorts first; repeated rows give repeated
results; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.buffers import pieces

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 12
EMBEDDING = 8
MAX_TRAIN_DOCS = 4000
MAX_LANGUAGES = 500
TRAIN_WINDOWS = 3
_AT_ONCE = 32


class ByteCnn:
    """Embedding, filters of each width (as rows of one matrix, zero beyond the width), max pooling, softmax."""

    def __init__(self, languages: list[str], seed: int = 0, embedding: int = EMBEDDING, filters: int = FILTERS, widths: tuple[int, ...] = WIDTHS):
        rng = np.random.default_rng(seed)
        self.languages, self.widths, self.span = languages, widths, max(widths)
        n = filters * len(widths)
        self.mask = np.zeros((self.span, embedding, n), np.float32)
        for i, w in enumerate(widths):
            self.mask[:w, :, i * filters : (i + 1) * filters] = 1
        self.mask = self.mask.reshape(self.span * embedding, n)
        self.emb = rng.normal(0, 0.5, (256, embedding)).astype(np.float32)
        self.emb[0] = 0  # byte 0 pads
        self.w = rng.normal(0, (2 / (self.span * embedding)) ** 0.5, self.mask.shape).astype(np.float32) * self.mask
        self.b = np.zeros(n, np.float32)
        self.v = rng.normal(0, (1 / n) ** 0.5, (n, len(languages))).astype(np.float32)
        self.c = np.zeros(len(languages), np.float32)

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """(windows, positions, span * embedding): the bytes under the filters at each position."""
        x = self.emb[windows]
        n, length, e = x.shape
        view = np.lib.stride_tricks.as_strided(x, (n, length - self.span + 1, self.span * e), (x.strides[0], x.strides[1], x.strides[2]))
        return np.ascontiguousarray(view)

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        cols = self.columns(windows)
        n, p, k = cols.shape
        return np.maximum((cols.reshape(n * p, k) @ self.w).reshape(n, p, -1).max(1) + self.b, 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        z = self.pooled(windows) @ self.v + self.c
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        return p / p.sum(1, keepdims=True)

    def fit(self, windows: np.ndarray, y: np.ndarray, epochs: int = 5, batch: int = 64, rate: float = 4e-3, seed: int = 0) -> ByteCnn:
        rng = np.random.default_rng(seed)
        weight = (len(y) / (len(self.languages) * np.maximum(np.bincount(y, minlength=len(self.languages)), 1))).astype(np.float32)
        names = ("emb", "w", "b", "v", "c")
        m = {k: np.zeros_like(getattr(self, k)) for k in names}
        s = {k: np.zeros_like(getattr(self, k)) for k in names}
        step = 0
        e = self.emb.shape[1]
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(y), batch):
                pick = order[at : at + batch]
                xb, yb = windows[pick], y[pick]
                cols = self.columns(xb)
                n, p, k = cols.shape
                conv = (cols.reshape(n * p, k) @ self.w).reshape(n, p, -1)
                where = conv.argmax(1)
                top = np.take_along_axis(conv, where[:, None], 1)[:, 0] + self.b
                h = np.maximum(top, 0)
                z = h @ self.v + self.c
                z -= z.max(1, keepdims=True)
                q = np.exp(z)
                q /= q.sum(1, keepdims=True)
                q[np.arange(n), yb] -= 1
                q *= weight[yb][:, None] / n
                dh = (q @ self.v.T) * (top > 0)
                under = cols[np.arange(n)[:, None], where]  # what lay under each filter at its maximum
                dcols = dh[:, :, None] * self.w.T[None]
                bytes_under = xb[np.arange(n)[:, None, None], where[:, :, None] + np.arange(self.span)]
                demb = np.zeros_like(self.emb)
                np.add.at(demb, bytes_under.ravel(), dcols.reshape(-1, e))
                demb[0] = 0
                grads = {"emb": demb, "w": np.einsum("nfk,nf->kf", under, dh) * self.mask, "b": dh.sum(0), "v": h.T @ q, "c": q.sum(0)}
                step += 1
                for name, g in grads.items():
                    m[name] = 0.9 * m[name] + 0.1 * g
                    s[name] = 0.99 * s[name] + 0.01 * g * g
                    getattr(self, name).__isub__(rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(s[name] / (1 - 0.99**step)) + 1e-8))
            rate *= 0.7
        return self


def windows_of(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each window, windows padded by byte 0, bytes in each) over whole texts."""
    lengths = np.diff(offsets)
    many = -(-lengths // window)
    rows = np.repeat(np.arange(len(lengths)), many)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many)
    starts = offsets[rows] + within * window
    real = np.minimum(window, offsets[rows + 1] - starts) if len(rows) else starts
    padded = np.concatenate([data, np.zeros(window, np.uint8)])
    out = padded[starts[:, None] + np.arange(window)]
    out[np.arange(window)[None, :] >= real[:, None]] = 0
    return rows, out, real


def score_texts(model: ByteCnn, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each text's probabilities, zero for texts without bytes."""
    total = np.zeros((len(offsets) - 1, len(model.languages)))
    rows, windows, real = windows_of(data, offsets)
    for at in range(0, len(rows), _AT_ONCE):
        p = model.probabilities(windows[at : at + _AT_ONCE]) * real[at : at + _AT_ONCE, None]
        np.add.at(total, rows[at : at + _AT_ONCE], p)
    return total / np.maximum(total.sum(1, keepdims=True), 1e-9)


def held_out(key: str = "doc_id") -> Column:
    """Whether the row is kept from learning: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, may_learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", max_train_docs: int = MAX_TRAIN_DOCS, seed: int = 0) -> ByteCnn | None:
    """Fit the network on about ``max_train_docs`` documents, up to ``TRAIN_WINDOWS`` windows of each."""
    labelled = docs.where(may_learn & F.col(lang).isNotNull() & F.col(key).isNotNull())
    counts = {r[0]: r[1] for r in labelled.groupBy(lang).count().orderBy(F.desc("count"), lang).limit(MAX_LANGUAGES).collect()}
    if not counts:
        return None
    share = max(8, max_train_docs // len(counts))
    rates = F.create_map(*(x for k, n in sorted(counts.items()) for x in (F.lit(k), F.lit(min(1.0, share / n)))))
    chosen = labelled.where((F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)) < F.element_at(rates, F.col(lang)))
    size = F.length(text)
    parts = [F.substring(F.col(text), F.greatest(F.lit(1), (size * f).cast("int") - WINDOW // 2), F.lit(WINDOW)) for f in (0.0, 0.4, 0.8)[:TRAIN_WINDOWS]]
    rows = chosen.select(F.col(lang), *(p.alias(f"p{i}") for i, p in enumerate(parts))).collect()
    languages = sorted({r[0] for r in rows})
    if not languages:
        return None
    x, y = [], []
    for r in sorted(rows, key=lambda r: tuple(str(v) for v in r)):
        for p in {p: None for p in r[1:] if p and p.strip()}:
            raw = p.encode()[:WINDOW]
            x.append(np.frombuffer(raw.ljust(WINDOW, b"\0"), np.uint8))
            y.append(languages.index(r[0]))
            if len(raw) > 60:  # short texts are judged too
                cut = raw[: 12 + (len(x) * 37) % 48]
                x.append(np.frombuffer(cut.ljust(WINDOW, b"\0"), np.uint8))
                y.append(languages.index(r[0]))
    if not x:
        return None
    return ByteCnn(languages, seed).fit(np.stack(x), np.array(y), seed=seed)


def predict(docs: DataFrame, model: ByteCnn | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) for every row."""
    kind = docs.schema[key].dataType.simpleString()
    judged = docs.select(F.col(key), F.col(text).cast("string").alias("text"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    if model is None:
        return judged.select(key, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by the parameters

    def run(batches):
        net = shared.value
        names = np.array(net.languages, object)
        for batch in batches:
            letters = batch.column(2).to_numpy(zero_copy_only=False)
            best, score = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows)
            for at, end, data, offsets in pieces(batch.column(1)):
                p = score_texts(net, data, offsets)
                best[at:end], score[at:end] = names[p.argmax(1)], np.clip(p.max(1), 0, 1)
            best[~letters], score[~letters] = "und", 0.0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.string()), pa.array(score)], [key, "lang_pred", "score"])

    return judged.mapInArrow(run, f"{key} {kind}, lang_pred string, score double")


def keep(docs: DataFrame, model: ByteCnn | None, text: str = "text", least: float = 0.4) -> DataFrame:
    """The rows of ``docs`` whose text has a letter and a language of score ``least`` or more; row by row, without a join."""
    letters = docs.where(F.col(text).cast("string").rlike(r"\p{L}"))
    if model is None:
        return letters
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for at, end, data, offsets in pieces(batch.column(place)):
                score[at:end] = score_texts(shared.value, data, offsets).max(1)
            yield batch.filter(pa.array(score >= least))

    return letters.mapInArrow(run, docs.schema)


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs, ~held_out())
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
