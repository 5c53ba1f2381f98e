"""Quality classification by co-training on two views of a page.

The text view sees what is written (how characters, words and lines are distributed and how much
repeats), the metadata view what is known of the page without reading it (source, language, size).
Each is a logistic regression. They start from the labelled documents; in every round each view
judges all unlabelled documents, gives the most confident judgements to the other as pseudo-labels, in
the labels' proportion, and both are fitted again. Each view is then calibrated on labelled documents
kept aside, the calibrated views are combined by a logistic regression on their log-odds, and all
documents are scored.

Fitting uses a bounded, hash-chosen sample of ``max_labelled`` labelled documents. The features of all
unlabelled ones are written once; a round scores them where they lie and only the ``give`` best of
each view come to the driver. Every text is read whole, very long ones in cuts.

Edge cases: a null text is empty; documents without an id are scored but not learned from; ties in
confidence go to the smaller id; an empty table gives an empty result; without labels of both kinds every document scores 1 and is kept;
null source, language or size are values of their own; of repeated labels the lowest counts;
repeated rows score alike; extra columns are ignored by :func:`score` and kept by :func:`keep`.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gristmill.plans.store import discard, materialize

MAX_LABELLED = 8000
ROUNDS = 4
GIVE = 200
KEEP_AT = 0.5
_SHOWN = "!#$%&'()*+,-./:;<=>?@[]^_`{|}~\""
_BUCKETS = 64
_CLASS = np.zeros(256, np.int64)
for _c, _chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r", "\n"), 1):
    _CLASS[[ord(x) for x in _chars]] = _c
_CLASS[128:] = 6
for _i, _ch in enumerate(_SHOWN):
    _CLASS[ord(_ch)] = 7 + _i
_CLASSES = 7 + len(_SHOWN)


def text_features(text: str | None) -> np.ndarray:
    """What the text view sees of a whole text."""
    text = text or ""
    raw = np.frombuffer(text.encode(), np.uint8)
    n = max(1, len(raw))
    shares = np.zeros(_CLASSES)
    for at in range(0, len(raw), 1 << 20):
        shares += np.bincount(_CLASS[raw[at : at + (1 << 20)]], minlength=_CLASSES)
    shares /= n
    words = text.split()
    w = max(1, len(words))
    kinds = len(set(words))
    lines = text.split("\n")
    some = [x for x in lines if x]
    pairs = len(set(zip(words, words[1:], strict=False)))
    long = max(map(len, words), default=0)
    return np.concatenate(
        [
            shares,
            np.sqrt(shares[[1, 2, 3, 7, 8, 9, 10]]),
            [np.log1p(len(raw)), np.log1p(len(words)), kinds / w, np.log1p(kinds), pairs / max(1, w - 1), len(raw) / w, np.log1p(long), len(set(some)) / max(1, len(some)), len(some) / w, np.log1p(len(some)), float(len(words) < 5), float(kinds / w < 0.2)],
        ]
    )


def page_features(source: str | None, lang: str | None, size: int | None) -> np.ndarray:
    """What the metadata view sees of a page."""
    out = np.zeros(2 * _BUCKETS + 22)
    out[zlib.crc32(f"s{source}".encode()) % _BUCKETS] = 1
    out[_BUCKETS + zlib.crc32(f"l{lang}".encode()) % _BUCKETS] = 1
    level = np.log1p(max(0, size or 0))
    out[2 * _BUCKETS + min(19, int(level * 1.5))] = 1
    out[-2:] = level, float(size is None)
    return out


class Logistic:
    """Logistic regression on standardised features, by Newton's method."""

    def fit(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> Logistic:
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        z = np.column_stack([np.ones(len(x)), (x - self.mean) / self.scale])
        z = np.clip(z, -8, 8)
        self.w = np.zeros(z.shape[1])
        penalty = np.full(z.shape[1], ridge)
        penalty[0] = 1e-6
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            v = p * (1 - p) + 1e-6
            step = np.linalg.solve((z * v[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * self.w)
            self.w += step
            if np.abs(step).max() < 1e-6:
                break
        return self

    def odds(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.clip(z @ self.w[1:] + self.w[0], -30, 30)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class CoTrained:
    """Two views, each with its calibration, and their combination."""

    views: tuple[Logistic, Logistic]
    calibration: tuple[Logistic, Logistic]
    combination: Logistic

    def parts(self, text_x: np.ndarray, page_x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text view's, metadata view's, combined) probability of good quality."""
        odds = [c.odds(v.odds(x)[:, None]) for v, c, x in zip(self.views, self.calibration, (text_x, page_x), strict=True)]
        return sigmoid(odds[0]), sigmoid(odds[1]), sigmoid(self.combination.odds(np.column_stack(odds)))


class ArrayPool:
    """Unlabelled features in memory; :func:`co_train` draws from it or from a :class:`TablePool`."""

    def __init__(self, x: np.ndarray, p: np.ndarray):
        self.x, self.left = (x, p), np.arange(len(x))

    def draw(self, views: tuple[Logistic, Logistic], low: int, high: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        out, taken = [], []
        for v in (0, 1):
            at, y = confident(views[v].odds(self.x[v][self.left]), self.left, low, high)
            out.append((self.x[0][at], self.x[1][at], y))
            taken.append(at)
        self.left = np.setdiff1d(self.left, np.concatenate(taken))
        return out


def confident(odds: np.ndarray, ids: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, labels) of the ``low`` least and ``high`` greatest odds among those under 0.1 or over 0.9."""
    p = sigmoid(odds)
    down, up = np.flatnonzero(p < 0.1), np.flatnonzero(p > 0.9)
    down, up = down[np.lexsort((ids[down], odds[down]))][:low], up[np.lexsort((ids[up], -odds[up]))][:high]
    return ids[np.concatenate([down, up])], np.repeat([0.0, 1.0], [len(down), len(up)])


class TablePool:
    """Unlabelled features in a table (node, x, p); each task passes on its own most confident rows, and the best of all come to the driver."""

    def __init__(self, table: DataFrame):
        self.table, self.used = table, np.zeros(0, np.int64)

    def draw(self, views: tuple[Logistic, Logistic], low: int, high: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        shared = self.table.sparkSession.sparkContext.broadcast((views, self.used))

        def run(batches):
            views, used = shared.value
            for batch in batches:
                free = np.flatnonzero(~np.isin(batch.column(0).to_numpy(), used))
                if not len(free):
                    continue
                ids, x = batch.column(0).to_numpy()[free], [_rows(batch.column(i), free) for i in (1, 2)]
                for v in (0, 1):
                    odds = views[v].odds(x[v])
                    for side, (l, h) in enumerate(((low, 0), (0, high))):
                        chosen, _ = confident(odds, ids, l, h)
                        at = np.flatnonzero(np.isin(ids, chosen))
                        take = pa.array(free[at])
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), v, np.int32)), pa.array(np.full(len(at), side, np.int32)), pa.array(odds[at] if side == 0 else -odds[at]), *(batch.column(i).take(take) for i in range(3))], ["view", "side", "rank", "node", "x", "p"])

        found = self.table.select("node", "x", "p").mapInArrow(run, "view int, side int, rank double, node long, x binary, p binary").dropDuplicates(["view", "side", "node"])
        place = F.row_number().over(Window.partitionBy("view", "side").orderBy("rank", "node"))
        best = found.withColumn("place", place).where(F.col("place") <= F.when(F.col("side") == 0, low).otherwise(high)).toArrow()  # twice ``give`` rows
        view, side, node = (best[c].to_numpy() for c in ("view", "side", "node"))
        out = []
        for v in (0, 1):
            at = np.flatnonzero(view == v)
            at = at[np.lexsort((node[at], side[at]))]
            out.append((*(_rows(best[c].combine_chunks(), at) for c in ("x", "p")), side[at].astype(float)))
        self.used = np.union1d(self.used, node)
        shared.destroy()
        return out


def _rows(column: pa.Array, rows: np.ndarray) -> np.ndarray:
    raw = column.take(pa.array(rows, pa.int64())).to_pylist()
    return np.frombuffer(b"".join(raw), np.float32).reshape(len(raw), -1).astype(np.float64) if raw else np.zeros((0, 1))


def co_train(labelled: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool, rounds: int = ROUNDS, give: int = GIVE, seed: int = 0) -> CoTrained:
    """Fit both views. A quarter of the labels is kept aside for calibration."""
    pool = ArrayPool(*pool) if isinstance(pool, tuple) else pool
    aside = np.random.default_rng(seed).random(len(y)) < 0.25
    if len(set(y[aside].tolist())) < 2 or len(set(y[~aside].tolist())) < 2:
        aside = np.zeros(len(y), bool)
    own = [(x[~aside], y[~aside]) for x in labelled]
    views = [Logistic().fit(*o) for o in own]
    share = float(y[~aside].mean())
    for _ in range(rounds):
        given = pool.draw(tuple(views), round(give * (1 - share)), round(give * share))
        if not any(len(g[2]) for g in given):
            break
        for v in (0, 1):
            said = given[1 - v]
            if len(said[2]):
                own[v] = (np.concatenate([own[v][0], said[v]]), np.concatenate([own[v][1], said[2]]))
                views[v] = Logistic().fit(*own[v])
    held = aside if aside.any() else np.ones(len(y), bool)
    calibration = [Logistic().fit(v.odds(x[held])[:, None], y[held]) for v, x in zip(views, labelled, strict=True)]
    odds = np.column_stack([c.odds(v.odds(x[held])[:, None]) for v, c, x in zip(views, calibration, labelled, strict=True)])
    return CoTrained(tuple(views), tuple(calibration), Logistic().fit(odds, y[held]))


def _features(text, source, lang, size) -> tuple[np.ndarray, np.ndarray]:
    x = [text_features(t) for t in text]
    p = [page_features(*v) for v in zip(source, lang, size, strict=True)]
    return np.array(x).reshape(len(x), -1), np.array(p).reshape(len(p), -1)


def _view(docs: DataFrame, key: str) -> DataFrame:
    """The columns that the views are made from; those that are missing count as null."""
    column = lambda name, kind: (F.col(name) if name in docs.columns else F.lit(None)).cast(kind).alias(name)
    return docs.select(F.col(key), column("text", "string"), column("source", "string"), column("lang", "string"), column("n_chars", "long"))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", quality: str = "quality", max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS, give: int = GIVE, seed: int = 0) -> CoTrained | None:
    """Learn from ``labels`` (key, quality 0 or 1); None if they are not of both kinds."""
    known = labels.where(F.col(key).isNotNull() & F.col(quality).isin(0, 1)).groupBy(key).agg(F.min(quality).cast("double").alias("y"))
    ids = materialize(docs.where(F.col(key).isNotNull()).select(key).distinct().join(known, key), "labelled")
    n = ids.count()
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(seed), F.lit("quality")), F.lit(1 << 30)) / float(1 << 30)
    chosen = ids.where(draw < min(1.0, max_labelled / max(1, n)))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x, p = _features(*(part.column(i).to_pylist() for i in (1, 2, 3, 4)))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([r.astype(np.float32).tobytes() for r in m], pa.binary()) for m in (x, p))], ["node", "x", "p"])

    plain = _view(docs.where(F.col(key).isNotNull()), key)
    features = plain.withColumn("node", F.xxhash64(key)).select("node", "text", "source", "lang", "n_chars").mapInArrow(run, "node long, x binary, p binary")
    features = materialize(features, "features")  # so that no text is shuffled
    sample = features.join(F.broadcast(chosen.select(F.xxhash64(key).alias("node"), "y")), "node").toArrow()  # max_labelled rows or about
    if not sample.num_rows:
        return None
    sample = sample.sort_by("node")
    every = np.arange(sample.num_rows)
    x, p = (_rows(sample[c].combine_chunks(), every) for c in ("x", "p"))
    y = sample["y"].to_numpy()
    if len(set(y.tolist())) < 2:
        return None
    table = materialize(features.join(known.select(F.xxhash64(key).alias("node")), "node", "left_anti"), "unlabelled")
    discard(features)
    model = co_train((x, p), y, TablePool(table), rounds, give, seed)
    discard(table)
    discard(ids)
    return model


def score(docs: DataFrame, model: CoTrained | None, key: str = "doc_id", keep_at: float = KEEP_AT) -> DataFrame:
    """(key, text_score, page_score, score, keep) for every row."""
    if model is None:
        one = F.lit(1.0)
        return docs.select(key, one.alias("text_score"), one.alias("page_score"), one.alias("score"), F.lit(True).alias("keep"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                parts = shared.value.parts(*_features(*(part.column(i).to_pylist() for i in (1, 2, 3, 4))))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(v) for v in parts), pa.array(parts[2] >= keep_at)], [key, "text_score", "page_score", "score", "keep"])

    kind = docs.schema[key].dataType.simpleString()
    return _view(docs, key).mapInArrow(run, f"{key} {kind}, text_score double, page_score double, score double, keep boolean")


def keep(docs: DataFrame, model: CoTrained | None, key: str = "doc_id", keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` that score ``keep_at`` or more; judged row by row, without a join."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    place = {c: names.index(c) for c in ("text", "source", "lang", "n_chars") if c in names}

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                columns = [part.column(place[c]).to_pylist() if c in place else [None] * part.num_rows for c in ("text", "source", "lang", "n_chars")]
                good = shared.value.parts(*_features(*columns))[2] >= keep_at
                yield part.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, train(docs, labels))
