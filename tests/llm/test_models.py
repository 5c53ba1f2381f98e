import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from gristmill.functions.buffers import flat_bytes
from gristmill.llm import ctw, langid, quality

SF = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- context-tree weighting


def brute_ctw(train, score, depth):
    """Sequential definition: the ratio of weighted probabilities with and without each bit."""
    counts, kids = defaultdict(lambda: [0, 0]), defaultdict(set)

    def walk(x):
        b = b"\xff" * depth + x + b"\xff"
        for i in range(depth, len(b)):
            for bit in range(8):
                yield b[i - depth : i], (1 << bit) | (b[i] >> (8 - bit)), b[i] >> (7 - bit) & 1

    for x in train:
        for c, node, one in walk(x):
            for d in range(depth + 1):
                counts[c[depth - d :], node][one] += 1
                if d < depth:
                    kids[c[depth - d :], node].add((c[depth - d - 1 :], node))
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)

    def weighted(k):
        if k not in counts:
            return 0.0
        own = kt(*counts[k])
        return own if len(k[0]) == depth else np.logaddexp(own, sum(weighted(q) for q in kids[k])) - math.log(2)

    def after(c, node, one, d=0):
        k = (c[depth - d :], node)
        a, b = counts.get(k, (0, 0))
        own = kt(a + (not one), b + one)
        if d == depth:
            return own
        child = (c[depth - d - 1 :], node)
        rest = sum(weighted(q) for q in kids.get(k, ()) if q != child)
        return np.logaddexp(own, rest + after(c, node, one, d + 1)) - math.log(2)

    return [sum(after(*w) - weighted((b"", w[1])) for w in walk(x)) / math.log(10) for x in score]


@pytest.mark.parametrize(("depth", "most"), [(5, ctw.FREQUENT_STRINGS), (5, 20), (3, 0), (1, 4)])
def test_ctw_is_the_definition(spark, depth, most):
    train, score = ["hello world", "abab abab ab", "", "HELLO"], ["hello", "abc world", "", "zé", None]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(train + score)], "doc_id long, text string, value double")
    got = {r["doc_id"]: r for r in ctw.scores(docs, ctw.F.col("doc_id") < len(train), depth=depth, frequent_strings=most).collect()}
    want = np.array(brute_ctw([t.lower().encode() for t in train], [(t or "").encode() for t in score], depth))
    assert np.allclose([got[len(train) + i]["score"] for i in range(len(score))], want, atol=1e-9)
    sizes = [len((t or "").encode()) + 1 for t in score]
    assert np.allclose([got[len(train) + i]["bits_per_byte"] for i in range(len(score))], -want / math.log10(2) / sizes)


def test_ctw_without_texts(spark):
    docs = spark.createDataFrame([(2, "ab")], "doc_id long, text string")
    assert abs(ctw.scores(docs, ctw.F.lit(False)).first()["bits_per_byte"] - 8) < 1e-9
    assert ctw.scores(docs.limit(0), ctw.F.lit(True)).collect() == []


def test_base_scores(spark):
    rows = [(i, t) for i, t in enumerate(["The cat", "the dog THE", None, "", "cat　cat x", "rare words here", "the\tend", "É é"])] + [(None, "the cat")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    low = {c: c + 32 for c in range(65, 91)}
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)), None] for _, t in rows]
    learn = [i is None or zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    c = Counter(w for t, ok in zip(tokens, learn, strict=True) if ok for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 9)) for t in tokens)
    for most in (ctw.FREQUENT_WORDS, 0):
        got = ctw.scores(docs, ~ctw.held_out(), frequent_words=most).collect()
        assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 9)) for r in got) == want
    none = ctw.scores(docs, ctw.F.lit(False)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in none)
    assert abs(none[0]["score"]) > 0


# ---------------------------------------------------------------- language


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs, ~langid.held_out())
    got = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out()).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.97
    odd = spark.createDataFrame([(1, None), (2, "12 34 !!"), (3, ""), (4, "the and of with " * 5000), (4, "the and of with " * 5000), (None, "the and of")], "doc_id long, text string")
    seen = sorted(langid.predict(odd, model).collect(), key=lambda r: (r["doc_id"] or 0))
    assert [r["lang_pred"] for r in seen if r["doc_id"] in (1, 2, 3)] == ["und"] * 3
    assert all(0 <= r["score"] <= 1 for r in seen) and seen[-1] == seen[-2] and seen[-1]["lang_pred"] == "en"
    kept = langid.keep(odd.withColumnRenamed("doc_id", "score"), model)  # a clashing name passes through
    assert kept.count() == 3 and kept.columns == ["score", "text"]


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert langid.train(docs, ~langid.held_out()) is None
    assert langid.predict(docs, None).first()["lang_pred"] == "und"


def test_windows_cover_texts():
    data, offsets = flat_bytes(pa.array(["a" * 600, "", "b"]))
    rows, windows, real = langid.windows_of(data, offsets)
    assert rows.tolist() == [0, 0, 0, 2] and real.tolist() == [256, 256, 88, 1] and (windows != 0).sum() == 601


# ---------------------------------------------------------------- quality


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels.where("doc_id % 2 = 0"))
    got = quality.score(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
    assert got.keep[got.quality == 1].mean() > 0.98 and got.keep[got.quality == 0].mean() < 0.1


def test_quality_edge_cases(spark):
    rows = [(i, "good words that differ a lot here" if i % 2 else "bad bad bad bad bad", i % 2) for i in range(40)]
    docs = spark.createDataFrame([(i, t, None, None, None, 7) for i, t, _ in rows] + [(None, None, "s", "l", -1, 7)], "doc_id long, text string, source string, lang string, n_chars long, keep int")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (0, None)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    kept = quality.keep(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} >= {i for i, _, q in rows if q}
    assert quality.score(docs, model).count() == 41
    assert quality.train(docs, labels.where("quality = 1")) is None
    assert quality.keep(docs, None).count() == 41 and quality.score(docs.limit(0), model).count() == 0


def test_co_training_passes_labels_on():
    rng = np.random.default_rng(0)
    y = (rng.random(3000) < 0.5).astype(float)
    a = np.column_stack([y * 4 + rng.normal(size=3000), rng.normal(size=(3000, 5))])
    b = np.column_stack([y * 2 + rng.normal(size=3000), rng.normal(size=(3000, 20))])
    with_pool = quality.co_train((a[:40], b[:40]), y[:40], (a[40:2000], b[40:2000]))
    alone = quality.co_train((a[:40], b[:40]), y[:40], (a[:0], b[:0]))
    right = lambda m, v: ((m.views[v].odds((a, b)[v][2000:]) > 0) == y[2000:]).mean()
    assert right(with_pool, 1) > right(alone, 1)
    random.seed(0)
