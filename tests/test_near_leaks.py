import numpy as np

from gristmill.operators import dataset
from gristmill.operators.dedup import signatures


def _texts():
    rng = np.random.default_rng(4)
    out = []
    for _ in range(12):
        base = [f"w{x}" for x in rng.integers(0, 900, 60)]
        for k in range(7):
            words = list(base)
            for _ in range(2 * k):
                words[rng.integers(len(words))] = f"x{rng.integers(999)}"
            out.append(" ".join(words))
    return out + out[:3] + [None, "", "", "short", "a longer text behind all others " * 4000]


def _near(sig, a, b, threshold):
    return np.mean(np.array(sig[a]) == np.array(sig[b])) >= threshold


def test_near_leaks_against_all_pairs(spark):
    texts = _texts()
    rows = [(i, t, "train" if i % 3 else "val", 7) for i, t in enumerate(texts)] + [(None, texts[0], "val", 7), (900, texts[-1], None, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, split string, score int").repartition(3)
    sig = {r["id"]: r["sig"] for r in signatures(df.where("doc_id is not null"), "doc_id", "text", 128).collect()}
    train = [r[0] for r in rows if r[2] == "train"]
    held = [r[0] for r in rows if r[2] != "train" and r[0] is not None]
    want = {h for h in held if any(_near(sig, h, t, 0.8) for t in train)}
    got = dataset.near_leaks(df, "doc_id", "text", "split").collect()
    assert {r["id"] for r in got} == want and len(got) == len(want) and 10 < len(want) < len(held)
    assert all(r["item"] in train and _near(sig, r["id"], r["item"], 0.8) for r in got)
    assert dataset.near_leaks(df.limit(0), "doc_id", "text", "split").count() == 0


def test_decontaminate_against_all_pairs(spark):
    texts = _texts()
    incoming = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    bench = spark.createDataFrame([("a", texts[0]), ("b", texts[9]), ("c", "short"), ("d", None), ("e", texts[0])], "id string, text string")
    sig = {r["id"]: r["sig"] for r in signatures(incoming, num_perm=128).collect()}
    want = {i for i in sig if _near(sig, i, 0, 0.65) or _near(sig, i, 9, 0.65)} | {i for i, t in enumerate(texts) if t in ("short", "", None)}
    got = {r["id"]: r for r in dataset.decontaminate(incoming, bench).collect()}
    assert set(got) == want
    assert (got[0]["item"], got[0]["method"]) == ("a", "exact")
    assert got[texts.index("short")]["method"] == "exact"


def test_texts_of_one_vocabulary_do_not_meet(spark, monkeypatch):
    """unlike texts that share many minima met in all buckets, each held one with nearly all others."""
    rng = np.random.default_rng(9)
    common = [f"word{x}" for x in range(40)]
    texts = [" ".join([*rng.permutation(common), *(f"{x:x}" for x in rng.integers(1 << 40, size=7))]) for _ in range(120)]
    texts += [texts[i] + f" end{i}" for i in range(1, 120, 3)]
    df = spark.createDataFrame([(i, t, "train" if i % 3 else "val") for i, t in enumerate(texts)], "doc_id long, text string, split string")
    sig = {r["id"]: np.array(r["sig"]) for r in signatures(df, "doc_id", "text", 128).collect()}
    score = {i: max((float(np.mean(sig[i] == sig[j])), -j) for j in sig if j % 3) for i in sig if i % 3 == 0}
    pairs = [float(np.mean(sig[i] == sig[j])) for i in sig if i % 3 == 0 for j in sig if j % 3]
    met, meet = [], dataset._meet
    monkeypatch.setattr(dataset, "_meet", lambda *a: met.append(meet(*a)) or met[-1])
    got = {r["id"]: (r["score"], -r["item"]) for r in dataset.near_leaks(df, "doc_id", "text", "split").collect()}
    assert got == {i: s for i, s in score.items() if s[0] >= 0.8} and len(got) > 3
    assert np.mean(np.array(pairs) > 0.3) > 0.9
    assert sum(m.distinct().count() for m in met) < 3 * len(got)
