import numpy as np
import xxhash

from gristmill.llm import simhash


def test_golay_code_is_perfect():
    leaders, lists = simhash.golay()
    assert len(set(leaders.tolist())) == 2048 and np.bitwise_count(leaders).max() == 3
    assert np.diff(lists[0][0]).tolist() == [1] * 2048
    assert round(np.diff(lists[2][0]).mean(), 2) == 21.75  # the ball of 5 bits against that of 3


def test_linked_fingerprints_share_a_home_anchor():
    rng = np.random.default_rng(0)
    x = rng.integers(-(2**63), 2**63 - 1, 2000, dtype=np.int64).view(np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(64, 2, replace=False):
            y[i] ^= np.uint64(1) << np.uint64(b)
    rx, ax, _ = simhash.anchors(x.view(np.int64))
    ry, ay, hy = simhash.anchors(y.view(np.int64))
    visits = set(zip(rx.tolist(), ax.tolist(), strict=True))
    assert all(v in visits for v in zip(ry[hy].tolist(), ay[hy].tolist(), strict=True))


def brute(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint():
    for t in (None, "", "  \n", "One", "one TWO", "a b c", "a b c d a b c d", "É x　y z É x　y", "w " * 300):
        assert simhash.fingerprint(t) == brute(t)


def components(fps, ids):
    label = dict(enumerate(range(len(fps))))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= 2 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return [min(ids[j] for j in range(len(fps)) if label[j] == label[i]) for i in range(len(fps))]


def test_components_match_brute_force(spark):
    rng = np.random.default_rng(4)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 500, 150)) for _ in range(12)]
    texts = []
    for b in base:
        for k in range(4):
            words = b.split()
            for _ in range(k):
                words[rng.integers(len(words))] = "changed"
            texts.append(" ".join(words))
    texts += [None, "", "\n", "twice", "twice"]
    ids = [1000 - i for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts, range(len(texts)), strict=True)), "doc_id long, text string, fp int").repartition(3)
    want = dict(zip(ids, components([brute(t) for t in texts], ids), strict=True))
    for rows in (simhash.ANCHOR_ROWS, 1):  # compared per anchor, and by shared points
        assert {r["doc_id"]: r["component_id"] for r in simhash.components(docs, anchor_rows=rows).collect()} == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_empty_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c"), (5, "a b c"), (5, "a b c")], "doc_id long, text string")
    assert {r["component_id"] for r in simhash.components(docs).collect()} == {5}
    assert simhash.keep_one(docs).count() == 2  # one of the repeated rows, and the one without an id
    assert simhash.components(docs.limit(0)).count() == 0
