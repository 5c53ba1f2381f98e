import numpy as np

import corpus_pipeline
from gristmill.llm import nearset


def brute(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_shingles():
    for t in (None, "", " \n", "one", "One one", "a b c d e", "a b c d e a b c d e a b", "w " * 300):
        assert len(nearset.shingles(t)) == len(brute(t))
    assert nearset.shingles("a b").tolist() != nearset.shingles("b a").tolist()


def test_stage_keeps_one_of_near_copies(spark):
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(8):
        base = [f"w{x}" for x in rng.integers(0, 400, 200)]
        for k in range(12):
            words = list(base)
            for _ in range(k % 7):
                words[rng.integers(len(words))] = "changed"
            texts.append(" ".join(words))
    texts += [None, "", "few words", "Few  words", "few words more"]
    sets = [brute(t) for t in texts]
    label = list(range(len(texts)))
    close = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    for _ in range(len(texts)):
        for i, j in close:
            label[i] = label[j] = min(label[i], label[j])
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(None, "few words", 0), (0, texts[0], 0)], "doc_id long, text string, n_chars int").repartition(3)
    kept = corpus_pipeline.near_dedup_stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted(set(label))
    assert kept.where("doc_id is null").count() == 1
    assert nearset.components(docs.limit(0)).count() == 0


def test_possible_holds_every_link_around_a_pivot(spark):
    """Sets around one pivot: with changes, cut short, grown, or unlike it; each linked pair of two components is a candidate."""
    rng = np.random.default_rng(9)
    pivot = np.unique(rng.integers(0, 1 << 63, 120).astype(np.uint64))
    extra = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    sets = []
    for k in range(90):
        own = pivot[rng.random(len(pivot)) < rng.choice([0.72, 0.8, 0.86, 0.95])] if k % 3 else pivot[: rng.integers(70, 118)]
        sets.append(np.unique(np.concatenate([own, extra[rng.random(60) < rng.choice([0, 0.05, 0.3])]])))
    sets += [np.unique(np.concatenate([extra, pivot[:n]])) for n in (0, 1, 2, 3)]

    def jaccard(a, b):
        shared = len(np.intersect1d(a, b))
        return shared / (len(a) + len(b) - shared)

    linked = [jaccard(pivot, s) >= 0.8 for s in sets]
    component = [-1 if yes else i for i, yes in enumerate(linked)]
    rows = []
    for i, s in enumerate(sets):
        out = np.setdiff1d(s, pivot)
        rows.append((-5, i, component[i], linked[i], len(s), len(s) - len(out), out[: int(0.2 * len(s) + 1e-6) + 1].view(np.int64).tolist()))
    around = spark.createDataFrame(rows, "pivot long, node long, component long, linked boolean, size long, common long, outside array<long>")
    found = {tuple(r) for r in nearset.possible(around, 0.8).collect()}
    wanted = {(i, j) for j in range(len(sets)) for i in range(j) if component[i] != component[j] and jaccard(sets[i], sets[j]) >= 0.8}
    inside = {(i, j) for i, j in wanted if not set(rows[i][6]) & set(rows[j][6])}
    assert len(wanted) > 50 and inside
    assert wanted <= found
    assert len(found) < len(sets) * (len(sets) - 1) // 2
    assert not nearset.possible(around.limit(0), 0.8).collect()


def test_anchors_are_golay_points_and_near_sets_share_some():
    _, points = nearset._points()
    both = np.concatenate([points.T, -points.T])
    assert len(np.unique(both, axis=0)) == 4096
    assert sorted(set((points.T @ both.T).reshape(-1).tolist())) == [-24, -8, 0, 8, 24]  # 8, 12 or 16 signs differ
    rng = np.random.default_rng(11)
    for n, shared in ((9, 8), (45, 40), (360, 320)):
        values = rng.integers(0, 1 << 63, (300, 2 * n - shared)).astype(np.uint64)
        a, b = (np.stack([nearset.sums(np.sort(v)) for v in part]) for part in (values[:, :n], values[:, n - shared :]))
        same = (nearset.anchors(a) == nearset.anchors(b)).sum(1)
        assert same.min() > 0 and 11 < same.mean() < 17
        assert ((a[:, :128] > 0) != (b[:, :128] > 0)).sum(1).max() <= nearset.FAR
        other = np.roll(b, 1, axis=0)
        assert (nearset.anchors(a) == nearset.anchors(other)).sum() <= 1
    assert set(nearset.sums(np.zeros(0, np.uint64)).tolist()) == {0}


def test_meetings_are_compared_within_their_anchor(spark):
    near, far = 0, -1
    rows = [(1, near, near, [5, 6]), (1, near, near, [5, 6]), (2, near, 1, [5, 7]), (3, far, far, [5, 6]), (4, far, 3, [8]), (5, near, near, [])]
    found = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, node long, low long, high long, anchors array<int>").repartition(3)
    met = nearset.meeting(found)
    assert sorted(map(tuple, met.collect())) == [(5, 1), (5, 2), (5, 3), (6, 1), (6, 3)]
    assert sorted(map(tuple, nearset.close(met, found).collect())) == [(5, 1), (5, 2)]
    assert not nearset.close(nearset.meeting(found.limit(0)), found).collect()


def test_a_group_around_a_pivot_does_not_become_all_its_pairs(spark):
    """Members that are less than 0.8 like the pivot and share some of few possible changes: only links, or what connects them, are handed on."""
    rng = np.random.default_rng(3)
    pivot = np.unique(rng.integers(0, 1 << 63, 200).astype(np.uint64))
    changes = rng.integers(0, 1 << 63, (40, 5)).astype(np.uint64)
    sets = []
    for k in range(160):
        own = rng.choice(40, 5, replace=False) if k % 8 else sorted(rng.choice(40, 5, replace=False))
        sets.append(np.unique(np.concatenate([np.delete(pivot, [5 * c + i for c in own for i in range(5)]), *changes[own]])))
        if not k % 8:
            sets.append(sets[-1][1:])  # a link of its own

    shared = lambda a, b: len(np.intersect1d(a, b))
    rows = []
    for i, s in enumerate(sets):
        out = np.setdiff1d(s, pivot)
        rows.append((-5, i, i, False, len(s), len(s) - len(out), out[: int(0.2 * len(s) + 1e-6) + 1].view(np.int64).tolist(), np.packbits(np.isin(pivot, s)).tobytes()))
    around = spark.createDataFrame(rows, "pivot long, node long, component long, linked boolean, size long, common long, outside array<long>, holds binary")
    links = {(i, j) for j in range(len(sets)) for i in range(j) if 1.8 * shared(sets[i], sets[j]) >= 0.8 * (len(sets[i]) + len(sets[j]))}

    def parts(pairs):
        label = list(range(len(sets)))
        for _ in label:
            for i, j in pairs:
                label[i] = label[j] = min(label[i], label[j])
        return label

    assert 20 <= len(links) < 2000
    for size in (1024, 30):  # in one block, and in several
        found = {tuple(r) for r in nearset.possible(around, 0.8, size).collect()}
        assert found <= links and len(found) < 2 * len(sets)
        assert parts(found) == parts(links)


def test_a_group_of_near_copies_has_few_pivots(spark, monkeypatch):
    """Copies of one text that meet at many anchors, too far from each other to be one component: each is measured against about one pivot."""
    rng = np.random.default_rng(17)
    base = [f"w{x}" for x in rng.integers(0, 400, 150)]
    texts = []
    for k in range(160):
        words = list(base)
        for at in rng.choice(150, 1 + k % 9, replace=False):
            words[at] = f"new{rng.integers(30)}"
        texts.append(" ".join(words))
    sets = [brute(t) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    label = list(range(len(texts)))
    for _ in label:
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    compared = []
    measured = nearset.measured
    monkeypatch.setattr(nearset, "measured", lambda pairs, *rest: compared.append(pairs.distinct().count()) or measured(pairs, *rest))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["component_id"] for r in nearset.components(docs).collect()}
    assert found == dict(enumerate(label))
    assert 1 < len(set(label)) < len(texts)
    assert len(texts) // 2 < sum(compared) < 2 * len(texts)


def test_members_of_an_anchor_have_a_pivot_in_common(spark):
    rng = np.random.default_rng(23)
    rows = sorted({(int(b), int(n)) for b, n in zip(rng.integers(0, 40, 160), rng.integers(0, 90, 160), strict=True)})
    found = [tuple(r) for r in nearset.stars(spark.createDataFrame(rows, "bucket int, node long")).collect()]
    assert len(found) == len(set(found)) and all(i != j for i, j in found)
    around = {i: {i} for i, _ in found}
    for i, j in found:
        around[i].add(j)
    for bucket in {b for b, _ in rows}:
        members = {n for b, n in rows if b == bucket}
        assert len(members) == 1 or any(members <= star for star in around.values())
    assert not nearset.stars(spark.createDataFrame([], "bucket int, node long")).collect()
