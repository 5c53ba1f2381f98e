import numpy as np
from pyspark.sql import functions as F

from gristmill.llm import chroma


def brute(a, b):
    votes = {}
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            if x == y:
                votes[j - i] = votes.get(j - i, 0) + 1
    if not votes:
        return 0, 0, 1.0
    at = min((o for o in votes if votes[o] == max(votes.values())), key=lambda o: (abs(o), o))
    return at, votes[at], chroma.error_at(np.array(a), np.array(b), at)


def test_silences_and_held_tones_of_different_lengths_align(spark):
    tone = lambda f, n: 0.5 * np.sin(2 * np.pi * f * np.arange(n) / chroma.RATE)
    sounds = [np.zeros(20000), np.zeros(33000), tone(440, 20000), tone(440, 40000), np.concatenate([tone(300, 15000), np.zeros(15000)])]
    prints = chroma.fingerprints(spark.createDataFrame([(i, bytearray(chroma.encode_wav(x))) for i, x in enumerate(sounds)], "id long, audio binary"), "id", "audio")
    p = {r["id"]: np.array(r["print"], np.int32).view(np.uint32) for r in prints.collect()}
    want = {(a, b): brute(p[a].tolist(), p[b].tolist()) for a in p for b in p if a != b}
    want = {k: v for k, v in want.items() if v[1] >= chroma.MIN_VOTES and v[2] <= chroma.MAX_ERROR}
    got = {(r["a"], r["b"]): (r["offset"], r["votes"], r["error"]) for r in chroma.pairs(prints, F.lit(True), "id").collect()}
    assert got == want and (0, 1) in got and (2, 3) in got


def test_long_held_values_are_correlated():
    rng = np.random.default_rng(1)
    for n, m in ((900, 700), (300, 1200)):
        a, b = (rng.choice([7, 7, 7, 9], k).astype(np.uint32) for k in (n, m))
        assert chroma.best_offset(a, b) == brute(a, b)


def test_blocks_of_queries_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    prints = [rng.choice([7, 7, 9, 11], k).astype(np.uint32) for k in (40, 3, 5, 60, 17, 1)] + [np.full(30, 7, np.uint32), np.full(4, 7, np.uint32), np.zeros(0, np.uint32)]
    prints += [rng.integers(0, 1 << 32, 50, dtype=np.uint32) for _ in range(4)] + [prints[0].copy()]
    table = spark.createDataFrame([(i, p.view(np.int32).tolist()) for i, p in enumerate(prints)] + [(None, [7, 7, 7])], "id long, print array<int>")
    asked = {i for i in range(len(prints)) if i % 2 == 0} | {len(prints) - 1}
    want = {}
    for a in range(len(prints) - 1):
        for b in range(len(prints) - 1):
            if a != b and (a in asked):
                v = brute(prints[a].tolist(), prints[b].tolist())
                if v[1] >= chroma.MIN_VOTES and v[2] <= chroma.MAX_ERROR:
                    want[a, b] = v
    found = chroma._classes_and_pairs(table, F.col("id").isin(*asked), "id", chroma.MIN_VOTES, chroma.MAX_ERROR, block_steps=60)[1]
    assert {(r["a"], r["b"]): (r["offset"], r["votes"], r["error"]) for r in found.collect()} == want and want


def test_align_of_an_empty_table(spark):
    table = spark.createDataFrame([], "id long, print array<int>, value int")
    assert chroma.align(table, F.lit(True), "id").collect() == []
