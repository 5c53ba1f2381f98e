import hashlib
import random

import numpy as np
import pytest

from gristmill.llm import suffix


def brute(rows, length=200):
    raws = [(t or "").encode() for _, t in rows]
    seen = {}
    for r in raws:
        for i in range(len(r) - length + 1):
            seen[r[i : i + length]] = seen.get(r[i : i + length], 0) + 1
    out = []
    for (key, _), r in zip(rows, raws, strict=True):
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        out.append((key, len(r), len(r) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus():
    random.seed(9)
    words = ["".join(random.choice("abcdeé") for _ in range(random.randint(1, 7))) for _ in range(400)]
    text = lambda n: " ".join(random.choice(words) for _ in range(n))
    shared, edge = text(60), text(30)
    rows = [(i, f"{text(40)} {shared} {text(40)}") for i in range(12)]
    rows += [(20 + i, f"{edge} {text(10)} {edge[:150]}{edge[:100]}") for i in range(4)]
    rows += [(30, "x" * 700), (31, "ab" * 300), (32, text(20)), (33, None), (34, ""), (35, text(300)), (36, text(35))]
    rows += [(40, rows[0][1]), (41, rows[-2][1]), (42, rows[-1][1][:199]), (43, shared[:199]), (44, shared[3:203])]
    return rows


@pytest.mark.parametrize(("group_runs", "bucket_rows"), [(suffix.GROUP_RUNS, suffix.BUCKET_ROWS), (1, 40), (suffix.GROUP_RUNS, 7)])
def test_matches_brute_force(spark, group_runs, bucket_rows):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffix.remove(docs, report=True, group_runs=group_runs, bucket_rows=bucket_rows)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_sections_of_a_long_text(monkeypatch):
    data = np.frombuffer(" ".join(str(i * 7919 % 1013) for i in range(4000)).encode(), np.uint8)
    whole = suffix.chosen(data, np.array([0, len(data)]))
    windows = {w: p for p, a, b in zip(*whole[1:4], strict=True) for w in range(a, b + 1)}
    parts = {}
    for lo, hi in suffix.sections(len(data), 200, 1000):
        _, place, first, last, _, _ = suffix.chosen(data[lo:hi], np.array([0, hi - lo]))
        for p, a, b in zip(place + lo, first + lo, last + lo, strict=True):
            for w in range(a, b + 1):
                assert w not in parts
                parts[w] = p
    assert parts == windows


def test_multikey_sort():
    random.seed(2)
    items = [(random.randrange(3), bytes(random.choice(b"ab") for _ in range(24))) for _ in range(300)]
    words = np.frombuffer(b"".join(b for _, b in items), ">u8").astype(np.uint64).reshape(-1, 3)
    order, common = suffix.multikey_sort(np.array([g for g, _ in items]), words)
    ranked = [items[i] for i in order]
    assert ranked == sorted(items)
    for (g, a), (h, b), c in zip(ranked, ranked[1:], common[1:], strict=False):
        assert c == (-1 if g != h else next((i for i in range(24) if a[i] != b[i]), 24))


def test_general_form(spark):
    rows = [(1, "é" * 150 + "!", 1), (2, "?" + "é" * 150, 2), (None, "é" * 150, 3), (4, None, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    got = {r["start"]: r["text"] for r in suffix.remove(docs).collect()}
    assert got == {1: "!", 2: "?", 3: "", 4: None}
    assert suffix.remove(docs).columns == docs.columns
    assert suffix.remove(docs.limit(0), report=True).count() == 0


def test_hot_leading_tokens_over_many_buckets(spark):
    """One passage in every text, alike in its run in most and cut differently in the rest."""
    random.seed(4)
    words = ["".join(random.choice("mnopqr") for _ in range(5)) for _ in range(300)]
    text = lambda n: " ".join(random.choice(words) for _ in range(n))
    passage = text(40)
    rows = [(i, passage) for i in range(60)] + [(100 + i, f"{text(3)} {passage[i:]} {text(4)}") for i in range(25)] + [(200 + i, passage[: 190 + i]) for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(tuple(r) for r in suffix.remove(docs, report=True, bucket_rows=5).collect()) == brute(rows)


def test_repeated_ids_and_missing_ids_are_judged_by_their_own_text(spark):
    random.seed(3)
    text = lambda n: "".join(random.choice("abcdefgh ") for _ in range(n))
    shared = text(300)
    rows = [(1, text(500)), (1, shared), (2, text(50) + shared), (None, text(400)), (None, shared[:250]), (3, text(600)), (3, text(10))]
    rows += [(4, rows[5][1])] + [(5, text(260))] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in suffix.remove(docs, report=True).collect()), key=str)
    assert got == sorted(((None if r[0] == -1 else r[0], *r[1:]) for r in brute([(-1 if k is None else k, t) for k, t in rows])), key=str)


def test_clashing_columns_stay(spark):
    docs = spark.createDataFrame([(1, "q" * 450, 1, 2, 3, "a")], "doc_id long, text string, lead int, run int, place int, copies string")
    got = suffix.remove(docs)
    assert got.columns == docs.columns and got.first()["text"] == "" and got.first()["copies"] == "a"
