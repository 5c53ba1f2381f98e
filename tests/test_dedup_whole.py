import random

from gristmill.operators import dedup
from gristmill.plans import catalog


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(n))


def test_whole_texts_are_compared(spark):
    head, body = words(0, 90), words(1, 3000)
    rows = [(1, head + " " + words(2, 1500)), (2, head + " " + words(3, 1500)), (3, words(4, 90) + " " + body), (4, words(5, 90) + " " + body)]
    got = {r[0]: r[1] for r in dedup.near_duplicates(spark.createDataFrame(rows, "id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 3}


def test_short_rows_are_kept(spark, tmp_path):
    text = words(6, 50)
    spark.createDataFrame([(1, "short"), (2, "short"), (3, None), (4, text), (5, text)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r[0]: r[1] for r in catalog.QUERIES["minhash_greedy"](spark, str(tmp_path)).collect()}
    assert got == {1: True, 2: True, 3: True, 4: True, 5: False}
