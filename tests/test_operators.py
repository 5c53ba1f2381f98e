import datetime as dt
import random

import numpy as np
import pytest

from gristmill.operators import dedup, evaluate, graph, lake, sampling, sensor, vectors


def test_components(spark):
    random.seed(1)
    edges = [(random.randrange(200), random.randrange(200)) for _ in range(120)] + [(i, 500) for i in range(300, 400)] + [(7, 7), (900, 900)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r[0]: r[1] for r in graph.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {v: root(v) for v in parent}
    assert graph.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_greedy_keep(spark):
    links = [(1, 2), (2, 3), (3, 4), (10, 11)]
    got = {r[0]: r[1] for r in dedup.greedy_keep(spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 10, 11, 20)], "id long"), spark.createDataFrame(links, "src long, dst long")).collect()}
    assert got == {1: True, 2: False, 3: True, 4: False, 10: True, 11: False, 20: True}


def test_near_duplicates(spark):
    base = "the quick brown fox jumps over the lazy dog and runs away from here " * 4
    rows = [(1, base), (2, base), (3, base[:-10] + "elsewhere."), (4, "something else entirely " * 9), (5, ""), (6, None)]
    got = {r[0]: r[1] for r in dedup.near_duplicates(spark.createDataFrame(rows, "id long, text string")).collect()}
    assert got[2] == 1 and got[3] == 1 and got[4] == 4 and got[6] == 5


def _windows(spark, rows):
    return spark.createDataFrame([(d, c, dt.date(2024, 1, 1) + dt.timedelta(days=k), r) for d, c, k, r in rows], "device string, channel string, window_start date, readings array<double>")


def test_stuck_runs(spark):
    rng = np.random.default_rng(0)
    rows = [("d", "a", k, [float(x) for x in rng.normal(0, 1 if k < 40 else 0.01, 20)]) for k in range(52)] + [("d", "b", 0, [1.0, 1.0])]
    got = {(r["channel"], r["window_start"]): r["score"] for r in sensor.stuck(_windows(spark, rows)).collect()}
    day = lambda k: dt.date(2024, 1, 1) + dt.timedelta(days=k)
    assert [got["a", day(k)] for k in range(52)] == [1.0] * 49 + [0.0] * 3
    assert got["b", day(0)] is None


def test_device_stop_and_plans(spark):
    rows = [("d", "a", 0, [1.0, 1.0]), ("d", "b", 0, [2.0, 2.0]), ("d", "a", 1, [-999.0] * 2), ("d", "b", 1, [1.0, 2.0]), ("d", "a", 9, [-999.0] * 2)]
    w = _windows(spark, rows)
    assert [r["window_start"] for r in sensor.device_stops(w).collect()] == [dt.date(2024, 1, 1)]
    plans = spark.createDataFrame([("d", dt.date(2024, 1, 2), dt.date(2024, 1, 3))], "plan_device string, plan_start date, plan_end date")
    got = {(r["channel"], r["window_start"].day): r["score"] for r in sensor.planned_faults(w, plans).collect()}
    assert got == {("a", 1): 1.0, ("b", 1): 1.0, ("a", 2): 1.0, ("b", 2): 1.0, ("a", 10): 0.0}


def test_drift(spark):
    rng = np.random.default_rng(0)
    rows = [("d", "a", k, [float(x) for x in rng.normal(0 if k < 8 else 9, 1, 30)]) for k in range(10)] + [("d", "b", k, [1.0, 2.0, 3.0]) for k in range(5)]
    w = _windows(spark, rows).selectExpr("*", "'m' mode")
    got = {(r["channel"], r["window_start"].day): r["score"] for r in sensor.drift(w).collect()}
    assert got["a", 9] == got["a", 10] == 0.0 and got["a", 3] == 1.0 and all(got["b", k] == 1.0 for k in range(1, 6))


def test_scd2(spark):
    rows = [("x", dt.date(2024, 1, d), a) for d, a in ((1, "p"), (2, "p"), (3, "q"), (5, None), (6, "")) ]
    dim = lake.scd2(spark.createDataFrame(rows, "k string, day date, a string"), ["k"], ["a"], "day").orderBy("version").collect()
    assert [(r["a"], r["valid_from"].day, r["valid_to"].day if r["valid_to"] else None, r["is_current"]) for r in dim] == [("p", 1, 3, False), ("q", 3, 5, False), (None, 5, None, True)]


def test_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    lake.write_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    lake.write_partitions(spark.createDataFrame([(3, "b")], "v int, p string"), path, ["p"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (3, "b")]


def test_quotas_and_samples(spark):
    assert sampling.quotas([("a", 10), ("b", 5)], 6, {}) == {"a": 4, "b": 2}
    df = spark.createDataFrame([(i, "ab"[i % 3 == 0]) for i in range(90)], "id long, s string")
    got = sampling.stratified_sample(df, "s", 30)
    assert got.count() == 30 and got.where("s = 'a'").count() == 20
    assert sampling.random_sample(df.repartition(7), 5).collect() == sampling.random_sample(df, 5).collect()


def test_statistics(spark):
    df = spark.createDataFrame([(True, True), (True, False), (False, False), (False, True)], "a boolean, b boolean")
    assert evaluate.precision_recall(df, "a", "b").first()["precision"] == 0.5
    assert evaluate.kappa(df, "a", "b").first()["kappa"] == 0.0
    same = spark.range(1000).selectExpr("cast(id as double) x")
    assert evaluate.psi(same, same, "x").first()["level"] == "stable"
    assert evaluate.psi(same, same.selectExpr("x + 900 x"), "x").first()["level"] == "significant"
    assert evaluate.sign_test(spark.createDataFrame([(1, 0)] * 8, "a int, b int"), "a", "b")["p"] == pytest.approx(2 / 256)


def test_vector_search(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 8))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(999, None)], "id long, vector array<double>")
    got = vectors.search(df, [(i, x[i].tolist()) for i in range(3)], 4).orderBy("query_id", "rank").collect()
    n = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert [r["id"] for r in got] == np.argsort(-(n[:3] @ n.T), axis=1)[:, :4].ravel().tolist()


def test_multivariate(spark):
    import pandas as pd

    rng = np.random.default_rng(0)
    f = rng.normal(size=(100, 1))
    x = f @ np.array([[1, 2, -1, 0.5]]) + 0.05 * rng.normal(size=(100, 4))
    x[90:, 2] += 5
    df = pd.DataFrame(x, columns=list("abcd")).assign(kind="k", device=1, at=range(100))
    out = sensor.multivariate(spark.createDataFrame(df), "kind", "device", "at", list("abcd")).toPandas().sort_values("at")
    assert out.flagged[90:].all() and out.flagged[:90].mean() < 0.1 and (out.top_channel[90:] == "c").all()


def test_envelopes_and_alerts(spark):
    rng = np.random.default_rng(0)
    rows = [("d", "a", k, [float(x) for x in rng.normal(10, 1, 50)]) for k in range(20)] + [("d", "b", k, [1.0, 1.0]) for k in range(20)] + [("d", "c", k, [float(x) for x in rng.normal(k * 5, 1, 50)]) for k in range(20)]
    got = {r["channel"]: r for r in sensor.envelopes(_windows(spark, rows), ["channel"]).collect()}
    assert set(got) == {"a"} and 6 < got["a"]["lo"] < 8 and 12 < got["a"]["hi"] < 14
    a = spark.createDataFrame([("k", "x", "info", 1), ("k", "x", "error", 2), ("k", "y", "warning", 3)], "kind string, dataset string, severity string, at int")
    assert {(r["dataset"], r["severity"], r["n"]) for r in lake.converge_alerts(a).collect()} == {("x", "error", 2), ("y", "warning", 1)}
    m = spark.createDataFrame([("up", {"b": '2"', "a": "1"}, 1.5), ("n", {}, 2.0)], "name string, labels map<string,string>, value double")
    assert sorted(r[0] for r in lake.prometheus(m).collect()) == ["n 2.0", 'up{a="1",b="2\\""} 1.5']
