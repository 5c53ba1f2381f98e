import hashlib

import pytest
from pyspark.sql import functions as F

from gristmill.operators import dedup, detection, evaluate, funnel, tuning, warehouse
from gristmill.sources import samples


def test_blocks_are_next_fit_and_keep_splits_apart(spark):
    rows = [(i, [i % 7] * (i * 5 % 23), "val" if i % 5 == 0 else "train") for i in range(60)] + [(99, [1] * 50, "train")]
    got = tuning.pack_blocks(spark.createDataFrame(rows, "id long, tokens array<int>, split string"), "id", "tokens", "split", 20, 256).collect()
    assert all(len(r["input_ids"]) == 20 == len(r["loss_mask"]) and sum(r["loss_mask"]) == r["n_real"] for r in got)
    for split in ("val", "train"):
        want, cur = [], []
        for _, ids, _ in sorted((r for r in rows if r[2] == split), key=lambda r: str(r[0])):
            seq = [*ids, 256]
            if len(seq) > 20:
                want += [cur] * bool(cur) + [seq[i : i + 20] for i in range(0, len(seq) - 19, 20)]
                cur = []
                continue
            if len(cur) + len(seq) > 20:
                want.append(cur)
                cur = []
            cur = cur + seq
        want += [cur] * bool(cur)
        mine = [r["input_ids"][: r["n_real"]] for r in sorted(got, key=lambda r: r["block_id"]) if r["split"] == split]
        assert mine == want


def test_corrupted_facts(spark):
    rows = [(i, [f"fact {i} with {i} things", "second 100%"]) for i in range(200)] + [(999, [])]
    got = tuning.corrupt_facts(spark.createDataFrame(rows, "id long, facts array<string>"), "id", "facts").collect()
    assert len(got) == 200 and {r["kind"] for r in got} == {"number_swap", "hallucinate", "omit"}
    for r in got:
        assert {"number_swap": r["corrupted"][1:] == r["facts"][1:] and len(r["corrupted"][0]) == len(r["facts"][0]), "hallucinate": r["corrupted"][1:] == r["facts"], "omit": r["corrupted"] == r["facts"][:1]}[r["kind"]]
        assert r["kind"] != "number_swap" or r["corrupted"] != r["facts"]


def test_running_total_and_mix(spark):
    rows = [(i, (i * 7) % 13) for i in range(500)]
    got = {r["id"]: r["spent_before"] for r in tuning.running_total(spark.createDataFrame(rows, "id long, c int"), "id", "c", 7).collect()}
    total = 0
    for i, c in rows:
        assert got[i] == total
        total += c
    d = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(300)] + [(1000 + i, "c") for i in range(9)], "id long, s string")
    assert {r[0]: r[1] for r in tuning.mix(d, "s", {"a": 2, "b": 1}, "id").groupBy("s").count().collect()} == {"a": 200, "b": 100}
    assert tuning.mix(d, "s", {"a": 1, "z": 1}, "id").count() == 0


def test_preference_split_needs_enough(spark):
    with pytest.raises(ValueError, match="fewer than"):
        tuning.preference_split(spark.range(10), "id")


def test_tolerant_lines(spark):
    lines = ['﻿{"id": "a", "text": "x"}', '{"text": "no id"}', "{broken", "", '{"id": "b", "text": " "}']
    rows = samples.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"), "id string, text string")
    got = rows.collect()
    assert len(got) == 4 and got[0]["id"] == "a" and got[1]["id"].startswith("row") and got[2][samples.BAD] == "{broken" and got[2]["id"] is None
    report = samples.check_upload(rows, ["text"], ["id", "text"]).first()
    assert (report["n_lines"], report["n_bad"], report["empty_text"], report["ok"]) == (4, 1, 1, False)
    with pytest.raises(ValueError, match="not there"):
        samples.check_upload(rows, ["lang"], ["id"])


def test_prune_report(spark, tmp_path):
    path = str(tmp_path / "lake")
    spark.range(100).withColumn("day", F.when(F.col("id") < 50, "d1").otherwise("d2")).repartition(1).write.partitionBy("day").parquet(path)
    df = samples.scan(spark, path)
    r = samples.prune_report(df, F.col("day") == "d1").first()
    assert (r["n_files"], r["n_read"]) == (2, 1) and 0 < r["skipped"] < 1
    assert samples.prune_report(df, F.col("day") == "none").first()["skipped"] is None


def test_greedy_buckets_and_links_against_brute_force(spark):
    keyed = [(1, "a"), (2, "a"), (2, "b"), (3, "b"), (3, "c"), (4, "c"), (5, "d"), (6, "d"), (6, "e"), (7, "e")]
    got = {r["rep"]: r["kept"] for r in dedup.greedy_buckets(spark.createDataFrame(keyed, "rep long, bucket string")).collect()}
    kept = []
    for n in sorted({n for n, _ in keyed}):
        own = {b for m, b in keyed if m == n}
        if not any(own & {b for m, b in keyed if m == k} for k in kept):
            kept.append(n)
    assert {n for n, k in got.items() if k} == set(kept)


def test_at_ranks(spark):
    values = [float((i * 37) % 101) for i in range(1000)] + [5.0] * 400
    ordered = sorted(values)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for k in (1, 2, 400, 777, 1400):
        assert evaluate.at_ranks(df, "v", [k], 20) == [ordered[k - 1]]
    assert evaluate.at_ranks(df.where("v is null"), "v", [1]) == []


def test_levels_gate_and_parity(spark):
    recall = spark.createDataFrame([("a", 10, 0.95), ("b", 10, 0.2), ("c", 10, 0.5), ("d", 10, 0.5)], "form string, n long, rate double")
    ceiling = spark.createDataFrame([("a", 1.0), ("b", 0.2), ("c", 0.9)], "form string, ceiling double")
    got = {r["form"]: r["verdict"] for r in detection.judge_levels(recall, {"a": (0.9, 0.1), "b": (0.9, 0.1), "c": (0.9, 0.1), "d": (None, 0.1)}, ceiling).collect()}
    assert got == {"a": "PASS", "b": "CEILING", "c": "BREACH", "d": "NO_SLO"}
    now = spark.createDataFrame([(1.0, 0.5), (2.0, None), (3.0, 0.1)], "threshold double, rate double")
    frozen = spark.createDataFrame([(1.0, 0.52), (2.0, 0.3), (4.0, None)], "threshold double, rate double")
    assert {r["threshold"]: r["ok"] for r in detection.gate(now, frozen, 0.05).collect()} == {1.0: True, 2.0: False, 3.0: False, 4.0: False}
    arms = lambda c, s, d: spark.createDataFrame([("clean", 100, c), ("synth", 100, s), ("dirty", 100, d)], "arm string, n long, n_flagged long")
    verdict = lambda *a: detection.parity(arms(*a)).first()["verdict"]
    assert [verdict(2, 3, 50), verdict(2, 4, 50), verdict(20, 20, 50)] == ["PASS", "SYNTH_FLAGGED", "DIRTY_MISSED"]


def test_metric_states_and_reach(spark):
    now = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", None), ("n", 1.0)], "name string, value double")
    old = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 1.0), ("g", 1.0)], "name string, value double")
    assert {r["name"]: r["state"] for r in warehouse.verify_metrics(now, old).collect()} == {"a": "same", "b": "moved", "c": "error", "n": "new", "g": "gone"}
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "src string, dst string")
    got = {r["node"]: r["depth"] for r in warehouse.reached(edges, spark.createDataFrame([("a",)], "node string")).collect()}
    assert got == {"b": 1, "c": 2}


def test_a_score_is_worked_out_once(spark):
    df = spark.createDataFrame([("a", "x" * 50), ("b", "y z " * 20)], "id string, text string")
    stages = [s for s in funnel.TEXT_FUNNEL if s.op != "exact_text"]
    run = funnel.run(df, stages, carry=[])
    plan = run._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan  # read from the written scores
    assert run.columns == ["id", *(f"score_{s.op}" for s in stages), "dropped_seq", "dropped_by"]


def test_paraphrase(spark):
    df = spark.createDataFrame([("甲，乙，丙。",), ("概述：乙，丙，甲。",), ("only one.",), (None,)], "t string")
    got = [r[0] for r in df.select(tuning.paraphrase(F.col("t"), F.lit(tuning.LEADS[0]))).collect()]
    assert got == ["该条目：乙，丙，甲。", "概述：丙，甲，乙。", "only one.", ""]


def test_synthesis_leaves_out_what_changes_nothing(spark):
    df = spark.createDataFrame([(str(i), f"text {i}") for i in range(100)], "id string, text string")
    got = tuning.synthesise(df, {"upper": (1, F.upper), "same": (1, lambda t: t)}, 0.5, 2)
    made = got.where("source_id is not null").collect()
    assert 20 < len(made) < 90 and {r["synthesized_by"] for r in made} == {"upper"}
    assert got.where("source_id is null").count() == 100


def test_fingerprint_ignores_order(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "i int, s string")
    assert evaluate.fingerprint(a).first() == evaluate.fingerprint(a.orderBy(F.desc("i"))).first()
    one = hashlib.md5(b"1|x").hexdigest()
    assert evaluate.fingerprint(a.limit(1)).first()["fingerprint"] == f"{int(one[:15], 16)}:{int(one[15:30], 16)}"
