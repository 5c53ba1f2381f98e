import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from gristmill.functions import text as T
from gristmill.operators import extract, funnel, registry

TEXTS = ["", "   ", "　全角　", "one line", "a\na\na\nb", "aaaaaaaabc", "中文 mixed 文字", "转载请注明出处 www.foo.cn", "call 13812345678 or é.x@y.org", "110101199001011234", "x\x1cy\x85z w", None]


def test_scores_follow_their_formulas(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")
    got = {r["id"]: r for r in df.select("id", T.text_length("text").alias("a"), T.doc_length("text").alias("b"), T.script_ratio("text").alias("c"), T.char_repetition("text").alias("d"), T.line_repetition("text").alias("e"), T.boilerplate("text").alias("f"), T.pii_detect("text").alias("g")).collect()}
    for i, t in enumerate(TEXTS):
        t = t or ""
        s, dense = t.strip(), "".join(t.split())
        lines = [x.strip() for x in t.split("\n") if x.strip()]
        run = max((len(m[0]) for m in re.finditer(r"(?s)(.)\1*", s)), default=0)
        assert got[i]["a"] == len(s)
        assert got[i]["b"] == len(dense)
        assert got[i]["c"] == pytest.approx(sum("一" <= c <= "鿿" for c in t) / len(dense) if dense else 0)
        assert got[i]["d"] == pytest.approx(1 - run / len(s) if len(s) >= 4 else 1)
        assert got[i]["e"] == pytest.approx(len(set(lines)) / len(lines) if len(lines) > 1 else 1)
    assert got[7]["f"] == pytest.approx(0.6)
    assert got[8]["g"] == pytest.approx(0.32)


def test_normalize(spark):
    raw = ["a\r\nb\rc", "x​y", "tab\there  twice ", "a\n\n\n\nb", "été", "clean", " ", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(raw)], "id int, text string")
    text, rules = T.normalize("text")
    got = [(r[1], r[2]) for r in df.select("id", text, rules).orderBy("id").collect()]
    assert [g[0] for g in got] == ["a\nb\nc", "xy", "tab here twice", "a\n\nb", unicodedata.normalize("NFC", raw[4]), "clean", "", ""]
    assert got[5][1] == [] and got[0][1] == ["newline"] and got[4][1] == ["nfc"]


def test_funnel_attribution(spark):
    rows = [("a", "A good long enough sentence to keep, surely."), ("b", "short"), ("c", "A good long enough sentence to keep, surely."), ("d", "same line of words here\nsame line of words here\nsame line of words here")]
    out = funnel.run(spark.createDataFrame(rows, "id string, text string"), funnel.TEXT_FUNNEL)
    assert {r["id"]: r["dropped_by"] for r in out.collect()} == {"a": None, "b": "doc_length", "c": "exact_text", "d": "line_repetition"}
    stats = {r["op"]: (r["n_in"], r["n_out"]) for r in funnel.stats(out, funnel.TEXT_FUNNEL).collect()}
    assert stats["doc_length"] == (4, 3) and stats["line_repetition"] == (3, 2) and stats["exact_text"] == (2, 1)
    assert funnel.verdicts(out, funnel.TEXT_FUNNEL).where("id = 'b'").count() == 1


def test_registry_guards():
    with pytest.raises(ValueError):
        registry.operator("doc_length", ("text_article",))(lambda c: c)
    with pytest.raises(ValueError):
        registry.get("nothing")
    with pytest.raises(ValueError):
        funnel.check([funnel.Stage("doc_length")], "fhir_resource")


def test_articles(spark):
    body = "word " * 30
    pages = [
        (1, f"<html><title>T</title><nav><p>menu</p></nav><h1>A &amp; B</h1><p>{body}</p><p> x&nbsp;y </p></html>"),
        (2, "<div>nothing</div>"),
        (3, "<p></p>"),
        (4, "<p>too short</p>"),
        (5, f"one<br>{body}<br/>three"),
        (6, None),
    ]
    got = {r["id"]: r for r in extract.articles(spark.createDataFrame(pages, "id int, html string"), "html").collect()}
    assert got[1]["title"] == "A & B" and got[1]["paragraphs"] == [body.strip(), "x y"]
    assert [got[i]["attempts"][0].split(":")[1] for i in (2, 3, 4, 6)] == ["no_container", "no_paragraphs", "too_short", "no_container"]
    assert got[5]["paragraphs"][0] == "one"


def test_uniform(spark):
    v = spark.range(2000).select(T.uniform(F.col("id"), 3).alias("u")).agg(F.avg("u"), F.min("u"), F.max("u")).first()
    assert abs(v[0] - 0.5) < 0.03 and 0 <= v[1] and v[2] < 1
