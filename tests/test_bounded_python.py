"""What reaches Python is bounded by a batch, not by a text, a group or the table."""

import random
import re
import unicodedata

from pyspark.sql import functions as F
from pyspark.util import PythonEvalType

from gristmill.functions import text as T
from gristmill.operators import dedup, tuning


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_the_first_bytes_become_tokens(spark):
    """whole texts went to Python for their first bytes."""
    texts = ["", None, "abc", "é" * 9, "x" * 5000, "中文" * 4]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").select("id", tuning.byte_tokens(F.col("text"), 7).alias("t"))
    assert [r["t"] for r in df.orderBy("id").collect()] == [list((t or "").encode()[:7]) for t in texts]
    at = plan(df)
    assert "substring(cast(text" in at[at.index("ArrowEvalPython") :]


def test_shards_pass_through_python_in_batches(spark):
    """a shard of about 20,000 texts was gathered in Python as one table."""
    rows = [(f"k{i}" if i else None, [i % 250] * (i * 7 % 31), ["train", "val", None][i % 5 % 3]) for i in range(400)]
    df = spark.createDataFrame(rows, "id string, tokens array<int>, split string").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        packed = tuning.pack_blocks(df, "id", "tokens", "split", 20, 256)
        got = packed.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "FlatMapGroupsInPandas" not in plan(packed)
    for split in ("train", "val", None):
        want, cur = [], []
        for _, ids, _ in sorted((r for r in rows if r[2] == split), key=lambda r: (r[0] is None, r[0] or "")):
            seq = [*ids, 256]
            if cur and len(cur) + len(seq) > 20:
                want, cur = [*want, cur], []
            if len(seq) > 20:
                want += [seq[i : i + 20] for i in range(0, len(seq) - 19, 20)]
            else:
                cur = cur + seq
        want += [cur] * bool(cur)
        mine = sorted((r for r in got if r["split"] == split), key=lambda r: r["block_id"])
        assert [r["block_id"] for r in mine] == list(range(len(want)))
        assert [r["input_ids"][: r["n_real"]] for r in mine] == want
        assert all(r["input_ids"][r["n_real"] :] == [256] * (20 - r["n_real"]) and r["loss_mask"] == [1] * r["n_real"] + [0] * (20 - r["n_real"]) for r in mine)


def test_the_manifest_gathers_no_shard(spark, tmp_path):
    """the manifest's blocks came from whole shards held in Python."""
    from gristmill.plans import catalog

    texts = [(i, f"text {i} " * (i % 90)) for i in range(300)]
    for name, order in (("a", texts), ("b", texts[::-1])):
        spark.createDataFrame(order, "doc_id long, text string").write.parquet(str(tmp_path / name / "documents.parquet"))
    one, two = (catalog.QUERIES["shard_manifest"](spark, str(tmp_path / name)) for name in ("a", "b"))
    assert sorted(one.collect()) == sorted(two.collect()) and one.count() == 2
    assert "FlatMapGroupsInPandas" not in plan(one)


def _plain(t):
    """The rules of normalisation one after the other."""
    t, names = t or "", []
    blank = "[\t\x0b\x0c\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
    control = lambda s: "".join(c for c in s if c in "\n\t\r" or unicodedata.category(c) not in ("Cc", "Cf"))
    for name, rule in {
        "nfc": lambda s: unicodedata.normalize("NFC", s),
        "line_separators": lambda s: s.replace("\u2028", "\n").replace("\u2029", "\n"),
        "newline": lambda s: re.sub(r"\r\n?", "\n", s),
        "zero_width": lambda s: re.sub("[\u200b\u200c\u200d\u2060\ufeff]", "", s),
        "control_chars": control,
        "whitespace_collapse": lambda s: re.sub(r"\n{3,}", "\n\n", re.sub(r"(?m)^ +| +$", "", re.sub(blank, " ", s))),
        "strip": lambda s: s.strip(T.WS_CHARS),
    }.items():
        after = rule(t)
        names += [name] * (after != t)
        t = after
    return t, names


def _odd_texts():
    draw = random.Random(5)
    odd = ["e\u0301", "\u1100\u1161\u11a8", "\uac00\u11a8", "\u212b", "\u2126", "\u304b\u3099", "\u0915\u093c", "\u2000", "\u3000", "\xa0", "\x85", "\u2028", "\r\n", "\r", "\u200b", "\ufeff", "\x07", "\xad", "\n", "\n\n\n", " ", "  ", "\t", "a", "b.", "中", "é", "\U0001f600", "\U0001d15e"]
    return [None, "", " ", *("".join(draw.choices(odd, k=draw.randrange(1, 24))) for _ in range(1500))]


def test_normalisation_equals_its_rules(spark):
    texts = _odd_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = df.select("id", T.normalized("text").alias("n")).select("id", "n.*").orderBy("id").collect()
    assert [(r["text"], r["rules"]) for r in got] == [_plain(t) for t in texts]
    late = df.select(*T.normalize("text", ("newline", "nfc"))).collect()
    assert len(late) == len(texts) and all(unicodedata.is_normalized("NFC", r[0]) for r in late)


def test_composed_characters_are_left_as_they_are():
    held = [c for c in map(chr, range(0x110000)) if re.match("[" + re.sub(r"\\x\{(\w+)\}", lambda m: f"\\U{int(m[1], 16):08x}", T.COMPOSED) + "]", c)]
    joins = {d[-1] for d in (unicodedata.normalize("NFD", c) for c in map(chr, range(0x110000))) if len(d) > 1} | {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}
    assert len(held) > 40000 and not joins & set(held)
    assert all(unicodedata.is_normalized("NFC", c) and not unicodedata.combining(c) for c in held)


def test_composed_texts_stay_out_of_python(spark, tmp_path):
    """every text went to Python to be composed, ASCII included."""
    from gristmill.plans import catalog

    spark.createDataFrame([(1, "plain", "a"), (2, "cafe\u0301", "a")], "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    df = catalog.QUERIES["normalize_summary"](spark, str(tmp_path))
    assert (df.first()["n"], df.first()["n_changed"]) == (2, 1)
    at = plan(df)
    assert "RLIKE" in at[at.index("ArrowEvalPython") :].split("\n")[0] and "ELSE" not in at[at.index("ArrowEvalPython") :].split("\n")[0]


def test_rules_are_worked_out_once(spark, tmp_path):
    """each rule's name worked out all rules before it anew, and so did the text."""
    from gristmill.plans import catalog

    spark.createDataFrame([(1, "a  b", "a")], "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    df = catalog.QUERIES["normalized_documents"](spark, str(tmp_path))
    assert [tuple(r) for r in df.collect()] == [(1, "a b", ["whitespace_collapse"])]
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("regexp_replace") == 6


def test_texts_are_signed_where_arrow_holds_them(spark):
    """every text of a batch became a Python string and every signature an array of its own."""
    texts = [None, "", "abc", "中", "a longer text " * 2000, "é" * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    signed = dedup.signatures(df, num_perm=16)
    factor, shift = dedup.hash_family(16, 42)
    for r in signed.collect():
        raw = (texts[r["id"]] or "").encode().ljust(4, b"\0")
        seen = {int.from_bytes(raw[i : i + 4], "little") for i in range(len(raw) - 3)}
        assert r["sig"] == [min((x * int(f) + int(s)) % 2**64 >> 33 for x in seen) for f, s in zip(factor.ravel(), shift.ravel())]
    assert re.search(rf"ArrowEvalPython .*, {PythonEvalType.SQL_SCALAR_ARROW_UDF}\n", plan(signed))
