import hashlib
import itertools
import random
import sys

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gristmill.llm import bpe

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(PATH)


def texts():
    random.seed(3)
    yield from ["", " ", "don't we'll  go\n\n\tnow", "<|endoftext|>a <|endoftext|><|endoftext|>", "x" * 5000, "été ²½ ٣", "՘ ࢏a ꟎", "\x1c\x85\xa0 　"]
    for _ in range(30):
        yield "".join(random.choice([chr(random.randrange(32, 127)), chr(random.randrange(32, 0x3000)), " ", "\n"]) for _ in range(300))


def test_codec_is_the_library(vocabulary, library):
    codec = bpe.Codec(vocabulary)
    for t in texts():
        ids = codec.encode(t)
        assert ids == library.encode(t, add_special_tokens=False).ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_pretokens_of_every_code_point(library):
    for at in range(0, 0x110000, 400):
        points = [chr(c) for c in range(at, min(at + 400, 0x110000)) if not 0xD800 <= c < 0xE000]
        t = "".join(f"a{c}1{c} {c}! " for c in points)
        assert [len(x) for x in bpe.words_of(t)] == [e - s for _, (s, e) in library.pre_tokenizer.pre_tokenize_str(t)]


def test_segments_keep_the_tokens(vocabulary, monkeypatch):
    t = " ".join(texts()) * 3
    whole = bpe.Codec(vocabulary).encode(t)
    monkeypatch.setattr(bpe.segments, "__defaults__", (50,))
    assert bpe.Codec(vocabulary).encode(t) == whole


def test_lexicon(vocabulary, tmp_path):
    words = {w: vocabulary.merge(w) for w in (b" the", b" then", b"then", b"\xc3\xa9t", b"a", b"tion", b" nation")}
    (tmp_path / "lex").write_bytes(bpe.compile_lexicon(words))
    lexicon = bpe.Lexicon(str(tmp_path / "lex"))
    assert {w: lexicon.find(w) for w in words} == words
    assert lexicon.words == len(words) and lexicon.find(b" th") is None and lexicon.find(b"zz") is None
    assert [lexicon.index(w) for w in sorted(words)] == list(range(len(words)))
    (tmp_path / "none").write_bytes(bpe.compile_lexicon({}))
    assert bpe.Lexicon(str(tmp_path / "none")).find(b"a") is None


def test_round_trip_on_rows(spark, library):
    rows = [(1, "Hello there, hello"), (1, "Hello there, hello"), (2, None), (3, ""), (None, "été <|endoftext|>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    name = bpe.ship_lexicon(spark, PATH, bpe.frequent_words(docs))
    assert bpe.ship_lexicon(spark, PATH, bpe.frequent_words(docs)) == name
    back = bpe.decode(bpe.encode(docs, PATH, name), PATH).collect()
    assert sorted(((r["text"] or ""), r["decoded"]) for r in back) == sorted((t or "", t or "") for _, t in rows)
    assert all(list(r["ids"]) == library.encode(r["text"] or "", add_special_tokens=False).ids for r in back)
    with pytest.raises(ValueError):
        bpe.encode(docs.withColumnRenamed("text", "ids"), PATH, name, text="ids")
    assert bpe.round_trip_digests(docs.limit(0), PATH, None).count() == 0
    assert sys.maxunicode == 0x10FFFF


def flat(texts):
    raws = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raws), np.uint8), np.cumsum([0, *map(len, raws)])


def test_token_starts_are_the_librarys(library):
    def expected(texts):
        at, out = 0, []
        for t in texts:
            places = list(itertools.accumulate((len(c.encode()) for c in t), initial=at))
            out += [places[lo] for _, (lo, _) in library.pre_tokenizer.pre_tokenize_str(t)]
            at = places[-1]
        return out

    quotes = ["'", "'s", "'l", "'ll", "a'l", "l", "x'", " 's", "  's", "\n't've're'm'd'LL", "''s", "'sabc'rest 've", "don't  we'll ", " ", "'", "r", "e", "\u3000 a", "\t ", " b"]
    for some in (quotes, list(texts())):
        some = [t for t in some if "<|" not in t]
        assert bpe.token_starts(*flat(some)).tolist() == expected(some)
    random.seed(8)
    mixed = ["".join(random.choice("'' \n\tstrevlmdaé1² 　!") for _ in range(random.randrange(12))) for _ in range(4000)]
    assert bpe.token_starts(*flat(mixed)).tolist() == expected(mixed)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every = ["".join(f"a{c}1{c} {c}! " for c in points[at : at + 4000]) for at in range(0, len(points), 4000)]
    assert bpe.token_starts(*flat(every)).tolist() == expected(every)


def test_digests_encode_distinct_tokens_together(vocabulary, library, tmp_path, monkeypatch):
    """As the library has them, and no token of up to MATRIX_BYTES is walked or merged by itself."""
    rows = [None, "", *(t for t in texts() if "<|" not in t), " the then\u00e9 nation " * 50, "abc" * 300]
    rows += [rows[5], "naïve façade 日本語のテキスト " * 20, None]

    def expected(t):
        e = library.encode(t or "", add_special_tokens=False)
        return len(e.ids), hashlib.sha256(",".join(map(str, e.ids)).encode()).hexdigest(), hashlib.sha256(library.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()

    (tmp_path / "lex").write_bytes(bpe.compile_lexicon({w: vocabulary.merge(w) for w in (b" the", b" then", b" nation", b" ", b"a")}))
    merge = bpe.Vocabulary.merge

    def long_only(self, word):
        assert len(word) > bpe.MATRIX_BYTES
        return merge(self, word)

    monkeypatch.setattr(bpe.Vocabulary, "merge", long_only)
    for lexicon in (None, bpe.Lexicon(str(tmp_path / "lex"))):
        assert list(bpe.Codec(vocabulary, lexicon).digests(pa.array(rows))) == [expected(t) for t in rows]
    monkeypatch.undo()
    rows += ["<|endoftext|>a <|endoftext|><|endoftext|>", "<|endoftext|>", "x<|endoftext|>"]
    for size in (100, bpe.PIECE_BYTES):
        monkeypatch.setattr(bpe, "PIECE_BYTES", size)
        assert list(bpe.Codec(vocabulary, lexicon).digests(pa.array(rows).slice(1))) == [expected(t) for t in rows[1:]]


def test_merge_all_and_index_all(vocabulary, tmp_path):
    random.seed(5)
    words = [bytes(random.choice(b"ethnaoisr \xc3\xa9") for _ in range(random.randrange(1, 70))) for _ in range(3000)] + [bytes([b]) for b in range(256)]
    data, offsets = np.frombuffer(b"".join(words), np.uint8), np.cumsum([0, *map(len, words)])
    ids, counts = vocabulary.merge_all(data, offsets[:-1], np.diff(offsets))
    merged = [vocabulary.merge(w) for w in words]
    assert ids.tolist() == [i for m in merged for i in m] and counts.tolist() == list(map(len, merged))
    for some in (words[::3], []):
        (tmp_path / f"lex{len(some)}").write_bytes(bpe.compile_lexicon({w: (1,) for w in some}))
        lexicon = bpe.Lexicon(str(tmp_path / f"lex{len(some)}"))
        assert lexicon.index_all(data, offsets[:-1], np.diff(offsets)).tolist() == [lexicon.index(w) for w in words]
