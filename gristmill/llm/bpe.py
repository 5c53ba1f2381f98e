"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The corpus's frequent words are merged once on the driver and compiled into a minimal
acyclic automaton: words share prefixes and suffixes, and every edge carries the number of
words that sort before it, so a walk yields the word's index and with it its ids. The file
is handed to the executors with ``addFile`` and memory-mapped there. Words that are not in
the lexicon are merged exactly, by the vocabulary's merge ranks.

Edge cases: a null text is an empty text (no ids); special tokens of the vocabulary found in
a text become their own id, as the tokenizers library does; a long text is worked through in
segments that end where no token can straddle; repeated rows give repeated results; extra
columns pass through ``encode`` untouched unless they carry the output's name, which raises.

Digests are made for many texts at once: the places where tokens begin are found by code point
classes; the distinct tokens of a piece walk the lexicon together, those that are not in it are
merged as rows of a matrix, and what each stands for is copied to its places. Texts with special
tokens and texts longer than a piece are worked through one by one.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import mmap
import os
import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.buffers import distinct_words, flat_bytes, pieces
from gristmill.plans.store import discard, materialize

# Fixed value: the pre-tokenizer's pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: code points that this regex module calls letters or numbers and the tokenizers library does not (a newer Unicode).
NEWER = (
    "՘֋-֌࢏౜೜₏₝-₟꟎-꟏꟒꟔꟝꟢꟱꭬-꭭"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    "\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8"
    "\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20"
    "\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    "\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de"
    "\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    "\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
SPLIT = regex.compile(PATTERN)
# The same pattern with its classes spelled out for Latin-1, for the faster standard module.
_LETTER, _NUMBER, _SPACE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
SPLIT_LATIN = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
SPLIT_NEWER = regex.compile(PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{NEWER}])").replace(r"\p{L}+|", rf"[\p{{L}}--[{NEWER}]]+|").replace(r"\p{N}+|", rf"[\p{{N}}--[{NEWER}]]+|"), regex.V1)
HAS_NEWER = regex.compile(f"[{NEWER}]")
SAFE_CUT = regex.compile(r"(?<=\S) (?=\S)")
_NO_PAIR = 1 << 62
SEGMENT_CHARS = 1 << 19
PIECE_BYTES = 1 << 22
MATRIX_BYTES, MATRIX_ROWS = 64, 4096
MEMO_WORDS = 250_000


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of each range, one range after another."""
    return np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)


def byte_letters() -> dict[int, str]:
    """The vocabulary file's letter for each byte: printable Latin-1 stands for itself, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Vocabulary:
    """A byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = {c: b for b, c in byte_letters().items()}
        model = spec["model"]
        ids = model["vocab"]
        self.token_bytes: dict[int, bytes] = {i: bytes(back[c] for c in s) for s, i in ids.items() if all(c in back for c in s)}
        self.byte_ids = [ids[c] for _, c in sorted(byte_letters().items())]
        self.pairs: dict[int, int] = {}  # left << 32 | right: rank << 32 | merged
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.pairs[ids[a] << 32 | ids[b]] = rank << 32 | ids[a + b]
        self.pair_keys = np.array(sorted(self.pairs), np.int64)
        self.pair_values = np.array([self.pairs[k] for k in sorted(self.pairs)], np.int64)
        self.byte_array = np.array(self.byte_ids, np.int64)
        self.byte_pairs = self.pair_ranks(self.byte_array[:, None], self.byte_array[None, :])
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        self.token_bytes |= {i: s.encode() for s, i in self.special.items()}
        self.special_split = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What ``pairs`` has for each pair, _NO_PAIR where it has none."""
        wanted = left << 32 | right
        if not len(self.pair_keys):
            return np.full(wanted.shape, _NO_PAIR)
        at = np.minimum(np.searchsorted(self.pair_keys, wanted), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == wanted, self.pair_values[at], _NO_PAIR)

    def merge_all(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each) of the words ``data[begin:begin + size]``, as :meth:`merge` has them.

        Words of like size are the rows of a matrix; each round merges one pair in every row that has one.
        """
        order = np.argsort(size, kind="stable")
        short = int(np.searchsorted(size[order], MATRIX_BYTES, "right"))
        counts, parts = np.zeros(len(size), np.int64), []
        for at in range(0, short, MATRIX_ROWS):
            own = order[at : min(short, at + MATRIX_ROWS)]
            width = int(size[own].max())
            inside = np.arange(width) < size[own, None]
            raw = data[np.where(inside, begin[own, None] + np.arange(width), 0)]
            ids = np.where(inside, self.byte_array[raw], -1)
            ranks = np.where(inside[:, 1:], self.byte_pairs[raw[:, :-1], raw[:, 1:]], _NO_PAIR)
            out, row = np.full(ids.shape, -1, np.int64), np.arange(len(own))
            while ranks.shape[1]:
                where = ranks.argmin(1)
                best = ranks[np.arange(len(row)), where]
                more = best != _NO_PAIR
                out[row[~more], : ids.shape[1]] = ids[~more]
                row, where, best, ids, ranks = row[more], where[more], best[more], ids[more], ranks[more]
                if not len(row):
                    break
                left = np.arange(ids.shape[1] - 1)
                ids = np.take_along_axis(ids, left + (left > where[:, None]), 1)
                ranks = np.take_along_axis(ranks, left[:-1] + (left[:-1] >= where[:, None]), 1)
                ids[np.arange(len(row)), where] = best & 0xFFFFFFFF
                for step in (-1, 0):  # the pairs before and behind the merged one are new
                    new = np.flatnonzero((where + step >= 0) & (where + step < ranks.shape[1]))
                    place = where[new] + step
                    ranks[new, place] = self.pair_ranks(ids[new, place], ids[new, place + 1])
            out[row, : ids.shape[1]] = ids
            counts[own] = (out >= 0).sum(1)
            parts.append(out[out >= 0])
        for i in order[short:]:
            merged = self.merge(data[begin[i] : begin[i] + size[i]].tobytes())
            counts[i] = len(merged)
            parts.append(np.array(merged, np.int64))
        ids = np.concatenate([np.zeros(0, np.int64), *parts])
        first = np.empty(len(size), np.int64)
        first[order] = np.cumsum(counts[order]) - counts[order]
        return ids[ranges(first, counts)], counts

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Exact BPE: always the pair of least rank, leftmost first."""
        ids = [self.byte_ids[b] for b in word]
        if len(ids) > 48:
            return self._merge_long(ids)
        if len(ids) < 2:
            return tuple(ids)
        get, none = self.pairs.get, _NO_PAIR
        ranks = [get(a << 32 | b, none) for a, b in itertools.pairwise(ids)]
        while ranks and (best := min(ranks)) != none:
            i = ranks.index(best)
            ids[i : i + 2] = [best & 0xFFFFFFFF]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get(ids[i] << 32 | ids[i + 1], none)
            if i:
                ranks[i - 1] = get(ids[i - 1] << 32 | ids[i], none)
        return tuple(ids)

    def _merge_long(self, ids: list[int]) -> tuple[int, ...]:
        """The same by a heap over a linked list, n log n for a word without end."""
        n, pairs = len(ids), self.pairs
        after, before, live = [*range(1, n), -1], [*range(-1, n - 1)], [True] * n
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (p := pairs.get(ids[i] << 32 | ids[j])) is not None:
                heapq.heappush(heap, (p, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if live[i] else -1
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i] = pairs[a << 32 | b] & 0xFFFFFFFF
            live[j] = False
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return tuple(ids[i] for i in range(n) if live[i])


def compile_lexicon(words: dict[bytes, tuple[int, ...]]) -> bytes:
    """A minimal acyclic automaton over ``words`` (built from sorted input, merging equal suffixes) with the ids of each.

    Layout: int32 values: states, edges, words, ids; then per state the first edge and whether a
    word ends; per edge byte, target and the words that sort before it below the same state;
    per word the first id; the ids.
    """
    ordered = sorted(words)
    edges: list[dict[int, int]] = [{}]
    final: list[bool] = [False]
    known: dict[tuple, int] = {}
    path: list[tuple[int, int, int]] = []  # parent, byte, child, not yet merged
    free: list[int] = []

    def settle(down_to: int) -> None:
        while len(path) > down_to:
            parent, b, child = path.pop()
            key = (final[child], tuple(edges[child].items()))
            same = known.setdefault(key, child)
            if same != child:
                edges[parent][b] = same
                edges[child], final[child] = {}, False
                free.append(child)

    last = b""
    for w in ordered:
        common = len(os.path.commonprefix([w, last]))
        settle(common)
        node = path[-1][2] if path else 0
        for b in w[common:]:
            if free:
                child = free.pop()
            else:
                child = len(edges)
                edges.append({})
                final.append(False)
            edges[node][b] = child
            path.append((node, b, child))
            node = child
        final[node] = True
        last = w
    settle(0)
    below: dict[int, int] = {}
    stack = [0]
    while stack:
        s = stack[-1]
        todo = [t for t in edges[s].values() if t not in below]
        if todo:
            stack.extend(todo)
        else:
            below[s] = final[s] + sum(below[t] for t in edges[s].values())
            stack.pop()
    number = {s: i for i, s in enumerate(below)} | {}
    order = sorted(below, key=lambda s: (s != 0, number[s]))
    number = {s: i for i, s in enumerate(order)}
    first, label, target, skip = [0], [], [], []
    for s in order:
        before = int(final[s])
        for b, t in sorted(edges[s].items()):
            label.append(b)
            target.append(number[t])
            skip.append(before)
            before += below[t]
        first.append(len(label))
    starts = [0, *itertools.accumulate(len(words[w]) for w in ordered)]
    ids = [i for w in ordered for i in words[w]]
    parts = [[len(order), len(label), len(ordered), len(ids)], first, [int(final[s]) for s in order], label, target, skip, starts, ids]
    return np.concatenate([np.asarray(p, np.int32) for p in parts]).tobytes()


class Lexicon:
    """A compiled lexicon, memory-mapped."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.view = memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)).cast("i")
        states, n_edges, n_words, n_ids = self.view[:4]
        cuts = [4, *itertools.accumulate((states + 1, states, n_edges, n_edges, n_edges, n_words + 1, n_ids), initial=4)][1:]
        self.first, self.final, self.label, self.target, self.skip, self.starts, self.ids = (self.view[a:b] for a, b in itertools.pairwise(cuts))
        self.states, self.edges, self.words = states, n_edges, n_words
        self.edge_keys = np.repeat(np.arange(states), np.diff(np.asarray(self.first))) << 8 | np.asarray(self.label)

    def index(self, word: bytes) -> int:
        """The word's place among the sorted words, or -1."""
        s, at, first, label = 0, 0, self.first, self.label
        for b in word:
            lo, hi = first[s], first[s + 1]
            while lo < hi:
                mid = (lo + hi) // 2
                if label[mid] < b:
                    lo = mid + 1
                else:
                    hi = mid
            if lo == first[s + 1] or label[lo] != b:
                return -1
            at += self.skip[lo]
            s = self.target[lo]
        return at if self.final[s] else -1

    def index_all(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """:meth:`index` of the words ``data[begin:begin + size]``, which walk the automaton together."""
        found, row = np.full(len(size), -1, np.int64), np.arange(len(size))
        state, place, depth = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64), 0
        final, skip, target = (np.asarray(x) for x in (self.final, self.skip, self.target))
        while len(row) and self.edges:
            ended = size[row] == depth
            whole = ended & (final[state] > 0)
            found[row[whole]] = place[whole]
            row, state, place = row[~ended], state[~ended], place[~ended]
            key = state << 8 | data[begin[row] + depth]
            edge = np.minimum(np.searchsorted(self.edge_keys, key), self.edges - 1)
            there = self.edge_keys[edge] == key
            row, edge = row[there], edge[there]
            state, place = target[edge].astype(np.int64), place[there] + skip[edge]
            depth += 1
        return found

    def find(self, word: bytes) -> tuple[int, ...] | None:
        i = self.index(word)
        return None if i < 0 else tuple(self.ids[self.starts[i] : self.starts[i + 1]])


class _Memo(dict):
    """Ids by word: lexicon first, else merged; emptied when full."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None):
        super().__init__()
        self.vocabulary, self.lexicon = vocabulary, lexicon

    def of(self, word: str) -> tuple[int, ...]:
        raw = word.encode()
        ids = self.lexicon.find(raw) if self.lexicon else None
        return self.vocabulary.merge(raw) if ids is None else ids

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.of(word)
        if len(word) <= 64:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = ids
        return ids


def words_of(text: str) -> list[str]:
    """The text's pre-tokens."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return (SPLIT_NEWER if HAS_NEWER.search(text) else SPLIT).findall(text)
    return SPLIT_LATIN.findall(text)


_SPACES, _LETTERS, _NUMBERS, _OTHERS = range(4)
_classes: list[np.ndarray] = []


def point_classes() -> np.ndarray:
    """The pattern's class of each code point, made once per process."""
    if not _classes:
        table = np.full(0x110000, _OTHERS, np.uint8)
        for low, high in ((0, 0xD800), (0xE000, 0x110000)):
            points = "".join(map(chr, range(low, high)))
            for kind, found in ((_SPACES, r"\s+"), (_LETTERS, r"\p{L}+"), (_NUMBERS, r"\p{N}+"), (_OTHERS, f"[{NEWER}]+")):
                for m in regex.finditer(found, points):
                    table[low + m.start() : low + m.end()] = kind
        _classes.append(table)
    return _classes[0]


def token_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The byte places where the pre-tokens of texts without special tokens begin, the texts lying one after another."""
    if not len(data):
        return np.zeros(0, np.int64)
    if (data < 128).all():
        points, where = data, None
    else:
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        where = np.flatnonzero(data & 0xC0 != 0x80)  # the byte place of each code point
    n, kind = len(points), point_classes()[points]
    first = offsets[:-1][np.diff(offsets) > 0]
    first = first if where is None else np.searchsorted(where, first)
    opens = np.zeros(n + 1, bool)  # a text begins here, or all have ended
    opens[first] = opens[n] = True
    start = np.concatenate([[True], kind[1:] != kind[:-1]]) | opens[:-1]
    space = kind == _SPACES
    # the last of a run of white space before a visible character is a token, or the visible one's if it is a blank
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~opens[1:-1])
    start[last] = True
    start[last[points[last] == 32] + 1] = False
    quote = np.flatnonzero((points == 39) & start)
    quote = quote[~opens[quote + 1]]
    second = points[quote + 1]
    short = quote[np.isin(second, [ord(c) for c in "stmd"])]
    near = quote + 2 < n
    quote, second = quote[near & ~opens[np.minimum(quote + 2, n)]], second[near & ~opens[np.minimum(quote + 2, n)]]
    third = points[quote + 2]
    long = quote[((third == ord("e")) & ((second == ord("r")) | (second == ord("v")))) | ((second == ord("l")) & (third == ord("l")))]
    for at, size in ((short, 2), (long, 3)):
        start[at + 1] = False
        ends = at + size
        start[ends[ends < n]] = True
    found = np.flatnonzero(start)
    return found if where is None else where[found]


def segments(text: str, chars: int = SEGMENT_CHARS) -> Iterator[str]:
    """The text cut at single spaces between two visible characters, where a token always begins."""
    at = 0
    while len(text) - at > chars:
        cut = SAFE_CUT.search(text, at + chars)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def copied(values: pa.Array, codes: np.ndarray, counts: np.ndarray, words: pa.Array, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of each word's codes, word after word as in ``words``, and where those of the words ``which`` begin."""
    data, offsets = flat_bytes(values.take(pa.array(codes)))
    ends = offsets[np.concatenate([[0], np.cumsum(counts)])]
    each = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    data, offsets = flat_bytes(each.take(words))
    return data, offsets[which]


class Codec:
    """Encodes and decodes texts exactly as the vocabulary's library does."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None = None):
        self.vocabulary, self.memo = vocabulary, _Memo(vocabulary, lexicon)
        self.bytes_of = vocabulary.token_bytes.__getitem__
        tokens = range(max(vocabulary.token_bytes, default=-1) + 1)
        self.shown = pa.array([b"%d," % i for i in tokens], pa.large_binary())
        self.back = pa.array([vocabulary.token_bytes.get(i, b"") for i in tokens], pa.large_binary())

    def word_parts(self, text: str) -> Iterator[tuple[bool, list[str]]]:
        """(special, pre-tokens) of each stretch of the text, in order."""
        split = self.vocabulary.special_split
        at = 0
        for m in split.finditer(text) if split else ():
            yield from self._plain(text[at : m.start()])
            yield True, [m[0]]
            at = m.end()
        yield from self._plain(text[at:] if at else text)

    def _plain(self, text: str) -> Iterator[tuple[bool, list[str]]]:
        if text:
            for part in segments(text):
                yield False, words_of(part)

    def encode_parts(self, text: str) -> Iterator[list[int]]:
        for special, words in self.word_parts(text):
            yield [self.vocabulary.special[w] for w in words] if special else list(itertools.chain.from_iterable(map(self.memo.__getitem__, words)))

    def encode(self, text: str) -> list[int]:
        return list(itertools.chain.from_iterable(self.encode_parts(text)))

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, digests of the decimal ids joined by commas and of the text decoded from them."""
        n, ids_sha, text_sha = 0, hashlib.sha256(), hashlib.sha256()
        for ids in self.encode_parts(text) if text else ():
            if ids:
                ids_sha.update((("," if n else "") + ",".join(map(str, ids))).encode())
                text_sha.update(self.decode(ids).encode())
                n += len(ids)
        return n, ids_sha.hexdigest(), text_sha.hexdigest()

    def ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each) of many words: lexicon first, else merged."""
        data, offsets = flat_bytes(words)
        begin, size, lexicon = offsets[:-1], np.diff(offsets), self.memo.lexicon
        at = lexicon.index_all(data, begin, size) if lexicon else np.full(len(size), -1)
        listed, rest = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        merged, counted = self.vocabulary.merge_all(data, begin[rest], size[rest])
        counts = np.zeros(len(size), np.int64)
        counts[rest] = counted
        if len(listed):
            starts = np.asarray(lexicon.starts).astype(np.int64)
            counts[listed] = starts[at[listed] + 1] - starts[at[listed]]
        first = np.cumsum(counts) - counts
        ids = np.empty(int(counts.sum()), np.int64)
        ids[ranges(first[rest], counts[rest])] = merged
        if len(listed):
            ids[ranges(first[listed], counts[listed])] = np.asarray(lexicon.ids)[ranges(starts[at[listed]], counts[listed])]
        return ids, counts

    def digests(self, texts: pa.Array) -> Iterator[tuple[int, str, str]]:
        """:meth:`digest` of each text, with each distinct token of a piece encoded once."""
        special = [s.encode() for s in self.vocabulary.special]
        for at, end, data, offsets in pieces(texts, PIECE_BYTES):
            raw = data.tobytes()
            alone = {i for i in range(end - at) if offsets[i + 1] - offsets[i] > PIECE_BYTES}
            if any(s in raw for s in special):
                alone |= {i for i in range(end - at) if any(s in raw[offsets[i] : offsets[i + 1]] for s in special)}
            if len(alone) == end - at:
                yield from (self.digest(texts[at + i].as_py()) for i in range(end - at))
                continue
            starts = token_starts(data, offsets)
            tokens = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(raw)])
            coded = tokens.dictionary_encode()
            words, which = coded.indices, np.searchsorted(starts, offsets)  # the first token of each text
            codes, counts = self.ids_of(coded.dictionary)
            n = np.concatenate([[0], np.cumsum(counts[words.to_numpy()])])[which]
            ids, ids_at = copied(self.shown, codes, counts, words, which)
            back, back_at = copied(self.back, codes, counts, words, which)
            for i in range(end - at):
                if i in alone:
                    yield self.digest(texts[at + i].as_py())
                    continue
                decoded = back[back_at[i] : back_at[i + 1]].tobytes().decode("utf-8", "replace").encode()
                yield int(n[i + 1] - n[i]), hashlib.sha256(ids[ids_at[i] : max(ids_at[i], ids_at[i + 1] - 1)]).hexdigest(), hashlib.sha256(decoded).hexdigest()

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of, ids)).decode("utf-8", "replace")


_open: dict[tuple[str, str | None], Codec] = {}


def _codec(vocabulary_path: str, lexicon_name: str | None) -> Codec:
    """One per Python worker, kept over tasks."""
    key = (vocabulary_path, lexicon_name)
    if key not in _open:
        _open.clear()
        _open[key] = Codec(Vocabulary(vocabulary_path), Lexicon(SparkFiles.get(lexicon_name)) if lexicon_name else None)
    return _open[key]


def frequent_words(docs: DataFrame, text: str = "text", most: int = 32_768) -> list[str]:
    """The pre-tokens of at most ``most`` of the corpus's most frequent words, counted over every text.

    The cut falls between classes of like frequency, so it does not depend on the order of rows.
    """

    def count(batches):
        for batch in batches:
            for _, _, data, offsets in pieces(batch.column(0)):
                for words, n in distinct_words(data, offsets):
                    yield pa.RecordBatch.from_arrays([words.cast(pa.string()), pa.array(n)], ["word", "n"])

    counts = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = materialize(counts.where("n > 1 and octet_length(word) <= 64"), "words")
    level = F.floor(F.log2("n") * 16).alias("level")
    levels = counts.groupBy(level).agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect()
    total, least = 0, None
    for row in levels:  # at most 64 * 16 rows
        total += row["words"]
        if total > most:
            break
        least = row["level"]
    found = [] if least is None else [r["word"] for r in counts.where(level >= least).select("word").collect()]
    discard(counts)
    return sorted({part for word in found for part in words_of(" " + word)})


def ship_lexicon(spark: SparkSession, vocabulary_path: str, words: list[str]) -> str:
    """Compile ``words`` and hand the file to all executors; returns its name there."""
    vocabulary = Vocabulary(vocabulary_path)
    blob = compile_lexicon({w.encode(): vocabulary.merge(w.encode()) for w in words})
    name = f"lexicon-{hashlib.sha256(blob).hexdigest()[:24]}.fst"
    if any(x.endswith("/" + name) for x in spark.sparkContext.listFiles):
        return name
    path = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)
    with open(path, "wb") as f:
        f.write(blob)
    spark.sparkContext.addFile("file://" + os.path.abspath(path))
    return name


def encode(docs: DataFrame, vocabulary_path: str, lexicon_name: str | None, text: str = "text", out: str = "ids") -> DataFrame:
    """Every row with its texts' ids (array<int>) in ``out``."""
    if out in docs.columns:
        raise ValueError(f"column {out} exists already")

    @F.pandas_udf("array<int>")
    def ids(texts):
        codec = _codec(vocabulary_path, lexicon_name)
        return texts.map(lambda t: codec.encode(t) if t else [])

    return docs.withColumn(out, ids(F.col(text)))


def decode(docs: DataFrame, vocabulary_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Every row with the text that its ids stand for; null ids give null."""
    if out in docs.columns:
        raise ValueError(f"column {out} exists already")

    @F.pandas_udf("string")
    def back(column):
        codec = _codec(vocabulary_path, None)
        return column.map(lambda x: None if x is None else codec.decode([int(i) for i in x]))

    return docs.withColumn(out, back(F.col(ids)))


def round_trip_digests(docs: DataFrame, vocabulary_path: str, lexicon_name: str | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: n_tokens and digests of the decimal ids joined by commas and of the text decoded from them."""

    def digest(batches):
        codec = _codec(vocabulary_path, lexicon_name)
        for batch in batches:
            keys, rows = batch.column(0), list(codec.digests(batch.column(1)))
            n, a, b = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([keys, pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.col(text).cast("string").alias("text")).mapInArrow(digest, f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return round_trip_digests(docs, path, ship_lexicon(spark, path, frequent_words(docs)))
