"""Removal of repeated passages with a distributed, content-sampled suffix array.

Every byte that lies in a string of ``length`` bytes which also starts anywhere else, in the
same text or another, is removed; strings are judged on the input.

The suffixes that are sorted are those at content-chosen places: of the 32-byte strings in each
window of ``length`` bytes, the place of the one with the least hash (the leftmost of equals).
Equal windows choose the same place, so two equal windows are found as two suffixes with equal
leading tokens (those 32 bytes) that agree far enough to the right, and before them to the left.

1. Each text yields its chosen places with the run of windows that chose each, the leading tokens
   (their first four bytes and a hash of all 32) and a hash of the run's bytes.
2. Sampled splitters range-partition these suffixes by leading tokens, then by the run's hash, so
   leading tokens that a third of all texts share are split over many buckets. A bucket sorts
   locally by multikey quicksort; from the common prefix lengths it knows how often each run occurs
   and how many runs share their leading tokens. Runs that occur twice are repeated as a whole. What
   a bucket cannot know is how its first and last run and leading tokens go on in its neighbours:
   of these two ends each bucket gives a summary, the summaries are compared across boundaries, and
   the result, a few rows a bucket, is broadcast back to the suffixes.
3. Where runs with equal leading tokens differ, one of each kind brings its bytes. These are
   range-partitioned by leading tokens; a bucket sorts the suffixes to the right and the prefixes
   to the left by multikey quicksort, and the two arrays of common prefix lengths tell for each
   window whether another agrees on both sides. Leading tokens with more than ``group_runs``
   different runs are not brought together: their windows are compared one by one, by hash, as an
   aggregate.

Hashes of runs are 64 bits beside 64 of their leading tokens.

A bucket holds about ``bucket_rows`` suffixes; there are as many buckets as that takes.

Edge cases: a null text is empty; texts shorter than ``length`` lose nothing; very long texts are
worked through in sections; a row is told by its id and a hash of its text, so rows without an id and
rows that share an id are judged each by its own text, and rows that repeat both are copies of each
other; of equally small hashes in a window the leftmost counts; an empty table gives an empty
result; extra columns are ignored by :func:`spans` and kept by :func:`remove`.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType

from gristmill.functions.buffers import pieces
from gristmill.plans.store import discard, materialize

LENGTH = 200
LEAD = 32
GROUP_RUNS = 20_000
BUCKET_ROWS = 1_000_000
_TOP = np.uint64(1 << 63)
SIGN = "__suffix_sign"  # hash of a row's text
_SECTION = 1 << 20
_rng = np.random.default_rng(6)
_LEAD_SALT = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
_RUN_SALT = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
_STEPS = [int(x) | 1 for x in _rng.integers(1 << 60, 1 << 63, 8)]
_BASE, _PLACE_BITS = 0xD1342543DE82EF95, 24
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not len(_powers) or len(_powers["up"]) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _powers[name] = np.multiply.accumulate(x)
    return _powers["up"], _powers["down"]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(29)


def lead_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the LEAD bytes from each place on, by doubling."""
    h, size = _LEAD_SALT[data], 1
    for step in _STEPS:
        if size == LEAD:
            break
        h = h[:-size] * np.uint64(step) + h[size:]
        size *= 2
    return _mixed(h)


def run_hash_prefixes(data: np.ndarray) -> np.ndarray:
    up, _ = _power(len(data) + 1)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(_RUN_SALT[data] * up[: len(data)], dtype=np.uint64)])


def run_hashes(prefixes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = _power(len(prefixes))
    return _mixed((prefixes[end] - prefixes[start]) * down[start])


def chosen(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(row, place, first window, last window, leading tokens, run hash), places and windows from the row's start."""
    n, windows = len(data), len(data) - length + 1
    if windows <= 0:
        return (*(np.zeros(0, np.int64) for _ in range(4)), *(np.zeros(0, np.uint64) for _ in range(2)))
    hashes = lead_hashes(data)
    least = hashes >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
    span, size = length - LEAD + 1, 1
    while size * 2 <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:windows], least[span - size : span - size + windows])
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:windows]
    valid = np.flatnonzero(np.arange(windows) + length <= offsets[row + 1])
    if not len(valid):
        return chosen(data[:0], offsets[:1], length)
    place = (least[valid] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    begin = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    end = np.concatenate([begin[1:], [len(valid)]]) - 1
    first, last, place = valid[begin], valid[end], place[begin]
    row = row[first]
    hashed = run_hashes(run_hash_prefixes(data), first, last + length)
    base = offsets[row]
    lead = hashes[place] >> np.uint64(32)
    for i in range(4):
        lead |= data[place + i].astype(np.uint64) << np.uint64(56 - 8 * i)
    lead ^= _TOP  # signed order is then the order of the bytes
    return row, place - base, first - base, last - base, lead, hashed


def sections(offsets: np.ndarray, length: int, most: int = _SECTION) -> list[tuple[int, int]]:
    """Starts and ends of overlapping sections of one text such that each window lies in exactly one."""
    n = int(offsets)
    if n <= most + length:
        return [(0, n)]
    return [(at, min(n, at + most + length - 1)) for at in range(0, n - length + 1, most)]


def signed(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with a hash of each row's text."""
    return docs.withColumn(SIGN, F.hash(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def places(docs: DataFrame, key: str, text: str, length: int) -> DataFrame:
    kind = docs.schema[key].dataType.simpleString()
    names = [key, SIGN, "place", "first", "last", "lead", "run"]

    def run(batches):
        for batch in batches:
            for at, end, data, offsets in pieces(batch.column(2), _SECTION):
                ids, signs = (batch.column(i).slice(at, end - at) for i in (0, 1))
                cuts = sections(offsets[-1], length) if end == at + 1 else [(0, len(data))]
                for lo, hi in cuts:
                    part = offsets if len(cuts) == 1 else np.array([0, hi - lo])
                    row, *values, lead, hashed = chosen(data[lo:hi], part, length)
                    row = pa.array(row)
                    yield pa.RecordBatch.from_arrays([ids.take(row), signs.take(row), *(pa.array((v + lo).astype(np.int32)) for v in values), pa.array(lead.view(np.int64)), pa.array(hashed.view(np.int64))], names)

    return docs.select(F.col(key), SIGN, F.col(text).cast("string")).mapInArrow(run, f"{key} {kind}, {SIGN} int, place int, first int, last int, lead long, run long")


INNER, END_LEAD, END_RUN = 0, 1, 2


def judge(lead: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, ...]:
    """A bucket as (order, copies, leads, kinds, edge).

    Per row in sorted order: how many rows its run has here, whether it is its run's first row, how
    many runs its leading tokens have here, and whether these (END_LEAD) or the run too (END_RUN)
    touch an end of the bucket.
    """
    order, common = multikey_sort(np.zeros(len(lead), np.int64), np.stack([lead.view(np.uint64) ^ _TOP, run.view(np.uint64) ^ _TOP], 1))
    new_lead, new_run = common < 8, common < 16
    run_no, lead_no = np.cumsum(new_run) - 1, np.cumsum(new_lead) - 1
    edge = np.full(len(lead), INNER, np.int8)
    edge[(lead_no == 0) | (lead_no == lead_no[-1])] = END_LEAD
    edge[(run_no == 0) | (run_no == run_no[-1])] = END_RUN
    return order, np.bincount(run_no)[run_no], new_run, np.bincount(lead_no[new_run])[lead_no], edge


def buckets(found: DataFrame, key: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The suffixes, with what their bucket knows of each; those that are plainly alone are left out."""
    kind = found.schema[key].dataType.simpleString()
    extra = ["copies", "leads", "kinds", "edge"]

    def run(batches):
        t = pa.Table.from_batches(list(batches), schema) if (batches := [b for b in batches if b.num_rows]) else None
        if t is None:
            return
        order, copies, leads, kinds, edge = judge(t["lead"].to_numpy(), t["run"].to_numpy())
        keep = np.flatnonzero((edge != INNER) | (copies > 1) | (kinds > 1))
        t = t.take(pa.array(order[keep]))
        arrays = [*(_one(c) for c in t.columns), pa.array(copies[keep].astype(np.int64)), pa.array(leads[keep]), pa.array(kinds[keep].astype(np.int64)), pa.array(edge[keep])]
        yield from pa.Table.from_arrays(arrays, [*t.column_names, *extra]).to_batches(max_chunksize=20_000)

    schema = to_arrow_schema(found.schema)
    parts = max(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-found.count() // bucket_rows))
    dealt = found.repartitionByRange(parts, "lead", "run", key, SIGN, "place")
    return dealt.mapInArrow(run, f"{key} {kind}, {SIGN} int, place int, first int, last int, lead long, run long, copies long, leads boolean, kinds long, edge byte")


def across_boundaries(judged: DataFrame, key: str) -> DataFrame:
    """``judged`` with the numbers of rows and runs that hold over all buckets.

    A bucket has at most two end runs and two end leads, so the summaries are a few rows a bucket.
    """
    one = F.struct(F.col(key).alias("k"), SIGN, "place")
    ends = judged.where(F.col("edge") == END_RUN).groupBy("lead", "run").agg(F.count("*").alias("all_copies"), F.min(F.when(F.col("leads"), one)).alias("one"))
    ends = materialize(ends, "end-runs")
    inner = judged.where((F.col("edge") == END_LEAD) & F.col("leads")).groupBy("lead").agg(F.count("*").alias("n"))
    kinds = inner.unionByName(ends.groupBy("lead").agg(F.count("*").alias("n"))).groupBy("lead").agg(F.sum("n").alias("all_kinds"))
    kinds = materialize(kinds, "end-leads")
    end_run, touched = F.col("edge") == END_RUN, F.col("edge") != INNER
    told = judged.join(F.broadcast(ends), ["lead", "run"], "left").join(F.broadcast(kinds), "lead", "left")
    told = told.withColumn("leads", F.when(end_run, F.col("leads") & one.eqNullSafe(F.col("one"))).otherwise(F.col("leads")))
    told = told.withColumn("copies", F.when(end_run, F.col("all_copies")).otherwise(F.col("copies"))).withColumn("kinds", F.when(touched, F.col("all_kinds")).otherwise(F.col("kinds")))
    return told.where("copies > 1 or kinds > 1").select(key, SIGN, "place", "first", "last", "lead", "run", "copies", "leads", "kinds")


def _one(column: pa.ChunkedArray) -> pa.Array:
    """A column as one array."""
    whole = column.combine_chunks()
    return pa.concat_arrays(whole.chunks) if isinstance(whole, pa.ChunkedArray) else whole


# ---------------------------------------------------------------- local sorting


def multikey_sort(group: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common) of byte strings given as big-endian 8-byte words, within groups.

    Multikey quicksort with a whole word as its key: each round sorts only the ranges that are
    still equal by their next word. ``common[i]`` is the number of leading bytes that the i-th
    shares with the one before it, -1 at a group's start.
    """
    n, width = words.shape
    order = np.lexsort((words[:, 0], group))
    common = np.full(n, -1, np.int64)
    same_group = np.concatenate([[False], group[order][1:] == group[order][:-1]])
    equal = same_group.copy()
    for d in range(width):
        if d:
            inside = equal | np.concatenate([equal[1:], [False]])
            at = np.flatnonzero(inside)
            if not len(at):
                break
            segment = np.cumsum(~equal[at])
            order[at] = order[at][np.lexsort((words[order[at], d], segment))]
        at = np.flatnonzero(equal)
        differ = words[order[at], d] ^ words[order[at - 1], d]
        broken = differ != 0
        zero_bytes = sum((differ[broken] < np.uint64(1 << 8 * (8 - j))).astype(np.int64) for j in range(1, 8))
        common[at[broken]] = 8 * d + zero_bytes
        equal[at[broken]] = False
    common[equal] = 8 * width
    return order, common


def padded_words(data: np.ndarray, start: np.ndarray, size: np.ndarray, width: int, backwards: bool = False) -> np.ndarray:
    """Strings of up to ``width`` bytes from ``start`` on (or ending before it, reversed) as zero-padded 8-byte words."""
    width = -(-width // 8) * 8
    out = np.zeros((len(start), width), np.uint8)
    step = np.arange(width)
    for at in range(0, len(start), 4096):
        s, k = start[at : at + 4096, None], size[at : at + 4096, None]
        source = s - 1 - step if backwards else s + step
        out[at : at + 4096] = np.where(step < k, data[np.clip(source, 0, max(len(data) - 1, 0))], 0)
    return out.view(">u8").astype(np.uint64)


def repeated_windows(group: np.ndarray, data: np.ndarray, offsets: np.ndarray, place: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """(runs, windows) whether a window of a run equals one of another run with the same leading tokens.

    A run's bytes are ``data[offsets[i]:offsets[i + 1]]`` and its chosen place lies ``place[i]`` bytes in;
    column o stands for the window that begins o bytes before the place.
    """
    n, span = len(group), length - LEAD + 1
    sizes = np.diff(offsets)
    most, least = place, place - (sizes - length)
    at = offsets[:-1] + place
    right, right_common = multikey_sort(group, padded_words(data, at, np.minimum(offsets[1:] - at, length), length))
    left, left_common = multikey_sort(group, padded_words(data, at, place, span, True))
    right_rank, left_rank = np.empty(n, np.int64), np.empty(n, np.int64)
    right_rank[right], left_rank[left] = np.arange(n), np.arange(n)
    out = np.zeros((n, span), bool)
    for o in range(span):
        own = np.flatnonzero((least <= o) & (o <= most))
        if len(own) < 2:
            continue
        r = np.cumsum(right_common < length - o)[right_rank[own]]
        a = np.cumsum(left_common < o)[left_rank[own]]
        both = r * np.int64(n + 1) + a
        order = np.argsort(both, kind="stable")
        same = both[order][1:] == both[order][:-1]
        out[own[order[np.flatnonzero(same)]], o] = True
        out[own[order[np.flatnonzero(same) + 1]], o] = True
    return out


def fetch(requests: DataFrame, docs: DataFrame, key: str, text: str, length: int, group_runs: int) -> DataFrame:
    """The bytes of each requested run; for crowded leading tokens the hash of each window instead (``window``)."""
    kind = docs.schema[key].dataType.simpleString()
    wanted = requests.groupBy(key, SIGN).agg(F.collect_list(F.struct("place", "first", "last", "lead", "copies", "kinds")).alias("runs"))
    wanted = wanted.withColumnsRenamed({key: "__suffix_key", SIGN: "__suffix_own"})
    joined = docs.join(wanted, F.col(key).eqNullSafe(F.col("__suffix_key")) & (F.col(SIGN) == F.col("__suffix_own"))).select(key, SIGN, F.col(text).cast("string").alias("t"), "runs")
    names = [key, SIGN, "lead", "place", "first", "single", "content", "window"]

    def run(batches):
        before = None
        for batch in batches:
            ids, signs, rows = batch.column(0), batch.column(1), []

            def out():
                i, lead, place, first, single, content, window = zip(*rows, strict=True)
                i = pa.array(i)
                return pa.RecordBatch.from_arrays([ids.take(i), signs.take(i), pa.array(lead, pa.int64()), pa.array(place, pa.int32()), pa.array(first, pa.int32()), pa.array(single), pa.array(content, pa.binary()), pa.array(window, pa.int64())], names)

            size = 0
            for i, (t, runs) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                row = (ids[i].as_py(), signs[i].as_py())
                if row == before:  # a repeated row: its runs have been brought
                    continue
                before = row
                raw = (t.as_py() or "").encode()
                for r in runs.as_py():
                    content = raw[r["first"] : r["last"] + length]
                    if r["kinds"] <= group_runs:
                        rows.append((i, r["lead"], r["place"], r["first"], r["copies"] == 1, content, None))
                        size += len(content)
                    else:
                        prefixes = run_hash_prefixes(np.frombuffer(content, np.uint8))
                        starts = np.arange(r["last"] - r["first"] + 1)
                        for p, h in enumerate(run_hashes(prefixes, starts, starts + length).view(np.int64).tolist()):
                            rows.append((i, r["lead"], r["place"], r["first"] + p, r["copies"] == 1, None, h))
                        size += 64 * len(starts)
                    if size > 4_000_000:
                        yield out()
                        rows, size = [], 0
            if rows:
                yield out()

    return joined.mapInArrow(run, f"{key} {kind}, {SIGN} int, lead long, place int, first int, single boolean, content binary, window long")


def compare(contents: DataFrame, key: str, length: int) -> DataFrame:
    """(key, sign, start, end) of repeated windows of runs that occur once, from buckets by leading tokens."""
    kind = contents.schema[key].dataType.simpleString()

    def judged(t: pa.Table):
        lead = t["lead"].to_numpy()
        content = _one(t["content"]).cast(pa.large_binary())
        offsets = np.frombuffer(content.buffers()[1], np.int64)[content.offset : content.offset + len(content) + 1]
        data = np.frombuffer(content.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        place, first = t["place"].to_numpy().astype(np.int64), t["first"].to_numpy().astype(np.int64)
        marks = repeated_windows(lead, data, offsets - offsets[0], place - first, length)
        marks &= t["single"].to_numpy()[:, None]
        edge = np.zeros((len(lead), marks.shape[1] + 2), np.int8)
        edge[:, 1:-1] = marks
        change = np.diff(edge, axis=1)
        row, low = np.nonzero(change == 1)
        _, high = np.nonzero(change == -1)  # windows low to high - 1 bytes before the place
        at = pa.array(row)
        return pa.RecordBatch.from_arrays([_one(t[key]).take(at), _one(t[SIGN]).take(at), pa.array((place[row] - high + 1).astype(np.int32)), pa.array((place[row] - low + length).astype(np.int32))], [key, SIGN, "start", "end"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count < 8192:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            lead = t["lead"].to_numpy()
            final = int(np.searchsorted(lead, lead[-1]))
            if final:
                yield judged(t.slice(0, final).combine_chunks())
            held = t.slice(final).combine_chunks().to_batches()
            count = t.num_rows - final
        if count:
            yield judged(pa.Table.from_batches(held).combine_chunks())

    parts = int(contents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = contents.repartitionByRange(parts, "lead").sortWithinPartitions("lead")
    return dealt.select(key, SIGN, "lead", "place", "first", "single", "content").mapInArrow(run, f"{key} {kind}, {SIGN} int, start int, end int")


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, group_runs: int = GROUP_RUNS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(key, sign, start, end): byte ranges that lie in repeated strings; ranges of a text may overlap. ``sign`` is :func:`signed`'s."""
    if length < LEAD:
        raise ValueError(f"strings of {LEAD} bytes at least")
    docs = signed(docs.select(key, text), text)
    found = materialize(places(docs, key, text, length), "places")
    judged = materialize(buckets(found, key, bucket_rows), "judged")
    discard(found)
    told = across_boundaries(judged, key)
    whole = told.where("copies > 1").select(key, SIGN, F.col("first").alias("start"), (F.col("last") + length).alias("end"))
    requests = told.where("kinds > 1 and (copies = 1 or leads)")
    contents = materialize(fetch(requests, docs, key, text, length, group_runs), "runs")
    parted = compare(contents.where("window is null"), key, length)
    windows = contents.where("window is not null").select(key, SIGN, "lead", "window", "first", "single")
    twice = windows.groupBy("lead", "window").agg(F.count("*").alias("n")).where("n > 1").select("lead", "window")
    crowded = windows.where("single").join(twice, ["lead", "window"]).select(key, SIGN, F.col("first").alias("start"), (F.col("first") + length).alias("end"))
    return whole.unionByName(parted).unionByName(crowded)


def merged(ranges: np.ndarray) -> np.ndarray:
    """Ranges as maximal runs, in order."""
    if not len(ranges):
        return ranges
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    reach = np.maximum.accumulate(ranges[:, 1])
    begin = np.concatenate([[True], ranges[1:, 0] > reach[:-1]])
    starts = ranges[begin, 0]
    ends = reach[np.concatenate([np.flatnonzero(begin)[1:] - 1, [len(ranges) - 1]])]
    return np.stack([starts, ends], 1)


def remove(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, group_runs: int = GROUP_RUNS, bucket_rows: int = BUCKET_ROWS, report: bool = False) -> DataFrame:
    """``docs`` with repeated bytes taken out of ``text``; what is left of a torn character is dropped too.

    With ``report``, per row (key, n_bytes, n_removed, n_spans, kept_sha256) instead.
    """
    cuts = spans(docs, key, text, length, group_runs, bucket_rows).groupBy(key, SIGN).agg(F.collect_set(F.struct("start", "end")).alias("__suffix_cuts"))
    cuts = cuts.withColumnsRenamed({key: "__suffix_key", SIGN: "__suffix_own"})
    rows = signed(docs.select(F.col(key), F.col(text).cast("string").alias(text)) if report else docs, text)
    wanted = rows.join(cuts, F.col(key).eqNullSafe(F.col("__suffix_key")) & (F.col(SIGN) == F.col("__suffix_own")), "left").drop(SIGN, "__suffix_key", "__suffix_own")
    names = wanted.columns
    at_text, at_cuts, at_key = names.index(text), names.index("__suffix_cuts"), names.index(key)

    def run(batches):
        for batch in batches:
            texts, cuts, rows = batch.column(at_text), batch.column(at_cuts), []
            for t, c in zip(texts, cuts, strict=True):
                raw = t.as_py()
                raw = b"" if raw is None else raw.encode()
                if c.is_valid:
                    v = c.values
                    ranges = merged(np.stack([v.field(0).to_numpy(), v.field(1).to_numpy()], 1).astype(np.int64))
                    ends = [0, *ranges[:, 1].tolist()]
                    kept = b"".join(raw[a:b] for a, b in zip(ends, [*ranges[:, 0].tolist(), len(raw)], strict=True))
                else:
                    ranges, kept = (), raw
                if report:
                    rows.append((len(raw), len(raw) - len(kept), len(ranges), hashlib.sha256(kept).hexdigest()))
                else:
                    rows.append(kept.decode("utf-8", "ignore") if t.is_valid else None)
            if report:
                a, b, c, d = zip(*rows, strict=True) if rows else ((),) * 4
                yield pa.RecordBatch.from_arrays([batch.column(at_key), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64()), pa.array(d, pa.string())], [key, "n_bytes", "n_removed", "n_spans", "kept_sha256"])
            else:
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string()) if i == at_text else batch.column(i) for i in range(len(names)) if i != at_cuts], [x for x in names if x != "__suffix_cuts"])

    if report:
        return wanted.mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    schema = wanted.drop("__suffix_cuts").schema
    schema[text].dataType = StringType()
    return wanted.mapInArrow(run, schema).select(docs.columns)


def op6_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), report=True)
