"""Removal of bytes that long repeated strings cover.

A byte goes if some string of ``LENGTH`` bytes covers it that also starts elsewhere.

1. Every window of LENGTH bytes is dealt to its anchor: its run of ``GRAM`` bytes with the smallest
   hash. Equal windows have equal anchors at the same offset, so they meet; neighbouring windows
   share theirs, so they travel as one fragment, without its bytes at first.
2. Fragments of an anchor that occurs once are done. Equal fragments count once, with their number.
   Where all fragments of an anchor are equal, every window of them is repeated.
3. The remaining distinct fragments are fetched and dealt to buckets of bounded size. An anchor
   with more than ``NODE_FRAGMENTS`` distinct fragments fits no bucket; its windows are counted
   by a digest of each, in rows that spread over all tasks.
4. In a bucket the Burrows-Wheeler transform of the fragments gives common prefixes by increasing
   value: intervals of strings are extended backward, breadth first; where an interval ends for
   the first time, the prefixes there have the length of the level. Suffix ranks, known by doubling,
   give the first level; at LENGTH it stops: suffixes without a border between them share more.
5. Repeated windows go back to their documents, which lose the bytes that they cover.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import id_and_text, slices
from ledgermill.session import written

LENGTH = 400
GRAM = 32
BUCKET_BYTES = 300_000
NODE_FRAGMENTS = 8192
SEPARATOR = 0xFF  # no byte of UTF-8 text
PLACE_BITS = 24  # of a place in a buffer of whole texts cut at 2^24 bytes
PIECE = 1 << 22
BUFFER = 1 << 17
FACTORS = [np.uint64(f) for f in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes at each place."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    words = np.empty(len(data) - 7, dtype=np.uint64)
    for k in range(8):
        part = data[k : k + (len(data) - k) // 8 * 8].view("<u8")
        words[k::8] = part
    words *= np.uint64(0x9E3779B97F4A7C15)
    words ^= words >> np.uint64(29)
    out = words[:n].copy()
    for k, factor in zip(range(8, GRAM, 8), FACTORS, strict=True):
        out += words[k : k + n] * factor
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return out


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every ``width`` neighbours, from running minima of blocks."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[: len(values)] = values
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def fragments(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int):
    """Fragments of texts that lie at starts..ends in a buffer.

    Returns arrays: first window, number of windows, anchor place, anchor hash. Ties between grams
    go to the leftmost, so equal windows choose alike.
    """
    width = length - GRAM + 1
    hashes = gram_hashes(data)
    if len(hashes) < width:
        return (np.zeros(0, dtype=np.int64),) * 3 + (np.zeros(0, dtype=np.int64),)
    low = np.uint64((1 << PLACE_BITS) - 1)
    packed = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    anchors = (window_minima(packed, width) & low).astype(np.int64)
    inside = np.zeros(len(anchors) + 1, dtype=np.int32)
    long = ends - starts >= length
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - length + 1, -1)
    inside = np.cumsum(inside[:-1]) > 0
    change = np.ones(len(anchors) + 1, dtype=bool)
    change[1:-1] = (anchors[1:] != anchors[:-1]) | (inside[1:] != inside[:-1])
    # Two texts that follow each other begin a run each.
    change[starts[long]] = True
    first = np.flatnonzero(change)
    count = np.diff(first)
    first = first[:-1]
    mine = inside[first]
    first, count = first[mine], count[mine]
    place = anchors[first]
    return first, count, place, hashes[place].view(np.int64)


def pieces_of(text: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """A text in pieces that share all but one byte of a window, so that every window is in one."""
    step = PIECE - length + 1
    for at in range(0, max(1, len(text) - length + 1), step):
        yield at, text[at : at + PIECE]


def start_depth(length: int) -> int:
    """The largest doubled rank below ``length``."""
    h = 8
    while 2 * h < length:
        h *= 2
    return h


def suffix_order(text: np.ndarray, depth: int, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``depth`` bytes, and the rank of each by ``start`` bytes.

    Ranks by eight bytes are doubled; only suffixes that still share a rank are sorted again. The
    text counts as followed by separators.
    """
    n = len(text)
    padded = np.concatenate([text, np.full(8, SEPARATOR, dtype=np.uint8)])
    keys = np.empty(n, dtype=np.uint64)
    for k in range(8):
        part = padded[k : k + (n + 8 - k) // 8 * 8].view(">u8")
        keys[k::8] = part[: len(keys[k::8])]
    order = np.argsort(keys)
    rank = np.empty(n, dtype=np.int64)
    fresh = np.concatenate([[True], keys[order[1:]] != keys[order[:-1]]])
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    early = None
    h = 8
    while h < depth:
        if h == start:
            early = rank.copy()
        # Ranks are the first places of their groups, so a group is sorted in its own places.
        sorted_rank = rank[order]
        same = np.concatenate([sorted_rank[1:] == sorted_rank[:-1], [False]])
        open_ = same | np.concatenate([[False], same[:-1]])
        places = np.flatnonzero(open_)
        if not len(places):
            break
        items = order[places]
        after = np.where(items + h < n, rank[np.minimum(items + h, n - 1)], n)
        key = rank[items] * (n + 1) + after
        again = np.argsort(key)
        key, items = key[again], items[again]
        order[places] = items
        head = np.concatenate([[True], key[1:] != key[:-1]])
        rank[items] = np.maximum.accumulate(np.where(head, places, 0))
        h *= 2
    return order, rank.copy() if early is None else early


def shared_borders(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order, and for each place whether it shares ``length`` bytes with the one before.

    Intervals of the strings that ranks tell apart are extended backward through the Burrows-Wheeler
    transform, level by level. An interval whose end has no common prefix yet sets it to the length
    of the level and is extended in turn. Places without one after the last level share more.
    """
    n = len(text)
    start = start_depth(length)
    order, early = suffix_order(text, length + 1, start)
    last = text[order - 1]  # the transform; the first suffix wraps round to a separator
    by_byte = np.argsort(last, kind="stable")
    forward = np.empty(n, dtype=np.int64)  # where the suffix that is one byte longer stands
    forward[by_byte] = np.arange(n)
    ranks = early[order]
    known = np.ones(n + 1, dtype=bool)
    known[1:n] = ranks[1:] != ranks[:-1]
    lows = np.flatnonzero(known[:n])
    highs = np.append(lows[1:], n)
    for _ in range(start + 1, length + 1):
        sizes = highs - lows
        if not len(sizes):
            break
        owner = np.repeat(np.arange(len(lows)), sizes)
        places = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + lows[owner]
        keep = last[places] != SEPARATOR
        owner, places = owner[keep], places[keep]
        longer = forward[places]
        turn = np.argsort(longer)
        longer, owner, byte = longer[turn], owner[turn], last[places[turn]]
        # One byte before one interval: places that follow each other.
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (byte[1:] != byte[:-1])]) if len(owner) else keep[:0]
        first = np.flatnonzero(new)
        lows = longer[first]
        highs = lows + np.diff(np.append(first, len(longer)))
        open_ = ~known[highs]
        lows, highs = lows[open_], highs[open_]
        known[highs] = True
    return order, ~known[:n]


def repeated_windows(contents: list[bytes], numbers: np.ndarray, length: int) -> list[np.ndarray]:
    """For each distinct fragment, which of its windows occur more than once.

    ``numbers``: how many equal fragments each one stands for.
    """
    sizes = np.array([len(c) for c in contents], dtype=np.int64)
    text = np.frombuffer(b"\xff".join(contents) + b"\xff", dtype=np.uint8)
    starts = np.cumsum(sizes + 1) - sizes - 1
    order, shared = shared_borders(text, length)
    owner = np.repeat(np.arange(len(contents)), sizes + 1)
    left = starts[owner] + sizes[owner] - np.arange(len(text))
    weight = np.where(left >= length, numbers[owner], 0)[order]
    group = np.cumsum(~shared) - 1
    total = np.bincount(group, weights=weight)
    again = np.zeros(len(text), dtype=bool)
    again[order] = (total[group] > 1) & (weight > 0)
    return [again[s : s + n - length + 1] for s, n in zip(starts, sizes, strict=True)]


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text_hash, text``: equal rows of these are told apart by nothing, and need not be."""
    return id_and_text(docs, id_col, text_col).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text")
    )


FRAGMENT = "anchor long, content long, doc_id long, text_hash long, start long, n_windows int"


def _fragments(keyed: DataFrame, length: int) -> DataFrame:
    def found(buffer: list[tuple]) -> pa.RecordBatch:
        data = b"".join(piece for _, _, _, piece in buffer)
        sizes = np.array([len(piece) for _, _, _, piece in buffer], dtype=np.int64)
        ends = np.cumsum(sizes)
        first, count, _, anchor = fragments(np.frombuffer(data, dtype=np.uint8), ends - sizes, ends, length)
        owner = np.searchsorted(ends, first, side="right")
        view, digest = memoryview(data), xxhash.xxh3_64_intdigest
        stops = (first + count + length - 1).tolist()
        content = [digest(view[a:b]) for a, b in zip(first.tolist(), stops, strict=True)]
        ids = pa.array([doc_id for doc_id, _, _, _ in buffer], pa.int64())
        hashes = np.array([h for _, h, _, _ in buffer], dtype=np.int64)
        offset = np.array([at for _, _, at, _ in buffer], dtype=np.int64) - (ends - sizes)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(anchor),
                pa.array(np.array(content, dtype=np.uint64).view(np.int64)),
                ids.take(pa.array(owner)),
                pa.array(hashes[owner]),
                pa.array(first + offset[owner]),
                pa.array(count.astype(np.int32)),
            ],
            names=[field.split()[0] for field in FRAGMENT.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer, size = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, text_hash, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    for at, piece in pieces_of(text, length):
                        buffer.append((doc_id, text_hash, at, piece))
                        size += len(piece)
                        if size >= BUFFER:
                            yield found(buffer)
                            buffer, size = [], 0
        if buffer:
            yield found(buffer)

    return keyed.where(F.octet_length("text") >= length).mapInArrow(run, FRAGMENT)


def _same_row(left: tuple[str, str], right: tuple[str, str]):
    return F.expr(f"{left[0]} <=> {right[0]} and {left[1]} = {right[1]}")


def _contents(keyed: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """``anchor, content, number, data`` of the fragments asked for, from the rows that hold them."""
    per_row = asked.groupBy(F.col("place.doc_id").alias("a_id"), F.col("place.text_hash").alias("a_hash")).agg(
        F.collect_list(F.struct("anchor", "content", "number", "place.start", "place.n_windows")).alias("parts")
    )
    both = keyed.join(per_row, _same_row(("doc_id", "text_hash"), ("a_id", "a_hash"))).select("text", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "content", "number", "data"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for piece in slices(batch, "text"):
                rows = [
                    (p["anchor"], p["content"], p["number"], text[p["start"] : p["start"] + p["n_windows"] + length - 1])
                    for text, parts in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True)
                    for p in parts
                ]
                if rows:
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return both.mapInArrow(run, "anchor long, content long, number long, data binary")


RUNS = "anchor long, content long, low int, high int"


def _bucket_runs(contents: DataFrame, buckets: int, length: int) -> DataFrame:
    """Runs of repeated windows, low to high, of each distinct fragment."""

    def solve(table: pa.Table) -> pa.Table:
        # A row of the input that occurs twice delivers its fragments twice.
        held: dict[tuple[int, int], tuple[int, bytes]] = {}
        names = ("anchor", "content", "number", "data")
        for anchor, content, number, data in zip(*(table.column(k).to_pylist() for k in names), strict=True):
            held[anchor, content] = (number, data)
        keys = sorted(held)
        numbers = np.array([held[k][0] for k in keys], dtype=np.int64)
        flags = repeated_windows([held[k][1] for k in keys], numbers, length)
        out = [(*key, lo, hi) for key, flag in zip(keys, flags, strict=True) for lo, hi in zip(*runs_of(flag), strict=True)]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        columns = list(zip(*out, strict=True)) if out else [()] * 4
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["anchor", "content", "low", "high"])

    dealt = contents.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInArrow(solve, RUNS)


def _window_runs(contents: DataFrame, length: int) -> DataFrame:
    """The same for anchors that fit no bucket: each window is counted by its digest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, content, number, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                view = memoryview(data)
                n = len(data) - length + 1
                digests = [xxhash.xxh3_64_intdigest(view[k : k + length]) for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, anchor, dtype=np.int64)),
                        pa.array(np.full(n, content, dtype=np.int64)),
                        pa.array(np.full(n, number, dtype=np.int64)),
                        pa.array(np.arange(n, dtype=np.int32)),
                        pa.array(np.array(digests, dtype=np.uint64).view(np.int64)),
                    ],
                    names=["anchor", "content", "number", "low", "digest"],
                )

    windows = contents.dropDuplicates(["anchor", "content"]).mapInArrow(
        cut, "anchor long, content long, number long, low int, digest long"
    )
    windows = written(windows, "hot-windows")
    counts = windows.groupBy(F.col("anchor").alias("c_anchor"), F.col("digest").alias("c_digest"))
    counts = written(counts.agg(F.sum("number").alias("times")).where("times > 1"), "hot-counts")
    again = windows.join(counts, F.expr("anchor = c_anchor and digest = c_digest"))
    return again.select("anchor", "content", "low", (F.col("low") + 1).alias("high"))


def repeated_ranges(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, low, high``: ranges of places where a repeated window starts."""
    keyed = _keyed(docs, id_col, text_col)
    every = written(_fragments(keyed, length), "fragments")
    anchors = every.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("content").alias("least"), F.max("content").alias("most")
    )
    anchors = written(anchors.where("n > 1").selectExpr("anchor", "least != most as mixed"), "repeated-anchors")
    rows = written(every.join(anchors, "anchor"), "repeated-fragments")
    whole = rows.where(~F.col("mixed")).selectExpr("doc_id", "text_hash", "start as low", "start + n_windows as high")
    mixed = rows.where("mixed")

    distinct = mixed.groupBy("anchor", "content").agg(
        F.count("*").alias("number"),
        F.min(F.struct("doc_id", "text_hash", "start", "n_windows")).alias("place"),
    )
    distinct = written(distinct, "distinct-fragments")
    sizes = written(distinct.groupBy("anchor").agg(F.count("*").alias("n_contents")), "anchor-sizes")
    size, largest = distinct.join(sizes, "anchor").agg(
        F.sum(F.when(F.col("n_contents") <= NODE_FRAGMENTS, F.col("place.n_windows") + (length - 1))), F.max("n_contents")
    ).first()
    buckets = max(1, -(-(size or 0) // BUCKET_BYTES))
    contents = _contents(keyed, distinct, length)
    if (largest or 0) > NODE_FRAGMENTS:
        # Both kinds read the fragments from one table, so that texts are shuffled for them once.
        contents = written(contents, "fragment-contents")
        hot = written(sizes.where(F.col("n_contents") > NODE_FRAGMENTS).select("anchor"), "hot-anchors")
        runs = [
            _window_runs(contents.join(hot, "anchor", "left_semi"), length),
            _bucket_runs(contents.join(hot, "anchor", "left_anti"), buckets, length),
        ]
    else:
        runs = [_bucket_runs(contents, buckets, length)]
    found = written(runs[0] if len(runs) == 1 else runs[0].unionByName(runs[1]), "repeated-runs")
    parts = mixed.select("anchor", "content", "doc_id", "text_hash", "start").join(found, ["anchor", "content"])
    parts = parts.selectExpr("doc_id", "text_hash", "start + low as low", "start + high as high")
    return written(whole.unionByName(parts), "repeated-ranges")


def covered(ranges: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """The maximal runs of bytes that the windows starting in the ranges cover."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        end = high + length - 1
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((low, end))
    return out


KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` for every row.

    ``kept`` are the bytes that no repeated window covers, in order. A null or empty text keeps
    nothing. Repeated rows are repeats of each other, so each loses all windows. A null id stays
    null. An empty table gives an empty result. ``length`` exceeds the GRAM bytes of an anchor.
    """
    if length <= GRAM:
        raise ValueError(f"length must exceed {GRAM}")
    ranges = repeated_ranges(docs, length, id_col, text_col)
    per_row = ranges.groupBy(F.col("doc_id").alias("r_id"), F.col("text_hash").alias("r_hash")).agg(
        F.collect_set(F.struct("low", "high")).alias("ranges")
    )
    keyed = _keyed(docs, id_col, text_col)
    both = keyed.join(per_row, _same_row(("doc_id", "text_hash"), ("r_id", "r_hash")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        names = [field.split()[0] for field in KEPT.split(", ")]
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for doc_id, text, found in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    spans = covered([(r["low"], r["high"]) for r in found or []], length)
                    edges = [0, *(e for span in spans for e in span), len(text)]
                    kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    digest = hashlib.sha256(kept).hexdigest()
                    rows.append((doc_id, len(text), len(text) - len(kept), len(spans), digest, kept))
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return both.select("doc_id", "text", "ranges").mapInArrow(run, KEPT)
