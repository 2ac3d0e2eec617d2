"""Periodic runs of words: maximal stretches that repeat with a period.

1. Words are numbered. A run of ``EXPONENT`` periods holds every three words in a row at least three
   times, so stretches without such three-word strings are cut out first: nothing is lost, and most
   texts end here.
2. What is left goes into two suffix trees, of the text and of its reversal, built by Ukkonen's
   method. A tour of a tree visits its leaves in order and notes the shallowest node it passes between
   two leaves; a sparse table over these depths answers in constant time how far two suffixes agree:
   the depth of the lowest common ancestor of their leaves.
3. The smallest rotation of a run's period is a Lyndon word under the order of words or under the
   reversed one, and the longest at its place. The longest Lyndon word at a place ends at the next
   smaller suffix. Each is a candidate, extended to the right by the tree of the text and to the left
   by the tree of the reversal; what is long enough is a run, and no run is missed.

Stretches of several texts share a tree; each ends with a symbol of its own, smaller than all words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import id_and_text, slices

LENGTH, EXPONENT = 6, 4
GRAM = 3
TREE_WORDS = 8192  # texts share a tree up to this size; a longer stretch has its own
TABLE_BITS = 20
SEPARATORS = "[\\x20\\x09-\\x0D]+"
FACTORS = [np.uint64(f) for f in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class SuffixTree:
    """Ukkonen's suffix tree of symbols below ``sigma``; the last symbol occurs once.

    Leaf k, in order of creation, is the suffix that starts at k.
    """

    def __init__(self, symbols: list[int], sigma: int):
        self.size, self.sigma = len(symbols), sigma
        n = self.size
        starts, stops, links, suffixes = [0], [0], [0], [-1]
        child: dict[int, int] = {}
        node = length = waiting = edge = leaves = 0
        for at, symbol in enumerate(symbols):
            waiting += 1
            unlinked = 0
            while waiting:
                if not length:
                    edge = at
                key = node * sigma + symbols[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(starts)
                    if unlinked:
                        links[unlinked] = node
                    unlinked = node
                else:
                    first = starts[below]
                    span = min(stops[below], at + 1) - first
                    if length >= span:
                        edge += span
                        length -= span
                        node = below
                        continue
                    if symbols[first + length] == symbol:
                        length += 1
                        if unlinked:
                            links[unlinked] = node
                        break
                    middle = len(starts)
                    starts.append(first)
                    stops.append(first + length)
                    links.append(0)
                    suffixes.append(-1)
                    child[key] = middle
                    starts[below] = first + length
                    child[middle * sigma + symbols[first + length]] = below
                    child[middle * sigma + symbol] = len(starts)
                    if unlinked:
                        links[unlinked] = middle
                    unlinked = middle
                starts.append(at)
                stops.append(n)
                links.append(0)
                suffixes.append(leaves)
                leaves += 1
                waiting -= 1
                if node:
                    node = links[node]
                elif length:
                    length -= 1
                    edge = at - waiting + 1
        self.suffixes = suffixes
        self.spans = np.array(stops, dtype=np.int64) - np.array(starts, dtype=np.int64)
        keys = np.fromiter(child.keys(), dtype=np.int64, count=len(child))
        self.nodes = np.fromiter(child.values(), dtype=np.int64, count=len(child))
        self.parents, self.first_symbols = keys // sigma, keys % sigma

    def tour(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of their leaves, children by ``order`` of their first symbols, and
        the depth of the shallowest node between each leaf and the one before."""
        turn = np.lexsort((order[self.first_symbols], self.parents))
        nodes, parents = self.nodes[turn], self.parents[turn]
        bounds = np.searchsorted(parents, np.arange(len(self.spans) + 1)).tolist()
        nodes, spans, suffixes = nodes.tolist(), self.spans.tolist(), self.suffixes
        leaves, depths = [], []
        depth = [0] * len(spans)
        stack, passed = [0], 0
        while stack:
            node = stack.pop()
            if node < 0:  # not the first child: the tour came through the parent
                node = -node
                passed = depth[node] - spans[node]
            suffix = suffixes[node]
            if suffix >= 0:
                leaves.append(suffix)
                depths.append(passed)
                continue
            lo, hi = bounds[node], bounds[node + 1]
            here = depth[node]
            for k in range(hi - 1, lo, -1):
                below = nodes[k]
                depth[below] = here + spans[below]
                stack.append(-below)
            below = nodes[lo]
            depth[below] = here + spans[below]
            stack.append(below)
        return np.array(leaves, dtype=np.int64), np.array(depths, dtype=np.int64)


class CommonPrefix:
    """How many symbols the suffixes at two places share, in constant time."""

    def __init__(self, tree: SuffixTree, order: np.ndarray):
        leaves, depths = tree.tour(order)
        self.rank = np.empty(tree.size, dtype=np.int64)
        self.rank[leaves] = np.arange(tree.size)
        self.table = [depths.astype(np.int32)]
        width = 1
        while 2 * width <= tree.size:
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For arrays of places; ``a`` and ``b`` differ."""
        left, right = self.rank[a], self.rank[b]
        low, high = np.minimum(left, right) + 1, np.maximum(left, right) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), dtype=np.int64)
        for k in np.unique(level).tolist():
            mine = level == k
            row = self.table[k]
            out[mine] = np.minimum(row[low[mine]], row[high[mine] - (1 << k)])
        return out


def next_smaller(rank: list[int]) -> list[int]:
    """The next place whose rank is smaller; the last places have none and get the length."""
    n = len(rank)
    out = [n] * n
    stack: list[int] = []
    for at, value in enumerate(rank):
        while stack and rank[stack[-1]] > value:
            out[stack.pop()] = at
        stack.append(at)
    return out


def runs_of_stretches(stretches: list[np.ndarray], least: int, exponent: int) -> np.ndarray:
    """Rows (stretch, start, length, period) of all runs of lists of word numbers."""
    sizes = np.array([len(s) for s in stretches], dtype=np.int64)
    values, flat = np.unique(np.concatenate(stretches), return_inverse=True)
    ends = len(stretches) + 1  # symbol 0 stands in front, the others end the stretches
    starts = 1 + np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(1 + int((sizes + 1).sum()), dtype=np.int64)
    owner = np.repeat(np.arange(len(stretches)), sizes)
    places = np.arange(len(flat)) + 1 + owner
    text[places] = flat + ends
    text[starts + sizes] = np.arange(1, ends)
    sigma, n = ends + len(values), len(text)
    upward = np.arange(sigma)
    downward = np.concatenate([upward[:ends], upward[ends:][::-1]])
    tree = SuffixTree(text.tolist(), sigma)
    ahead = CommonPrefix(tree, upward)
    turned, _ = tree.tour(downward)
    down_rank = np.empty(n, dtype=np.int64)
    down_rank[turned] = np.arange(n)
    behind = CommonPrefix(SuffixTree(text[::-1].tolist(), sigma), upward)
    found = []
    for rank in (ahead.rank, down_rank):
        after = np.array(next_smaller(rank.tolist()), dtype=np.int64)[places]
        period = after - places
        right = ahead(places, after)
        left = behind(n - places, n - after)  # the symbols before both
        length = left + period + right
        good = (length >= least) & (length >= exponent * period)
        start = (places - left - starts[owner])[good]
        found.append(np.stack([owner[good], start, length[good], period[good]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


def stretches_of(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, least: int, exponent: int):
    """Starts and ends of what may hold runs, of texts that lie one after the other.

    With at least 4 periods and 6 words a run holds each of its three-word strings three times, and four
    or more of them start next to each other. Strings are counted in a table by hash: strings that share
    a place only keep more. Counting goes on inside what is left until little changes.
    """
    if exponent < 4 or least < 6:
        long = np.flatnonzero(sizes >= least)
        return starts[long], starts[long] + sizes[long]
    n = len(words)
    values = words.astype(np.uint64)
    mixed = np.zeros(n, dtype=np.uint64)
    for k in range(GRAM):
        mixed[: n - k] += values[k:] * FACTORS[k]
    group = np.repeat(np.arange(len(sizes)), sizes)
    left = np.repeat(starts + sizes, sizes) - np.arange(n)
    alive = np.flatnonzero(left >= GRAM)
    for _ in range(6):
        if not len(alive):
            break
        key = (mixed[alive] + group[alive].astype(np.uint64) * FACTORS[3]) * FACTORS[0]
        key = ((key ^ (key >> np.uint64(31))) * FACTORS[1]) >> np.uint64(64 - TABLE_BITS)
        key = key.astype(np.int64)
        kept = alive[np.bincount(key)[key] >= 3]
        if not len(kept):
            return kept, kept
        head = np.concatenate([[True], (np.diff(kept) != 1) | (np.diff(group[kept]) != 0)])
        number = np.cumsum(head) - 1
        kept = kept[np.bincount(number)[number] >= 4]
        before, alive = len(alive), kept
        if len(alive):
            head = np.concatenate([[True], (np.diff(alive) != 1) | (np.diff(group[alive]) != 0)])
            group[alive] = np.cumsum(head) - 1
        if len(alive) > 0.95 * before:
            break
    if not len(alive):
        return alive, alive
    first = np.flatnonzero(np.concatenate([[True], np.diff(group[alive]) != 0]))
    last = np.append(first[1:], len(alive)) - 1
    return alive[first], alive[last] + GRAM


def runs_of_texts(texts: list[list[bytes]], least: int = LENGTH, exponent: int = EXPONENT) -> list[np.ndarray]:
    """For each list of words its runs, rows (start, length, period) by start, then period."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(words) for words in texts], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    found = [np.zeros((0, 3), dtype=np.int64)] * len(texts)
    if not sizes.sum():
        return found
    flat = np.concatenate(
        [np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words)) for words in texts]
    )
    lows, highs = stretches_of(flat, starts, sizes, least, exponent)
    parts, first, held = [], 0, 0
    for k, size in enumerate((highs - lows).tolist()):
        if held and held + size > TREE_WORDS:
            parts.append((first, k))
            first, held = k, 0
        held += size
    if len(lows):
        parts.append((first, len(lows)))
    rows = []
    for a, b in parts:
        runs = runs_of_stretches([flat[x:y] for x, y in zip(lows[a:b], highs[a:b], strict=True)], least, exponent)
        runs[:, 1] += lows[a:b][runs[:, 0]]
        rows.append(runs[:, 1:])
    if rows:
        every = np.concatenate(rows)
        owner = np.searchsorted(starts + sizes, every[:, 0], side="right")
        every[:, 0] -= starts[owner]
        turn = np.lexsort((every[:, 2], every[:, 0], owner))
        every, owner = every[turn], owner[turn]
        heads = np.flatnonzero(np.concatenate([[True], np.diff(owner) != 0])) if len(owner) else owner
        for lo, hi in zip(heads, np.append(heads[1:], len(owner)), strict=False):
            found[owner[lo]] = every[lo:hi]
    return found


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by a space."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[k] for k in kept.tolist()])


RUNS = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def find_runs(
    docs: DataFrame, least: int = LENGTH, exponent: int = EXPONENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, runs, collapsed`` for every row.

    ``runs``: every maximal stretch of ``least`` words or more that holds its smallest period
    ``exponent`` (2 or more) times, by start, then period; starts count words from 0. ``collapsed``: the
    words that are left if each run keeps its first period only. A null or empty text has no words, no
    runs and an empty ``collapsed``. Repeated rows give a row each, a null id stays null, an empty table
    gives an empty result. A text lies in the memory of its task as a list of words.
    """
    if exponent < 2:
        raise ValueError("a run holds its period twice at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [text.split() for text in part.column(1).to_pylist()]
                found = runs_of_texts(texts, least, exponent)
                offsets = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
                every = np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)
                rows = pa.StructArray.from_arrays([pa.array(every[:, k]) for k in range(3)], fields=list(kind.value_type))
                kept = [collapse(words, runs) for words, runs in zip(texts, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(offsets, rows), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["doc_id", "runs", "collapsed"],
                )

    rows = id_and_text(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, RUNS)


def repeat_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text``: about one text in ten repeats a part of itself from some word on, as its id decides.

    With h the crc32 of the id in decimal and g = floor(h / 10), h divisible by 10 and n words: from word
    a = g mod n on, word i becomes word a + (i - a) mod p, p = 1 + floor((n - a) / (3 + g mod 8)). Words
    are joined by a space there. Texts without words and rows without an id stay.
    """
    rows = id_and_text(docs, id_col, text_col)
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", SEPARATORS), lambda w: w != "")
    chosen = F.when(hashed % 10 == 0, words)
    rows = rows.withColumn("words", chosen).withColumn("g", F.floor(hashed / 10).cast("long"))
    n = F.size("words")
    rows = rows.withColumn("a", F.when(n > 0, (F.col("g") % n).cast("int")))
    rows = rows.withColumn("p", F.expr("cast(1 + (size(words) - a) div (3 + g % 8) as int)"))
    turned = F.expr(
        "array_join(concat(slice(words, 1, a), transform(sequence(a, size(words) - 1),"
        " i -> words[a + (i - a) % p])), ' ')"
    )
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), turned).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """One row of plain columns for each row of :func:`find_runs`."""

    def lines(runs: Column) -> Column:
        line = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
        return F.when(F.size(runs) > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise(F.lit(""))

    # Quotients of whole numbers that are equal are equal as doubles too.
    ranked = F.transform(
        "runs", lambda r: F.struct((-r["length"] / r["period"]).alias("key"), r["start"], r["period"], r["length"])
    )
    best = F.array_min(ranked)
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(lines(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
