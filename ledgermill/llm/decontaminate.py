"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

1. Every document is cut into words; runs of three words that also occur in a test item are seeds,
   the common ones too. What is found in a document so depends on it and the items alone, never on
   how often a passage or its words occur in the rest of the corpus.
2. Two different seeds of an item near each other in a document make a window; of an item that has
   but one seed that one does. Windows that lack too many of the item's words to reach the threshold
   in any order are left out.
3. The item is aligned with the window word by word; the score is the best local alignment over the
   best possible one. Edited and paraphrased copies lose some words but keep the order of others.
   VERBATIM words in a row are a copy whatever share of a long item they are.

Test items are read in blocks of bounded size, one pass over the documents per block; a block is
the only thing that tasks receive whole. Nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.common import id_and_text, ship_package, slices
from ledgermill.session import written

GRAM = 3
BLOCK_CHARS = 16 << 20  # characters of test items in a block
SEED_ROWS = 1 << 20  # pairs of a seed and an item looked at together
WINDOW = 64  # words in which the seeds of a window lie
SEEDS = 2
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
LEAST_WORDS = 8  # aligned words that tell a copy from a phrase
VERBATIM = 50  # words in a row that tell a copy whatever the length of the item
ALIGN_CELLS = 1 << 16  # of a row of the tables aligned together
WORD = re.compile(r"\w+")


def lowered(text: str) -> str:
    """Lower case with every code point in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


@dataclass
class Items:
    """A block of test items: words as numbers from 1 on, and the n-grams of every item."""

    words: dict[str, int]
    ids: list[int | None]
    texts: list[np.ndarray]
    codes: np.ndarray  # n-gram codes, sorted; one for each item that holds the n-gram
    owners: np.ndarray  # the place of that item
    needs: np.ndarray  # different seeds that a window must hold, by item

    @classmethod
    def of(cls, rows: list[tuple[int | None, str]]) -> Items:
        words: dict[str, int] = {}
        texts = [
            np.array([words.setdefault(w, len(words) + 1) for w in WORD.findall(lowered(text))], dtype=np.int64)
            for _, text in rows
        ]
        none = np.zeros(0, dtype=np.int64)
        block = cls(words, [i for i, _ in rows], texts, none, none, none)
        grams = [np.unique(block.grams(t)) for t in texts]
        if grams:
            codes, owners = np.concatenate(grams), np.repeat(np.arange(len(grams)), [len(g) for g in grams])
            order = np.argsort(codes, kind="stable")
            block.codes, block.owners = codes[order], owners[order]
            block.needs = np.array([min(SEEDS, len(g)) for g in grams])
        return block

    def grams(self, numbers: np.ndarray) -> np.ndarray:
        """A 63-bit code for the n-gram at each place; -1 where a word is not of the items.

        Should two n-grams share a code, the alignment tells them apart.
        """
        if len(numbers) < GRAM:
            return np.zeros(0, dtype=np.int64)
        parts = [numbers[k : len(numbers) - GRAM + 1 + k] for k in range(GRAM)]
        known = np.logical_and.reduce([p > 0 for p in parts])
        code = parts[0].astype(np.uint64)
        for part in parts[1:]:
            code = code * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.uint64)
            code ^= code >> np.uint64(29)
        return np.where(known, (code >> np.uint64(1)).astype(np.int64), -1)

    def numbers(self, words: list[str]) -> np.ndarray:
        get = self.words.get
        return np.array([get(w, 0) for w in words], dtype=np.int64)

    def windows(self, numbers: np.ndarray) -> list[tuple[int, int]]:
        """(item, bin) where enough different seeds of an item lie in a window of a document.

        Windows overlap by half: bin k holds the seeds that begin in the halves k and k + 1.
        """
        codes = self.grams(numbers)
        place = np.flatnonzero(codes >= 0)
        low = np.searchsorted(self.codes, codes[place], "left")
        times = np.searchsorted(self.codes, codes[place], "right") - low
        place, low, times = place[times > 0], low[times > 0], times[times > 0]
        if not len(place):
            return []
        half = place // (WINDOW // 2)
        found = []
        first = 0
        while first < len(place):
            # The hits of a few halves at a time; the last half also begins the next stretch.
            total = np.cumsum(times[first:])
            stop = int(half[first + min(np.searchsorted(total, SEED_ROWS), len(total) - 1)])
            stop = max(stop, int(half[first]) + 1)
            end = int(np.searchsorted(half, stop, "right"))
            found.append(self._dense(half[first:end], low[first:end], times[first:end], stop))
            first = end if end == len(place) else int(np.searchsorted(half, stop, "left"))
        return sorted({pair for pairs in found for pair in pairs})

    def _dense(self, half: np.ndarray, low: np.ndarray, times: np.ndarray, stop: int) -> list[tuple[int, int]]:
        at = np.repeat(low - np.cumsum(times) + times, times) + np.arange(times.sum())
        half = np.repeat(half, times)
        pairs = np.concatenate([np.stack([self.owners[at], half - back, at]) for back in (0, 1)], axis=1)
        pairs = np.unique(pairs, axis=1)[:2]
        pairs, seeds = np.unique(pairs, axis=1, return_counts=True)
        return [tuple(p) for p in pairs[:, seeds >= self.needs[pairs[0]]].T.tolist()]

    def may_hold(self, item: int, window: np.ndarray, threshold: float) -> bool:
        """Whether enough words of the item are in the window for the threshold, or a verbatim part, in any order."""
        words = self.texts[item]
        return int(np.isin(words, window).sum()) >= min(threshold * len(words), VERBATIM)

    def verbatim(self, item: int, window: np.ndarray) -> tuple[int, int]:
        """First and end word of the longest part of the item that stands in the window word by word."""
        words = self.texts[item]
        run, best, end = np.zeros(len(window) + 1, dtype=np.int64), 0, 0
        for word in words:
            run[1:] = np.where(window == word, run[:-1] + 1, 0)
            top = int(run.argmax())
            if run[top] > best:
                best, end = int(run[top]), top
        return end - best, end


def align(items: list[np.ndarray], windows: list[np.ndarray]) -> list[tuple[float, int, int, int]]:
    """Best local alignment of each item with its window: score, matches, first and end word.

    Rows of the table run over the words of an item, for all pairs at once; gaps along a row are
    closed by a running maximum. A number 0 in a window matches nothing.
    """
    tall, wide = max(map(len, items)), max(map(len, windows))
    n = len(items)
    item, window = np.full((n, tall), -1, dtype=np.int64), np.full((n, wide), -2, dtype=np.int64)
    for k in range(n):
        item[k, : len(items[k])] = items[k]
        window[k, : len(windows[k])] = windows[k]
    # A cell packs score, matches and start, so that one maximum carries all three.
    steps = np.arange(wide + 1)
    score = np.zeros((n, wide + 1), dtype=np.int64)
    origin = np.broadcast_to(steps, score.shape).copy()
    count = np.zeros_like(score)
    best = np.zeros((4, n), dtype=np.int64)
    for row in range(tall):
        same = item[:, row, None] == window
        diagonal = np.zeros_like(score)
        diagonal[:, 1:] = score[:, :-1] + np.where(same, MATCH, MISMATCH)
        came = np.zeros_like(origin)
        came[:, 1:] = origin[:, :-1]
        met = np.zeros_like(count)
        met[:, 1:] = count[:, :-1] + same
        up = score + GAP
        take = diagonal >= up
        value, came, met = np.where(take, diagonal, up), np.where(take, came, origin), np.where(take, met, count)
        fresh = value <= 0
        value, came, met = np.where(fresh, 0, value), np.where(fresh, steps, came), np.where(fresh, 0, met)
        # Along the row a gap costs -GAP for each word: the running maximum of value - GAP * place.
        lifted = value - GAP * steps
        top = np.maximum.accumulate(lifted, axis=1)
        source = np.maximum.accumulate(np.where(lifted == top, steps, 0), axis=1)
        score = top + GAP * steps
        origin, count = np.take_along_axis(came, source, 1), np.take_along_axis(met, source, 1)
        end = np.argmax(score, axis=1)
        at = (np.arange(n), end)
        better = score[at] > best[0]
        best = np.where(better, np.stack([score[at], count[at], origin[at], end]), best)
    return [
        (best[0, k] / (MATCH * len(items[k])), int(best[1, k]), int(best[2, k]), int(best[3, k])) for k in range(n)
    ]


LEAKS = "doc_id long, text_hash long, item_id long, score double, matched_words int, start int, end int"


def _found(docs: DataFrame, items, threshold: float) -> DataFrame:
    """Leaks of a block of items: seeds, windows and alignments of a document in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Items = items.value
        for batch in batches:
            for part in slices(batch, "text"):
                keys, spans, numbers, pairs = [], [], [], []
                for doc_id, digest, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    low = lowered(text)
                    places = [m.span() for m in WORD.finditer(low)]
                    words = block.numbers([low[x:y] for x, y in places])
                    mine = []
                    for item, place in block.windows(words):
                        n = len(block.texts[item])
                        first = place * (WINDOW // 2) - n
                        first, end = max(0, first), first + WINDOW + 2 * n
                        if block.may_hold(item, words[first:end], threshold):
                            mine.append((item, len(keys), first, end))
                    if mine:
                        keys.append((doc_id, digest))
                        spans.append(places)
                        numbers.append(words)
                        pairs += mine
                # Windows of all documents at hand are aligned together.
                best: dict[tuple[int, int], tuple] = {}
                for group in _groups(pairs, block):
                    found = align([block.texts[p[0]] for p in group], [numbers[p[1]][p[2] : p[3]] for p in group])
                    for (item, row, base, _), (score, matches, first, end) in zip(group, found, strict=True):
                        least = min(LEAST_WORDS, len(block.texts[item]))
                        copied = score >= threshold and matches >= least
                        if not copied and matches >= VERBATIM:
                            window = numbers[row][base : base + WINDOW + 2 * len(block.texts[item])]
                            first, end = block.verbatim(item, window)
                            copied = end - first >= VERBATIM
                        if copied and score > best.get((row, item), (0,))[0]:
                            at = spans[row][base + first][0], spans[row][base + end - 1][1]
                            best[row, item] = (float(score), matches, *at)
                out = [(*keys[row], block.ids[item], *best[row, item]) for row, item in sorted(best)]
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32()]
                    names = [field.split()[0] for field in LEAKS.split(", ")]
                    columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text_hash", "text").mapInArrow(run, LEAKS)


def _groups(pairs: list[tuple], block: Items) -> Iterator[list[tuple]]:
    """Pairs (item, row, start, end) in groups whose tables stay below ALIGN_CELLS, or one pair."""
    group: list[tuple] = []
    width = 0
    for pair in sorted(pairs, key=lambda p: len(block.texts[p[0]])):
        wider = max(width, pair[3] - pair[2] + 1)
        if group and (len(group) + 1) * wider > ALIGN_CELLS:
            yield group
            group, wider = [], pair[3] - pair[2] + 1
        group.append(pair)
        width = wider
    if group:
        yield group


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_and_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document and test item found in it, with score, aligned words and place.

    ``doc_id, text_hash, item_id, score, matched_words, start, end``: start and end are code points
    of the best alignment, or of the verbatim part where the score is below the threshold. Null or
    empty texts and items of fewer than GRAM words match nothing.
    Repeated rows are found once per distinct id and text; a null id stays null. Without documents
    or items the result is empty.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = _hashed(docs, id_col, text_col)
    tests = id_and_text(benchmark, item_col, item_text_col)
    chars = tests.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    result = None
    for k in range(blocks):
        mine = tests.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)) == k) if blocks > 1 else tests
        block = Items.of(sorted((tuple(r) for r in mine.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])))
        items = spark.sparkContext.broadcast(block)
        found = _found(rows.where("text != ''"), items, threshold)
        result = found if result is None else result.unionByName(found)
    # Equal items of several blocks, and repeated rows, are reported once.
    return result.distinct()


def leaking_ids(docs: DataFrame, benchmark: DataFrame, **names: str) -> DataFrame:
    """``doc_id, text_hash`` of the documents that hold a test item."""
    return find_leaks(docs, benchmark, **names).select("doc_id", "text_hash").distinct()


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of the documents that hold no test item."""
    leaks = written(leaking_ids(docs, benchmark, id_col=id_col, text_col=text_col), "leaking-documents")
    leaks = leaks.select(F.col("doc_id").alias("leak_of_id"), F.col("text_hash").alias("leak_of_hash"))
    same = docs[id_col].cast("long").eqNullSafe(leaks["leak_of_id"]) & (
        F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))) == leaks["leak_of_hash"]
    )
    return docs.join(leaks, same, "left_anti")
