"""Removal of near copies: texts whose sets of word shingles are similar, found and verified exactly.

1. SimHash fingerprints of the same shingles (``simhash``) give classes of texts that are a few bits apart. Each
   text is a candidate with the first of its class. Fingerprints miss pairs and join texts that are not similar,
   so their links are verified with those of step 3, and steps 2 to 4 find what they miss.
2. Shingles have one order, very common ones last. Two texts similar enough share one of their first
   n - least + 1 shingles, so each distinct text is placed under those. Only places that two texts share
   are kept.
3. Along each place, texts by size, neighbours and the first with all others are candidates. A parity
   sketch of each set bounds from below how many shingles differ and drops most candidates. Of the others
   each text's link to its least partner is verified on the sets.
4. Where texts of a place are still apart, the sketches of all pairs of them are compared. Of the pairs that
   pass, first a spanning forest of each place is verified, which connects nearly all that belongs
   together; then every pair that is still apart. A place with ``BLOCK`` texts or more is dealt out as pairs of blocks, so a task holds two
   blocks at most.

Every link used is verified, and a pair is passed over only if verified links connect its texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import simhash
from ledgermill.llm.common import id_and_text, slices
from ledgermill.llm.components import connected_components
from ledgermill.llm.simhash import SEED, shingle_hashes
from ledgermill.session import scratch, write_shared, written

WORDS, SIMILARITY = 5, 0.8
BLOCK = 2048
PAIRS = 1 << 20
# Shingles in HOT_TIMES or more of the texts that a task counts together are common. A shingle in one text
# of a thousand is; texts of 500 shingles have fewer than HOT_SHINGLES of them. This order decides on speed alone.
HOT_BUFFER, HOT_TIMES, HOT_SHINGLES = 4 << 20, 8, 500_000
LEAST_BITS, MOST_BITS = 8, 16  # of a sketch, as powers of two


def shingle_set(text: bytes, words_in_shingle: int) -> np.ndarray:
    """Hashes of the distinct shingles, sorted; a text without words has the empty shingle."""
    found = shingle_hashes(text, words_in_shingle)
    if not len(found):
        found = np.array([xxhash.xxh64_intdigest(b"", SEED)], dtype="<u8")
    return np.unique(found.view(np.int64))


def least_shared(similarity: float, size: int) -> int:
    return int(np.ceil(similarity * size - 1e-9))


def sketch(found: np.ndarray) -> bytes:
    """Parity of the shingles that fall on each bit; twice as many bits as shingles, a power of two."""
    bits = min(MOST_BITS, max(LEAST_BITS, int(2 * len(found) - 1).bit_length()))
    return np.packbits(np.bincount(found & ((1 << bits) - 1), minlength=1 << bits) & 1 > 0).tobytes()


def least_apart(a: bytes, b: bytes) -> int:
    """Shingles at least that only one of two sets has: the bits in which their sketches differ."""
    if len(a) < len(b):
        a, b = b, a
    low = np.frombuffer(b, dtype=np.uint8)
    high = np.bitwise_xor.reduce(np.frombuffer(a, dtype=np.uint8).reshape(-1, len(low)), axis=0)
    return int(np.bitwise_count(high ^ low).sum())


def may_match(size_a, place_a, size_b, place_b, similarity: float):
    """Whether two sets can be similar if the key at these places is the first shingle they share."""
    rest = np.minimum(size_a - place_a, size_b - place_b)
    enough = rest * (1 + similarity) >= similarity * (size_a + size_b) - 1e-6
    return enough & (np.minimum(size_a, size_b) >= similarity * np.maximum(size_a, size_b) - 1e-6)


def common_shingles(rows: DataFrame, words_in_shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of many texts, sorted, and the place of each when ordered by the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            values, times = np.unique(np.concatenate(held), return_counts=True)
            often = times >= HOT_TIMES
            return pa.RecordBatch.from_arrays([pa.array(values[often]), pa.array(times[often])], names=["shingle", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column(1).to_pylist():
                    held.append(shingle_set(text, words_in_shingle))
                    size += len(held[-1])
                    if size >= HOT_BUFFER:
                        yield counted()
                        held, size = [], 0
        if held:
            yield counted()

    counts = rows.mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    found = counts.orderBy(F.desc("n"), "shingle").limit(HOT_SHINGLES).toArrow()
    shingles = found.column("shingle").to_numpy()
    order = np.argsort(shingles)
    return shingles[order], (len(shingles) - np.arange(len(shingles)))[order]


def _placed(rows: DataFrame, words_in_shingle: int, similarity: float) -> DataFrame:
    """``node, size, keys, bits``: the first shingles of each text in the common order, and its sketch."""
    sent = rows.sparkSession.sparkContext.broadcast(common_shingles(rows, words_in_shingle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, ranks = sent.value
        for batch in batches:
            for part in slices(batch, "text"):
                keys, sizes, bits = [], [], []
                for text in part.column(1).to_pylist():
                    found = shingle_set(text, words_in_shingle)
                    bits.append(sketch(found))
                    sizes.append(len(found))
                    if len(common):
                        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
                        found = found[np.argsort(np.where(common[at] == found, ranks[at], 0), kind="stable")]
                    keys.append(found[: len(found) - least_shared(similarity, len(found)) + 1])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int32()), pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                    names=["node", "size", "keys", "bits"],
                )

    return rows.mapInArrow(run, "node long, size int, keys array<long>, bits binary")


class _Pairs:
    """Pairs of nodes, each once as far as this task can tell."""

    def __init__(self):
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.held.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
            self.size += len(a)
            if self.size > PAIRS:
                self.held = [self.take()]
                self.size = len(self.held[0])

    def take(self) -> np.ndarray:
        every = np.concatenate(self.held) if self.held else np.zeros((0, 2), dtype=np.int64)
        self.held, self.size = [], 0
        turn = np.lexsort((every[:, 1], every[:, 0]))
        every = every[turn]
        fresh = np.ones(len(every), dtype=bool)
        fresh[1:] = (every[1:] != every[:-1]).any(axis=1)
        return every[fresh]


MET = "member boolean, key long, node long, size int, place int"


def _shared_places(placed: DataFrame, similarity: float) -> DataFrame:
    """Members (key, node, size, place) of keys that several texts share, and candidate links (key, node)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _Pairs()
        kept = None  # the last row: key, node, size, place, whether the key was met before, the key's first row

        def out(member: bool, *columns: np.ndarray) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            arrays = [pa.array(np.full(len(columns[0]), member))]
            arrays += [pa.array(c.astype(k.to_pandas_dtype())) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["member", "key", "node", "size", "place"])

        def links() -> pa.RecordBatch:
            found = pairs.take()
            return out(False, found[:, 0], found[:, 1], np.zeros(len(found)), np.zeros(len(found)))

        for batch in batches:
            if not batch.num_rows:
                continue
            table = np.stack([np.asarray(batch.column(k), dtype=np.int64) for k in range(4)])
            met, first = False, None
            if kept is not None:
                table, met, first = np.concatenate([kept[0], table], axis=1), kept[1], kept[2]
            again = np.concatenate([[False], (table[0, 1:] == table[0, :-1]) & (table[1, 1:] == table[1, :-1])])
            table = table[:, ~again]  # a text that is there twice
            key, node, size, place = table
            before = np.concatenate([[met], key[1:] == key[:-1]])
            after = np.concatenate([before[1:], [False]])
            heads = np.maximum.accumulate(np.where(before, 0, np.arange(len(key))))
            first_rows = table[:, heads]
            if met:  # the first key began in an earlier batch
                own = np.arange(len(key)) < (np.flatnonzero(~before)[0] if (~before).any() else len(key))
                first_rows[:, own] = first[:, None]
            follow = np.flatnonzero(before[1:]) + 1
            near = may_match(size[follow], place[follow], size[follow - 1], place[follow - 1], similarity)
            pairs.add(node[follow[near]], node[follow[near] - 1])
            far = first_rows[:, follow]
            near = may_match(size[follow], place[follow], far[2], far[3], similarity) & (far[1] != node[follow])
            pairs.add(node[follow[near]], far[1][near])
            last = len(key) - 1
            mine = np.flatnonzero((before | after)[:last])
            kept = (table[:, last:], bool(before[last]), first_rows[:, last])
            yield out(True, *(c[mine] for c in table))
            if pairs.size > PAIRS // 2:
                yield links()
        if kept is not None and kept[1]:
            yield out(True, *kept[0])
        yield links()

    spread = placed.select("node", "size", F.posexplode("keys").alias("place", "key")).select("key", "node", "size", "place")
    return spread.repartition("key").sortWithinPartitions("key", "size", "node").mapInArrow(run, MET)


APART = "a long, b long, block int, label long, size int, place int, bits binary"


def _apart(one: tuple, two: tuple, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of two lists of (size, place, label, bits) that differ in label and may be similar.

    Sketches are compared row by row, so only pairs that can be similar become rows.
    """
    most = (1 - similarity) / (1 + similarity)
    (size, place, label, bits), (other_size, other_place, other_label, other_bits) = one, two
    widths = {w: np.array([k for k, b in enumerate(other_bits) if len(b) == w]) for w in {len(b) for b in other_bits}}
    tables = {w: np.frombuffer(b"".join(other_bits[k] for k in at), dtype=np.uint64).reshape(len(at), -1) for w, at in widths.items()}
    left, right = [], []
    for k in range(len(size)):
        near = may_match(size[k], place[k], other_size, other_place, similarity) & (label[k] != other_label)
        if not near.any():
            continue
        mine = np.frombuffer(bits[k], dtype=np.uint64)
        for width, at in widths.items():
            asked = np.flatnonzero(near[at])
            if not len(asked):
                continue
            table, own = tables[width][asked], mine
            if len(own) > table.shape[1]:
                own = np.bitwise_xor.reduce(own.reshape(-1, table.shape[1]), axis=0)
            elif len(own) < table.shape[1]:
                table = np.bitwise_xor.reduce(table.reshape(len(asked), -1, len(own)), axis=1)
            differ = np.bitwise_count(table ^ own).sum(axis=1, dtype=np.int64)
            hits = at[asked[differ <= (size[k] + other_size[at[asked]]) * most + 1e-6]]
            left.append(np.full(len(hits), k))
            right.append(hits)
    none = [np.zeros(0, dtype=np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs (a, b) make a spanning forest; pairs of small nodes come first."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    kept = []
    for k in np.lexsort((high, low)).tolist():
        x, y = root(int(low[k])), root(int(high[k]))
        if x != y:
            parent[y] = x
            kept.append(k)
    return np.array(kept, dtype=np.int64)


def _mixed(members: DataFrame) -> DataFrame:
    """The members of keys whose texts have different labels."""
    keys = members.groupBy(F.col("key").alias("mixed_key")).agg(F.min("label").alias("low"), F.max("label").alias("high"))
    keys = written(keys.where("low != high").select("mixed_key"), "mixed-keys")
    return written(members.join(keys, F.col("key") == F.col("mixed_key"), "left_semi"), "mixed-members")


def _pairs_apart(members: DataFrame, similarity: float, forest: bool) -> DataFrame:
    """Pairs (a, b) of texts of one key with different labels whose sketches allow it; may repeat.

    With ``forest`` only enough of them to connect what all of a bucket would connect.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in APART.split(", ")]
        pairs = _Pairs()
        held: list = [None, [], 0]  # a key, its members not dealt out yet, blocks that are

        def links() -> pa.RecordBatch:
            found = pairs.take()
            fill = np.zeros(len(found), dtype=np.int64)
            kinds = ("i8", "i8", "i4", "i8", "i4", "i4")
            columns = (found[:, 0], found[:, 1], fill - 1, fill, fill, fill)
            arrays = [pa.array(c.astype(k)) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*arrays, pa.nulls(len(found), pa.binary())], names=names)

        def deal(rows: list[tuple]) -> pa.RecordBatch:
            nodes, sizes, places, labels, bits = zip(*rows, strict=True)
            key, _, number = held
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            columns = ([key] * len(rows), nodes, [number] * len(rows), labels, sizes, places, bits)
            held[2] += 1
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        def close() -> Iterator[pa.RecordBatch]:
            rows = held[1]
            if held[2] and rows:
                yield deal(rows)
            elif len(rows) > 1:
                nodes, *columns, bits = zip(*rows, strict=True)
                nodes, side = np.array(nodes), (*map(np.array, columns), bits)
                a, b = _apart(side, side, similarity)
                a, b = nodes[a[a < b]], nodes[b[a < b]]
                chosen = _forest(a, b) if forest else slice(None)
                pairs.add(a[chosen], b[chosen])

        for batch in batches:
            keys, *columns = (c.to_pylist() for c in batch.columns)
            for key, *row in zip(keys, *columns, strict=True):
                if key != held[0]:
                    yield from close()
                    held[:] = [key, [], 0]
                held[1].append(tuple(row))
                if len(held[1]) == BLOCK:
                    rows, held[1] = held[1], []
                    yield deal(rows)
            if pairs.size > PAIRS // 2:
                yield links()
        yield from close()
        yield links()

    met = members.select("key", "node", "size", "place", "label", "bits")
    met = met.repartition("key").sortWithinPartitions("key", "size", "node")
    met = written(met.mapInArrow(run, APART), "pairs-apart")
    return met.where("block < 0").select("a", "b").union(_cells(met.where("block >= 0"), similarity, forest))


def _cells(dealt: DataFrame, similarity: float, forest: bool) -> DataFrame:
    """Pairs of overfull keys: blocks whose sizes allow similar texts meet in one cell."""
    sizes = dealt.groupBy("a", "block").agg(F.min("size").alias("low"), F.max("size").alias("high"))
    sizes = written(sizes, "key-blocks")
    left = sizes.select(F.col("a").alias("key"), F.col("block").alias("one"), F.col("high").alias("most"))
    right = sizes.select(F.col("a").alias("other_key"), F.col("block").alias("two"), F.col("low").alias("least"))
    # Texts lie by size, so block two is not smaller.
    match = (F.col("key") == F.col("other_key")) & (F.col("one") <= F.col("two"))
    meet = left.join(right, match & (F.col("most") >= F.col("least") * similarity - 1e-6)).select("key", "one", "two")
    meet = written(meet, "block-pairs")
    rows = dealt.select(F.col("a").alias("key"), F.col("b").alias("node"), "block", "label", "size", "place", "bits")
    first = rows.join(meet.withColumn("block", F.col("one")), ["key", "block"])
    second = rows.join(meet.where("one < two").withColumn("block", F.col("two")), ["key", "block"])

    def cell(key: tuple, table: pa.Table) -> pa.Table:
        one, two = key[1].as_py(), key[2].as_py()
        node, block, label, size, place = (table.column(c).to_numpy() for c in ("node", "block", "label", "size", "place"))
        bits = table.column("bits").to_pylist()
        a = np.flatnonzero(block == one)
        b = a if one == two else np.flatnonzero(block == two)
        sides = [(size[at], place[at], label[at], [bits[k] for k in at]) for at in (a, b)]
        x, y = _apart(*sides, similarity)
        x, y = node[a[x]], node[b[y]]
        chosen = _forest(x, y) if forest else slice(None)
        pairs = _Pairs()
        pairs.add(x[chosen], y[chosen])
        found = pairs.take()
        return pa.table({"a": pa.array(found[:, 0]), "b": pa.array(found[:, 1])})

    return first.unionByName(second).groupBy("key", "one", "two").applyInArrow(cell, "a long, b long")


def _sketched(links: DataFrame, placed: DataFrame, similarity: float) -> DataFrame:
    """The links whose sketches allow texts similar enough."""
    sides = [placed.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}"), F.col("bits").alias(f"bits_{c}")) for c in "ab"]
    both = links.join(sides[0], "a").join(sides[1], "b").select("a", "b", "size_a", "size_b", "bits_a", "bits_b")
    most = (1 - similarity) / (1 + similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = (np.asarray(batch.column(2), dtype=np.int64) + np.asarray(batch.column(3), dtype=np.int64)) * most + 1e-6
            bits = zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)
            apart = np.fromiter((least_apart(x, y) for x, y in bits), dtype=np.int64, count=batch.num_rows)
            yield batch.select([0, 1]).filter(pa.array(apart <= sizes))

    return both.mapInArrow(run, "a long, b long")


def _sets(texts: DataFrame, links: DataFrame, words_in_shingle: int) -> DataFrame:
    """``node, shingles`` of the texts at the ends of the links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [shingle_set(text, words_in_shingle) for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.list_(pa.int64()))], names=["node", "shingles"]
                )

    ends = written(links.selectExpr("a as node").union(links.selectExpr("b as node")).distinct(), "link-ends")
    wanted = texts.join(ends, "node", "left_semi").select("node", "text")
    return written(wanted.mapInArrow(run, "node long, shingles array<long>"), "shingle-sets")


def _alike(links: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The links (a, b) whose texts share ``similarity`` of their distinct shingles (Jaccard)."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    both = links.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("left", "right"))
    alike = both.where(shared >= similarity * (F.size("left") + F.size("right") - shared) - 1e-6)
    return written(alike.select("a", "b"), "verified-links")


def _stars(known: DataFrame) -> DataFrame:
    return known.where("node != component").selectExpr("node as a", "component as b")


def _fingerprint_links(texts: DataFrame, words_in_shingle: int) -> DataFrame:
    """Candidate links (a, b) of each text to the smallest text of its class of SimHash fingerprints."""
    prints = simhash.fingerprints(texts, words_in_shingle, "node", "text")
    linked = simhash.near_duplicates(prints).where("doc_id != component_id")
    return linked.select(F.least("doc_id", "component_id").alias("a"), F.greatest("doc_id", "component_id").alias("b"))


def similar_texts(texts: DataFrame, words_in_shingle: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``node, component`` over every pair of texts that are similar enough, from ``node, text`` (bytes).

    Each node has one row. Texts without a similar one have no row.
    """
    placed = written(_placed(texts, words_in_shingle, similarity), "placed-texts")
    met = written(_shared_places(placed, similarity), "shared-places")
    printed = written(_sketched(_fingerprint_links(texts, words_in_shingle), placed, similarity), "fingerprint-links")
    tried = written(met.where("not member").selectExpr("key as a", "node as b").distinct(), "candidate-links")
    links = written(_sketched(tried, placed, similarity), "sketched-links")
    # Most texts have a partner that proves similar: one link each connects nearly all.
    both = links.union(links.selectExpr("b as a", "a as b"))
    nearest = both.groupBy("a").agg(F.min("b").alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    nearest = written(nearest.union(printed).distinct(), "nearest-links")
    proved = _alike(nearest, _sets(texts, nearest, words_in_shingle), similarity)
    known = written(connected_components(proved), "connected-texts")
    tried = nearest
    for forest in (True, False):
        members = met.where("member").join(known, "node", "left")
        members = members.select("key", "node", "size", "place", F.coalesce("component", "node").alias("label"))
        members = _mixed(written(members, "labelled-members")).join(placed.select("node", "bits"), "node")
        pairs = _pairs_apart(members, similarity, forest).distinct().join(tried, ["a", "b"], "left_anti")
        pairs = written(pairs, "untried-pairs")
        proved = _alike(pairs, _sets(texts, pairs, words_in_shingle), similarity)
        known = written(connected_components(proved.union(_stars(known))), "connected-texts")
        tried = tried.union(pairs)
    return known


def without_near_copies(
    docs: DataFrame,
    words_in_shingle: int = WORDS,
    similarity: float = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All columns of one row for each group of near copies: the smallest id, null last.

    Two texts are near copies if they share ``similarity`` (more than 0) of their distinct shingles; all
    such pairs are found. Texts without words, null ones included, are one group. Of rows with equal id
    and text one stays, whichever. An empty table stays empty.
    """
    spark = docs.sparkSession
    with scratch(spark):
        rows = id_and_text(docs, id_col, text_col)
        hashed = rows.select("doc_id", F.xxhash64("text").alias("text_hash"))
        order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id")
        equal = hashed.groupBy("text_hash", "doc_id").agg(F.count("*").alias("rows"))
        firsts = equal.groupBy("text_hash").agg(F.min(F.struct(order.alias("order"), "rows")).alias("first"))
        firsts = firsts.select("text_hash", "first.order.no_id", "first.order.doc_id", "first.rows")
        firsts = written(firsts, "first-rows")
        once = firsts.select(F.col("text_hash").alias("first_hash"), F.col("doc_id").alias("first_id"))
        texts = rows.select("doc_id", F.xxhash64("text").alias("node"), F.col("text").cast("binary").alias("text"))
        texts = texts.join(once, F.expr("node = first_hash and doc_id <=> first_id"), "left_semi").select("node", "text")
        if not firsts.where("rows > 1").isEmpty():
            texts = texts.dropDuplicates(["node"])
        linked = written(similar_texts(texts, words_in_shingle, similarity), "linked-texts")
        named = firsts.join(linked.withColumnRenamed("node", "text_hash"), "text_hash", "left")
        best = F.min(F.struct("no_id", "doc_id", "text_hash", "rows")).alias("first")
        keepers = named.groupBy(F.coalesce("component", "text_hash").alias("class")).agg(best)
        path = write_shared(
            keepers.select(F.col("first.doc_id").alias("keep_id"), F.col("first.text_hash").alias("keep_hash"), "first.rows"),
            "kept-rows",
        )
    keepers = spark.read.parquet(path)
    names = docs.columns
    inner = [f"c{k}" for k in range(len(names))]
    base = docs.toDF(*inner)
    key, text = F.col(inner[names.index(id_col)]), F.col(inner[names.index(text_col)])
    same = key.cast("long").eqNullSafe(F.col("keep_id")) & _hash_of(text, "keep_hash")
    alone = base.join(keepers.where("rows = 1"), same, "left_semi")
    many = base.join(keepers.where("rows > 1"), same).dropDuplicates(["keep_id", "keep_hash"]).select(*inner)
    return alone.unionByName(many).toDF(*names)


def _hash_of(text: Column, name: str) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))) == F.col(name)
