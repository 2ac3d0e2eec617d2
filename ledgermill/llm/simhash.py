"""SimHash fingerprints and their near-duplicate components.

Fingerprints at ``distance`` or fewer differing bits are found by deletion variants. With
``distance`` 3 a fingerprint is cut into two segments, fewer than the four that exact equality
would need: of two segments one differs by one bit at most. Each segment is indexed once per
position with the bit there taken out; two fingerprints whose segments differ by one bit at most
share such a variant. Equal variants meet in one bucket, where the whole distance is verified.

Only distinct fingerprints are indexed. A bucket yields a spanning forest of its links, never all
its pairs. A bucket beyond ``BLOCK`` members is dealt out again as pairs of blocks, so no task
holds more than two blocks.

Similar shingle sets are more than fingerprints can promise; for those see ``near_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import id_and_text, slices
from ledgermill.llm.components import connected_components
from ledgermill.session import written

BITS = 64
SEED = 42
SHINGLE = 3
DISTANCE = 3
BLOCK = 2048


def shingle_hashes(text: bytes, words_in_shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of each shingle of UTF-8 bytes, repeats included; fewer words are one shingle."""
    words = text.lower().split()
    if len(words) <= words_in_shingle:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(words_in_shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, SEED) for s in shingles], dtype="<u8")


def text_fingerprint(text: bytes, words_in_shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of UTF-8 bytes; no words: zero."""
    hashes = shingle_hashes(text, words_in_shingle)
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, dtype=np.int64)
    for first in range(0, len(hashes), 65536):  # a bounded table of bits, however long the text
        part = hashes[first : first + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, words_in_shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, text_hash, fp``: the fingerprint of each row as a signed long. Null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [text_fingerprint(text, words_in_shingle) for text in part.column(2).to_pylist()]
                signed = np.array(found, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(signed)], names=["doc_id", "text_hash", "fp"]
                )

    rows = id_and_text(docs, id_col, text_col)
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def _variants(fps: DataFrame, distance: int) -> DataFrame:
    """``fp, key``: a key for each segment and each position taken out of it.

    With s segments, distance d <= 2s - 1 leaves one segment with one differing bit at most.
    """
    segments = (distance + 2) // 2
    keys = []
    for segment in range(segments):
        low, high = BITS * segment // segments, BITS * (segment + 1) // segments
        mask = (1 << high) - (1 << low)
        for bit in range(low, high):
            kept = mask & ~(1 << bit)
            signed = kept - (1 << 64) if kept >= 1 << 63 else kept
            # The bits kept tell the segment apart only together with the bit taken out.
            keys.append(F.xxhash64(F.lit(bit), F.col("fp").bitwiseAND(F.lit(signed))))
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of signed fingerprints; numpy counts those of a signed number's magnitude."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def _forest(fps: np.ndarray, others: np.ndarray | None, distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest among ``fps``, or between them and ``others``."""
    nodes = fps if others is None else np.concatenate([fps, others])
    near = range(len(fps))
    if others is None and len(fps) <= 128:
        # Most small buckets hold no link at all: one table of distances tells.
        table = _differing(fps[:, None], fps[None, :]) <= distance
        near = np.flatnonzero(table.sum(axis=1) > 1).tolist()
    tree = np.arange(len(nodes))
    out = []
    for k in near:
        first = k + 1 if others is None else len(fps)
        hits = first + np.flatnonzero(_differing(nodes[first:], nodes[k]) <= distance)
        hits = hits[tree[hits] != tree[k]]
        if len(hits):
            trees, at = np.unique(tree[hits], return_index=True)
            out += [(int(nodes[k]), int(nodes[hit])) for hit in hits[at]]
            tree[np.isin(tree, trees)] = tree[k]
    return out


RUN = "a long, b long, block int"


def _bucket_links(rows: DataFrame, distance: int) -> DataFrame:
    """Rows (a, b, block): links with block -1; members b of an overfull bucket a with their block.

    Rows arrive sorted by key and fingerprint. A bucket larger than BLOCK is passed on in blocks.
    """

    def of_bucket(fps: np.ndarray) -> list[tuple[int, int]]:
        if len(fps) == 2:
            return [(int(fps[0]), int(fps[1]))] if int(_differing(fps[:1], fps[1])[0]) <= distance else []
        return _forest(fps, None, distance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held, block = None, np.zeros(0, dtype=np.int64), 0
        a: list[int] = []
        b: list[int] = []
        blocks: list[int] = []

        def keep(links: list[tuple[int, int]]) -> None:
            for x, y in links:
                a.append(x)
                b.append(y)
                blocks.append(-1)

        def deal(key: int, fps: np.ndarray, number: int) -> None:
            a.extend([key] * len(fps))
            b.extend(fps.tolist())
            blocks.extend([number] * len(fps))

        def close() -> None:
            nonlocal block
            if held_key is not None and block:
                if len(held):
                    deal(held_key, held, block)
            elif len(held) > 1:
                keep(of_bucket(held))
            block = 0

        def batch_out() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(blocks, pa.int32())],
                names=["a", "b", "block"],
            )
            a.clear(), b.clear(), blocks.clear()
            return out

        for batch in batches:
            fps, keys = (np.asarray(batch.column(k), dtype=np.int64) for k in (0, 1))
            if not len(keys):
                continue
            starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
            ends = np.append(starts[1:], len(keys))
            # Buckets of two that lie inside the batch are verified all at once.
            inner = np.ones(len(starts), dtype=bool)
            inner[0] = inner[-1] = False
            twos = starts[inner & (ends - starts == 2)]
            close_by = _differing(fps[twos], fps[twos + 1]) <= distance
            keep(list(zip(fps[twos[close_by]].tolist(), fps[twos[close_by] + 1].tolist(), strict=True)))
            for run_no in np.flatnonzero(~inner | (ends - starts > 2)).tolist():
                lo, hi = int(starts[run_no]), int(ends[run_no])
                key = int(keys[lo])
                if key != held_key:
                    close()
                    held_key, held = key, fps[lo:hi]
                else:
                    held = np.concatenate([held, fps[lo:hi]])
                while len(held) > BLOCK:
                    deal(key, held[:BLOCK], block)
                    held, block = held[BLOCK:], block + 1
            yield batch_out()
        close()
        yield batch_out()

    return rows.select("fp", "key").mapInArrow(run, RUN)


def _block_pairs(members: DataFrame, distance: int) -> DataFrame:
    """Links of overfull buckets: every pair of blocks of a bucket meets in one cell."""
    sizes = members.groupBy("a").agg((F.max("block") + 1).alias("blocks"))
    cells = (
        members.join(written(sizes, "bucket-blocks"), "a")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.col("a").alias("key"),
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "block",
            F.col("b").alias("fp"),
        )
    )

    def cell(key: tuple, table: pa.Table) -> pa.Table:
        blocks, fps = (table.column(k).to_numpy() for k in ("block", "fp"))
        if key[1].as_py() == key[2].as_py():
            links = _forest(fps, None, distance)
        else:
            left = blocks == key[1].as_py()
            links = _forest(fps[left], fps[~left], distance)
        ends = list(zip(*links, strict=True)) if links else [(), ()]
        return pa.table({"a": pa.array(ends[0], pa.int64()), "b": pa.array(ends[1], pa.int64())})

    return cells.groupBy("key", "low", "high").applyInArrow(cell, "a long, b long")


def _classes(prints: DataFrame, distance: int) -> DataFrame:
    """``fp, least_id, class``: the class of each distinct fingerprint."""
    smallest = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fingerprints")
    buckets = _variants(smallest.select("fp"), distance).repartition("key").sortWithinPartitions("key", "fp")
    found = written(_bucket_links(buckets, distance), "bucket-links")
    links = found.where("block < 0").select("a", "b")
    members = found.where("block >= 0")
    links = written(links.distinct(), "links").union(_block_pairs(members, distance))
    linked = written(connected_components(links).withColumnRenamed("node", "fp"), "linked-fingerprints")
    classes = smallest.join(linked, "fp", "left").select("fp", "least_id", F.coalesce("component", "fp").alias("class"))
    return written(classes, "fingerprint-classes")


def near_duplicates(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fp, component_id`` from ``doc_id, fp``: the smallest id reachable over links.

    Rows with equal fingerprints share a component. A row without an id belongs to the component
    of its fingerprint, which is null if no row of it has an id. Ids are not names of fingerprints:
    repeated ids with different texts link nothing by themselves.
    """
    prints = written(prints.select("doc_id", "fp"), "fingerprints")
    classes = _classes(prints, distance)
    # A class is named by its smallest document, so classes are combined before names go back.
    names = written(classes.groupBy("class").agg(F.min("least_id").alias("component_id")), "class-names")
    by_fp = written(classes.join(names, "class").select("fp", "component_id"), "fingerprint-names")
    return prints.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(column: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
