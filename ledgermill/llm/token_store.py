"""Token ids in binary shards with a minimal perfect hash index.

Documents are range-partitioned by key and each task writes its ids to one shard, in key order.
The index is split by a hash of the key; each part holds a minimal perfect hash of its keys, a
fingerprint per key that rejects unknown keys, and the place of each key's ids. A lookup reads a
bounded number of index words and then the ids, wherever the key lies.

Shard: 8 bytes magic, 8 bytes width of an id (2 or 4), then raw little-endian ids.
Index part: 8 bytes magic, 8 bytes length of a JSON header, the header, then the arrays it lists.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermill.llm.common import fresh_folder, id_and_text, open_folder, read_file, slices, write_file
from ledgermill.llm.tokens import encoder
from ledgermill.session import written

SHARD_MAGIC, INDEX_MAGIC = b"LMTOKEN1", b"LMINDEX1"
HEAD = 16
PART_KEYS = 200_000
ROOM = 1.7  # bits of a level for each key left
ENTRIES = "doc_id long, shard int, file string, start long, n_tokens long"


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser of a multiply-xorshift hash."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mix(keys, 7) % np.uint64(parts)).astype(np.int64)


def index_path(folder: str, part: int) -> str:
    return os.path.join(folder, f"index-{part:08d}.mph")


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 11) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Levels of bits: a key sits at its first level where no other key left shares its bit.

    The slot of a key is the number of set bits before its own.
    """

    def __init__(self, sizes: list[int], words: np.ndarray, ranks: np.ndarray):
        self.sizes, self.words, self.ranks = sizes, words, ranks
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys``: distinct 64-bit integers."""
        sizes, levels, rest = [], [], keys.astype(np.uint64)
        while len(rest):
            size = max(64, -(-int(ROOM * len(rest)) // 64) * 64)
            at = (mix(rest, 101 + len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            rest = rest[~alone[at]]
        bits = np.concatenate(levels) if levels else np.zeros(0, dtype=bool)
        words = np.packbits(bits, bitorder="little").view("<u8") if len(bits) else np.zeros(0, "<u8")
        counts = np.bitwise_count(words).astype(np.int64)
        ranks = np.concatenate([[0], np.cumsum(counts)])[: len(words)].astype("<u4")
        return cls(sizes, words, ranks)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for a key that sits at no level."""
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = self.starts[level] + (mix(keys[left], 101 + level) % np.uint64(size)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[hit]] = (self.ranks[at >> 6].astype(np.int64) + below)[hit]
            left = left[~hit]
        return out


def index_bytes(entries: pd.DataFrame) -> list[bytes]:
    """One index part from rows ``doc_id, file, start, n_tokens``; equal keys keep all their rows."""
    entries = entries.sort_values(["doc_id", "file", "start"], kind="stable", ignore_index=True)
    keys, first, count = np.unique(entries["doc_id"].to_numpy(np.int64), return_index=True, return_counts=True)
    hashed = PerfectHash.build(keys)
    slots = hashed.slots(keys)
    files, number = np.unique(entries["file"].to_numpy(dtype=object).astype(str), return_inverse=True)
    prints, firsts, counts = np.zeros(len(keys), "<u4"), np.zeros(len(keys), "<u4"), np.zeros(len(keys), "<u4")
    prints[slots], firsts[slots], counts[slots] = fingerprint(keys), first, count
    arrays = {
        "words": hashed.words.astype("<u8"),
        "start": entries["start"].to_numpy("<u8"),
        "n_tokens": entries["n_tokens"].to_numpy("<u8"),
        "ranks": hashed.ranks,
        "prints": prints,
        "first": firsts,
        "count": counts,
        "file": number.astype("<u4"),
    }
    header = {"sizes": hashed.sizes, "files": list(files), "arrays": [[k, a.dtype.str, len(a)] for k, a in arrays.items()]}
    head = json.dumps(header).encode()
    head += b" " * (-len(head) % 8)
    return [INDEX_MAGIC, len(head).to_bytes(8, "little"), head, *(a.tobytes() for a in arrays.values())]


class IndexPart:
    """A part of the index, mapped from its bytes."""

    def __init__(self, data: pa.Buffer | bytes):
        view = memoryview(data)
        if bytes(view[:8]) != INDEX_MAGIC:
            raise ValueError("not an index part")
        size = int.from_bytes(view[8:16], "little")
        header, at = json.loads(bytes(view[16 : 16 + size])), 16 + size
        self.arrays = {}
        for name, kind, length in header["arrays"]:
            self.arrays[name] = np.frombuffer(view, kind, length, at)
            at += length * np.dtype(kind).itemsize
        self.files = np.array(header["files"], dtype=object)
        self.hashed = PerfectHash(header["sizes"], self.arrays["words"], self.arrays["ranks"])

    def lookup(self, keys: np.ndarray) -> pd.DataFrame:
        """Rows ``doc_id, file, start, n_tokens`` of the keys that are in the index."""
        a, keys = self.arrays, keys.astype(np.int64)
        slots = self.hashed.slots(keys)
        hit = np.flatnonzero(slots >= 0)
        hit = hit[a["prints"][slots[hit]] == fingerprint(keys[hit])] if len(hit) else hit
        count = a["count"][slots[hit]].astype(np.int64)
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        entry = np.repeat(a["first"][slots[hit]].astype(np.int64), count) + inside
        return pd.DataFrame(
            {
                "doc_id": np.repeat(keys[hit], count),
                "file": self.files[a["file"][entry]] if len(entry) else np.array([], dtype=object),
                "start": a["start"][entry].astype(np.int64),
                "n_tokens": a["n_tokens"][entry].astype(np.int64),
            }
        )


@dataclass
class TokenStore:
    """Shards and index below ``folder``; ``entries`` and ``shards`` are written tables."""

    folder: str
    parts: int
    entries: DataFrame
    shards: DataFrame

    def get(self, key: int) -> list[np.ndarray]:
        """The ids of each document with this key; an unknown key gives none."""
        keys = np.array([key], dtype=np.int64)
        try:
            found = IndexPart(read_file(index_path(self.folder, int(part_of(keys, self.parts)[0])))).lookup(keys)
        except FileNotFoundError:  # a part without keys has no file
            return []
        return [read_ids(f, int(s), int(n)) for f, s, n in zip(found["file"], found["start"], found["n_tokens"], strict=True)]

    def lookup(self, keys: DataFrame, key_col: str = "doc_id") -> DataFrame:
        """Joins keys to places through the index: ``doc_id, file, start, n_tokens``.

        A repeated key is looked up once; a null or unknown key gives no row.
        """
        parts, folder = self.parts, self.folder

        def find(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            try:
                part = IndexPart(read_file(index_path(folder, int(key[0]))))
            except FileNotFoundError:  # a part without keys has no file
                return pd.DataFrame(columns=["doc_id", "file", "start", "n_tokens"])
            return part.lookup(np.unique(pdf["doc_id"].to_numpy(np.int64)))

        asked = keys.select(keys[key_col].cast("long").alias("doc_id")).where("doc_id is not null")
        return _with_part(asked, parts).groupBy("part").applyInPandas(find, "doc_id long, file string, start long, n_tokens long")

    def read(self, places: DataFrame) -> DataFrame:
        """Reads ids at ``doc_id, file, start, n_tokens``: adds ``ids_crc32`` and the global start."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                crcs = [
                    zlib.crc32(read_ids(f, int(s), int(n)).tobytes())
                    for f, s, n in zip(pdf["file"], pdf["start"], pdf["n_tokens"], strict=True)
                ]
                yield pdf.assign(ids_crc32=np.array(crcs, dtype=np.int64))

        read = (
            places.select("doc_id", "file", "start", "n_tokens")
            .repartition(max(1, self.shards.count()), "file")
            .sortWithinPartitions("file", "start")
            .mapInPandas(run, "doc_id long, file string, start long, n_tokens long, ids_crc32 long")
        )
        bases = self.shards.select("file", "base")
        return read.join(bases, "file").select(
            "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
        )


_open: dict[str, tuple[pa.NativeFile, int]] = {}


def read_ids(file: str, start: int, n_tokens: int) -> np.ndarray:
    """Ids of one document from its shard, as unsigned 32-bit integers."""
    if file not in _open:
        for source, _ in _open.values():
            source.close()
        _open.clear()
        fs, plain = open_folder(file)
        source = fs.open_input_file(plain)
        head = source.read(HEAD)
        if head[:8] != SHARD_MAGIC:
            raise ValueError(f"not a shard: {file}")
        _open[file] = (source, int.from_bytes(head[8:], "little"))
    source, width = _open[file]
    return np.frombuffer(source.read_at(n_tokens * width, HEAD + start * width), f"<u{width}").astype("<u4")


def _with_part(df: DataFrame, parts: int) -> DataFrame:
    """Adds the index part of ``doc_id``: the same hash as ``part_of``, in numpy per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column(0), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(part_of(keys, parts))], names=[*batch.schema.names, "part"]
            )

    fields = ", ".join(f"{name} {kind}" for name, kind in df.dtypes)
    return df.mapInArrow(run, f"{fields}, part long")


def write_store(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> TokenStore:
    """Writes documents in ascending key order to shards below ``folder`` and indexes them.

    A null or empty text is the end id alone. Rows with equal keys are separate documents, ordered
    by text. A null key sorts first; it has a place in a shard but no entry in the index. An empty
    table gives a store without shards. A task that runs again writes a new file; only files named
    by the written table of entries count.
    """
    folder = folder or fresh_folder(spark, "tokens")
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        coder = encoder(tokenizer)
        width = 2 if max(coder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        path = os.path.join(folder, f"shard-{shard:08d}-{uuid.uuid4().hex}.ids")
        out, at = None, 0
        for batch in batches:
            for part in slices(batch, "text"):
                coded = [ids + end for ids in coder.encode(part.column(1).to_pylist())]
                if out is None:
                    fs, plain = open_folder(path)
                    fs.create_dir(os.path.dirname(plain), recursive=True)
                    out = fs.open_output_stream(plain)
                    out.write(SHARD_MAGIC + width.to_bytes(8, "little"))
                for ids in coded:
                    out.write(np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes())
                sizes = np.array([len(ids) // 4 for ids in coded], dtype=np.int64)
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.full(n, shard, dtype=np.int32)),
                        pa.array([path] * n),
                        pa.array(at + np.cumsum(sizes) - sizes),
                        pa.array(sizes),
                    ],
                    names=["doc_id", "shard", "file", "start", "n_tokens"],
                )
                at += int(sizes.sum())
        if out is not None:
            out.close()

    ordered = id_and_text(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    entries = written(ordered.mapInArrow(run, ENTRIES), "token-entries")
    # One row per shard, so one task may order them.
    sums = entries.groupBy("shard", "file").agg(F.sum("n_tokens").alias("n_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = written(sums.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), "token-shards")

    keyed = entries.where("doc_id is not null").select("doc_id", "file", "start", "n_tokens")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries.count() // PART_KEYS))
    store = TokenStore(folder, parts, entries, shards)

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        write_file(index_path(folder, int(key[0])), *index_bytes(pdf))
        return pd.DataFrame({"part": [int(key[0])], "keys": [pdf["doc_id"].nunique()]})

    written(_with_part(keyed, parts).groupBy("part").applyInPandas(build, "part long, keys long"), "token-index")
    return store


def encode_and_read_back(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Writes a store, looks every key up in it and reads the ids: one row per document."""
    store = write_store(spark, docs, tokenizer, end_id)
    keyless = store.entries.where("doc_id is null").select("doc_id", "file", "start", "n_tokens")
    return store.read(store.lookup(docs).unionByName(keyless))
