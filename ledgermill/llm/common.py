"""Helpers that several operators of this package share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.session import shared_folder


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends the library to the executors, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgermill-"), "ledgermill.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in sorted(os.walk(package)):
            for name in sorted(names):
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    out.write(file, os.path.relpath(file, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and whole ``text`` (null: empty); every other column is left out."""
    ship_package(docs.sparkSession)
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder, for files that tasks write themselves."""
    return os.path.join(shared_folder(spark), "files", f"{name}-{uuid.uuid4().hex}")


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and plain path of a folder or file that all executors reach."""
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    if path.startswith("file:"):
        path = path[len("file:") :]
    return pafs.LocalFileSystem(), path


def write_file(path: str, *chunks: bytes) -> None:
    """Writes a whole file under a name of its own, then moves it into place."""
    fs, plain = open_folder(path)
    fs.create_dir(os.path.dirname(plain), recursive=True)
    draft = f"{plain}.{uuid.uuid4().hex}"
    with fs.open_output_stream(draft) as out:
        for chunk in chunks:
            out.write(chunk)
    fs.move(draft, plain)


def read_file(path: str) -> pa.Buffer:
    fs, plain = open_folder(path)
    with fs.open_input_file(plain) as source:
        return source.read_buffer()


def slices(batch: pa.RecordBatch, text: str, chars: int = 2_000_000):
    """Cuts a batch into runs of rows that hold about ``chars`` bytes of text, or one long text."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_pylist()
    first, held = 0, 0
    for row, size in enumerate(sizes):
        if held and held + size > chars:
            yield batch.slice(first, row - first)
            first, held = row, 0
        held += size
    if first < batch.num_rows:
        yield batch.slice(first)
