"""Token ids in length-delimited binary files with a separate offset index (operator 3).

A data file holds one record after another: the payload's length (unsigned 64-bit), a masked
checksum of those eight bytes, the payload, and a masked checksum of it, all little-endian. The
payload is a document's ids in 16 bits each, or 32 where the vocabulary needs them. The index file
beside it has four signed 64-bit numbers a record: document, whether it has an id, byte offset in
the data file, number of ids. A reader can so fetch any record alone, in any order.

Files are written in ascending doc_id order (null ids first, equal ids by a hash of the text), each under a name
of its own attempt and then moved into place, so a task that runs twice leaves one whole file. A
null text is an empty one, whose record holds the end id alone. Other columns are left behind.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opsignals.llm.common import shared_folder, slices, small_batches, table, tasks, texts, written
from opsignals.llm.tokens import library_memo, tokenizer_file

INDEX = np.dtype("<i8")
_MANIFEST = "part long, data string, index string, n_records long, n_tokens long, width int"


class TokenFiles(NamedTuple):
    """A folder of token files and its manifest: a row per file, in order of ``part``."""

    folder: str
    manifest: DataFrame


def masked(data: bytes) -> int:
    """CRC-32, rotated and shifted so that a checksum over data that hold checksums stays sound."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked(head)) + payload + struct.pack("<I", masked(payload))


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_token_files(docs: DataFrame, path: str, end_id: int, width: int = 2, folder: str | None = None) -> TokenFiles:
    """Encodes every whole text, appends ``end_id`` and writes records of ``width`` bytes an id."""
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or shared_folder(spark, "token-files")
    kind = {2: "<u2", 4: "<u4"}[width]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        memo, (store, top) = library_memo(path), _place(folder)
        store.create_dir(top, recursive=True)
        names = [f"{top}/part-{part:06d}.{suffix}" for suffix in ("bin", "idx")]
        drafts = [f"{n}.{attempt}" for n in names]
        offset = n_records = n_tokens = 0
        with store.open_output_stream(drafts[0]) as data, store.open_output_stream(drafts[1]) as index:
            for batch in slices(batches, "text"):
                flat, ends = memo.ids(batch.column("text"))
                if len(flat) and flat.max() >> 8 * width:
                    raise ValueError(f"an id needs more than {width} bytes")
                rows = []
                for doc, a, b in zip(batch.column("doc_id").to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    record = framed(np.append(flat[a:b], np.uint32(end_id)).astype(kind).tobytes())
                    rows.append((doc or 0, doc is not None, offset, b - a + 1))
                    offset += data.write(record)
                    n_tokens += b - a + 1
                index.write(np.array(rows, INDEX).tobytes())
                n_records += len(rows)
        if not n_records:
            for draft in drafts:
                store.delete_file(draft)
            return
        for draft, name in zip(drafts, names, strict=True):
            store.move(draft, name)
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "data": names[0], "index": names[1], "n_records": n_records, "n_tokens": n_tokens, "width": width}],
            schema=pa.schema([("part", pa.int64()), ("data", pa.string()), ("index", pa.string()), ("n_records", pa.int64()), ("n_tokens", pa.int64()), ("width", pa.int32())]),
        )

    # Bounds are drawn from samples of these keys, so a text is in them by its hash.
    by = [F.asc_nulls_first("doc_id"), F.xxhash64("text").asc()]
    made = texts(docs).repartitionByRange(tasks(spark), *by).sortWithinPartitions(*by).mapInArrow(write, _MANIFEST)
    return TokenFiles(folder, written(made, "token-manifest"))


def read_records(store: fs.FileSystem, data: str, index: str) -> Iterator[tuple[int | None, bytes]]:
    """Each record of a file by its index, checksums verified."""
    with store.open_input_stream(index) as rows, store.open_input_stream(data, buffer_size=1 << 20) as stream:
        while block := rows.read(32 * 4096):
            for doc, has_id, _, _ in np.frombuffer(block, INDEX).reshape(-1, 4).tolist():
                yield doc if has_id else None, _record(stream)


def read_record(store: fs.FileSystem, data: str, offset: int) -> bytes:
    """One record at an offset that the index gives."""
    with store.open_input_file(data) as stream:
        stream.seek(offset)
        return _record(stream)


def _record(stream) -> bytes:
    head = stream.read(12)
    size, check = struct.unpack("<QI", head)
    if check != masked(head[:8]):
        raise ValueError("a record's length is damaged")
    payload = stream.read(size)
    if struct.unpack("<I", stream.read(4))[0] != masked(payload):
        raise ValueError("a record is damaged")
    return payload


def read_token_files(files: TokenFiles) -> DataFrame:
    """doc_id, start (ids of all records before), n_tokens and ids (binary, 32-bit) of every record."""
    spark, folder = files.manifest.sparkSession, files.folder
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row per file
    placed = files.manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _place(folder)[0]
        for batch in batches:
            for file in batch.to_pylist():
                kind, start, held, size = {2: "<u2", 4: "<u4"}[file["width"]], file["base"], [], 0
                for doc, payload in read_records(store, file["data"], file["index"]):
                    ids = np.frombuffer(payload, kind).astype("<u4")
                    held.append((doc, start, len(ids), ids.tobytes()))
                    start, size = start + len(ids), size + len(ids)
                    if size > 1 << 21:
                        yield _rows(held)
                        held, size = [], 0
                if held:
                    yield _rows(held)

    return placed.repartitionByRange(tasks(spark), "part").mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def _rows(held: list[tuple]) -> pa.RecordBatch:
    kinds = {"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds.values())], list(kinds))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_token_files(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=0)
    return read_token_files(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
