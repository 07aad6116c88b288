"""Token files in frequency-ranked, byte-aligned variable-length coding.

A file holds documents in ascending ``doc_id`` order, in blocks.  A block ranks
its ids by frequency and stores each rank in 1 to 4 bytes; the byte counts lie
apart, four to a control byte, so a block is decoded by table lookups on whole
arrays.  The block's head keeps the rank table, document ids (a bit tells which are
null) and lengths.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamframe.llm.chunks import encoder
from loamframe.llm.shared import open_fs, partitions, scratch, text_or_empty

MAGIC = b"LTF1"
#: Ids in a block, about; a longer document is a block of its own.
BLOCK_IDS = 1 << 21
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64) + 1


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of an array of ranks below 2**32."""
    r = ranks.astype("<u4")
    code = (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    padded = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    padded[: len(r)] = code
    control = padded.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    used = np.arange(4, dtype=np.uint8) <= code[:, None]
    return control.astype(np.uint8).tobytes(), r.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ranks again: lengths by table lookup, then one gather for each byte place."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(lengths) - lengths
    d = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)])
    out = d[at].astype(np.uint32)
    for place in (1, 2, 3):
        longer = np.flatnonzero(lengths > place)
        if len(longer) == 0:
            break
        out[longer] |= d[at[longer] + place].astype(np.uint32) << np.uint32(8 * place)
    return out


def encode_block(doc_ids: np.ndarray, known: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    counts = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    table = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
    rank = np.zeros(len(counts), np.uint32)
    rank[table] = np.arange(len(table), dtype=np.uint32)
    control, data = encode_ranks(rank[ids]) if len(ids) else (b"", b"")
    parts = [table.astype("<u4").tobytes(), doc_ids.astype("<i8").tobytes(), np.packbits(known).tobytes(), lengths.astype("<i8").tobytes(), control, data]
    return struct.pack("<IQIQ", len(doc_ids), len(ids), len(table), len(data)) + b"".join(parts)


def decode_blocks(f: io.RawIOBase) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(doc ids, whether they are known, lengths, ids) of each block of an open file."""
    if f.read(4) != MAGIC:
        raise ValueError("not a token file")
    while head := f.read(24):
        docs, n, ranks, size = struct.unpack("<IQIQ", head)
        table = np.frombuffer(f.read(4 * ranks), "<u4")
        doc_ids = np.frombuffer(f.read(8 * docs), "<i8")
        known = np.unpackbits(np.frombuffer(f.read(-(-docs // 8)), np.uint8))[:docs].astype(bool)
        lengths = np.frombuffer(f.read(8 * docs), "<i8")
        control, data = f.read(-(-n // 4)), f.read(size)
        yield doc_ids, known, lengths, table[decode_ranks(control, data, n)]


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int, directory: str, files: int | None = None, special: bool = False) -> DataFrame:
    """Encode ``docs`` and write token files in ascending ``doc_id`` order.

    Returns the manifest: ``part``, ``path``, ``docs``, ``ids``, one row per file;
    ``part`` follows ``doc_id``.  Null texts count as empty, so every document has at
    least ``end_id``; a very long text is a block of its own.  Null ``doc_id`` come
    first; rows of equal or null ``doc_id`` keep the order of the scan and may be dealt
    to several files.  An empty table writes nothing; other columns are ignored.  With
    ``special``, strings of special tokens in a text give their ids.
    """
    spark = docs.sparkSession
    n = files or max(partitions(spark), docs.rdd.getNumPartitions())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("tie"), text_or_empty().alias("text"))
    dealt = rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(directory)
        enc = encoder(vocabulary, special)
        end = np.array([end_id], enc.dtype).tobytes()
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.tokens"
        out, total, docs_n = None, 0, 0
        held: list[bytes] = []
        held_ids: list[int | None] = []
        size = 0

        def flush() -> None:
            nonlocal held, held_ids, size
            if held:
                lengths = np.array([len(x) // enc.dtype.itemsize for x in held], np.int64)
                ids = np.array([x or 0 for x in held_ids], np.int64)
                known = np.array([x is not None for x in held_ids])
                out.write(encode_block(ids, known, lengths, np.frombuffer(b"".join(held), enc.dtype)))
            held, held_ids, size = [], [], 0

        for b in batches:
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), enc.encode_all(b.column("text").to_pylist()), strict=True):
                if out is None:
                    out = fs.open_output_stream(f"{base}/{name}")
                    out.write(MAGIC)
                held.append(ids + end)
                held_ids.append(doc_id)
                k = len(ids) // enc.dtype.itemsize + 1
                size, total, docs_n = size + k, total + k, docs_n + 1
                if size >= BLOCK_IDS:
                    flush()
        if out is not None:
            flush()
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [f"{directory}/{name}"], "docs": [docs_n], "ids": [total]})

    fs, base = open_fs(directory)
    fs.create_dir(base)
    written = dealt.mapInArrow(write, "part int, path string, docs long, ids long").collect()  # a row a file
    return spark.createDataFrame(written, "part int, path string, docs long, ids long")


def read_token_files(spark: SparkSession, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Documents of token files: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens``, ``ids_crc32`` and, if asked, ``ids``.

    The manifest has one row per file; only its totals are added up on the driver.
    """
    files, start = [], 0
    for r in sorted(manifest.collect(), key=lambda r: r.part):
        files.append((r.path, start))
        start += r.ids
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    if not files:
        return spark.createDataFrame([], schema)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, at in zip(b["path"], b["start"].tolist(), strict=True):
                fs, local = open_fs(path)
                with fs.open_input_stream(local) as f:
                    for doc_ids, known, lengths, ids in decode_blocks(f):
                        ends = np.cumsum(lengths)
                        starts = ends - lengths
                        raw = memoryview(ids.astype("<u4").tobytes())
                        out = pd.DataFrame({"doc_id": doc_ids, "start": at + starts, "n_tokens": lengths})
                        out["ids_crc32"] = [zlib.crc32(raw[4 * i : 4 * j]) for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
                        if with_ids:
                            out["ids"] = [ids[i:j].astype(np.int64) for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
                        out["doc_id"] = out["doc_id"].astype("Int64").mask(~known)
                        at += len(ids)
                        yield out

    rows = spark.createDataFrame(files, "path string, start long").repartition(len(files))
    return rows.mapInPandas(read, schema)


def store_tokens(docs: DataFrame, vocabulary: str, end_id: int, directory: str | None = None, special: bool = False) -> DataFrame:
    """Write ``docs`` as token files and read every document back from them.

    Odd rows as in :func:`write_token_files`; the files stay, they are the output.
    """
    spark = docs.sparkSession
    manifest = write_token_files(docs, vocabulary, end_id, directory or scratch(spark, "tokens"), special=special)
    return read_token_files(spark, manifest)
