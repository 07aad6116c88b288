"""Token counts from flat token files without an index.

A token file is nothing but ids, each document closed by an end id.  Files are
read in blocks of equal size; each block finds its end ids in one vectorised
comparison.  A prefix scan over the blocks of a file (how many documents ended
before, and where the last one did) stitches documents that cross blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamframe.llm.chunks import encoder
from loamframe.llm.shared import materialise, open_fs, scratch, text_or_empty

#: Ids read at once by a scan task.
BLOCK_IDS = 1 << 20


def write_flat_files(docs: DataFrame, vocabulary: str, end_id: int, directory: str) -> DataFrame:
    """Encode each scan partition to one flat file of little-endian ids.

    Returns which document is which in each file: ``file``, ``ordinal``,
    ``doc_id``.  Null texts count as empty and hold the end id alone.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_fs(directory)
        enc = encoder(vocabulary)
        end = np.array([end_id], enc.dtype).tobytes()
        name, out, n = f"{uuid.uuid4().hex}.ids", None, 0
        for b in batches:
            if b.num_rows == 0:
                continue
            out = out or fs.open_output_stream(f"{base}/{name}")
            for ids in enc.encode_all(b.column("text").to_pylist()):
                out.write(ids)
                out.write(end)
            yield pa.RecordBatch.from_pydict({"file": [name] * b.num_rows, "ordinal": pa.array(np.arange(n, n + b.num_rows)), "doc_id": b.column("doc_id")})
            n += b.num_rows
        if out is not None:
            out.close()

    fs, base = open_fs(directory)
    fs.create_dir(base)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return materialise(rows.mapInArrow(write, "file string, ordinal long, doc_id long"), "ordinals")


def count_tokens(files: DataFrame, directory: str, end_id: int, dtype: str = "<u2", block_ids: int = BLOCK_IDS) -> DataFrame:
    """Documents of flat token files: ``file``, ``ordinal``, ``start``, ``n_tokens`` (without the end id).

    ``files`` has a ``file`` column.  Ids after the last end id of a file belong
    to no document.  Empty files give no rows.
    """
    width = np.dtype(dtype).itemsize

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = open_fs(directory)
        for b in batches:
            for file in b["file"]:
                ids = fs.get_file_info(f"{base}/{file}").size // width
                k = np.arange(-(-ids // block_ids), dtype=np.int64)
                yield pd.DataFrame({"file": file, "block": k})

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = open_fs(directory)
        for b in batches:
            rows = []
            for file, block in zip(b["file"], b["block"].tolist(), strict=True):
                with fs.open_input_file(f"{base}/{file}") as f:
                    f.seek(block * block_ids * width)
                    ids = np.frombuffer(f.read(block_ids * width), dtype)
                ends = np.flatnonzero(ids == end_id)
                last = block * block_ids + int(ends[-1]) if len(ends) else None
                rows.append((file, block, len(ends), last, ends.astype("<u4").tobytes()))
            yield pd.DataFrame(rows, columns=["file", "block", "n", "last_end", "ends"]).astype({"last_end": "Int64"})

    def stitch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, block, raw, before, prev in zip(b["file"], b["block"].tolist(), b["ends"], b["before"].tolist(), b["prev_end"].tolist(), strict=True):
                ends = np.frombuffer(raw, "<u4").astype(np.int64) + block * block_ids
                starts = np.concatenate([[prev], ends[:-1]]) + 1
                yield pd.DataFrame({"file": file, "ordinal": before + np.arange(len(ends)), "start": starts, "n_tokens": ends - starts})

    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    found = (
        files.select("file").distinct().mapInPandas(blocks, "file string, block long")
        .repartition("file", "block").mapInPandas(scan, "file string, block long, n long, last_end long, ends binary")
    )
    placed = found.select(
        "file", "block", "ends", "n",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.max("last_end").over(earlier), F.lit(-1)).alias("prev_end"),
    ).where("n > 0")
    return placed.mapInPandas(stitch, "file string, ordinal long, start long, n_tokens long")


def document_token_counts(docs: DataFrame, vocabulary: str, end_id: int, directory: str | None = None) -> DataFrame:
    """Tokens of each document, counted from flat token files.

    One row per row of ``docs``: ``doc_id``, ``file``, ``start`` (ids before it in
    its file), ``n_tokens`` (without the end id).  Null and empty texts have 0
    tokens; very long ones cross blocks; repeated rows and null ``doc_id`` are rows
    like any other; an empty table gives no rows; other columns are ignored.
    """
    directory = directory or scratch(docs.sparkSession, "flat")
    ordinals = write_flat_files(docs, vocabulary, end_id, directory)
    counts = count_tokens(ordinals.where("ordinal = 0"), directory, end_id, encoder(vocabulary).dtype.str)
    # both sides have a row a document; file names compress too well to be judged by size
    return ordinals.join(counts.hint("merge"), ["file", "ordinal"]).select("doc_id", "file", "start", "n_tokens")
