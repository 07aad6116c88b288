"""Exchanges of compressed hash sets between scan blocks and the owners of hash ranges.

A block is a run of documents of one scan partition with about
:data:`BLOCK_WORDS` words.  It ends after a document, wherever Arrow batches end:
passes that read other columns get other batches.  Each block sends its sorted distinct hashes, Golomb
coded, to the owners of their ranges, perhaps with a number and a second hash for
each; an owner combines what all blocks sent and answers every block with one byte for each of
its hashes.  Answers lie in the shared folder, by scan partition, where the next
pass over the same blocks reads them.  Texts never move.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamframe.llm import golomb
from loamframe.llm.shared import drop_shuffles, give_back, open_fs, partitions, scratch
from loamframe.llm.words import text_slices, word_hashes, words

#: Words in a block, about; a block ends with the document that reaches this.
BLOCK_WORDS = 1_000_000
#: Bytes of text in a block, about, however few words they hold.
BLOCK_BYTES = 1 << 26
#: ``rid`` holds the scan partition above these bits.
ROW_BITS = 33


@dataclass
class Block:
    """Documents of one block: word hashes of all, and where each document's words begin."""

    pid: int
    sub: int
    rows: list[tuple[pa.RecordBatch, int, int]] = field(default_factory=list)
    rid: list[np.ndarray] = field(default_factory=list)
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    checks: list[np.ndarray] = field(default_factory=list)
    size: int = 0
    bytes: int = 0


def read_blocks(batches: Iterator[pa.RecordBatch], lower: bool, keep_bytes: bool = False, check: bool = False) -> Iterator[Block]:
    """Cut a scan into blocks; the same documents always give the same blocks, however they are batched.

    ``parts`` of a block has (bytes, starts, ends, word hashes, first word of each
    row and the end) for each slice; bytes are kept only if asked.  With ``check``,
    ``checks`` has word hashes of a second family.
    What an earlier task left in the worker, and then each block, is given back.
    """
    give_back(caches=True)
    block = None
    none = np.zeros(0, np.int64)
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rid = batch.column("rid").to_numpy()
        for first, data, offs in text_slices(batch.column("text")):
            if block is None:
                block = Block(int(rid[0]) >> ROW_BITS, 0)
            starts, ends, h, at = words(data, offs, lower)
            second = word_hashes(data, starts, ends, lower, key=1) if check else None
            i, n = 0, len(offs) - 1
            while i < n:
                # the first document that fills the block, whichever slice it came in, is its last
                full = min(int(np.searchsorted(at[1:], at[i] + BLOCK_WORDS - block.size)), int(np.searchsorted(offs[1:], offs[i] + BLOCK_BYTES - block.bytes)))
                j = min(max(full, i) + 1, n)
                w, b = slice(int(at[i]), int(at[j])), int(offs[i])
                block.rows.append((batch, first + i, j - i))
                block.rid.append(rid[first + i : first + j])
                own = (data[b : offs[j]], starts[w] - b, ends[w] - b) if keep_bytes else (none, none, none)
                block.parts.append((*own, h[w], at[i : j + 1] - at[i]))
                if second is not None:
                    block.checks.append(second[w])
                block.size += w.stop - w.start
                block.bytes += int(offs[j]) - b
                i = j
                if block.size >= BLOCK_WORDS or block.bytes >= BLOCK_BYTES:
                    yield block
                    block = Block(block.pid, block.sub + 1)
                    give_back()
    if block is not None and block.rid:
        yield block
        block = None
    give_back()


#: Sorted hashes (ties only where second hashes differ), a number for each or none, a second hash for each or none.
Message = tuple[np.ndarray, np.ndarray | None, np.ndarray | None]


def _pack(x: np.ndarray | None) -> bytes | None:
    return None if x is None else zlib.compress(x.view("<i8").tobytes(), 1)


def _unpack(raws: pa.ChunkedArray) -> np.ndarray | None:
    if raws.null_count:
        return None
    return np.concatenate([np.frombuffer(zlib.decompress(x.as_py()), "<i8") for x in raws])


def exchange(
    rows: DataFrame,
    start: Callable[[], Callable[[Block], Message]],
    answer: Callable[[int, np.ndarray, np.ndarray], np.ndarray],
    lower: bool,
    check: bool = False,
) -> str:
    """Run one exchange over ``rows`` (``rid``, ``text``, ...); returns the path of the answers.

    ``start()`` is called once in each task and gives the function from a block to
    its message.  ``answer(n, which, numbers)`` gets the number of distinct hashes
    (pairs of hashes, where second ones were sent) an owner holds, for each sent
    one its place among them, and its number (1 without one); it returns a byte for
    each hash sent.
    """
    spark = rows.sparkSession
    owners = 4 * max(partitions(spark), rows.rdd.getNumPartitions())
    path = scratch(spark, "answers")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        message = start()
        for block in read_blocks(batches, lower, check=check):
            keys, numbers, seconds = message(block)
            own = ((keys >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)
            ids, at = np.unique(own, return_index=True)
            cuts = [*at.tolist(), len(keys)]
            spans = list(zip(cuts[:-1], cuts[1:], strict=True))
            part = lambda x, i, j: None if x is None else x[i:j]
            yield pa.RecordBatch.from_pydict({
                "owner": pa.array(ids, pa.int64()),
                "pid": pa.array([block.pid] * len(ids), pa.int32()), "sub": pa.array([block.sub] * len(ids), pa.int32()),
                "keys": pa.array([golomb.encode(keys[i:j]) for i, j in spans], pa.binary()),
                "numbers": pa.array([_pack(part(numbers, i, j)) for i, j in spans], pa.binary()),
                "seconds": pa.array([_pack(part(seconds, i, j)) for i, j in spans], pa.binary()),
            })

    def settle(table: pa.Table) -> pa.Table:
        keys = [golomb.decode(x.as_py()) for x in table.column("keys")]
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        sent = np.concatenate(keys)
        seconds = _unpack(table.column("seconds"))
        if seconds is None:
            values, which = np.unique(sent, return_inverse=True)
            n = len(values)
        else:
            which, n = places(sent, seconds)
        numbers = _unpack(table.column("numbers"))
        out = answer(n, which, np.ones(len(sent), np.int64) if numbers is None else numbers).astype(np.uint8)
        replies = [zlib.compress(x.tobytes(), 1) for x in np.split(out, cuts)]
        return pa.table({"pid": table.column("pid"), "sub": table.column("sub"), "owner": table.column("owner"), "reply": pa.array(replies, pa.binary())})

    sent = rows.mapInArrow(send, "owner long, pid int, sub int, keys binary, numbers binary, seconds binary")
    answers = sent.groupBy("owner").applyInArrow(settle, "pid int, sub int, owner long, reply binary")
    with drop_shuffles(spark):
        answers.repartition(F.col("pid")).write.partitionBy("pid").parquet(path)
    return path


def places(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, int]:
    """For each pair of hashes its place among the distinct pairs, in ascending order, and how many there are."""
    by = np.lexsort((second, first))
    a, b = first[by], second[by]
    which = np.empty(len(by), np.int64)
    which[by] = np.cumsum(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[: len(by)]) - 1
    return which, int(which.max(initial=-1)) + 1


class Answers:
    """Answers for the blocks of one scan partition, read once."""

    def __init__(self, path: str) -> None:
        self.path, self.pid, self.subs = path, -1, {}

    def of(self, block: Block, keys: np.ndarray) -> np.ndarray:
        """The byte for each of the hashes that ``block`` sent."""
        if self.pid != block.pid:
            import pyarrow.parquet as pq
            from pyarrow import fs as pafs

            fs, base = open_fs(f"{self.path}/pid={block.pid}")
            self.pid, self.subs = block.pid, {}
            names = [f.path for f in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True)) if f.path.endswith(".parquet")]
            for name in names:
                with fs.open_input_file(name) as f:
                    t = pq.read_table(f)
                for sub, owner, reply in zip(t["sub"].to_pylist(), t["owner"].to_pylist(), t["reply"].to_pylist(), strict=True):
                    self.subs.setdefault(sub, []).append((owner, reply))
        parts = [np.frombuffer(zlib.decompress(r), np.uint8) for _, r in sorted(self.subs.get(block.sub, []))]
        out = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        if len(out) != len(keys):
            raise RuntimeError(f"block {block.pid}.{block.sub} differs from the one that asked: {len(out)} answers for {len(keys)} hashes")
        return out
