"""FASTQ files as a Spark data source, for batches and streams.

``spark.dataSource.register(FastqSource)``, then ``spark.read.format("fastq")`` or
``spark.readStream.format("fastq")``.  Plain files and block-compressed ones are cut
into ranges of bytes that are read by themselves; other compressed files are one
partition each.  What is no record (a line with ``@``, one more, one with ``+``, one
more) is passed over, wherever a range begins, so the rows do not depend on the cuts.

A range begins at the first line after a line end in it and reads on until a record
begins after a line end beyond it, so every record belongs to one range.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import blake2b
from itertools import zip_longest

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from loamframe.functions.names import FASTQ_ENDINGS, PAIR_MARKS

SCHEMA = "file string, pos long, read_id string, seq string, qual string"
MATES = ", seq2 string, qual2 string"
#: Records to a batch, bytes read at once, and bytes of a file to a partition.
BATCH, READ, SPLIT = 10_000, 1 << 20, 64 << 20
#: How a block of a block-compressed file begins, and the mark of the field with its size (fixed values).
BLOCK, BLOCK_SIZE = b"\x1f\x8b\x08\x04", b"BC\x02\x00"
NOT_HERE = 1 << 62


@dataclass
class FastqPart(InputPartition):
    """A range of a file, or a whole one with the file of its mates."""

    path: str
    start: int = 0
    end: int = NOT_HERE
    blocks: bool = False
    last: bool = True
    mate: str = ""


def _system(path: str):  # noqa: ANN202
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def list_files(path: str) -> list[tuple[str, int]]:
    """(path, size) of the FASTQ files at or below a path, by name."""
    from pyarrow import fs

    system, base = _system(path)
    info = system.get_file_info(base)
    found = [info] if info.is_file else system.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
    scheme = path.split("://", 1)[0] if "://" in path else "file"
    return sorted((f"{scheme}://{f.path}", f.size) for f in found if f.is_file and (info.is_file or f.path.endswith(FASTQ_ENDINGS[:4])))


def pair_up(files: Iterable[str]) -> tuple[list[tuple[str, str]], list[str]]:
    """(first and second mates, files that are neither or whose mate is missing)."""
    names = set(files)
    pairs, used = [], set()
    for path in sorted(names):
        ending = next((e for e in FASTQ_ENDINGS if path.endswith(e)), "")
        stem = path.removesuffix(ending)
        for first, second in PAIR_MARKS:
            other = stem.removesuffix(first) + second + ending
            if stem.endswith(first) and other in names:
                pairs.append((path, other))
                used |= {path, other}
                break
    return pairs, sorted(names - used)


def _in_blocks(path: str) -> bool:
    system, base = _system(path)
    with system.open_input_file(base) as f:
        head = f.read(18)
    return head[:4] == BLOCK and BLOCK_SIZE in head


def split_file(path: str, size: int, split: int) -> list[FastqPart]:
    """Ranges of about ``split`` bytes where a file can be read from its middle."""
    blocks = path.endswith(".gz") and size > split and _in_blocks(path)
    if size <= split or (path.endswith(".gz") and not blocks):
        return [FastqPart(path)]
    cuts = [*range(0, size, split), NOT_HERE]
    return [FastqPart(path, a, b, blocks, b == NOT_HERE) for a, b in zip(cuts, cuts[1:], strict=False)]


def _plain_chunks(f, start: int) -> Iterator[tuple[int, bytes]]:  # noqa: ANN001
    f.seek(start)
    while data := f.read(READ):
        yield start, data
        start += len(data)


def _gzip_chunks(f) -> Iterator[tuple[int, bytes]]:  # noqa: ANN001
    import gzip

    at, whole = 0, gzip.GzipFile(fileobj=f)
    while data := whole.read(READ):
        yield at, data
        at += len(data)


def _block_at(data: bytes, i: int) -> int:
    """Size of the block that begins at ``i``; 0 if none does."""
    if data[i : i + 4] != BLOCK or len(data) < i + 18:
        return 0
    at = data.find(BLOCK_SIZE, i + 12, i + 12 + int.from_bytes(data[i + 10 : i + 12], "little"))
    return 0 if at < 0 else int.from_bytes(data[at + 4 : at + 6], "little") + 1


def _block_chunks(f, start: int) -> Iterator[tuple[int, bytes]]:  # noqa: ANN001
    """Unpacked blocks that begin at ``start`` or later, each with its offset times 2^16."""
    f.seek(start)
    held, base, found = b"", start, start == 0
    while True:
        data = f.read(READ)
        held += data
        i = 0
        while i < len(held):
            if not found:  # a block begins where the next one follows it, or the file ends
                i = held.find(BLOCK, i)
                if i < 0:
                    i = max(0, len(held) - 3)
                    break
            n = _block_at(held, i)
            if not found and n and i + n + 18 > len(held) and data:
                break
            if not found and not (n and (i + n == len(held) or _block_at(held, i + n))):
                i += 1
                continue
            if n and i + n > len(held) and data:
                break
            if not n or i + n > len(held):
                if data and len(held) - i < 1 << 16:
                    break
                raise ValueError("a block-compressed file is damaged")
            found = True
            yield (base + i) << 16, zlib.decompress(held[i : i + n], 31)
            i += n
        held, base = held[i:], base + i
        if not data:
            return


def _lines(chunks: Iterator[tuple[int, bytes]], skip: bool) -> Iterator[tuple[int, bytes]]:
    """(place of the line end before, line); with ``skip`` from the first line end on."""
    rest, place = b"", -1
    for base, data in chunks:
        at = 0
        while (end := data.find(b"\n", at)) >= 0:
            if not skip:
                yield place, rest + data[at:end]
            skip, rest, place, at = False, b"", base + end, end + 1
        rest += data[at:]
    if rest and not skip:
        yield place, rest


def records(part: FastqPart, path: str | None = None) -> Iterator[tuple[int, str, str, str]]:
    """(place, id, sequence, quality) of the records of a part; the id ends at the first blank."""
    system, base = _system(path or part.path)
    with system.open_input_file(base) as f:
        if part.blocks:
            chunks = _block_chunks(f, part.start)
        elif base.endswith(".gz"):
            chunks = _gzip_chunks(f)
        else:
            chunks = _plain_chunks(f, part.start)
        end = part.end << 16 if part.blocks and part.end != NOT_HERE else part.end
        four: deque[tuple[int, bytes]] = deque()
        for line in _lines(chunks, part.start > 0):
            four.append(line)
            if len(four) < 4:
                continue
            place, head = four[0]
            if place >= end:
                return
            if head[:1] == b"@" and four[2][1][:1] == b"+":
                text = [four.popleft()[1].removesuffix(b"\r").decode("latin-1") for _ in range(4)]
                yield place + 1, text[0][1:].split(" ", 1)[0], text[1], text[3]
            else:
                four.popleft()


def mates(part: FastqPart) -> Iterator[tuple]:
    """Records of both files in step; names must agree, but for a last ``/1`` and ``/2``, and so must their number."""
    for a, b in zip_longest(records(part), records(part, part.mate)):
        if a is None or b is None:
            raise ValueError(f"{part.path} and {part.mate} have different numbers of reads")
        if a[1].removesuffix("/1") != b[1].removesuffix("/2"):
            raise ValueError(f"{part.path} and {part.mate} differ: {a[1]} and {b[1]}")
        yield *a, b[2], b[3]


def read_part(part: FastqPart, paired: bool, ends: bool) -> Iterator[pa.RecordBatch]:
    names = ["file", "pos", "read_id", "seq", "qual", *["seq2", "qual2"] * paired]
    kinds = [pa.string(), pa.int64(), *[pa.string()] * (len(names) - 2)]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    held: list[tuple] = []
    for record in mates(part) if paired else records(part):
        held.append((part.path, *record))
        if len(held) == BATCH:
            yield batch(held)
            held = []
    if ends and part.last:
        held.append((part.path, NOT_HERE, *[None] * (len(names) - 2)))
    if held:
        yield batch(held)


class FastqOptions:
    """``path``; ``pairs``: rows have both mates; ``ends``: a row without ``read_id`` ends each file; ``split``: bytes to a partition."""

    def __init__(self, options: dict[str, str]) -> None:
        flag = lambda k: str(options.get(k, "false")).lower() == "true"
        self.path, self.pairs, self.ends, self.split = options["path"], flag("pairs"), flag("ends"), int(options.get("split", SPLIT))

    def ready(self, strict: bool) -> dict[str, list[FastqPart]]:
        """The parts of each file or pair, by the first file's path; a file without its mate is left or, if ``strict``, an error."""
        files = dict(list_files(self.path))
        if not self.pairs:
            return {path: split_file(path, size, self.split) for path, size in files.items()}
        pairs, alone = pair_up(files)
        if alone and strict:
            raise ValueError(f"no mate for {', '.join(alone[:5])}")
        return {a: [FastqPart(a, mate=b)] for a, b in pairs}

    def read(self, partition: FastqPart) -> Iterator[pa.RecordBatch]:
        yield from read_part(partition, self.pairs, self.ends)


class FastqReader(FastqOptions, DataSourceReader):
    def partitions(self) -> list[FastqPart]:
        return [p for parts in self.ready(True).values() for p in parts]


def _mark(path: str) -> str:
    return blake2b(path.encode(), digest_size=8).hexdigest()


class FastqStreamReader(FastqOptions, DataSourceStreamReader):
    """Files not yet taken, whatever their times; they must appear whole, by renaming.

    An offset holds 16 digits for every file of the folder that has been taken, so a
    file is read once however late or old it is.  Pairs wait for both mates.
    """

    def initialOffset(self) -> dict:  # noqa: N802
        return {"taken": ""}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"taken": "".join(sorted(_mark(p) for p in self.ready(False)))}

    def partitions(self, start: dict, end: dict) -> list[FastqPart]:
        old, new = ({o["taken"][i : i + 16] for i in range(0, len(o["taken"]), 16)} for o in (start, end))
        found = {_mark(p): parts for p, parts in self.ready(False).items()}
        gone = new - old - found.keys()
        if gone:
            raise FileNotFoundError(f"{len(gone)} files of a batch are gone from {self.path}")
        return [p for m in sorted(new - old) for p in found[m]]

    def commit(self, end: dict) -> None:
        """Nothing to give up: files stay where they are."""


class FastqSource(DataSource):
    """Options as in :class:`FastqOptions`; ``path`` is a file or a folder."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA + MATES * FastqOptions(dict(self.options)).pairs

    def reader(self, schema: StructType) -> FastqReader:
        return FastqReader(dict(self.options))

    def streamReader(self, schema: StructType) -> FastqStreamReader:  # noqa: N802
        return FastqStreamReader(dict(self.options))
