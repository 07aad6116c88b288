"""Repeated passages across documents, by seeds that are extended both ways.

Seeds are winnowed anchors: every run of ``window`` words selects the least hash
of the short word runs inside it, so equal runs select equal anchors.  An
exchange of the anchors finds those that several documents share.  A shared seed
is extended to both sides: every run of ``window`` words around it is compared,
in a second exchange, with the least ``doc_id`` that has the same run.  Runs are
the same when two hashes of different families, 128 bits together, agree.  Runs that
also start in a document with a smaller id are repeats; overlapping ones join to
maximal repeats, and their words go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamframe.llm.exchange import Answers, Block, Message, exchange, places, read_blocks
from loamframe.llm.shared import discard, materialise, numbered, pinned, stable
from loamframe.llm.words import grams

WINDOW = 13
#: Words in a seed; a window holds ``window - seed + 1`` of them.
SEED = 6
#: Id of documents without one: not smaller than any.
LAST_ID = 2**63 - 1


def _anchors(h: np.ndarray, window: int, seed: int) -> np.ndarray:
    """The anchor of the window that starts at each word, as if rows had no borders."""
    g = grams(h, seed)
    n = len(h) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = g[:n].copy()
    for i in range(1, window - seed + 1):
        np.minimum(out, g[i : n + i], out=out)
    return out


def _starts(at: np.ndarray, n: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(whether a window starts at each of the first ``n`` words without leaving its row, row of each word)."""
    counts = np.diff(at)
    row = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(at[1:], counts) - np.arange(len(row))
    return (left >= window)[:n], row[:n]


class _Passes:
    """What each pass asks of a block."""

    def __init__(self, window: int, seed: int) -> None:
        self.window, self.seed = window, seed

    def windows(self, block: Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each slice: whether a window starts at a word, the word's row, the window's anchor."""
        for _, _, _, h, at in block.parts:
            a = _anchors(h, self.window, self.seed)
            ok, row = _starts(at, len(a), self.window)
            yield ok, row, a

    def anchors(self, block: Block) -> tuple[np.ndarray, np.ndarray, None]:
        """Distinct anchors of a block and in how many of its documents each lies."""
        own = []
        for ok, row, a in self.windows(block):
            r, v = row[ok], a[ok]
            by = np.lexsort((v, r))
            r, v = r[by], v[by]
            if len(v):
                new = np.concatenate([[True], (v[1:] != v[:-1]) | (r[1:] != r[:-1])])
                own.append(v[new])
        return (*np.unique(np.concatenate(own), return_counts=True), None) if own else (np.zeros(0, np.uint64), np.zeros(0, np.int64), None)

    def shared(self, block: Block, replies: Answers) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each slice: words where a window with a shared anchor starts, their rows in the block, the windows' two hashes."""
        keys, *_ = self.anchors(block)
        several = replies.of(block, keys) > 0
        base = 0
        out = []
        for (_, _, _, h, at), second, (ok, row, a) in zip(block.parts, block.checks, self.windows(block), strict=True):
            w = np.flatnonzero(ok)
            w = w[several[np.searchsorted(keys, a[w])]] if len(w) else w
            hashes = [grams(x, self.window)[w] if len(w) else np.zeros(0, np.uint64) for x in (h, second)]
            out.append((w, row[w] + base, *hashes))
            base += len(at) - 1
        return out

    def least_ids(self, found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct windows of a block: both hashes and the least document id that has each; for each window its place among them."""
        _, rows, first, second = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.uint64),) * 4
        own = ids[rows.astype(np.int64)]
        which, n = places(first, second)
        least = np.full(n, LAST_ID, np.int64)
        np.minimum.at(least, which, own)
        keys, checks = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        keys[which], checks[which] = first, second
        return keys, checks, least, which


def _ids(block: Block) -> np.ndarray:
    parts = [b.column("doc_id").slice(i, n).fill_null(LAST_ID).to_numpy() for b, i, n in block.rows]
    return np.concatenate(parts)


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, carry: tuple[str, ...] = (), texts: bool = True) -> DataFrame:
    """Remove each word inside a run of ``window`` words that also starts in a document with a smaller id.

    One row per row of ``docs``: ``rid``, ``doc_id``, ``n_words``, ``n_removed``,
    ``kept_sha256``, ``spans`` (maximal repeats as first and last word) and, with
    ``texts``, ``kept_text`` (kept words joined by one space); columns named by
    ``carry`` come along in the struct ``row``.

    Null, empty and wordless texts keep an empty text; an empty table gives an
    empty result.  A null ``doc_id`` is not smaller than any id; rows with the same
    id, repeated rows too, do not count against each other.  A very long text is a
    block of its own.  Columns of ``docs`` that are not named are ignored, whatever
    they are called.  Runs are judged on the input, not on what is left.
    """
    p = _Passes(window, seed)

    def several(n: int, which: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        return (np.bincount(which, weights=numbers, minlength=n) > 1)[which]

    def smaller_elsewhere(n: int, which: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        least = np.full(n, LAST_ID, np.int64)
        np.minimum.at(least, which, numbers)
        return least[which] < numbers

    def windows() -> Callable[[Block], Message]:
        replies = Answers(seeds)

        def message(block: Block) -> Message:
            keys, checks, least, _ = p.least_ids(p.shared(block, replies), _ids(block))
            return keys, least, checks

        return message

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = Answers(seeds), Answers(repeats)
        for block in read_blocks(batches, False, keep_bytes=True, check=True):
            ids = _ids(block)
            found = p.shared(block, first)
            keys, _, least, which = p.least_ids(found, ids)
            elsewhere = second.of(block, keys) > 0
            seen = 0
            for (data, starts, ends, h, at), (w, r, *_), (batch, i, n) in zip(block.parts, found, block.rows, strict=True):
                k = which[seen : seen + len(w)]
                seen += len(w)
                hit = w[elsewhere[k] | (least[k] < ids[r])] if len(w) else w
                cover = np.zeros(len(h) + 1, np.int64)
                cover[hit] += 1
                np.subtract.at(cover, hit + window, 1)
                gone = np.cumsum(cover[:-1]) > 0
                yield _rows(data, starts, ends, at, gone, batch, i, n)

    def _rows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, gone: np.ndarray, batch: pa.RecordBatch, i: int, n: int) -> pa.RecordBatch:
        counts = np.diff(at)
        row = np.repeat(np.arange(n), counts)
        kept = np.flatnonzero(~gone)
        joined = np.concatenate([[False], row[kept][1:] == row[kept][:-1]]) if len(kept) else np.zeros(0, bool)
        edge = np.zeros(len(data) + 1, np.int64)
        out = np.array(data)
        s, e = starts[kept], ends[kept]
        spaces = s[joined] - 1  # the byte before a word that is not its text's first is white space
        out[spaces] = 0x20
        np.add.at(edge, s - joined, 1)
        np.subtract.at(edge, e, 1)
        text = out[np.cumsum(edge[:-1]) > 0].tobytes()
        size = np.bincount(row[kept], weights=(e - s) + joined, minlength=n).astype(np.int64)
        cuts = np.concatenate([[0], np.cumsum(size)]).tolist()
        texts = [text[a:b].decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        removed = np.bincount(row[gone], minlength=n)
        turn = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
        spans: list[list[dict[str, int]]] = [[] for _ in range(n)]
        for a, b in zip(np.flatnonzero(turn == 1).tolist(), np.flatnonzero(turn == -1).tolist(), strict=True):
            while a < b:  # a run may cross from one row to the next
                stop = min(b, int(at[row[a] + 1]))
                spans[row[a]].append({"first": a - int(at[row[a]]), "last": stop - 1 - int(at[row[a]])})
                a = stop
        part = batch.slice(i, n)
        return pa.RecordBatch.from_pydict({
            "rid": part.column("rid"), "doc_id": part.column("doc_id"),
            "n_words": pa.array(counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "kept_text": pa.array(texts, pa.string()), "kept_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in texts],
            "spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
            "row": part.column("row"),
        })

    with pinned(docs.sparkSession):
        rows = numbered(stable(docs)).select("rid", F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct(F.lit(0).alias("_"), *[f"`{c}`" for c in carry]).alias("row"))
        seeds = exchange(rows.select("rid", "text"), lambda: p.anchors, several, lower=False)
        repeats = exchange(rows.select("rid", "doc_id", "text"), windows, smaller_elsewhere, lower=False, check=True)
        kind = rows.schema["row"].dataType.simpleString()
        schema = f"rid long, doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string, spans array<struct<first:int,last:int>>, row {kind}"
        wanted = ["rid", "doc_id", "n_words", "n_removed", "kept_sha256", "spans", *["kept_text"] * texts, *["row"] * bool(carry)]
        done = materialise(rows.mapInArrow(cut, schema).select(*wanted), "repeats")
    discard(docs.sparkSession, seeds, repeats)
    return done


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeats cut out of ``text``; texts without repeats stay as they are, ``n_chars`` follows.

    Rows stay, with all their columns; null, empty and long texts, repeated rows,
    null ids and empty tables as in :func:`remove_repeats`.
    """
    cut = remove_repeats(docs, carry=tuple(docs.columns))
    changed = F.col("n_removed") > 0
    made = {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("row.text")), "n_chars": None}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("row.n_chars"))
    return cut.select(*[made[c].alias(c) if c in made else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
