"""Byte-level BPE in DuckDB: recursive queries contract words, one aggregation decodes.

Inside a partition each distinct word is a set of (word, position, token) rows.
A recursive query joins neighbours with the merge table and contracts, in every
word at once, the leftmost pair of least rank, until no pair is left.  Long words
contract all pairs of their least rank that do not touch in one round.  That is the
same where every token's own bytes contract to it, as in any vocabulary made by
merging: then no pair that holds a new token can rank before the token.  Decoding
joins ids with the vocabulary and concatenates bytes in order of position.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamframe.llm.chunks import SEGMENT, byte_level_chunk, byte_level_keys, segments
from loamframe.llm.shared import text_or_empty

#: Chunks that one worker remembers; when full they become the older memory, of which what is met again is kept.
CACHE_CHUNKS = 300_000
#: Bytes of new words contracted by one query, and ids decoded by one.
WORD_BYTES, DECODE_IDS = 1 << 18, 1 << 19
#: Longer words contract many pairs a round, and keep their present state instead of a history.
LONG_WORD = 64
MEMORY = "250MB"

_CONTRACT = """
WITH RECURSIVE s(step, w, pos, tok) AS (
  SELECT 0, w, pos, tok FROM init
  UNION ALL
  SELECT step + 1, w, pos, CASE WHEN pos = spot THEN k ELSE tok END FROM (
    WITH pairs AS (
      SELECT step, w, pos, tok, lead(tok) OVER x AS next_tok, lag(pos) OVER x AS prev_pos FROM s WINDOW x AS (PARTITION BY w ORDER BY pos)
    ), ranked AS (
      SELECT pairs.*, merges.k FROM pairs LEFT JOIN merges ON merges.l = tok AND merges.r = next_tok
    ), best AS (
      SELECT w, min(k::BIGINT * 4294967296 + pos) % 4294967296 AS spot FROM ranked WHERE k IS NOT NULL GROUP BY w
    )
    SELECT ranked.*, best.spot FROM ranked JOIN best USING (w)
  ) WHERE prev_pos IS DISTINCT FROM spot
), done AS (SELECT w, max(step) AS step FROM s GROUP BY w)
SELECT w, tok FROM s JOIN done USING (w, step) ORDER BY w, pos
"""

_CONTRACT_LONG = """
WITH RECURSIVE s(w, pos, tok) USING KEY (w, pos) AS (
  SELECT w, pos, tok FROM init
  UNION ALL
  SELECT w, pos, CASE WHEN run % 2 = 0 THEN k ELSE -1 END FROM (
    WITH pairs AS (
      SELECT w, pos, tok, lead(tok) OVER x AS next_tok, row_number() OVER x AS i FROM recurring.s WHERE tok >= 0 WINDOW x AS (PARTITION BY w ORDER BY pos)
    ), ranked AS (
      SELECT pairs.*, merges.k FROM pairs LEFT JOIN merges ON merges.l = tok AND merges.r = next_tok
    ), best AS (
      SELECT w, min(k) AS m FROM ranked GROUP BY w HAVING min(k) IS NOT NULL
    )  -- run: how many pairs of least rank come right before; every second of a run is taken
    SELECT ranked.*, m, i - 1 - coalesce(max(CASE WHEN k IS DISTINCT FROM m THEN i END) OVER (PARTITION BY w ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM ranked JOIN best USING (w)
  ) WHERE run % 2 = 1 OR k = m
)
SELECT w, tok FROM s WHERE tok >= 0 ORDER BY w, pos
"""

_DECODE = """
SELECT doc, string_agg(bytes, '' ORDER BY pos) AS text FROM ids JOIN vocabulary USING (tok) GROUP BY doc
"""


class DuckBpe:
    """Encoder and decoder of one worker."""

    def __init__(self, path: str, pattern: str) -> None:
        import duckdb

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        splits = [(self.ranks[t[:i]], self.ranks[t[i:]], k) for t, k in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        left, right, rank = (pa.array(x, pa.int32()) for x in zip(*splits, strict=True))
        self.db = duckdb.connect()
        self.db.execute(f"SET threads = 1; SET memory_limit = '{MEMORY}'")
        self.db.register("merges_in", pa.table({"l": left, "r": right, "k": rank}))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges_in")
        self.db.register("vocabulary_in", pa.table({"tok": pa.array(list(self.ranks.values()), pa.int32()), "bytes": [t.decode("latin-1") for t in self.ranks]}))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary_in")
        self.db.unregister("merges_in")
        self.db.unregister("vocabulary_in")
        self.chunks: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _contract(self, words: list[bytes], query: str) -> list[bytes]:
        """Ids (little-endian, 32 bits) of each word."""
        out: list[bytes] = []
        at = 0
        while at < len(words):
            end, size = at, 0
            while end < len(words) and size < WORD_BYTES:
                size += len(words[end])
                end += 1
            part = words[at:end]
            lengths = np.array([len(w) for w in part])
            starts = np.cumsum(lengths) - lengths
            data = np.frombuffer(b"".join(part), np.uint8)
            w = np.repeat(np.arange(len(part), dtype=np.int32), lengths)
            pos = (np.arange(len(data)) - np.repeat(starts, lengths)).astype(np.int32)
            self.db.register("init", pa.table({"w": w, "pos": pos, "tok": self.byte[data]}))
            got = self.db.execute(query).fetchnumpy()
            self.db.unregister("init")
            tok = np.asarray(got["tok"]).astype("<u4")
            cuts = np.searchsorted(np.asarray(got["w"]), np.arange(len(part) + 1))
            raw = tok.tobytes()
            out += [raw[4 * i : 4 * j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            at = end
        return out

    def _learn(self, missing: list[str], plain: bool) -> None:
        older = self.older
        again = {k: older[k] for k in missing if k in older}
        if len(self.chunks) + len(missing) > CACHE_CHUNKS:
            self.older, self.chunks = self.chunks, {}
        self.chunks.update(again)
        missing = [k for k in missing if k not in again]
        cut = [[w.encode() for w in self.pattern.findall(c if plain else byte_level_chunk(c))] for c in missing]
        known: dict[bytes, bytes] = {}
        todo = []
        for w in {w for ws in cut for w in ws}:
            if w in self.ranks:
                known[w] = np.array([self.ranks[w]], "<u4").tobytes()
            else:
                todo.append(w)
        todo.sort(key=len)
        short = sum(len(w) <= LONG_WORD for w in todo)
        for part, query in ((todo[:short], _CONTRACT), (todo[short:], _CONTRACT_LONG)):
            known.update(zip(part, self._contract(part, query), strict=True))
        for c, ws in zip(missing, cut, strict=True):
            self.chunks[c] = b"".join([known[w] for w in ws])

    def encode_group(self, texts: list[str]) -> list[bytes]:
        cut = [byte_level_keys(t) for t in texts]
        unsafe = [i for i, keys in enumerate(cut) if keys is None]
        get = self.chunks.get
        found = [None if keys is None else list(map(get, keys)) for keys in cut]
        missing = {k for keys, ids in zip(cut, found, strict=True) if ids is not None and None in ids for k, i in zip(keys, ids, strict=True) if i is None}
        if missing:
            self._learn(list(missing), plain=False)
        fresh = self.chunks
        out = [b"" if ids is None else b"".join([fresh[k] if i is None else i for k, i in zip(keys, ids, strict=True)]) for keys, ids in zip(cut, found, strict=True)]
        for i in unsafe:
            words = self.pattern.findall(texts[i])
            own = self.chunks
            new = [w for w in set(words) if "\r" + w not in own]
            if new:
                self._learn(["\r" + w for w in new], plain=False)
            out[i] = b"".join([self.chunks["\r" + w] if "\r" + w in self.chunks else own["\r" + w] for w in words])
        return out

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        at = 0
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and (end == at or size + len(texts[end]) <= SEGMENT):
                size += len(texts[end])
                end += 1
            if size > 2 * SEGMENT and byte_level_keys(texts[at]) is not None:
                yield b"".join(self.encode_group([s])[0] for s in segments(texts[at]))
            else:
                yield from self.encode_group(texts[at:end])
            at = end

    def decode_all(self, ids: list[bytes]) -> list[bytes]:
        """Bytes of each list of ids, in groups of about :data:`DECODE_IDS`; a longer list goes in parts."""
        pieces = [(d, x[i : i + 4 * DECODE_IDS]) for d, x in enumerate(ids) for i in range(0, len(x), 4 * DECODE_IDS)]
        out: list[list[bytes]] = [[] for _ in ids]
        at = 0
        while at < len(pieces):
            end, size = at, 0
            while end < len(pieces) and (end == at or size + len(pieces[end][1]) <= 4 * DECODE_IDS):
                size += len(pieces[end][1])
                end += 1
            part = pieces[at:end]
            lengths = np.array([len(x) // 4 for _, x in part])
            tok = np.frombuffer(b"".join(x for _, x in part), "<u4").astype(np.int32)
            doc = np.repeat(np.arange(len(part), dtype=np.int32), lengths)
            self.db.register("ids", pa.table({"doc": doc, "pos": np.arange(len(tok), dtype=np.int32), "tok": tok}))
            for k, text in self.db.execute(_DECODE).fetchall():
                out[part[k][0]].append(text.encode("latin-1"))
            self.db.unregister("ids")
            at = end
        return [b"".join(x) for x in out]


_workers: dict[str, DuckBpe] = {}


def worker(path: str, pattern: str) -> DuckBpe:
    if path not in _workers:
        _workers[path] = DuckBpe(path, pattern)
    return _workers[path]


def bpe_encode_decode(docs: DataFrame, ranks_path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """Encode every text and decode its ids again.

    One row per row of ``docs``: ``doc_id``, ``n_tokens``, ``ids_sha256``,
    ``decoded_sha256`` and, with ``keep_ids``, ``ids`` and ``decoded``.  Null and
    empty texts have no ids; very long ones are cut where the pattern cuts.  Repeated
    rows and null ids are kept; an empty table gives an empty result; other columns
    are ignored.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded binary" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker(ranks_path, pattern)
        for b in batches:
            texts = b.column("text").to_pylist()
            at = 0
            while at < len(texts):
                size, end = 0, at
                while end < len(texts) and (end == at or size + len(texts[end]) <= SEGMENT):
                    size += len(texts[end])
                    end += 1
                ids = list(bpe.encode_all(texts[at:end]))
                decoded = bpe.decode_all(ids)
                out = {
                    "doc_id": b.column("doc_id").slice(at, end - at), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                    "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids], "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in decoded],
                }
                if keep_ids:
                    out |= {"ids": pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.binary())}
                yield pa.RecordBatch.from_pydict(out)
                at = end

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, schema)
