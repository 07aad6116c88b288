"""Spelling variants: words one edit apart, found with k-d trees over letter counts.

One inserted, deleted or replaced letter moves a word's vector of letter counts by an L1
distance of one or two, so near words lie in a small ball.  For every length a k-d tree
cuts the space of vectors into cells.  Its cuts come from a bounded sample of words and
decide only how work is dealt: every word is a point of its cell, and a query of every
cell whose box its ball meets, in the tree of its own length (a letter replaced) and in
that of the next (a letter inserted).  A cell is one task's work: there a tree with tight
boxes prunes again and the order of letters is verified.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamframe.llm.shared import discard, give_back, materialise, salted_join, settings, text_or_empty

#: Words to a cell, aimed at; a cell with many more is dealt to several tasks.
CELL = 2_000
#: Words of the sample that the trees' cuts come from; it bounds what the driver holds.
SAMPLE = 100_000
#: Words of a leaf inside a task, and bytes compared at once.
LEAF, BYTES = 12, 1 << 22
#: Words held by a scan block before they are sent on.
HELD = 400_000
DIMENSIONS = 32

#: Latin-1 bytes as they count: A-Z lower-cased, other letters kept, all else a blank.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
#: The dimension of each letter: one for each of a-z, the others share six.
_PLACE = np.array([b - 97 if 97 <= b <= 122 else 26 + b % 6 for b in range(256)])


def damaged(doc: bytes, run: bytes) -> bytes:
    """``run`` (Latin-1) without the letter that the checksum of ``doc`` and the run picks, for one in 97."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), zlib.crc32(doc))
    if h % 97:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[bytes] = Counter()

    def sent() -> Iterator[pa.RecordBatch]:
        words = list(held)
        for i in range(0, len(words), 50_000):
            part = words[i : i + 50_000]
            yield pa.RecordBatch.from_pydict({"word": pa.array([w.decode("latin-1") for w in part], pa.string()), "n": pa.array([held[w] for w in part], pa.int64())})
        held.clear()

    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            head = b"%s:" % ("" if doc is None else str(doc)).encode()
            # what Latin-1 lacks becomes a question mark, which is no letter either
            for run, n in Counter(text.encode("latin-1", "replace").translate(LETTERS).split()).items():
                word = damaged(head, run)
                if len(word) >= 5:
                    held[word] += n
        if len(held) > HELD:
            yield from sent()
    yield from sent()
    give_back()


def word_counts(docs: DataFrame, least: int = 3) -> DataFrame:
    """``word`` and ``n`` for words of five letters and more that occur ``least`` times."""
    counted = docs.select(F.col("doc_id"), text_or_empty().alias("text")).mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def letters(words: list[bytes]) -> np.ndarray:
    """Letters of words of one length, a row each."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1) if words else np.zeros((0, 0), np.uint8)


def vectors(rows: np.ndarray) -> np.ndarray:
    """Letter counts, at most 100 each, which brings no two words further apart."""
    n = len(rows)
    out = np.zeros(n * DIMENSIONS, np.int64)
    for i in range(0, n, max(1, BYTES // max(1, rows.shape[1]))):
        part = rows[i : i + max(1, BYTES // max(1, rows.shape[1]))]
        at = (np.arange(i, i + len(part))[:, None] * DIMENSIONS + _PLACE[part]).ravel()
        out += np.bincount(at, minlength=len(out))
    return np.minimum(out, 100).reshape(n, DIMENSIONS).astype(np.int8)


@dataclass
class Tree:
    """Nodes in order of their making: children (-1: a leaf), boxes, and the points of leaves."""

    low: np.ndarray
    high: np.ndarray
    left: np.ndarray
    right: np.ndarray
    first: np.ndarray
    last: np.ndarray
    order: np.ndarray

    def leaves(self) -> np.ndarray:
        return np.flatnonzero(self.left < 0)


def build(points: np.ndarray, leaf: int, tight: bool) -> Tree:
    """A k-d tree cut at medians of the widest dimension; boxes are ``tight`` around the points or fill space."""
    order = np.arange(len(points))
    nodes: list[list] = []

    def add(first: int, last: int, low: np.ndarray, high: np.ndarray) -> int:
        if tight and last > first:
            own = points[order[first:last]]
            low, high = own.min(0), own.max(0)
        nodes.append([low, high, -1, -1, first, last])
        return len(nodes) - 1

    todo = [add(0, len(points), np.zeros(DIMENSIONS, np.int8), np.full(DIMENSIONS, 100, np.int8))]
    while todo:
        k = todo.pop()
        low, high, _, _, first, last = nodes[k]
        if last - first <= leaf:
            continue
        own = points[order[first:last]].astype(np.int16)
        # the dimension and value that part the points most evenly
        middle = np.median(own, axis=0).astype(np.int16)
        below, upto = (own < middle).sum(0), (own <= middle).sum(0)
        half = (last - first) / 2
        miss = np.minimum(np.abs(below - half), np.abs(upto - half))
        d = int(np.argmin(miss))
        cut = int(middle[d]) - 1 if abs(below[d] - half) <= abs(upto[d] - half) else int(middle[d])
        goes = own[:, d] <= cut
        if goes.all() or not goes.any():
            continue  # all alike
        part = order[first:last]
        order[first:last] = np.concatenate([part[goes], part[~goes]])
        mid = first + int(goes.sum())
        upper, lower = high.copy(), low.copy()
        upper[d], lower[d] = cut, cut + 1
        nodes[k][2], nodes[k][3] = add(first, mid, low, upper), add(mid, last, lower, high)
        todo += nodes[k][2:4]
    columns = list(zip(*nodes, strict=True))
    return Tree(np.array(columns[0]), np.array(columns[1]), *(np.array(c) for c in columns[2:6]), order)


def meets(tree: Tree, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, leaf) pairs whose box lies within an L1 distance of ``radius``."""
    todo = [(np.arange(len(queries)), np.zeros(len(queries), np.int64))]
    size = BYTES // DIMENSIONS
    while todo:
        q, node = todo.pop()
        if len(q) > size:
            todo += [(q[i : i + size], node[i : i + size]) for i in range(0, len(q), size)]
            continue
        x = queries[q]
        away = np.maximum(tree.low[node] - x, 0).sum(1, dtype=np.int16) + np.maximum(x - tree.high[node], 0).sum(1, dtype=np.int16)
        near = away <= radius
        q, node = q[near], node[near]
        leaf = tree.left[node] < 0
        if leaf.any():
            yield q[leaf], node[leaf]
        q, node = q[~leaf], node[~leaf]
        if len(q):
            todo.append((np.concatenate([q, q]), np.concatenate([tree.left[node], tree.right[node]])))


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters are one replaced letter apart, or one inserted where ``b`` is longer by one."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    start = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(1)
    end = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return start + end >= a.shape[1]


def near_pairs(points: list[bytes], queries: list[bytes], same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, point) numbers of words one edit apart; all points have one length, queries that or one less."""
    if not points or not queries:
        return
    p, q = letters(points), letters(queries)
    pv, qv = vectors(p), vectors(q)
    radius = 2 if same else 1
    tree = build(pv, LEAF, tight=True)
    for ask, leaf in meets(tree, qv, radius):
        many = tree.last[leaf] - tree.first[leaf]
        ends = np.cumsum(many)
        width = max(DIMENSIONS, p.shape[1])
        cuts = np.unique(np.searchsorted(ends, np.arange(0, int(ends[-1]) if len(ends) else 0, max(1, BYTES // width))))
        for i, j in zip(cuts, [*cuts[1:], len(leaf)], strict=True):
            m = many[i:j]
            place = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
            a = np.repeat(ask[i:j], m)
            b = tree.order[np.repeat(tree.first[leaf[i:j]], m) + place]
            close = np.abs(qv[a] - pv[b]).sum(1, dtype=np.int16) <= radius
            a, b = a[close], b[close]
            good = one_edit(q[a], p[b])
            if good.any():
                yield a[good], b[good]


def _route(trees: dict[int, Tree], parts: dict[tuple[int, int], int]):  # noqa: ANN202
    """Rows (length, cell, part, word, n, role) for each word: one as a point, one a cell its balls meet."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            counts = batch.column("n").to_numpy()
            by: dict[int, list[int]] = {}
            for i, w in enumerate(words):
                by.setdefault(len(w), []).append(i)
            for size, rows in by.items():
                at = np.array(rows)
                x = vectors(letters([words[i] for i in rows]))
                for length, radius, role in ((size, 0, 0), (size, 2, 1), (size + 1, 1, 2)):
                    if length not in trees:
                        continue
                    for ask, leaf in meets(trees[length], x, radius):
                        # a point lies in one cell; a cell cut in parts gets the query once a part
                        split = np.array([parts.get((length, int(k)), 1) for k in leaf])
                        if role == 0:
                            chosen = np.array([zlib.crc32(words[at[i]]) for i in ask], np.int64) % split
                        else:
                            ask, leaf = np.repeat(ask, split), np.repeat(leaf, split)
                            chosen = np.arange(len(ask)) - np.repeat(np.cumsum(split) - split, split)
                        got = at[ask]
                        columns = {
                            "length": pa.array(np.full(len(got), length), pa.int32()), "cell": pa.array(leaf, pa.int32()), "part": pa.array(chosen, pa.int32()),
                            "word": pa.array([words[i].decode("latin-1") for i in got], pa.string()), "n": pa.array(counts[got], pa.int64()), "role": pa.array(np.full(len(got), role), pa.int32()),
                        }
                        yield pa.RecordBatch.from_pydict(columns)

    return route


ROUTED = "length int, cell int, part int, word string, n long, role int"
NEAR = "word string, near string, near_n long"


def _search(group: pa.Table) -> pa.Table:
    words = [w.encode("latin-1") for w in group.column("word").to_pylist()]
    counts, role = group.column("n").to_numpy(), group.column("role").to_numpy()
    own = np.flatnonzero(role == 0)
    a, b = [], []
    for kind in (1, 2):
        asks = np.flatnonzero(role == kind)
        for q, p in near_pairs([words[i] for i in own], [words[i] for i in asks], kind == 1):
            x, y = asks[q], own[p]
            a += [x] if kind == 1 else [x, y]  # the longer word is no query in this tree
            b += [y] if kind == 1 else [y, x]
    left, right = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (a, b))
    text = lambda z: pa.array([words[i].decode("latin-1") for i in z], pa.string())
    return pa.table({"word": text(left), "near": text(right), "near_n": pa.array(counts[right], pa.int64())})


def cells_of(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> tuple[dict[int, Tree], dict[tuple[int, int], int]]:
    """(a tree of cells for each length, how many parts each crowded cell is cut into).

    The trees grow on about ``sample`` words, those of least hash (all, if there are
    fewer), with leaves that hold about ``cell`` of all words.
    """
    sizes = {r["length"]: r["k"] for r in words.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("k")).collect()}
    total = sum(sizes.values())
    few = words.select("word")
    if total > sample:  # about so many rows leave the tasks, however many tasks there are
        few = few.where(F.xxhash64("word") < sample * 2**64 // total - 2**63)
    chosen = [r["word"].encode("latin-1") for r in few.collect()]
    by: dict[int, list[bytes]] = {length: [] for length in sizes}
    for w in chosen:
        by[len(w)].append(w)
    leaf = max(1, cell * len(chosen) // max(1, total))
    trees = {length: build(vectors(letters(own)) if own else np.zeros((0, DIMENSIONS), np.int8), leaf, tight=False) for length, own in by.items()}
    homes = words.mapInArrow(_homes(trees), "length int, cell int").groupBy("length", "cell").agg(F.count(F.lit(1)).alias("k"))
    crowded = homes.where(F.col("k") > 4 * cell).collect()
    return trees, {(r["length"], r["cell"]): -(-r["k"] // (2 * cell)) for r in crowded}


def _homes(trees: dict[int, Tree]):  # noqa: ANN202
    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[int, list[bytes]] = {}
            for w in batch.column("word").to_pylist():
                by.setdefault(len(w), []).append(w.encode("latin-1"))
            for length, own in by.items():
                for _, leaf in meets(trees[length], vectors(letters(own)), 0):
                    yield pa.RecordBatch.from_pydict({"length": pa.array(np.full(len(leaf), length), pa.int32()), "cell": pa.array(leaf, pa.int32())})

    return homes


def near_words(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """``word``, ``near`` and ``near_n`` for every two of ``words`` (``word``, ``n``) that are one edit apart, both ways."""
    trees, parts = cells_of(words, cell, sample)
    routed = words.mapInArrow(_route(trees, parts), ROUTED)
    return routed.groupBy("length", "cell", "part").applyInArrow(_search, NEAR)


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of its chain, for ``forms`` (``word``, ``form``), by pointer doubling.

    A form occurs at least twice as often as its word, so chains are short and end.
    """
    spark = forms.sparkSession
    now = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    total = now.count()
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = salted_join(now, step, ["root"], ["word"], total, "left")
        last, now = now, materialise(moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        discard(spark, last)
        if not now.where("moved").head(1):
            return now.select("word", "root")


def spelling_variants(docs: DataFrame, least: int = 3, times: int = 2) -> DataFrame:
    """Words with their near words, their form and the root of its chain.

    Words are runs of letters (A-Z, a-z and U+00C0 to U+00FF), A-Z lower-cased, some
    of them with a letter deleted by rule, of five letters and more that occur
    ``least`` times.  The form is the near word that occurs most often (ties: the
    least in code-point order), if it occurs ``times`` as often as the word.  Null
    and empty texts have no words, a null ``doc_id`` counts as an empty name, repeated
    rows count again, an empty table gives no rows; other columns are ignored.
    Returns ``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n``.
    """
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "500"}):
        words = materialise(word_counts(docs, least), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    found = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    every = words.join(found, "word", "left")
    much = -F.col("best.less") >= times * F.col("n")
    every = every.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(much, F.col("best.near")).alias("form"), F.when(much, -F.col("best.less")).alias("form_n"))
    every = materialise(every, "forms")
    ends = roots(every.where("form is not null"))
    out = every.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return out.select("word", "form", "root", "n", "n_near", "form_n")
