"""Near duplicates: a self join on the Jaccard similarity of word shingles.

Prefix filtering under several global token orders.  All orders put rare tokens
first (classes of document frequency, counted over every document by a compressed
exchange) and break ties by differently keyed hashes.  Documents as similar as
the threshold must share a prefix token under every order: the first order's
prefixes are joined, the others' are intersected on the joined pairs, and what is
left is verified on the sets.  Tokens of one document alone are never sent.

Components are wanted, so a token's members are first joined as a star around one
of them, whom one aggregation finds; only members still in different components
are compared further: all pairs of small token groups, and larger ones block
against block within the token, where prefixes and then sets meet in a task and only
links that connect what it has verified leave it.  How much is enough follows from the
sizes: rare tokens are what dissimilar documents differ in, and they are in the
prefix.  Keys that many rows hold are dealt to many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamframe.llm.components import components, forest
from loamframe.llm.exchange import Answers, Block, Message, exchange, read_blocks
from loamframe.llm.shared import discard, materialise, numbered, pinned, place, salted_join, stable, without
from loamframe.llm.words import grams, mix

SHINGLE = 5
#: Similarity in percent.
THRESHOLD = 80
#: Global token orders whose prefixes a pair must share.
ORDERS = 3
#: Largest token group whose pairs are listed; members of larger ones are compared in blocks of :data:`BLOCK`.
SMALL, BLOCK = 12, 256
#: Tokens of the sets in a block, about, however few sets they are.
BLOCK_TOKENS = 1 << 22
#: Distinct tokens held at once when blocks are compared.
COLUMNS = 8192
#: Star rounds, at most, before the remaining cross-component pairs are listed; they end when one finds no link.
STARS = 2


def block_sets(block: Block, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document of a block."""
    out = []
    for _, _, _, h, at in block.parts:
        g = grams(h, width)
        for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            n = j - i
            if n >= width:
                s = np.sort(g[i : j - width + 1])
                out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
            elif n:
                out.append(mix(grams(h[i:j], n), salt=n))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _firsts(sets: list[np.ndarray]) -> list[int]:
    """For each set the place of the first equal one."""
    seen: dict[bytes, int] = {}
    return [seen.setdefault(s.tobytes(), i) for i, s in enumerate(sets)]


def _least_common(n: int, percent: int) -> int:
    return -(-n * percent // 100)


def near_duplicates(docs: DataFrame, width: int = SHINGLE, percent: int = THRESHOLD, orders: int = ORDERS) -> DataFrame:
    """One row per row of ``docs``: ``rid``, ``place``, ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Documents link when the Jaccard similarity of their sets of distinct
    ``width``-word shingles (lower-cased A-Z) is at least ``percent``; components
    are what links reach, named by the smallest ``doc_id`` in them, whose row is
    kept.  Shorter texts are one shingle, very long ones have all of theirs.  Null,
    empty and wordless texts have no shingles and link with nothing; rows with a
    null ``doc_id`` take part and rank last.  Repeated rows link; one of them is
    kept.  An empty table gives an empty result.  Other columns are ignored.
    """
    spark = docs.sparkSession

    def tokens(block: Block) -> Message:
        sets = block_sets(block, width)
        own = [s for i, (s, f) in enumerate(zip(sets, _firsts(sets), strict=True)) if i == f and len(s)]
        return (*np.unique(np.concatenate(own), return_counts=True), None) if own else (np.zeros(0, np.uint64), np.zeros(0, np.int64), None)

    def frequency(n: int, which: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        total = np.bincount(which, weights=numbers, minlength=n)
        return np.floor(np.log2(total))[which]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replies = Answers(answers)
        for block in read_blocks(batches, True):
            sets = block_sets(block, width)
            firsts = _firsts(sets)
            keys, *_ = tokens(block)
            classes = replies.of(block, keys)
            rid = np.concatenate(block.rid)
            doc_id, where = (pa.concat_arrays([b.column(c).slice(i, n) for b, i, n in block.rows]) for c in ("doc_id", "place"))
            shared, prefixes = [], [[] for _ in range(orders)]
            for i, s in enumerate(sets):
                n = len(s)
                c = classes[np.searchsorted(keys, s)] if i == firsts[i] and n else np.zeros(0, np.uint8)
                common = np.count_nonzero(c)
                if not n or i != firsts[i] or common < _least_common(n, percent):
                    shared.append(None)
                    for p in prefixes:
                        p.append(None)
                    continue
                shared.append(s[c > 0].view(np.int64))
                p_len = n - _least_common(n, percent) + 1
                for k in range(orders):
                    first = np.lexsort((mix(s, salt=k + 1), c))[:p_len]
                    first = first[c[first] > 0]
                    prefixes[k].append(s[first].view(np.int64))
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_pydict({
                "rid": pa.array(rid, pa.int64()), "place": where, "doc_id": doc_id, "n": pa.array([len(s) for s in sets], pa.int32()),
                "class": pa.array(rid[firsts], pa.int64()), "shared": pa.array(shared, kind),
                **{f"p{k}": pa.array(p, kind) for k, p in enumerate(prefixes)},
            })

    schema = "rid long, place struct<file:long,at:long>, doc_id long, n int, class long, shared array<long>" + "".join(f", p{k} array<long>" for k in range(orders))
    with pinned(spark):
        rows = numbered(stable(docs).withColumn("place", place())).select("rid", "place", F.col("doc_id").cast("long").alias("doc_id"), "text")
        answers = exchange(rows.select("rid", "text"), lambda: tokens, frequency, lower=True)
        described = materialise(rows.mapInArrow(describe, schema), "described")
    discard(spark, answers)

    links = _linked(described.where("shared is not null").select("class", "n", "shared", *[f"p{k}" for k in range(orders)]), percent, orders)
    group = components(links).select(F.col("node").alias("class"), F.col("component").alias("group"))
    members = described.select("rid", "place", "doc_id", "n", "class")
    total = members.count()
    members = salted_join(members, group, ["class"], ["rid"], total, "left")
    # documents of no group stand alone, copies inside a block under their class
    members = materialise(members.withColumn("group", F.when(F.col("n") == 0, F.col("rid")).otherwise(F.coalesce("group", "class"))), "members")
    discard(spark, described, links)
    order = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), F.col("rid").alias("row"), F.col("doc_id").alias("doc_id"))
    heads = members.groupBy("group").agg(F.min(order).alias("head"))
    return salted_join(members, heads, ["group"], ["rid"], total).select(
        "rid", "place", "doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("head.doc_id").alias("component_id"), (F.col("rid") == F.col("head.row")).alias("kept")
    )


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set on the left shares with each on the right."""
    out = np.zeros((len(left), len(right)), np.int64)
    if not sum(map(len, left)) or not sum(map(len, right)):
        return out
    l_all, r_all = np.concatenate(left), np.concatenate(right)
    values = np.intersect1d(l_all, r_all)
    l_row, r_row = (np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right))
    l_ok, r_ok = np.isin(l_all, values), np.isin(r_all, values)
    l_row, l_at = l_row[l_ok], np.searchsorted(values, l_all[l_ok])
    r_row, r_at = r_row[r_ok], np.searchsorted(values, r_all[r_ok])
    for at in range(0, len(values), COLUMNS):
        m, k = (np.zeros((len(x), min(COLUMNS, len(values) - at)), np.float32) for x in (left, right))
        i, j = (l_at >= at) & (l_at < at + COLUMNS), (r_at >= at) & (r_at < at + COLUMNS)
        m[l_row[i], l_at[i] - at] = 1
        k[r_row[j], r_at[j] - at] = 1
        out += (m @ k.T).astype(np.int64)
    return out


def _candidates(percent: int):  # noqa: ANN202
    """A function from the members of two blocks of a token to those that have a partner in another group, sharing enough of the second prefixes, with their partners.

    A pair is named once, and only by the least token that it shares.
    """

    def compare(table: pa.Table) -> pa.Table:
        token, lo, hi = (table.column(c)[0].as_py() for c in ("token", "lo", "hi"))
        block = table.column("block").to_numpy()
        a, b = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        prefixes, tokens = ([x.values.to_numpy() for x in table.column(c).combine_chunks()] for c in ("p1", "tokens"))
        earlier = [t[t < token] for t in tokens]
        n, group, cls = table.column("n").to_numpy().astype(np.int64), table.column("group").to_numpy(), table.column("class").to_numpy()
        n_a, n_b = n[a][:, None], n[b][None, :]
        able = (group[a][:, None] != group[b][None, :]) & (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b))
        if lo == hi:
            able &= cls[a][:, None] < cls[b][None, :]
        if able.any():
            able &= _common([earlier[i] for i in a], [earlier[i] for i in b]) == 0
        if able.any():
            able &= _common([prefixes[i] for i in a], [prefixes[i] for i in b]) >= _enough(n_a, n_b, percent)
        i, j = np.nonzero(able)
        u, v = cls[a[i]], cls[b[j]]
        by = np.argsort(u, kind="stable")
        u, v = u[by], v[by]
        active = np.unique(np.concatenate([u, v]))
        cuts = pa.array(np.append(np.searchsorted(u, active), len(u)), pa.int32())
        key = lambda x, kind: pa.array(np.full(len(active), x), kind)
        return pa.table({
            "token": key(token, pa.int64()), "lo": key(lo, pa.int32()), "hi": key(hi, pa.int32()), "class": pa.array(active, pa.int64()),
            "partners": pa.ListArray.from_arrays(cuts, pa.array(v, pa.int64())),
        })

    return compare


def _verify(percent: int, orders: int):  # noqa: ANN202
    """A function from members with their sets and partners to links that connect all partners as similar as ``percent``, fewer than members."""

    def verify(table: pa.Table) -> pa.Table:
        lists = lambda c: [x.values.to_numpy() for x in table.column(c).combine_chunks()]
        n, cls, partners = table.column("n").to_numpy().astype(np.int64), table.column("class").to_numpy(), lists("partners")
        by = np.argsort(cls)
        a = np.flatnonzero([len(x) > 0 for x in partners])
        b = by[np.searchsorted(cls[by], np.unique(np.concatenate(partners)))]
        able = np.zeros((len(a), len(b)), bool)
        for row, i in enumerate(a):
            able[row, np.searchsorted(cls[b], partners[i])] = True
        n_a, n_b = n[a][:, None], n[b][None, :]
        for k in range(2, orders):
            p = lists(f"p{k}")
            able &= _common([p[i] for i in a], [p[i] for i in b]) >= _enough(n_a, n_b, percent)
        x, y = np.flatnonzero(able.any(axis=1)), np.flatnonzero(able.any(axis=0))
        able, a, b = able[np.ix_(x, y)], a[x], b[y]
        if able.any():
            sets = lists("shared")
            common = _common([sets[i] for i in a], [sets[i] for i in b])
            able &= 100 * common >= percent * (n[a][:, None] + n[b][None, :] - common)
        i, j = np.nonzero(able)
        found = pa.RecordBatch.from_pydict({"u": pa.array(cls[a[i]], pa.int64()), "v": pa.array(cls[b[j]], pa.int64())})
        return pa.Table.from_batches(list(forest([found])), found.schema)

    return verify


def _enough(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """As :func:`_least_shared`, for arrays of sizes."""
    return np.maximum(1, -(-percent * (n + m) // (100 + percent)) - np.maximum(_least_common(n, percent), _least_common(m, percent)) + 1)


def _near(n: str, m: str, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _least_shared(n: str, m: str, percent: int) -> Column:
    """Tokens that the prefixes of similar sets share: those needed in all, less all that can lie behind the prefix that ends first."""
    needed = F.floor((percent * (F.col(n) + F.col(m)) + 99 + percent) / (100 + percent))
    behind = F.floor((percent * F.greatest(n, m) + 99) / 100) - 1
    return F.greatest(F.lit(1), needed - behind)


def _stars(rows: DataFrame, total: int, turn: int, percent: int) -> DataFrame:
    """Each token's members (``leaf``) paired with one of them that is in another group (``hub``)."""
    head = F.min(F.struct(F.xxhash64("group", F.lit(turn)).alias("order"), "n", "class", "group")).alias("head")
    heads = rows.groupBy("token").agg(head, F.min("group").alias("low"), F.max("group").alias("high")).where("low < high").select("token", "head")
    met = salted_join(rows, heads, ["token"], ["class"], total).where(F.col("group") != F.col("head.group"))
    return met.where(_near("n", "head.n", percent)).select(F.col("head.class").alias("hub"), F.col("class").alias("leaf")).distinct()


def _open(rows: DataFrame, total: int) -> DataFrame:
    """Members of tokens that still join several groups, with ``size``, the token's members, and ``weight``, their tokens.

    Of tokens with the same members one is enough.
    """
    tokens = rows.groupBy("token").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"), F.min("group").alias("low"), F.max("group").alias("high"), F.bit_xor(F.xxhash64("class")).alias("x"), F.bit_xor(F.xxhash64("class", F.lit(1))).alias("y")
    ).where("low < high")
    one = tokens.groupBy("size", "weight", "low", "high", "x", "y").agg(F.min("token").alias("token")).select("token", "size", "weight")
    return materialise(salted_join(rows, one, ["token"], ["class"], total), "open")


def _rest(members: DataFrame, percent: int) -> DataFrame:
    """All pairs across groups in tokens of at most :data:`SMALL` members."""
    few = members.where(F.col("size") <= SMALL)
    other = few.select("token", F.col("class").alias("other"), F.col("n").alias("m"), F.col("group").alias("apart"))
    return few.join(other, "token").where("class < other and group <> apart").where(_near("n", "m", percent)).select(F.col("class").alias("hub"), F.col("other").alias("leaf")).distinct()


def _blocks(members: DataFrame, sets: DataFrame, percent: int, orders: int) -> DataFrame:
    """Links (``u``, ``v``) across groups in larger tokens, found and verified block against block.

    Two blocks meet with first their prefixes and then, of members that still have a
    partner there, whole sets: pairs stay inside tasks, and what leaves them is no
    more than the members.
    """
    many = members.where(F.col("size") > SMALL)
    many = many.withColumn("blocks", F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("weight") / BLOCK_TOKENS)).cast("int")).drop("size", "weight")
    lists = many.groupBy("class").agg(F.collect_list("token").alias("tokens"))  # not more than the prefix has
    held = many.join(lists.join(sets.select("class", "p1"), "class"), "class").withColumn("block", F.pmod(F.xxhash64("class"), "blocks").cast("int"))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    held = held.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("other", "blocks")
    near = held.groupBy("token", "lo", "hi").applyInArrow(_candidates(percent), "token long, lo int, hi int, class long, partners array<long>")
    near = materialise(near, "candidates")
    whole = sets.select("class", "n", "shared", *[f"p{k}" for k in range(2, orders)])
    met = salted_join(near, whole, ["class"], ["token", "lo", "hi"], near.count())
    links = materialise(met.groupBy("token", "lo", "hi").applyInArrow(_verify(percent, orders), "u long, v long").distinct(), "links")
    discard(sets.sparkSession, near)
    return links


def _met(pairs: DataFrame, sets: DataFrame, names: list[str], total: int) -> DataFrame:
    """Pairs with columns of both sets; only a hub's set is repeated, once for each part its leaves are cut into."""
    side = lambda x: sets.select(F.col("class").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in names]).join(pairs.select(x).distinct(), x, "left_semi")
    return salted_join(pairs.join(side("leaf"), "leaf"), side("hub"), ["hub"], ["leaf"], total, counted=pairs)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, orders: int) -> DataFrame:
    """The pairs (``hub``, ``leaf``) as similar as ``percent``; whole sets meet only where the other orders' prefixes do."""
    met = _met(pairs, sets, ["n", *[f"p{k}" for k in range(1, orders)]], pairs.count())
    for k in range(1, orders):
        met = met.where(F.size(F.array_intersect(f"p{k}_hub", f"p{k}_leaf")) >= _least_shared("n_hub", "n_leaf", percent))
    met = materialise(met.select("hub", "leaf"), "met")
    common = F.size(F.array_intersect("shared_hub", "shared_leaf"))
    good = _met(met, sets, ["n", "shared"], met.count()).withColumn("common", common)
    good = good.where(100 * F.col("common") >= percent * (F.col("n_hub") + F.col("n_leaf") - F.col("common")))
    good = materialise(good.select(F.col("hub").alias("u"), F.col("leaf").alias("v")), "links")
    discard(sets.sparkSession, met)
    return good


def _untested(pairs: DataFrame, tested: list[DataFrame]) -> DataFrame:
    """Pairs that no earlier round had, either way round."""
    both = lambda p: p.select(F.least("hub", "leaf").alias("a"), F.greatest("hub", "leaf").alias("b"))
    out = pairs.withColumns({"a": F.least("hub", "leaf"), "b": F.greatest("hub", "leaf")})
    for t in tested:
        out = out.join(both(t), ["a", "b"], "left_anti")
    return out.drop("a", "b")


def _linked(sets: DataFrame, percent: int, orders: int) -> DataFrame:
    """Links (``u``, ``v``) that connect all pairs of sets as similar as ``percent``."""
    spark = sets.sparkSession
    small = sets.select("class", "n", "p0")
    total = small.agg(F.coalesce(F.sum(F.size("p0")), F.lit(0))).first()[0]
    links, tested, group = spark.createDataFrame([], "u long, v long"), [], None
    for turn in range(STARS + 1):
        held = small.withColumn("group", F.col("class")) if group is None else materialise(small.join(group, "class", "left").withColumn("group", F.coalesce("group", "class")), "grouped")
        rows = held.select(F.explode("p0").alias("token"), "class", "n", "group")
        if turn == STARS:
            break
        found = materialise(_untested(_stars(rows, total, turn, percent), tested), "stars")
        tested.append(found)
        new = _verified(found, sets, percent, orders)
        if new.isEmpty():  # another star would hardly find more
            break
        last, links = links, materialise(links.union(new), "links")
        discard(spark, last, held)
        group = components(links).select(F.col("node").alias("class"), F.col("component").alias("group"))
    members = _open(rows, total)
    wide = _blocks(members, sets, percent, orders)
    found = materialise(_untested(_rest(members, percent), tested).distinct(), "rest")
    last, links = links, materialise(links.union(wide).union(_verified(found, sets, percent, orders)), "links")
    discard(spark, last, held, members, found, wide, *tested)
    return links


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near duplicates of an earlier one, with all their columns.

    Null, empty and long texts, repeated rows, null ids and empty tables as in
    :func:`near_duplicates`.
    """
    docs = stable(docs)
    return without(docs, materialise(near_duplicates(docs).where("not kept").select("place"), "gone"))
