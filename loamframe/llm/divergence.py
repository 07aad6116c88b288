"""How sources of a language differ in the words they use, by chunk factorisation.

Texts are cut at spaces; a chunk is what stands between.  Scan blocks number the
distinct chunks of their documents and take each of them apart into terms once; what
chunks count for is then summed by their terms, and each term is sent once for every
language and source of a block.  Terms never cross a space, so nothing is lost.

A document is in one block only, so the documents that have a term add up over blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamframe.llm.shared import give_back, materialise, partitions, settings

#: What each byte of a chunk becomes: A-Z lower-cased, other ASCII but letters a space, bytes beyond ASCII kept.
TERM_BYTES = bytes(c | 32 if chr(c).isalpha() and c < 128 else c if c > 127 else 32 for c in range(256))
#: Bytes of text that a scan block holds before it sends its terms on.
HELD = 32_000_000
COUNTS = "lang string, source string, term string, n long, docs long"
#: Documents that must have a term.
LEAST = 3


def _terms_of(chunks: pa.StringArray) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """(distinct terms, number of terms of each chunk, numbers of all chunks' terms one after another)."""
    _, ends, data = chunks.buffers()
    lowered = pa.py_buffer((data.to_pybytes() if data is not None else b"").translate(TERM_BYTES))
    cut = pc.split_pattern(pa.StringArray.from_buffers(len(chunks), ends, lowered, offset=chunks.offset), " ")
    pieces = pc.list_flatten(cut)
    real = pc.greater(pc.binary_length(pieces), 0)
    coded = pieces.filter(real).dictionary_encode()
    # a term that a chunk has twice is there twice, and so counts twice
    each = np.bincount(pc.list_parent_indices(cut).filter(real).to_numpy(), minlength=len(chunks))
    return coded.dictionary, each, coded.indices.to_numpy().astype(np.int64)


def _block(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms of a block for every language and source, and an empty term for each of these."""
    rows = pa.Table.from_batches(batches).combine_chunks()
    langs, sources = (rows[c].combine_chunks().dictionary_encode() for c in ("lang", "source"))
    group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
    order = np.argsort(group, kind="stable")  # documents of a group follow each other
    groups, group = np.unique(group[order], return_inverse=True)
    cut = pc.split_pattern(rows["text"].combine_chunks().take(pa.array(order)), " ")
    docs = len(group)
    del rows, order
    doc = pc.list_parent_indices(cut).to_numpy()
    coded = pc.list_flatten(cut).dictionary_encode()
    del cut
    terms, each, numbers = _terms_of(coded.dictionary)
    chunk = coded.indices.to_numpy()
    del coded
    first, many = np.cumsum(each) - each, each[chunk]
    key = np.repeat(first[chunk] - (np.cumsum(many) - many), many)
    key += np.arange(len(key))  # of each occurrence, the place of its term in numbers
    key = numbers[key]
    key *= docs
    key += np.repeat(doc, many)
    del chunk, doc, many
    key.sort()
    new_doc = np.ones(len(key), bool)
    new_doc[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new_doc)
    term, own = np.divmod(key[at], docs)
    own = group[own]
    new_row = np.ones(len(at), bool)
    new_row[1:] = (term[1:] != term[:-1]) | (own[1:] != own[:-1])
    start = np.flatnonzero(new_row)
    n, having = np.diff(at[start], append=len(key)), np.diff(start, append=len(at))
    term, own = term[start], own[start]
    del key, new_doc, at, new_row
    # groups occur, though they may have no terms
    text = pa.concat_arrays([terms.take(pa.array(term)), pa.array([""] * len(groups), pa.string())])
    own = np.concatenate([own, np.arange(len(groups))])
    n, having = (np.concatenate([x, np.zeros(len(groups), np.int64)]) for x in (n, having))
    names = (d.dictionary.take(pa.array(i[own])) for d, i in zip((langs, sources), np.divmod(groups, max(1, len(sources.dictionary))), strict=True))
    out = pa.RecordBatch.from_arrays([*names, text, pa.array(n, pa.int64()), pa.array(having, pa.int64())], ["lang", "source", "term", "n", "docs"])
    for i in range(0, out.num_rows, 20_000):
        yield out.slice(i, 20_000)


def _count_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size > HELD:
            yield from _block(held)
            held, size = [], 0
    if sum(b.num_rows for b in held):
        yield from _block(held)
    give_back()


def term_counts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``lang``, ``source``, ``term``, ``n`` of the terms that :data:`LEAST` documents of the language have; ``lang`` and ``source`` of all groups).

    ``whole`` is the language's ``n`` of a term, ``leads`` is 1 in one row of each of its terms.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    whole = W.partitionBy("lang", "term")
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": "500"}):
        dealt = docs.select(text("lang"), text("source"), text("text")).mapInArrow(_count_blocks, COUNTS).repartition(partitions(docs.sparkSession), "lang", "term")
        each = dealt.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        each = each.select("lang", "source", "term", "n", F.sum("n").over(whole).alias("whole"), (F.min("source").over(whole) == F.col("source")).cast("int").alias("leads"), F.sum("docs").over(whole).alias("docs"))
        each = materialise(each.where((F.col("docs") >= LEAST) | (F.col("term") == "")).drop("docs"), "terms")
    return each.where("term <> ''"), each.where("term = ''").select("lang", "source")


SCALE = 1_000_000_000


def _p(n: str, total: str) -> Column:
    """1 + floor(SCALE * (n + 1) / total), in decimals wide enough for any count; null if there is no total."""
    return F.expr(f"cast(cast({SCALE} as decimal(12,0)) * cast({n} + 1 as decimal(20,0)) div cast(nullif({total}, 0) as decimal(20,0)) as bigint) + 1")


def _f(p: str, q: str) -> Column:
    """floor((p - q)^2 / q), exact in 64 bits since p and q are at most SCALE + 1."""
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def _ranked(rows: DataFrame) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(order))


def _pairs(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Value of every ordered pair of sources of a language.

    Terms that one side or neither has need no row of their own: what they add
    follows from counts of counts.  Only terms that both have are joined.
    """
    wide = lambda c: c.cast("decimal(38,0)")
    side = lambda x: sizes.select("lang", *[F.col(c).alias(f"{c}_{x}") for c in ("source", "p0", "terms")], *["vocabulary"] * (x == "g"))
    own = lambda x: rows.select("lang", "term", *[F.col(c).alias(f"{c}_{x}") for c in ("source", "p", "p0")])
    key = ["lang", "source_g", "source_h"]
    met = own("g").join(own("h"), ["lang", "term"]).where("source_g <> source_h")
    sums = {"a": F.sum(_f("p_g", "p_h")), "b": F.sum(_f("p_g", "p0_h")), "c": F.sum(_f("p0_g", "p_h")), "d": F.sum(_f("p0_g", "p0_h"))}
    both = met.groupBy(*key).agg(*[v.alias(k) for k, v in sums.items()])
    # what both sides' sums below hold of a shared term is taken back out
    both = both.select(*key, (wide(F.col("a")) - wide(F.col("b")) - wide(F.col("c")) + wide(F.col("d"))).alias("value"))
    levels = rows.groupBy("lang", F.col("source").alias("x"), F.col("p").alias("p")).agg(F.count(F.lit(1)).alias("k"))
    against = levels.join(sizes.select("lang", F.col("source").alias("y"), F.col("p0").alias("q")), "lang").where("x <> y")
    ways = F.array(F.struct(F.col("x").alias("source_g"), F.col("y").alias("source_h"), _f("p", "q").alias("f")), F.struct(F.col("y").alias("source_g"), F.col("x").alias("source_h"), _f("q", "p").alias("f")))
    alone = against.select("lang", "k", F.inline(ways)).groupBy(*key).agg(F.sum(F.col("f").cast("decimal(19,0)") * F.col("k")).alias("value"))
    some = both.unionByName(alone.select(*key, wide(F.col("value")).alias("value"))).groupBy(*key).agg(F.sum("value").alias("value"))
    pairs = side("g").join(side("h"), "lang").where("source_g <> source_h").join(some, key, "left")
    neither = wide(F.expr("vocabulary - terms_g - terms_h")) * F.coalesce(_f("p0_g", "p0_h"), F.lit(0))
    value = F.coalesce("value", wide(F.lit(0))) + neither
    return pairs.select("lang", F.col("source_g").alias("source"), F.col("source_h").alias("item"), value.cast("long").alias("value"))


def source_divergence(docs: DataFrame, ranks: int = 200) -> DataFrame:
    """How each source differs from the other sources of its language, and in which terms from the whole language.

    Terms are runs of ASCII letters and of anything beyond ASCII, A-Z lower-cased;
    a language keeps those that :data:`LEAST` of its documents have.  A group's share of a
    term is 1 + floor(10^9 * (n + 1) / (N + V)).  ``part`` ``pair`` has a row for
    every other source, ``term`` the ``ranks`` terms that stand out most; all
    arithmetic is exact.  Null ``text``, ``lang`` and ``source`` are empty strings; a
    group without terms has pairs, of value 0 where its language keeps none; a
    repeated row is a document of its own; an empty table gives no rows; other columns,
    ``doc_id`` too, are ignored.
    """
    kept, groups = term_counts(docs)
    held = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"), F.count(F.lit(1)).alias("terms"), F.sum("leads").alias("leads"))
    vocabulary = held.groupBy("lang").agg(F.sum("leads").alias("vocabulary"), F.sum("own").alias("all"))
    sizes = groups.join(held.drop("leads"), ["lang", "source"], "left").join(vocabulary, "lang", "left").fillna(0)
    sizes = materialise(sizes.withColumn("total", F.expr("own + vocabulary")).withColumn("p0", _p("0", "total")), "sizes")
    rows = kept.join(sizes.select("lang", "source", "total", "p0", F.expr("`all` + vocabulary").alias("of_all")), ["lang", "source"])
    rows = rows.select("lang", "source", "term", _p("n", "total").alias("p"), "p0", _p("whole", "of_all").alias("q"))
    out = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), _f("p", "q").alias("value"))
    parts = [(F.lit("pair"), _ranked(_pairs(rows, sizes))), (F.lit("term"), _ranked(out).where(F.col("rank") <= ranks))]
    pair, term = (x.select("lang", "source", name.alias("part"), "item", "value", "rank") for name, x in parts)
    return pair.unionAll(term)
