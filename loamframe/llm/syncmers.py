"""Document fingerprints of closed syncmers over words, in DataFrame functions alone.

A k-mer is ``k`` words in a row; the ``s`` words in a row with the least hash are its
minimal inner substring.  A k-mer whose minimal inner substring stands at its start or
end is an anchor.  Whether it is one depends on its own words alone, so equal passages
have equal anchors wherever they stand.  An anchor's mark is a hash of its words and of
the distance to the anchor before it: two texts share a mark where the same k-mer
stands at the same place after the last anchor, so words put in or taken out elsewhere
do no harm, and the same words in another order do not match.

A fingerprint keeps the marks of at most ``marks`` bits of detail: at level ``v`` those
that 2^v divides, with the least ``v`` that leaves about ``marks`` or fewer.  The levels
nest, so fingerprints of a short and a long text compare at the higher one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamframe.llm.shared import materialise, partitions, place, stable, text_or_empty

#: Runs without a blank count as words of so many letters at most.
LONGEST = 32
WORD = rf"[^\x20\x09-\x0D]{{1,{LONGEST}}}"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def marks(text: Column, k: int = 5, s: int = 2) -> Column:
    """Distinct 32-bit marks of a text's anchors, in order; fewer than ``k`` words are one anchor, none give none."""
    width = k - s + 1

    def anchors(words: Column, inner: Column) -> Column:
        at = lambda j, i: F.get(inner, j + i)
        edges = lambda j: F.least(at(j, 0), at(j, width - 1))
        between = [lambda j, i=i: at(j, i) for i in range(1, width - 1)]
        middle = lambda j: F.least(*[f(j) for f in between]) if len(between) > 1 else between[0](j)
        every = F.sequence(F.lit(0), F.size(words) - k)
        chosen = F.filter(every, lambda j: edges(j) <= middle(j)) if between else every
        # inner substrings overlap, so every s-th and the last hold all words of a k-mer
        covers = sorted({*range(0, width, s), width - 1})
        own = lambda j: F.xxhash64(*[at(j, i) for i in covers])
        return _let(chosen, lambda c: F.transform(c, lambda j, i: F.xxhash64(own(j), j - F.coalesce(F.get(c, i - 1), j))))

    def hashed(words: Column) -> Column:
        inner = F.transform(F.sequence(F.lit(0), F.size(words) - s), lambda j: F.xxhash64(*[F.get(words, j + i) for i in range(s)]))
        whole = F.when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(words) >= k, _let(inner, lambda h: anchors(words, h))).otherwise(whole)

    found = _let(F.regexp_extract_all(text, F.lit(WORD), 0), hashed)
    return F.array_distinct(F.transform(found, lambda h: h.bitwiseAND(F.lit(0xFFFFFFFF))))


def _at_level(found: Column, level: Column) -> Column:
    return F.filter(found, lambda h: F.pmod(h, F.call_function("shiftleft", F.lit(1).cast("long"), level)) == 0)


def sketch(found: Column, most: int = 256) -> Column:
    """``level`` and the ``marks`` kept at it."""
    level = F.when(F.size(found) <= most, F.lit(0)).otherwise(F.ceil(F.log2(F.size(found) / most))).cast("int")
    return _let(F.struct(found.alias("f"), level.alias("v")), lambda x: F.struct(x["v"].alias("level"), _at_level(x["f"], x["v"]).alias("marks")))


def as_text(fingerprint: Column) -> Column:
    """A fingerprint as hexadecimal digits: two of the level, then eight a mark."""
    digits = lambda x, n: F.lower(F.lpad(F.hex(x), n, "0"))
    return F.concat(digits(fingerprint["level"], 2), F.array_join(F.transform(fingerprint["marks"], lambda h: digits(h, 8)), ""))


def likeness(a: Column, b: Column) -> Column:
    """Shared marks over those of the larger side, at the higher level of both; 1 for two fingerprints without marks."""
    level = F.greatest(a["level"], b["level"])
    both = F.struct(_at_level(a["marks"], level).alias("a"), _at_level(b["marks"], level).alias("b"))
    larger = lambda x: F.greatest(F.size(x["a"]), F.size(x["b"]))
    share = _let(both, lambda x: F.try_divide(F.size(F.array_intersect(x["a"], x["b"])).cast("double"), larger(x)))
    return F.when((F.size(a["marks"]) == 0) & (F.size(b["marks"]) == 0), F.lit(1.0)).otherwise(F.coalesce(share, F.lit(0.0)))


def _ranges(keyed: DataFrame, n: int) -> DataFrame:
    """The first ``key`` of each of at most ``n`` ranges with about as many rows each."""
    firsts = keyed.select("key").repartitionByRange(n, "key").groupBy(F.spark_partition_id().alias("range")).agg(F.min("key").alias("key"))
    return materialise(firsts.select("key"), "ranges")


def with_next(rows: DataFrame, n: int, carried: Callable[[DataFrame], DataFrame], following: list[str]) -> DataFrame:
    """``rows`` (``key``, other columns) with ``next_<c>`` of the row with the next key for ``c`` in ``following``; after the last comes the first.

    Rows are dealt to ``n`` ranges of keys, once; the first row of a range goes to
    the range before it too, so no task needs another's rows.  ``carried`` adds
    columns after the shuffle.
    """
    bounds = _ranges(rows, n).agg(F.array_sort(F.collect_list("key"))).scalar()
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, n.bit_length())))])
    dealt = rows.withColumn("bounds", bounds)
    # binary search: how many ranges begin at or before the key
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= F.size("bounds")) & (F.get("bounds", at + step - 1) <= F.col("key")), at + step).otherwise(at)) - 1
    dealt = dealt.withColumn("range", found)
    before = F.when(F.col("range") == 0, F.size("bounds") - 1).otherwise(F.col("range") - 1)
    here = F.struct(F.col("range"), F.lit(False).alias("guest"))
    there = F.struct(before.alias("range"), F.lit(True).alias("guest"))
    dealt = dealt.withColumn("to", F.when(F.get("bounds", F.col("range")) == F.col("key"), F.array(here, there)).otherwise(F.array(here)))
    dealt = dealt.select(*rows.columns, F.explode("to").alias("to")).select(*rows.columns, "to.range", "to.guest")
    order = W.partitionBy("range").orderBy("guest", "key")
    nexts = {f"next_{c}": F.lead(c).over(order) for c in following}
    return carried(dealt.repartitionById(n, "range")).withColumns(nexts).where(~F.col("guest")).drop("range", "guest")


def fingerprint_documents(docs: DataFrame, k: int = 5, s: int = 2, most: int = 256) -> DataFrame:
    """Fingerprints of every whole text, of its edited text, and their likeness.

    The edited text is the text with its last third (rounded down, in code points)
    replaced by as many code points from the start of the next document in
    descending ``doc_id``, or all of them if it has fewer; after the last document
    comes the first.  Null texts are empty; a null id comes last; documents with one
    id follow each other by file and place in it; a document alone is its own next.
    Repeated rows are documents of their own; an empty table gives no rows; other
    columns are ignored.  Returns ``doc_id``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next``.
    """
    if s < 1 or k < s + 1:
        raise ValueError("a k-mer needs more words than its inner substring")
    spark = docs.sparkSession
    # the complement turns the order of the ids round
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not(F.col("doc_id").cast("long")).alias("down"), place().alias("place"))
    rows = stable(docs.select("doc_id", "text")).select("doc_id", text_or_empty().alias("text"), key.alias("key"))

    def fingerprinted(dealt: DataFrame) -> DataFrame:
        return dealt.withColumn("found", marks(F.col("text"), k, s)).withColumn("own", sketch(F.col("found"), most)).drop("found").withColumn("n_chars", F.length("text").cast("long"))

    both = with_next(rows, partitions(spark), fingerprinted, ["text", "own"])
    keep = F.expr("cast(n_chars - n_chars div 3 as int)")
    edited = F.concat(F.substring("text", F.lit(1), keep), F.substring("next_text", F.lit(1), F.col("n_chars").cast("int") - keep))
    out = both.withColumn("edited", edited).drop("text", "next_text").withColumn("found", marks(F.col("edited"), k, s))
    out = out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "own", "next_own", sketch(F.col("found"), most).alias("other"))
    return out.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
