"""URL allow and block rules as a sort-merge range join.

Hosts are reversed label by label (``a.example.net`` becomes
``net.example.a.``), so a rule's host and all its subdomains are one interval
of sorted keys.  Urls and rules are cut into ranges of that order; a rule goes
to every range its interval meets.  Within a range one sorted sweep keeps the
stack of rules whose interval holds the current url; the longest rule on the
stack whose path begins the url's path decides.

Ranges are cut on (reversed host, path, row id), so one hot host, even one hot
url, spreads over many ranges.  A range is streamed, never held whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamframe.llm.shared import partitions

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LAST = "\U0010ffff"
_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Urls looked at for every range when cut points are chosen.
SAMPLES_PER_RANGE = 40


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    return F.translate(F.coalesce(F.regexp_extract(url, _SPLIT, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit(""))


def host_key(host: Column) -> Column:
    """Reversed labels, each closed by a dot; empty for an empty host."""
    reversed_labels = F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")
    return F.when(host == "", F.lit("")).otherwise(F.concat(reversed_labels, F.lit(".")))


def apply_url_rules(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
    ranges: int | None = None,
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row of ``pages``.

    ``rules`` has ``host``, ``path`` and ``verdict``.  A rule fits its host and
    all subdomains when the url's path starts with the rule's path; the longest
    rule text wins, ties go to the longer host and then to ``block``.

    Null urls and urls without ``://`` have an empty host and path, fit no rule
    and get the default; very long urls are judged whole.  Repeated rows stay repeated; empty tables give empty
    results; columns of ``pages`` named like the added ones are replaced.  Rules
    with a null host or path are ignored.
    """
    spark = pages.sparkSession
    n = ranges or partitions(spark)
    added = ("host", "path", "rule", "verdict")
    keep = [c for c in pages.columns if c not in added]
    atomic = (T.NumericType, T.StringType, T.BooleanType, T.DatetimeType)
    plain = [F.col(f"`{f.name}`") for f in pages.schema if f.name in keep and isinstance(f.dataType, atomic)]
    urls = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        url_host(F.col(f"`{url}`")).alias("host"),
        url_path(F.col(f"`{url}`")).alias("path"),
        F.lpad(F.conv(F.xxhash64(*plain).cast("string"), 10, 16), 16, "0").alias("salt"),
    ).select("row", "host", "path", F.concat(host_key(F.col("host")), F.lit("\x01"), "path", F.lit("\x01"), "salt").alias("key"))
    fraction = min(1.0, n * SAMPLES_PER_RANGE / max(1, pages.count()))
    found = sorted(r.key for r in urls.select("key").sample(fraction, seed=7).collect()) or [""]
    cuts = sorted({found[len(found) * i // n] for i in range(1, n)})

    bounds = np.array(cuts, object)

    @F.pandas_udf(T.IntegerType())
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy(object), "right").astype(np.int32))

    ranged = rules.where("host is not null and path is not null").select(
        host_key(F.translate("host", UPPER, LOWER)).alias("key"),
        F.col("host").alias("host"), F.col("path").alias("path"), F.col("verdict").alias("verdict"),
    )
    ranged = ranged.withColumn("range", F.explode(F.sequence(range_of("key"), range_of(F.concat("key", F.lit(LAST))))))
    row_type = urls.schema["row"].dataType
    both = urls.select(
        range_of("key").alias("range"), "key", F.lit(1).alias("kind"), "host", "path", F.lit(None).cast("string").alias("verdict"), "row"
    ).unionByName(ranged.select("range", "key", F.lit(0).alias("kind"), "host", "path", "verdict", F.lit(None).cast(row_type).alias("row")))
    dealt = both.repartition(n, "range").sortWithinPartitions("range", "key", "kind")
    out = T.StructType([T.StructField("row", row_type), *[T.StructField(c, T.StringType()) for c in added]])

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stack: list[tuple[str, str, str, str]] = []  # key, path, rule text, verdict
        now = -1
        for b in batches:
            rule, verdict = [None] * len(b), [default] * len(b)
            for i, (r, key, kind, host, path, v) in enumerate(zip(b["range"], b["key"], b["kind"], b["host"], b["path"], b["verdict"], strict=True)):
                if r != now:
                    stack, now = [], r
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    stack.append((key, path, host + path, v))
                    continue
                fits = [x for x in stack if path.startswith(x[1])]
                if fits:
                    best = max(fits, key=lambda x: (len(x[2]), len(x[0]), x[3] == "block"))
                    rule[i], verdict[i] = best[2], best[3]
            b["rule"], b["verdict"] = rule, verdict
            yield b.loc[b["kind"] == 1, ["row", *added]]

    judged = dealt.mapInPandas(sweep, out)
    return judged.select(*[F.col(f"row.`{c}`") for c in keep], *added)
