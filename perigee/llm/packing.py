"""Best-fit packing of documents into sequences, with conflicts.

A bin holds ``capacity`` units. Bins are ordered by residual space; each carries a bitmap of the
sources in it and one of the duplicate clusters in it. An item goes to the tightest bin that has
room and holds neither its source nor its cluster: the search starts at the smallest residual
that fits and goes on to its successors until a compatible bin is found, else a bin is opened.
Items come by falling size, ties by doc_id and piece (best-fit decreasing).

A document larger than a bin is cut into pieces of a whole bin each, and a rest that is packed
like a document; pieces carry their start, so nothing is lost.

Documents are dealt by a hash of their doc_id into shards of about ``SHARD`` documents, each
packed by itself. A shard is a bounded piece of work whatever the sources: the most frequent
source is spread over all shards. Only ids, sizes, source and cluster are shuffled, not texts.

Defined results. Null or blank text: size 0, in a bin of its conflicts' choosing like all others.
Null source or cluster: conflicts with nothing. Null doc_id: packed too. Repeated rows are each
packed. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
SHARD = 4096


def words(text: str = "text") -> Column:
    """Size of a text in words."""
    return F.size(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda w: w != ""))


def copies(text: str = "text") -> Column:
    """Cluster of a text: equal letters and digits, whatever the case, punctuation and spaces."""
    return F.xxhash64(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+", ""))


def best_fit(items: list, capacity: int) -> list:
    """The bin of each item (size, source bit, cluster bit), in the given order. Bits are 0 for no conflict."""
    order: list = []  # (residual, bin), ascending
    sources: list = []
    clusters: list = []
    out = []
    for size, source, cluster in items:
        at = bisect_left(order, (size, -1))
        while at < len(order) and (sources[order[at][1]] & source or clusters[order[at][1]] & cluster):
            at += 1
        if at < len(order):
            residual, b = order.pop(at)
            sources[b] |= source
            clusters[b] |= cluster
        else:
            residual, b = capacity, len(sources)
            sources.append(source)
            clusters.append(cluster)
        insort(order, (residual - size, b))
        out.append(b)
    return out


def _bits(values: pd.Series) -> list:
    """A bit for each value that occurs more than once; 0 for those that can't conflict."""
    many = values[values.notna() & values.duplicated(keep=False)].unique()
    bit = {v: 1 << i for i, v in enumerate(many)}
    return [bit.get(v, 0) for v in values]


def _pack(capacity: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "unnamed", "doc_id", "start"], ascending=[False, True, True, True], kind="stable", ignore_index=True)
        items = zip(rows["size"].tolist(), _bits(rows["source"]), _bits(rows["cluster"]), strict=True)
        rows["bin"] = best_fit(list(items), capacity)
        rows["position"] = rows.groupby("bin").cumcount()
        rows["bin"] = rows["shard"].astype("int64") * (1 << 32) + rows["bin"]
        return rows[["bin", "position", "doc_id", "unnamed", "piece", "start", "size"]]

    return run


def packed(docs: DataFrame, size: Column, source: Column, cluster: Column, capacity: int = CAPACITY) -> DataFrame:
    """bin, position, doc_id, piece, start, size (in the unit of ``size``) of every piece of ``docs``."""
    shards = -(-max(1, docs.count()) // SHARD)
    rows = docs.select(
        F.col("doc_id").cast("long"), size.cast("long").alias("whole"), source.cast("string").alias("source"), cluster.cast("string").alias("cluster")
    )
    # equal rows and rows without an id are told apart only to spread them
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("cluster", "source", "whole")).otherwise(F.xxhash64("doc_id"))
    last = F.greatest(F.ceil(F.col("whole") / capacity).cast("long") - 1, F.lit(0).cast("long"))
    pieces = rows.withColumn("shard", F.pmod(spread, F.lit(shards)).cast("int")).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    pieces = pieces.withColumn("start", F.col("piece") * capacity).select(
        "shard", F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc_id"), F.col("doc_id").isNull().alias("unnamed"), "piece", "start", F.least(F.col("whole") - F.col("start"), F.lit(capacity)).alias("size"), "source", "cluster"
    )
    out = pieces.groupBy("shard").applyInPandas(
        _pack(capacity), "bin long, position long, doc_id long, unnamed boolean, piece long, start long, size long"
    )
    return out.withColumn("doc_id", F.when(~F.col("unnamed"), F.col("doc_id"))).drop("unnamed")
