"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import discard, materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of `edges` (u, v), component being the smallest node reachable.

    Alternates two star contractions until nothing changes: every node hands its larger neighbours to the smallest
    one it knows, then its smaller neighbours. The number of rounds grows with the logarithm of the longest chain.
    Minima are folded before the shuffle; nothing is collected but the edge count and a checksum. Null ends and loops
    are ignored, repeated edges count once, an empty edge list gives an empty result.
    """
    e = (
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    e = materialize(e, "edges")
    seen = _print(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        before, e = e, materialize(small.distinct(), "edges")
        discard(before)
        now = _print(e)
        if now == seen:
            break
        seen = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _print(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]
