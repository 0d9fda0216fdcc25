"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import written


def _min_neighbours(pairs: DataFrame) -> DataFrame:
    """(u, m): the smallest of each u and its neighbours. Written, so that the
    join with the pairs of a very linked u is dealt anew and may be split."""
    return written(pairs.groupBy("u").agg(F.min("v").alias("m"))
                   .select("u", F.least("u", "m").alias("m")), "min-neighbours")


def stars(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) -> (v, root): every linked vertex but the smallest of
    its component, with that smallest one. Alternates the large-star and
    small-star steps (Kiveris et al., 2014), each a partial minimum and a
    join; the number of rounds grows with the logarithm of the largest
    component. No vertex list ever leaves the cluster."""
    e = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .distinct(), "edges")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = written(both.join(_min_neighbours(both), "u").where("v > u and v <> m")
                        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        small = large.join(_min_neighbours(large), "u")
        e = written(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (now.n, now.h) == before:
            return e.select(F.col("u").alias("v"), F.col("v").alias("root"))
        before = (now.n, now.h)
