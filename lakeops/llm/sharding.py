"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every shard draws a number in (0, 1) for a key from a hash of (seed, shard,
key); the key goes to the shard with the smallest -ln(u) / weight. A shard's
share is its weight's share, the place of a key depends on the key and the
shards alone, and one more shard takes rows only into itself, because no other
shard's draw changes.

Slots are numbered in parts of a shard, cut by a hash of all that tells rows apart
(key, size, checksum), so the rows of a hot key fall into as many parts as any. Rows equal
in all of it are dealt by a salt that is written with them, where one such row comes more
often than a part should hold.

Defined cases: a NULL key is one more key (it has a shard like any other);
repeated rows share a shard and get slots of their own; NULL text has no
bytes; texts of any length are read whole; an empty table gives no rows; other
columns are carried along, but input columns named shard or grown_shard are replaced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import numbered, utf8, written

# Hex digits of a row's hash that cut a shard into parts for numbering.
BUCKET_DIGITS = 3
# Equal rows from which they are salted, and at least this share of all rows: so many
# kinds of rows, at most, are hot.
SALTED, HOT_KINDS = 4096, 1000
SALTS = 256


def key_text(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit("null"))


def draw(key: Column, shard: Column, weight: Column, seed: str) -> Column:
    """-ln(u) / weight of one shard for a key; u from 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(seed), F.lit(":"), shard.cast("string"), F.lit(":"), key_text(key)))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / F.lit(float(1 << 52))) / weight


def best_shard(key: Column, weights: list[float], seed: str = "s0", first: int = 0) -> Column:
    """struct(score, shard) of the winning shard; ties go to the smaller
    number. ``weights[i]`` is the weight of shard ``first + i``; a shard of
    weight 0 takes nothing."""
    shards = F.array(*[F.struct(F.lit(first + i).alias("shard"), F.lit(float(w)).alias("weight"))
                       for i, w in enumerate(weights) if w > 0])
    return F.array_min(F.transform(shards, lambda s: F.struct(
        draw(key, s["shard"], s["weight"], seed).alias("score"), s["shard"].alias("shard"))))


def shard_rows(df: DataFrame, key: str, weights: list[float], seed: str = "s0",
               added_weight: float | None = None) -> DataFrame:
    """Add ``shard`` (int) and, with ``added_weight``, ``grown_shard``: the
    shard once one more of that weight is there."""
    best_at, more_at = (next(n for n in (c + "_" * i for i in range(len(df.columns) + 1)) if n not in df.columns)
                        for c in ("_best", "_more"))
    out = df.withColumn(best_at, best_shard(F.col(key), weights, seed))
    best = F.col(best_at)
    added = {"shard": best["shard"]}
    if added_weight is not None:
        out = out.withColumn(more_at, best_shard(F.col(key), [added_weight], seed, first=len(weights)))
        more = F.col(more_at)
        added["grown_shard"] = F.when(more["score"] < best["score"], more["shard"]).otherwise(best["shard"])
    return out.withColumns(added).drop(best_at, more_at)


def parts(rows: DataFrame, digest: str, salt: str) -> Column:
    """The part of a shard that a row is numbered in: the first digits of its
    digest; where a digest is hot, what comes before, the digest itself by salt, and
    what comes after are parts of their own, so parts keep the order of digests."""
    counts = rows.groupBy(digest).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SALTED)
    limit = max(SALTED, rows.count() // HOT_KINDS)
    hot = sorted(r[0] for r in counts.where(F.col("n") >= limit).select(digest).collect())  # HOT_KINDS at most
    own = F.substring(digest, 1, BUCKET_DIGITS)
    if not hot:
        return own
    ahead = F.size(F.filter(F.array(*[F.lit(h) for h in hot]), lambda h: h < F.col(digest)))
    mine = F.when(F.col(digest).isin(hot), F.concat(F.lit("1"), F.lpad(F.pmod(salt, F.lit(SALTS)).cast("string"), 3, "0")))
    return F.concat(own, F.lpad(ahead.cast("string"), 4, "0"), F.coalesce(mine, F.lit("0")))


def sharded_documents(docs: DataFrame, shards: int = 16, seed: str = "s0") -> DataFrame:
    """The digest columns of the contract. Only ids, sizes and checksums are
    shuffled, never texts."""
    data = utf8(F.col("text"))
    rows = docs.select("doc_id", (F.length(data).cast("long") + 1).alias("size"),
                       F.crc32(data).alias("text_crc32"))
    rows = shard_rows(rows, "doc_id", [1.0] * shards, seed, added_weight=1.0)
    digest = F.md5(F.concat_ws(":", key_text(F.col("doc_id")), F.col("size").cast("string"),
                               F.col("text_crc32").cast("string")))
    rows = written(rows.withColumn("_h", digest).withColumn("_salt", F.monotonically_increasing_id()), "shard-rows")
    rows = numbered(rows.withColumn("_bucket", parts(rows, "_h", "_salt")), "shard", "_bucket",
                    ["_h", "doc_id", "size", "text_crc32"], "slot")
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                       "grown_shard")
