"""MinHash near-duplicates with circulant permutations.

A document's set holds its distinct word shingles, as 64-bit hashes. Circulant
MinHash (C-MinHash, Li and Li, 2022) needs two permutations of a universe of 2^32
places: sigma breaks up whatever structure the set has, and pi, shifted around the
circle by 0, 1, 2, ..., gives every coordinate of the signature: coordinate k is the
least pi(sigma(s) + k). ROWS coordinates make a band; documents that agree on a
band meet in its bucket. With 24 bands of 4 a pair of similarity 0.8 meets in
none with probability 5e-10 (each band holds with 0.41), of 0.9 far less.

Equal sets are one class from the start, so copies cost one row each. Classes
that meet are settled by exact Jaccard on their full sets, never all pairs of a
bucket at once:

1. every member of a bucket is compared with the bucket's hub, its member of most
   company over all bands; a hub's members come in parts of PART;
2. links so far give groups. What is left open are pairs inside a bucket that
   are in different groups. A bucket's largest group is set apart, the others are cut
   into parts of PART, and each meets every part; an item hands on a spanning forest
   of what it finds. Buckets whose largest group is the same are put together where
   that takes fewer comparisons than one after the other.

No bucket is capped and no pair that could link two groups is left out, so the
components are those of all links between classes that share a bucket. Members
whose set sizes alone rule out the similarity are not compared.

Texts travel as zstandard bytes and are cut into shingles again where they
meet: that is smaller than their sets.

Defined cases: a text of fewer words than a shingle is one shingle of them all;
NULL texts and texts without words have the empty set, link with nothing and are
a component of their own; a NULL key is a component's id only if all its keys are NULL;
repeated rows share a component and come back as often as they came; an empty table gives no rows. Texts are
taken whole, whatever their length. Other columns of the input are not read."""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import written
from .components import stars

BANDS, ROWS = 24, 4
PART = 64           # classes of a bucket that meet as many at a time
SEED = 42
_WORDS = 200_000    # word hashes that a worker remembers
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SLICE = 512        # shingles whose coordinates are made at a time
_WIDE = 1 << 15     # shingles that a comparison spreads out at a time
_FIRST, _SECOND, _A, _B = (np.uint64(v) for v in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F,
                                                  0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


# ---------------------------------------------------------------- sets

def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, shingle: int = 2, known: dict[bytes, int] | None = None) -> np.ndarray:
    """The set as sorted distinct hashes of ``shingle`` words each (fewer
    words: one hash of them all). ``bytes.split`` cuts at space and
    \\t \\n \\v \\f \\r."""
    words = (text or "").encode("utf-8").translate(_FOLD).split()
    if not words:
        return np.zeros(0, np.uint64)
    known = {} if known is None else known
    if len(known) > _WORDS:
        known.clear()

    def seen(w):
        h = known[w] = xxhash.xxh64_intdigest(w, SEED)
        return h

    h = np.fromiter((known[w] if w in known else seen(w) for w in words), np.uint64, len(words))
    wide = min(shingle, len(h))
    out = np.full(len(h) - wide + 1, wide, np.uint64) * _SECOND
    for i in range(wide):
        out = mix(out * _FIRST + h[i:len(h) - wide + 1 + i])
    return np.unique(out)


def permuted(x: np.ndarray) -> np.ndarray:
    """pi: a bijection of 32-bit words, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signature(s: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """The circulant signature: ``size`` minima of pi(sigma(s) + k). Adding
    wraps at 2^32: the shift goes around the circle."""
    place = permuted((s >> np.uint64(32)).astype(np.uint32) * np.uint32(0x9E3779B1) + np.uint32(SEED))    # sigma
    shift = np.arange(size, dtype=np.uint32)
    low = np.full(size, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(place), _SLICE):
        np.minimum(low, permuted(place[i:i + _SLICE, None] + shift).min(axis=0), out=low)
    return low


def bands(low: np.ndarray, rows: int = ROWS) -> list[int]:
    data, wide = low.astype("<u4").tobytes(), 4 * rows
    return [xxhash.xxh64_intdigest(data[i:i + wide], SEED + i) - (1 << 63) for i in range(0, len(data), wide)]


def signed(docs: DataFrame, shingle: int, text: str, key: str) -> DataFrame:
    """Written: uid, key, n (set size), c1 and c2 (128 bits that name the set),
    bands, z (the text)."""
    def run(batches):
        known: dict[bytes, int] = {}
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            n, c1, c2, found, z = [], [], [], [], []
            for t in (v.as_py() for v in batch.column("_text")):
                s = shingle_set(t, shingle, known)
                d = xxhash.xxh3_128_intdigest(s.astype("<u8").tobytes(), SEED)
                n.append(len(s))
                c1.append((d >> 64) - (1 << 63))
                c2.append((d & (1 << 64) - 1) - (1 << 63))
                found.append(bands(signature(s)) if len(s) else None)
                z.append(pack.compress(t.encode("utf-8")) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("key"), pa.array(n, pa.int64()), pa.array(c1, pa.int64()),
                 pa.array(c2, pa.int64()), pa.array(found, pa.list_(pa.int64())), pa.array(z, pa.binary())],
                names=["uid", "key", "n", "c1", "c2", "bands", "z"])

    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{key}`").cast("long").alias("key"),
                       F.col(f"`{text}`").alias("_text"))
    return written(rows.mapInArrow(run, "uid long, key long, n long, c1 long, c2 long, bands array<long>, z binary"),
                   "signatures")


# ---------------------------------------------------------------- comparisons

def similar(a: list[np.ndarray], b: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets of ``a`` (rows) and ``b`` (columns) have 100 * common >=
    percent * union. Sets are spread out over their shingles, _WIDE at a time, and
    multiplied; counts below 2^24 are exact in float32."""
    n = np.array([len(s) for s in a], np.int64)[:, None]
    m = np.array([len(s) for s in b], np.int64)[None, :]
    every, place = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    owner = np.repeat(np.arange(len(a) + len(b)), np.concatenate([n.ravel(), m.ravel()]))
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    common = np.zeros((len(a), len(b)), np.int64)
    cuts = np.searchsorted(place, np.arange(0, len(every) + _WIDE, _WIDE))
    for k, (i, j) in enumerate(zip(cuts, cuts[1:])):
        spread = np.zeros((len(a) + len(b), _WIDE), np.float32)
        spread[owner[i:j], place[i:j] - k * _WIDE] = 1
        common += (spread[:len(a)] @ spread[len(a):].T).astype(np.int64)
    return (100 * common >= percent * (n + m - common)) & (common > 0)


def common_size(a: np.ndarray, b: np.ndarray) -> int:
    at = np.searchsorted(a, b)
    return int((a[np.minimum(at, len(a) - 1)] == b).sum())


def unpacked(z: bytes, shingle: int, known: dict) -> np.ndarray:
    return shingle_set(zstandard.ZstdDecompressor().decompress(z).decode("utf-8"), shingle, known)


def _fits(a: str, b: str, percent: int):
    """Set sizes that allow the similarity."""
    return F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)


def star_links(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(u, v): the pairs (uid, hub) that are similar. A hub's members come in
    parts, each with the hub's text once."""
    parts = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts"))
    dealt = pairs.join(parts, "hub").select(
        "hub", "uid", F.pmod(F.xxhash64("uid"), F.col("parts")).alias("part"), F.lit(1).alias("kind"))
    dealt = written(dealt, "hub-members")
    hubs = dealt.select("hub", "part").distinct().withColumn("uid", F.col("hub")).withColumn("kind", F.lit(0))
    items = (dealt.unionByName(hubs).join(texts.select("uid", "z"), "uid").repartition("hub", "part")
             .sortWithinPartitions("hub", "part", "kind"))

    def run(batches):
        known: dict[bytes, int] = {}
        hub = np.zeros(0, np.uint64)
        for pdf in batches:
            u, v = [], []
            for r in pdf.itertuples():
                s = unpacked(r.z, shingle, known)
                if r.kind == 0:
                    hub = s
                    continue
                both = common_size(hub, s)
                if 100 * both >= percent * (len(hub) + len(s) - both):
                    u.append(r.uid)
                    v.append(r.hub)
            yield pd.DataFrame({"u": np.array(u, np.int64), "v": np.array(v, np.int64)})

    return written(items.mapInPandas(run, "u long, v long"), "star-links")


def spanning(p: np.ndarray, q: np.ndarray) -> list[int]:
    """Places of links that connect all that the links (p, q) connect, without
    a circle."""
    root, kept = {}, []

    def top(x):
        while root.get(x, x) != x:
            root[x] = x = root.get(root[x], root[x])
        return x

    for k, (a, b) in enumerate(zip(p.tolist(), q.tolist())):
        a, b = top(a), top(b)
        if a != b:
            root[max(a, b)] = min(a, b)
            kept.append(k)
    return kept


def open_links(members: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(u, v): links between groups (``root``) that buckets of ``members``
    (b, uid, n, root) hold, as spanning forests of the groups that meet."""
    count = F.count(F.lit(1))
    buckets = (members.groupBy("b", "root").agg(count.alias("n")).groupBy("b")
               .agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("n_main"),
                    F.sum("n").alias("n_all"), count.alias("n_groups")).where("n_groups > 1"))
    opened = written(members.join(buckets.select("b", "main"), "b").select("main", "b", "uid", "root"), "open-members")
    apart = F.col("root") != F.col("main")
    merged = (opened.select("main", "uid", "root").distinct().groupBy("main")
              .agg((F.count_if(apart) * count).alias("at_once")))
    meets = (buckets.groupBy("main").agg(F.sum((F.col("n_all") - F.col("n_main")) * F.col("n_all")).alias("apart"))
             .join(merged, "main").select("main", (F.col("at_once") <= F.col("apart")).alias("together")))
    meets = written(buckets.select("b", "main").join(meets, "main").select("b", "together"), "open-buckets")
    opened = written(opened.join(meets, "b").withColumn("b", F.when(~F.col("together"), F.col("b")))
                     .select("main", F.coalesce("b", F.lit(0)).alias("b"), "uid", "root").distinct(), "open-groups")
    parts = opened.groupBy("main", "b").agg(F.ceil(F.count_if(apart) / PART).alias("few"),
                                            F.ceil(F.count_if(~apart) / PART).alias("many"))
    h = F.xxhash64("uid")
    own = (opened.join(parts, ["main", "b"]).withColumn("is_main", ~apart)
           .withColumn("own", F.when(F.col("is_main"), F.col("few") + F.pmod(h, F.col("many")))
                       .otherwise(F.pmod(h, F.col("few")))))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("is_main"), F.col("few"))
                                 .otherwise(F.col("few") + F.col("many")) - 1))
    items = (own.withColumn("other", other)
             .select("main", "b", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
                     (F.col("own") > F.col("other")).alias("second"), "uid", "root"))
    key = ["main", "b", "p", "q"]
    items = (items.join(texts.select("uid", "z"), "uid").repartition(*key).sortWithinPartitions(*key, "second", "uid"))

    def meet(rows, known):
        sets = [unpacked(r.z, shingle, known) for r in rows]
        root = np.array([r.root for r in rows], np.int64)
        left = [i for i, r in enumerate(rows) if not r.second]
        right = [i for i, r in enumerate(rows) if r.second] if rows[0].p != rows[0].q else left
        if not left or not right:
            return []
        near = similar([sets[i] for i in left], [sets[i] for i in right], percent)
        near &= root[left][:, None] != root[right][None, :]
        i, j = np.nonzero(near)
        u, v = root[left][i], root[right][j]
        return [(int(u[k]), int(v[k])) for k in spanning(u, v)]

    def run(batches):
        known: dict[bytes, int] = {}
        rows = (r for pdf in batches for r in pdf.itertuples())
        for _, own in groupby(rows, key=lambda r: (r.main, r.b, r.p, r.q)):
            found = meet(list(own), known)
            if found:
                yield pd.DataFrame(found, columns=["u", "v"])

    return written(items.mapInPandas(run, "u long, v long"), "open-links")


# ---------------------------------------------------------------- the operator

def bucket_members(classes: DataFrame) -> DataFrame:
    """Written: b, uid, n, hub, hub_n of every bucket of two or more classes."""
    each = classes.select("uid", "n", F.explode("bands").alias("b"))
    shared = each.groupBy("b").agg(F.count(F.lit(1)).alias("company")).where("company > 1")
    members = written(each.join(shared, "b"), "buckets")
    company = members.groupBy("uid").agg(F.sum("company").alias("company"))
    hubs = (members.drop("company").join(company, "uid").groupBy("b")
            .agg(F.max_by(F.struct("uid", "n"), F.struct("company", "n", "uid")).alias("hub")))
    return written(members.join(hubs, "b").select("b", "uid", "n", F.col("hub.uid").alias("hub"),
                                                  F.col("hub.n").alias("hub_n")), "bucket-members")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, text: str = "text",
                    key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id), a row for each document."""
    rows = signed(docs, shingle, text, key)
    classes = written(rows.where("n > 0").groupBy("c1", "c2").agg(F.min("uid").alias("uid"), F.min("key").alias("least")),
                      "classes")
    members = bucket_members(rows.select("uid", "n", "bands").join(classes.select("uid"), "uid", "left_semi"))
    texts = written(rows.select("uid", "z").join(members.select("uid").distinct(), "uid", "left_semi"), "texts")

    pairs = members.where(F.col("uid") != F.col("hub")).where(_fits("n", "hub_n", percent))
    first = stars(star_links(pairs.select("uid", "hub").distinct(), texts, shingle, percent))
    groups = first.select(F.col("v").alias("uid"), "root")
    rooted = written(members.where(F.col("uid") != F.col("hub")).join(groups, "uid", "left")
                     .select("b", "uid", "n", F.coalesce("root", "uid").alias("root")), "rooted")
    then = stars(open_links(rooted, texts, shingle, percent)).select(F.col("v").alias("root"), F.col("root").alias("last"))
    label = (classes.join(groups, "uid", "left").withColumn("root", F.coalesce("root", "uid"))
             .join(then, "root", "left").withColumn("root", F.coalesce("last", "root")))
    label = written(label.select("c1", "c2", "root", "least"), "rooted-classes")
    named = written(label.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    label = written(label.join(named, "root").select("c1", "c2", "component_id"), "labels")
    found = rows.where("n > 0").select("c1", "c2", "key", "n").join(label, ["c1", "c2"])
    alone = rows.where("n = 0").select("key", "n", F.col("key").alias("component_id"))
    return (found.select("key", "n", "component_id").unionByName(alone)
            .select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id"))


def minhash_documents(docs: DataFrame) -> DataFrame:
    """The contract's digest: 2-word shingles at 80 %."""
    out = near_duplicates(docs.select("doc_id", "text"), shingle=2, percent=80)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
