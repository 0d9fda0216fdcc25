"""SimHash near-duplicates: fingerprints, exact links within a few bits, and
the groups they form.

Links come from vantage-point trees. A tree looks at some bits only and, level
by level, deals fingerprints out by their Hamming distance (on those bits) to
the level's vantage point; its leaves are the shards. That distance never
exceeds the whole one, so by the triangle bound a fingerprint's links within
radius r lie in children whose distance differs by at most r. The trees'
bit sets are chosen so that two fingerprints with at most ``max_bits``
differing bits agree on all bits of some tree: cut 64 bits into b > max_bits
blocks and give every choice of b - max_bits blocks a tree. In that tree r is 0,
no shard beyond a fingerprint's own has to be searched, and the pair is met
in it. Inside a shard a vantage-point tree on all 64 bits goes on with radius
``max_bits``: each branch is searched by itself, and of the neighbouring branch
the fingerprints in the overlap around the border (``near_pairs``); a shard that is cut
into work items is cut by the same bound (``work_items``).

Fewer blocks mean fewer copies of each fingerprint but larger shards;
``tree_masks`` takes the number that makes least work for the number of
distinct fingerprints, with the same links for each. Equal fingerprints are one
vertex. A shard over ``CHUNK`` fingerprints is cut into chunks by distance, each pair of
chunks in reach of another a work item of its own, and an item returns a spanning star of
each group it finds (at most one link per fingerprint), never all its pairs.

Defined cases: NULL and wordless texts have fingerprint zero and link like any
other; a NULL doc_id is no component's id unless all of the component's are
NULL; repeated rows share a component; an empty table gives no rows."""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import written
from .components import stars

SEED = 42
CHUNK = 4096        # fingerprints of a shard that one work item compares with as many
LEVELS = 8          # vantage points of a tree
LEAF = 256          # fingerprints of a branch that are compared with as many outright
HELD = 1 << 20      # links that an item holds before it folds them into labels
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SLICE = 1 << 16    # shingles whose bits are counted at a time


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash over word shingles, repeats included. ``bytes.split`` cuts at
    space and \\t \\n \\v \\f \\r, the contract's white space."""
    words = (text or "").encode("utf-8").translate(_FOLD).split()
    if not words:
        return 0
    data, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[-n:] - 1).tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for i in range(0, n, _SLICE):
        h = np.array([digest(data[s:e], SEED) for s, e in zip(starts[i:i + _SLICE], stops[i:i + _SLICE])],
                     dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << b for b in range(64) if 2 * counts[b] > n))


def fingerprints(docs: DataFrame, shingle: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fp): fp is the fingerprint's 64 bits as a long."""
    def run(batches):
        for pdf in batches:
            fp = np.array([fingerprint(t, shingle) for t in pdf["_text"]], dtype=np.uint64)
            yield pd.DataFrame({"key": pdf["_key"].astype("Int64"), "fp": fp.view(np.int64)})

    rows = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
    return rows.mapInPandas(run, "key long, fp long").withColumnRenamed("key", key)


# ---------------------------------------------------------------- shards

def tree_masks(n: int, max_bits: int) -> list[int]:
    """The bits that each tree looks at, for ``n`` distinct fingerprints."""
    def work(b):
        trees, bits = comb(b, max_bits), 64 * (b - max_bits) // b
        return trees * n * (50 + n / 2 ** bits)     # dealing out costs about 50 comparisons

    b = min(range(max_bits + 1, max_bits + 5), key=work)
    cuts = [64 * i // b for i in range(b + 1)]
    blocks = [(1 << cuts[i + 1]) - (1 << cuts[i]) for i in range(b)]
    return [sum(c) for c in combinations(blocks, b - max_bits)]


def vantage_points(tree: int) -> list[int]:
    return [xxhash.xxh64_intdigest(f"{tree}:{level}", SEED) for level in range(LEVELS)]


def _long(bits: int) -> Column:
    return F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("long")


def shards(points: DataFrame, masks: list[int]) -> DataFrame:
    """(tree, leaf, fp): the shard of every fingerprint in every tree. A leaf
    is the path of distances to the tree's vantage points."""
    def leaf(tree, mask):
        at = F.lit(0).cast("long")
        for v in vantage_points(tree):
            at = at * 64 + F.bit_count(F.col("fp").bitwiseXOR(_long(v)).bitwiseAND(_long(mask)))
        return F.struct(F.lit(tree).alias("tree"), at.alias("leaf"))

    return (points.select("fp", F.explode(F.array(*[leaf(i, m) for i, m in enumerate(masks)])).alias("s"))
            .select("s.tree", "s.leaf", "fp"))


def work_items(sharded: DataFrame, max_bits: int = 4) -> DataFrame:
    """(tree, leaf, a, b, fp, second): shards of two or more. One of up to CHUNK
    fingerprints is the item (0, 0). A larger one is ordered by the distance to a
    vantage point on all 64 bits and cut into chunks; the item (a, a) is a chunk by
    itself, the item (a, b) what ``a`` and ``b`` (``second``) have in the other's
    reach: by the triangle bound a fingerprint at distance d is sent only to chunks
    that hold distances from d - max_bits to d + max_bits. A distance with over
    CHUNK fingerprints fills several chunks, dealt by a hash."""
    key = ["tree", "leaf"]
    sized = sharded.join(sharded.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), key)
    small = sized.where(F.col("n") <= CHUNK).select(
        *key, F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), "fp", F.lit(False).alias("second"))
    away = F.bit_count(F.col("fp").bitwiseXOR(_long(xxhash.xxh64_intdigest("chunks", SEED))))
    large = sized.where(F.col("n") > CHUNK).select(*key, "fp", away.alias("d"))
    shard = Window.partitionBy(*key).orderBy("d")       # at most 65 rows of a shard
    near = shard.rangeBetween(-max_bits, max_bits)
    cells = (large.groupBy(*key, "d").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("start", F.sum("n").over(shard) - F.col("n"))
             .withColumn("first", F.floor(F.col("start") / CHUNK))
             .withColumn("last", F.floor((F.col("start") + F.col("n") - 1) / CHUNK))
             .withColumn("low", F.min("first").over(near)).withColumn("high", F.max("last").over(near)))
    dealt = (large.join(cells, [*key, "d"])
             .withColumn("own", F.floor((F.col("start") + F.pmod(F.xxhash64("fp"), F.col("n"))) / CHUNK))
             .withColumn("other", F.explode(F.sequence("low", "high"))))
    return small.unionByName(dealt.select(*key, F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"),
                                          "fp", (F.col("own") > F.col("other")).alias("second")))


def near_pairs(x: np.ndarray, a: np.ndarray, b: np.ndarray | None, max_bits: int, compared: list | None = None):
    """(p, q): places in ``x`` of all pairs within ``max_bits`` among the places ``a``,
    or between ``a`` and ``b``, in parts. A vantage-point tree: what lies up to the
    median distance to a vantage point and what lies beyond are searched each by
    itself, and of pairs across only those in the overlap of ``max_bits`` around
    the border, as no others can be near. ``compared`` collects the pairs looked at."""
    def ball(places, v):
        return np.bitwise_count(x[places] ^ x[v]).astype(np.int16)

    def compare(a, b):
        same = b is None
        for i in range(0, len(a), LEAF):
            rows, cols = a[i:i + LEAF], a[i:] if same else b
            p, q = np.nonzero(np.bitwise_count(x[rows][:, None] ^ x[cols][None]) <= max_bits)
            if compared is not None:
                compared.append(len(rows) * len(cols))
            keep = p < q if same else slice(None)
            yield rows[p[keep]], cols[q[keep]]

    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        if not len(a) or b is not None and not len(b):
            continue
        if len(a) * len(a if b is None else b) <= LEAF * LEAF:
            yield from compare(a, b)
        elif b is None:
            d = ball(a, a[len(a) // 2])
            cut = int(np.median(d))
            inside, outside = a[d <= cut], a[d > cut]
            if not len(outside):            # no distance above the median: split below it
                cut = int(d.max()) - 1
                inside, outside = a[d <= cut], a[d > cut]
            if not len(inside):             # all equally far
                yield from compare(a, None)
                continue
            todo += [(inside, None), (outside, None),
                     (a[(d <= cut) & (d > cut - max_bits)], a[(d > cut) & (d <= cut + max_bits)])]
        else:
            v = (a if len(a) >= len(b) else b)[0]
            d, e = ball(a, v), ball(b, v)
            cut = int(np.median(np.concatenate([d, e])))
            parts = [(a[d <= cut], b[e <= cut]), (a[d > cut], b[e > cut]),
                     (a[(d <= cut) & (d > cut - max_bits)], b[(e > cut) & (e <= cut + max_bits)]),
                     (a[(d > cut) & (d <= cut + max_bits)], b[(e <= cut) & (e > cut - max_bits)])]
            if any(len(p) == len(a) and len(q) == len(b) for p, q in parts):
                yield from compare(a, b)    # the vantage point tells nothing apart
            else:
                todo += parts


def local_links(x: np.ndarray, max_bits: int, second: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star (point, root) of every group that links within ``max_bits``
    form among the fingerprints ``x`` (uint64), or between those marked ``second`` and
    the others. Links are folded into labels as they come, so that a group
    in which all are near never stands in memory as pairs."""
    root, ps, qs, held = np.arange(len(x)), [], [], 0

    def folded():
        p, q = np.concatenate([*ps, np.arange(len(x))]), np.concatenate([*qs, root])
        label = np.arange(len(x))
        while True:
            low = np.minimum(label[p], label[q])
            new = label.copy()
            np.minimum.at(new, p, low)
            np.minimum.at(new, q, low)
            new = new[new]
            if (new == label).all():
                return label
            label = new

    every = np.arange(len(x))
    a, b = (every, None) if second is None or not second.any() else (every[~second], every[second])
    for p, q in near_pairs(x, a, b, max_bits):
        ps.append(p)
        qs.append(q)
        held += len(p)
        if held > HELD:
            root, ps, qs, held = folded(), [], [], 0
    if held:
        root = folded()
    linked = np.nonzero(root != every)[0]
    return x[linked], x[root[linked]]


def links(points: DataFrame, max_bits: int, n: int) -> DataFrame:
    """(u, v): links that connect exactly what all links within ``max_bits``
    connect, for distinct fingerprints ``points`` (fp), ``n`` of them."""
    key = ["tree", "leaf", "a", "b"]

    def run(batches):
        """Items arrive sorted; only the last item of a batch may go on."""
        rest = None

        def compared(pdf, cuts):
            fp, second = pdf["fp"].to_numpy().view(np.uint64), pdf["second"].to_numpy()
            found = [local_links(fp[i:j], max_bits, second[i:j]) for i, j in zip(cuts, cuts[1:]) if j - i > 1]
            u, v = (np.concatenate([fp[:0], *z]) for z in (zip(*found) if found else ([], [])))
            return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            k = pdf[key].to_numpy()
            cuts = [0, *(np.nonzero((k[1:] != k[:-1]).any(axis=1))[0] + 1).tolist()]
            rest = pdf.iloc[cuts[-1]:]
            if len(cuts) > 1:
                yield compared(pdf, cuts)
        if rest is not None:
            yield compared(rest, [0, len(rest)])

    items = work_items(shards(points, tree_masks(n, max_bits)), max_bits)
    return (items.repartition(*key).sortWithinPartitions(*key, "fp")
            .mapInPandas(run, "u long, v long"))


def grouped(fps: DataFrame, max_bits: int, key: str) -> DataFrame:
    """``fps`` (key, fp; written) plus ``root``, a fingerprint that names the
    component, and ``component_id``: the smallest key reachable over links of at
    most ``max_bits`` differing bits."""
    points = written(fps.groupBy("fp").agg(F.min(key).alias("least")), "points")
    found = stars(links(points.select("fp"), max_bits, points.count()))
    rooted = (points.join(found.select(F.col("v").alias("fp"), "root"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    named = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    label = written(rooted.join(named, "root").select("fp", "root", "component_id"), "labels")
    return fps.join(label, "fp")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, text: str = "text",
                    key: str = "doc_id") -> DataFrame:
    """(key, fp, component_id), a row for each document."""
    fps = written(fingerprints(docs, shingle, text, key), "fingerprints")
    return grouped(fps, max_bits, key).select(key, "fp", "component_id")


def representatives(docs: DataFrame, shingle: int = 4, max_bits: int = 4, text: str = "text",
                    key: str = "doc_id") -> DataFrame:
    """One row of ``docs``, unchanged, of each component: the one with the
    smallest key, of equal keys the one of smallest fingerprint, of rows equal in
    both any one that hashes lowest."""
    def run(batches):
        for batch in batches:
            texts = batch.column("row").field(text_at)
            fp = np.array([fingerprint(t.as_py(), shingle) for t in texts], dtype=np.uint64)
            yield batch.append_column("fp", pa.array(fp.view(np.int64)))

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    text_at, wrapped = docs.columns.index(text), docs.select(row.alias("row"))
    rows = written(wrapped.mapInArrow(run, T.StructType([*wrapped.schema.fields, T.StructField("fp", T.LongType())])),
                   "documents-fingerprinted", compression="zstd")
    own = F.col(f"row.`{key}`")
    first = (grouped(rows.select(own.cast("long").alias("key"), "fp"), max_bits, "key").groupBy("root")
             .agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "fp")).alias("first"))
             .select(F.coalesce(F.col("first.key").cast("string"), F.lit("null")).alias("name"), "first.fp"))
    one = Window.partitionBy("name", "fp").orderBy(F.xxhash64("row"))
    return (rows.withColumn("name", F.coalesce(own.cast("long").cast("string"), F.lit("null")))
            .join(first, ["name", "fp"]).withColumn("place", F.row_number().over(one)).where("place = 1")
            .select("row.*"))


def simhash_documents(docs: DataFrame) -> DataFrame:
    out = near_duplicates(docs.select("doc_id", "text"), shingle=4, max_bits=4)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
