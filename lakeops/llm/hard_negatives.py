"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Candidates are ordered along a Hilbert curve through the dimensions that spread
most and written as Parquet blocks: a row of the table is a block of up to
BLOCK near vectors with its zone map, the least and the largest value of every
dimension and of the label. Anchors are packed into groups in the same order.

For an anchor a and a block, interval arithmetic bounds every inner product:
from the sum of min(a_i lo_i, a_i hi_i) to the sum of max(a_i lo_i, a_i hi_i). Two
plans are made from zone maps alone:

* positives: the blocks that may hold the anchor's label and whose upper bound
  reaches its k-th best score inside its own block, known when that is written;
* negatives: the blocks that may hold another label and whose interval meets a
  window of the anchor, from LOW to HIGH hundredths of a positive's score.

A plan is a written list of cells (block, group, anchors). Blocks in no cell are
dropped before any shuffle; the others meet the groups of their cells, at most
MEET groups in one work item, and are scored exactly. A task keeps the best few of
each anchor or window, so a block hands on a bounded number of rows for each.

The curve's axes and scales come from about SAMPLE rows picked by a hash of the id;
they change which blocks are read and never the result. How much the bounds
leave out depends on the data: nothing among vectors without any structure.

Defined cases: rows with a NULL id or label, a NULL vector or a NULL or non-finite
component take no part, nor do empty vectors; only vectors of one length are
compared; rows equal in id, label and vector count once; an anchor's other rows
are those of another id, so an id with several rows is anchored by each of them;
an anchor without positives, or a window without rows, gives none; windows of
negative scores are empty; scores beyond a long count as the nearest long. Other columns of the
input are not read."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import written
from .hilbert import hilbert_keys
from .topk_search import valid, whole

BLOCK = 512             # candidates of a block
GROUP = 256             # anchors of a group
ZONES = 8192            # zone maps that a group is held against at a time
MEET = 32               # groups that meet a block in one work item
AXES, KEY_BITS = 16, 48
SAMPLE = 20_000
HELD = 500_000          # best rows that a task holds before it hands them on
LOW, HIGH = 50, 95      # hundredths of the positive's score
_LIMIT = 2 ** 63 - 1


# ---------------------------------------------------------------- packing

def to_bytes(m: np.ndarray) -> bytes:
    """A matrix of whole doubles in the narrowest type that holds it exactly."""
    top = np.abs(m).max(initial=0)
    kind = "h" if top < 1 << 15 else "f" if top <= 1 << 24 else "d"
    return kind.encode() + m.astype(np.dtype(kind)).tobytes()


def from_bytes(data: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(data, np.dtype(chr(data[0])), offset=1).reshape(-1, dim).astype(np.float64)


def curve(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """By length of vector: the axes, their low ends and cell widths, and the
    bits of an axis."""
    step = max(1, -(-rows.count() // SAMPLE))
    spread = (rows.where(F.pmod(F.xxhash64("id"), F.lit(step)) == 0).select("dim", F.posexplode("v").alias("i", "x"))
              .groupBy("dim", "i").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("sd")).collect())
    out = {}
    for dim in {r.dim for r in spread}:
        own = sorted((r for r in spread if r.dim == dim), key=lambda r: (-r.sd, r.i))[:AXES]
        bits = min(16, max(1, KEY_BITS // len(own)))
        sd = np.array([r.sd if np.isfinite(r.sd) and r.sd > 0 else 1.0 for r in own])
        mean = np.array([r["mean"] for r in own])
        out[dim] = (np.array([r.i for r in own]), mean - 2.5 * sd, 5 * sd / (1 << bits), bits)
    return out


def ordered(rows: DataFrame, k: int) -> DataFrame:
    """The written blocks: block, dim, n, ids, labels, m, the zone map (lo, hi,
    label_lo, label_hi) and the anchors in it with their k-th best score among
    the block's other rows of their label."""
    axes = curve(rows)

    def keyed(batches):
        for pdf in batches:
            pdf["key"] = np.int64(0)
            for dim, own in pdf.groupby("dim"):
                if dim in axes:
                    pick, start, width, bits = axes[dim]
                    m = np.stack(own["v"].to_numpy()).astype(np.float64)[:, pick]
                    cells = np.clip((m - start) / width, 0, (1 << bits) - 1).astype(np.int64)
                    pdf.loc[own.index, "key"] = hilbert_keys(cells, bits)
            yield pdf

    names = "block long, dim int, n int, ids binary, labels binary, m binary, lo binary, hi binary, " \
            "label_lo int, label_hi int, anchors array<struct<at int, seed long>>"

    def block(number, dim, part):
        v = np.stack([p[1] for p in part]).astype(np.float64)
        ids, labels = np.array([p[0] for p in part], np.int64), np.array([p[2] for p in part], np.int32)
        at = np.nonzero([p[3] for p in part])[0]
        score = masked(scores(v[at], v), (labels[at][:, None] == labels) & (ids[at][:, None] != ids))
        seeds = np.sort(score, axis=1)[:, -k] if score.shape[1] >= k else np.full(len(at), -np.inf)
        return {"block": number, "dim": dim, "n": len(part), "ids": ids.tobytes(), "labels": labels.tobytes(),
                "m": to_bytes(v), "lo": to_bytes(v.min(axis=0)), "hi": to_bytes(v.max(axis=0)),
                "label_lo": int(labels.min()), "label_hi": int(labels.max()),
                "anchors": [{"at": int(a), "seed": int(s) if np.isfinite(s) else None} for a, s in zip(at, seeds)]}

    def run(batches):
        number, dim, part = None, None, []
        for pdf in batches:
            if number is None:
                number = int(pdf["part"].iloc[0]) << 32
            for d, i, v, l, a in zip(pdf["dim"], pdf["id"], pdf["v"], pdf["label"], pdf["is_anchor"]):
                if part and (d != dim or len(part) == BLOCK):
                    yield pd.DataFrame([block(number, dim, part)])
                    number, part = number + 1, []
                dim = d
                part.append((i, v, l, a))
        if part:
            yield pd.DataFrame([block(number, dim, part)])

    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // (64 * BLOCK)))
    order = ["dim", "label", "key", "id", "tie"]
    dealt = (rows.mapInPandas(keyed, "id long, label int, v array<double>, dim int, is_anchor boolean, key long")
             .withColumn("tie", F.xxhash64("v")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
             .withColumn("part", F.spark_partition_id()))
    return written(dealt.mapInPandas(run, names), "candidate-blocks")


def anchor_groups(blocks: DataFrame) -> DataFrame:
    """grp, dim, ids, labels, seeds, m: up to GROUP anchors each, in the
    order of the blocks they stand in."""
    def taken(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                m, ids = from_bytes(r.m, r.dim), np.frombuffer(r.ids, np.int64)
                labels = np.frombuffer(r.labels, np.int32)
                out += [(r.dim, r.block, a["at"], ids[a["at"]], labels[a["at"]], a["seed"], to_bytes(m[a["at"]]))
                        for a in r.anchors]
            yield pd.DataFrame(out, columns=["dim", "block", "at", "id", "label", "seed", "v"]).astype(
                {"seed": "Int64"})

    def run(batches):
        number, part = None, []

        def group():
            m = np.concatenate([from_bytes(p.v, p.dim) for p in part])
            return pd.DataFrame([{"grp": number, "dim": part[0].dim, "ids": [int(p.id) for p in part],
                                  "labels": [int(p.label) for p in part], "m": to_bytes(m),
                                  "seeds": [None if pd.isna(p.seed) else int(p.seed) for p in part]}])

        for pdf in batches:
            if number is None:
                number = int(pdf["part"].iloc[0]) << 32
            for p in pdf.itertuples():
                if part and (p.dim != part[0].dim or len(part) == GROUP):
                    yield group()
                    number, part = number + 1, []
                part.append(p)
        if part:
            yield group()

    rows = written(blocks.where(F.size("anchors") > 0).select("block", "dim", "ids", "labels", "m", "anchors")
                   .mapInPandas(taken, "dim int, block long, at int, id long, label int, seed long, v binary"), "anchors")
    order = ["dim", "block", "at"]
    parts = max(1, -(-rows.count() // (8 * GROUP)))
    dealt = (rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
             .withColumn("part", F.spark_partition_id()))
    return written(dealt.mapInPandas(run, "grp long, dim int, ids array<long>, labels array<int>, m binary, "
                                          "seeds array<long>"), "anchor-groups")


# ---------------------------------------------------------------- scores and bounds

def scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of all pairs, as int64; one matrix product where
    every sum is below 2^53, else in Python numbers."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, a.shape[1])
    if top < 1 << 53:
        return (a @ x.T).astype(np.int64)
    to_int = np.frompyfunc(int, 1, 1)
    exact = to_int(a) @ to_int(x).T
    return np.clip(exact, -_LIMIT - 1, _LIMIT).astype(np.int64)


def masked(score: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Scores as doubles or Python numbers with -inf outside ``keep``."""
    kind = np.float64 if np.abs(score.astype(np.float64)).max(initial=0) < 1 << 53 else object
    return np.where(keep, score.astype(kind), -np.inf)


def intervals(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds (least, largest) of the inner products of each row of ``a`` with
    any vector between the rows of ``lo`` and ``hi``, rounding included."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    least, largest = up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T
    room = 1e-9 * (np.abs(a) @ np.maximum(np.abs(lo), np.abs(hi)).T) + 0.5
    return least - room, largest + room


def best(key: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int):
    """The k first rows of each key: high scores first, then small ids."""
    order = np.lexsort((ids, ~score, key))      # ~s orders longs downwards
    key, score, ids = key[order], score[order], ids[order]
    keep = np.arange(len(key)) - np.searchsorted(key, key, side="left") < k
    return key[keep], score[keep], ids[keep]


def top_of(score: np.ndarray, keep: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k best kept scores of each row, and their ties."""
    s = masked(score, keep)
    if s.shape[1] > k:
        keep = keep & (s >= np.partition(s, -k, axis=1)[:, -k][:, None])
    return np.nonzero(keep)


# ---------------------------------------------------------------- plans

def zone_chunks(blocks: DataFrame) -> DataFrame:
    """Written: dim, chunk and the zone maps of about ZONES blocks, dealt out
    by a hash of the block; their order does not matter here."""
    zone = F.struct("block", "label_lo", "label_hi", "lo", "hi")
    chunk = F.pmod(F.xxhash64("block"), F.lit(max(1, -(-blocks.count() // ZONES))))
    return written(blocks.groupBy("dim", chunk.alias("chunk")).agg(F.collect_list(zone).alias("zones")), "zone-maps")


def plan(groups: DataFrame, chunks: DataFrame, needed, name: str) -> DataFrame:
    """The written cells (block, grp, at). ``needed`` takes a group's row, the
    bounds (least, largest) and the blocks' label ranges, and marks the
    anchors (rows) that must read a block (column)."""
    key = ["dim", "chunk", "salt"]
    theirs = (groups.join(chunks.select("dim", "chunk"), "dim").withColumn("salt", F.pmod("grp", F.lit(MEET)))
              .withColumn("kind", F.lit(1)))
    ours = chunks.join(theirs.select(*key).distinct(), ["dim", "chunk"]).withColumn("kind", F.lit(0))
    both = (ours.unionByName(theirs, allowMissingColumns=True).repartition(*key)
            .sortWithinPartitions(*key, "kind", "grp"))

    def run(batches):
        for r in (r for pdf in batches for r in pdf.itertuples()):
            if r.kind == 0:
                block = np.array([z["block"] for z in r.zones], np.int64)
                low, high = (np.array([z[c] for z in r.zones], np.int64) for c in ("label_lo", "label_hi"))
                lo, hi = (np.concatenate([from_bytes(z[c], r.dim) for z in r.zones]) for c in ("lo", "hi"))
                continue
            least, largest = intervals(from_bytes(r.m, r.dim), lo, hi)
            need = needed(r, least, largest, low, high)
            some = np.nonzero(need.any(axis=0))[0]
            if len(some):
                yield pd.DataFrame({"block": block[some], "grp": r.grp,
                                    "at": [np.nonzero(need[:, j])[0].astype(np.int32) for j in some]})

    return written(both.mapInPandas(run, "block long, grp long, at array<int>"), name)


def cells_scored(cells: DataFrame, groups: DataFrame, blocks: DataFrame, found, key: list[str], k: int,
                 name: str) -> DataFrame:
    """The written best k rows (key, id, score) of every key: the blocks of
    ``cells`` meet their groups, ``found`` returns (keys, scores, ids) of one meeting,
    its keys as rows of whole numbers."""
    meets = F.pmod("grp", F.lit(max(1, -(-groups.count() // MEET))))
    cells = cells.withColumn("salt", meets)
    theirs = cells.join(groups.drop("dim", "seeds"), "grp").withColumn("kind", F.lit(1))
    ours = (blocks.select("block", "dim", F.col("ids").alias("b_ids"), F.col("labels").alias("b_labels"),
                          F.col("m").alias("b_m"))
            .join(cells.select("block", "salt").distinct(), "block").withColumn("kind", F.lit(0)))
    items = (ours.unionByName(theirs, allowMissingColumns=True).repartition("block", "salt")
             .sortWithinPartitions("block", "salt", "kind", "grp"))
    schema = ", ".join(f"{c} long" for c in [*key, "id", "score"])

    def run(batches):
        held: list = []
        count, columns = 0, len(key)

        def compact():
            keys = np.concatenate([h[0] for h in held])
            names, place = np.unique(keys, axis=0, return_inverse=True)
            at, score, ids = best(place.ravel(), *(np.concatenate([h[c] for h in held]) for c in (1, 2)), k)
            return names[at], score, ids

        def out(keys, score, ids):
            return pd.DataFrame({**{c: keys[:, i] for i, c in enumerate(key)}, "id": ids, "score": score})

        for r in (r for pdf in batches for r in pdf.itertuples()):
            if r.kind == 0:
                dim, ids = int(r.dim), np.frombuffer(r.b_ids, np.int64)
                labels, x = np.frombuffer(r.b_labels, np.int32), from_bytes(r.b_m, dim)
                continue
            keys, score, who = found(r, np.asarray(r.at), from_bytes(r.m, dim), x, ids, labels)
            if len(keys):
                held.append((keys.reshape(-1, columns), score, who))
                count += len(keys)
            if count > HELD:
                held, count = [compact()], 0
                count = len(held[0][1])
                if count > HELD // 2:
                    yield out(*held[0])
                    held, count = [], 0
        if held:
            yield out(*compact())

    every = written(items.mapInPandas(run, schema), f"{name}-parts")
    rank = Window.partitionBy(*key).orderBy(F.col("score").desc(), "id")
    return written(every.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k), name)


# ---------------------------------------------------------------- the operator

def _positives_needed(r, least, largest, low, high):
    label = np.asarray(r.labels, np.int64)[:, None]
    seed = np.array([-np.inf if s is None or s != s else float(s) for s in r.seeds])[:, None]
    return (low <= label) & (label <= high) & (largest >= seed)


def windows(r) -> list[tuple[int, int, int, int]]:
    """(anchor, place of the positive, least score, largest score) of the
    windows that can hold a score."""
    return [(w["at"], w["place"], -(-LOW * w["score"] // 100), HIGH * w["score"] // 100)
            for w in r.windows if w["score"] >= 0]


def _negatives_needed(r, least, largest, low, high):
    need = np.zeros(least.shape, bool)
    for at, _, a, b in windows(r):
        need[at] |= (largest[at] >= a) & (least[at] <= b)
    label = np.asarray(r.labels, np.int64)[:, None]
    return need & ~((low == label) & (high == label))


def hard_negatives(df: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, id_col: str = "vec_id",
                   vector_col: str = "vector", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score):
    for the rows that ``is_anchor`` picks, their nearest rows of the same label and
    for each the best rows of other labels inside its window of scores.
    ``vector_col`` holds whole numbers as doubles."""
    v = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    rows = (df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"), v.alias("v"),
                      F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull()).where(valid(F.col("v")))
            .withColumn("dim", F.size("v")).where("dim > 0").select("id", "label", "v", "dim", "is_anchor").distinct())
    blocks = ordered(written(rows, "candidates"), positives)
    groups, chunks = anchor_groups(blocks), zone_chunks(blocks)

    def same_label(r, at, m, x, ids, labels):
        score, own = scores(m[at], x), np.asarray(r.labels)[at][:, None]
        i, j = top_of(score, (labels == own) & (ids != np.asarray(r.ids)[at][:, None]), positives)
        return np.stack([np.full(len(i), r.grp), at[i]], axis=1).astype(np.int64), score[i, j], ids[j]

    near = cells_scored(plan(groups, chunks, _positives_needed, "positive-plan"), groups, blocks, same_label,
                        ["grp", "at"], positives, "positives")
    listed = near.groupBy("grp").agg(F.collect_list(F.struct(
        F.col("at").cast("int").alias("at"), F.col("rank").alias("place"), "score")).alias("windows"))
    windowed = written(groups.drop("seeds").join(listed, "grp"), "windowed-groups")

    def in_window(r, at, m, x, ids, labels):
        where = {a: i for i, a in enumerate(at.tolist())}
        score, own = scores(m[at], x), np.asarray(r.labels)[at][:, None]
        other = (labels != own) & (ids != np.asarray(r.ids)[at][:, None])
        found = [w for w in windows(r) if w[0] in where]
        if not found:
            return np.zeros((0, 3), np.int64), np.zeros(0, np.int64), ids[:0]
        row = np.array([where[w[0]] for w in found])
        w = np.array(found, dtype=np.int64)
        s = score[row]
        i, j = top_of(s, other[row] & (s >= w[:, 2:3]) & (s <= w[:, 3:4]), negatives)
        return np.stack([np.full(len(i), r.grp, np.int64), w[i, 0], w[i, 1]], axis=1), s[i, j], ids[j]

    hard = cells_scored(plan(windowed, chunks, _negatives_needed, "negative-plan"), windowed, blocks, in_window,
                        ["grp", "at", "place"], negatives, "negatives")
    anchors = groups.select("grp", F.posexplode("ids").alias("at", "anchor_id"))
    positive = near.select("grp", "at", F.col("rank").cast("long").alias("place"), F.col("id").alias("positive_id"),
                           F.col("score").alias("positive_score"))
    return (hard.join(positive, ["grp", "at", "place"]).join(anchors, ["grp", "at"])
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


def mined(embeddings: DataFrame) -> DataFrame:
    """The contract's search: floor(256 x), labels shifted where the id is
    divisible by 7, anchors where it is divisible by 50."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.select("vec_id", label.alias("label"), F.transform(
        F.col("embedding"), lambda x: whole(x.cast("double") * 256)).alias("vector"))
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)
