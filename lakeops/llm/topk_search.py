"""Exact top-k by inner product, pruned with multi-resolution segment
statistics.

A vector is cut into segments; a segment keeps its mean and its deviation. For
segments of length m the squared distance of q and x is at least the sum of
m * ((mean_q - mean_x)^2 + (dev_q - dev_x)^2), which with both norms gives an
upper bound of the inner product: sum of m * (mean_q * mean_x + dev_q * dev_x).
Vectors are first turned by an orthogonal basis, which leaves inner products as
they are: the eigenvectors of the second moments of about SAMPLE rows picked by a
hash, in falling order, so that segments hold components of like size. The
basis decides how much the bounds leave out and never the result.

Candidates are written once as blocks of near vectors, in the order of a Hilbert
curve through the leading turned components. A block has a zone map, the least and
the largest of each of the finest level's statistics over its rows, and each
query in it starts from its k-th best score there. Then, coarse to fine:

* a group of queries is held against all zone maps: interval arithmetic bounds
  every score in a block, and blocks that no query of the group needs are not sent to
  it (``plan``);
* where a block arrives, queries that its zone map rules out leave it out, with
  the k-th best score that they have by then;
* the bounds of 1, 4, 16 and 32 segments are tried on the pairs that are left, each on the
  queries and candidates with any pair left, and survivors are scored exactly on the
  untouched whole numbers.

A work item holds up to GROUP queries and streams through its share of the
blocks that the group needs, best bounds first. A candidate is so sent once for GROUP
queries, packed, and never for each of them; memory is bounded by the group and the
block. The items' answers (k rows for each query and share) are merged by a rank per
query. What the bounds leave out depends on the data: next to nothing
among vectors without structure.

Defined cases: vectors that are NULL, hold NULL or non-finite components or have
no id take no part; an empty vector scores 0 with other empty ones; only
vectors of one length are compared; a candidate with the query's own id
is the query's own row; rows that repeat (id, vector) count once, and an id
with several vectors is answered by its best scores over them; an empty table
gives no rows. Scores beyond a long are reported as the nearest long. Other
columns of the input are not read."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import written
from .hilbert import hilbert_keys

LEVELS = (1, 4, 16, 32)      # segments, coarse to fine
BLOCK = 512                  # candidates of a block
GROUP = 8192                 # queries of a work item, fewer where they are long
GROUP_BYTES = 4 << 20
QUERIES = 1024               # queries of a group that meet a block at a time
SHARE_ROWS = 1 << 16         # candidates that a work item streams through, where there are so many
ZONES = 1024                 # zone maps that a group is held against at a time
SALTS = 8                    # parts into which the groups that meet a zone chunk are dealt
SAMPLE = 4096
AXES, KEY_BITS = 16, 48      # of the curve
SAFE = float(1 << 22)        # components up to this multiply exactly in float64


# ---------------------------------------------------------------- packing

def pack(m: np.ndarray) -> bytes:
    """A matrix of whole doubles in the narrowest type that holds it exactly."""
    top = np.abs(m).max(initial=0)
    kind = "h" if top < 1 << 15 else "f" if top <= 1 << 24 else "d"
    return kind.encode() + m.astype(np.dtype(kind)).tobytes()


def unpack(data: bytes, n: int) -> np.ndarray:
    flat = np.frombuffer(data, np.dtype(chr(data[0])), offset=1).astype(np.float64)
    return flat.reshape(n, len(flat) // max(1, n))


# ---------------------------------------------------------------- bounds

def bound_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose inner products bound those of the rows of ``x`` from above:
    scaled means and deviations of about equal segments."""
    cuts = np.linspace(0, x.shape[1], segments + 1).astype(int)
    cols = []
    for a, b in zip(cuts, cuts[1:]):
        part = x[:, a:b]
        root = np.sqrt(max(1, b - a))
        mean = part.mean(axis=1) if b > a else np.zeros(len(x))
        dev = np.sqrt(((part - mean[:, None]) ** 2).mean(axis=1)) if b > a + 1 else np.zeros(len(x))
        cols += [root * mean, root * dev]
    return np.stack(cols, axis=1)


def zone_bounds(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The largest inner product of each row of ``q`` with any row between the
    rows of ``lo`` and ``hi``, rounding included."""
    room = 1e-9 * (np.abs(q) @ np.maximum(np.abs(lo), np.abs(hi)).T) + 1e-6
    return np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T + room


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row-wise integer inner products of two equally long lists of rows."""
    top = max(np.abs(q).max(initial=0), np.abs(x).max(initial=0))
    if top <= SAFE:
        return np.einsum("ij,ij->i", q, x).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(r, s)) for r, s in zip(q, x)]
    return np.array([min(max(v, -2 ** 63), 2 ** 63 - 1) for v in exact], dtype=np.int64)


def basis(sample: np.ndarray) -> np.ndarray:
    """An orthogonal matrix whose columns are the sample's main directions
    about zero, strongest first; the identity where that can't be computed."""
    d = sample.shape[1]
    scale = np.abs(sample).max(initial=0)
    if not d or not scale:
        return np.eye(d)
    x = sample / scale
    return np.linalg.eigh(x.T @ x)[1][:, ::-1].copy()


class TopK:
    """The best k candidates of each query of a group, over a stream of
    candidate blocks. ``floor`` holds scores that k rows are known to reach."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, turn: np.ndarray, floor: np.ndarray):
        self.ids, self.q, self.k, self.turn, self.floor = ids, vectors, k, turn, floor
        turned = vectors @ turn
        self.features = [bound_features(turned, s) for s in LEVELS]
        self.norm = np.sqrt((vectors * vectors).sum(axis=1))
        n = len(ids)
        self.score = np.zeros((n, k), dtype=np.int64)
        self.vec = np.zeros((n, k), dtype=np.int64)
        self.real = np.full((n, k), False)
        self.pairs = self.scored = 0        # offered, and scored exactly

    def threshold(self, at: slice) -> np.ndarray:
        """A candidate below this score can't enter a query's k best."""
        full = self.real[at].all(axis=1)
        return np.maximum(self.floor[at], np.where(full, self.score[at].min(axis=1).astype(float), -np.inf))

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        turned, norm = x @ self.turn, np.sqrt((x * x).sum(axis=1))
        theirs = [bound_features(turned, s) for s in LEVELS]
        lo, hi = theirs[-1].min(axis=0, keepdims=True), theirs[-1].max(axis=0, keepdims=True)
        for i in range(0, len(self.ids), QUERIES):
            at = slice(i, min(i + QUERIES, len(self.ids)))
            self.pairs += (at.stop - at.start) * len(ids)
            limit = self.threshold(at)
            # bounds that overflow compare as not below the limit
            need = np.nonzero(~(zone_bounds(self.features[-1][at], lo, hi)[:, 0] < limit))[0]
            self.meet(at.start + need, limit[need], ids, x, theirs, norm)

    def meet(self, rows: np.ndarray, limit: np.ndarray, ids, x, theirs, norm) -> None:
        """Offer the candidates to the queries ``rows`` level by level."""
        cols = np.arange(len(ids))
        alive = ids[None, :] != self.ids[rows][:, None]
        for mine, other in zip(self.features, theirs):
            if not alive.any():
                return
            r, c = alive.any(axis=1), alive.any(axis=0)
            rows, limit, cols, alive = rows[r], limit[r], cols[c], alive[np.ix_(r, c)]
            # rounding of the bound and the score stays far below this margin
            margin = 1e-9 * np.outer(self.norm[rows], norm[cols]) + 1e-6
            alive &= ~(mine[rows] @ other[cols].T + margin < limit[:, None])
        self.scored += int(alive.sum())
        r, c, score = self.survivors(rows, alive, limit, ids[cols], x[cols])
        self.merge(rows, r, ids[cols][c], score)

    def survivors(self, rows, alive, limit, ids, x):
        """Exact scores of the pairs still alive, and of those only the ones
        that may enter: above the k-th best, or equal with a smaller id. Where
        most pairs are left, one matrix product scores them all."""
        q = self.q[rows]
        if alive.mean() > 1 / 8 and max(np.abs(q).max(initial=0), np.abs(x).max(initial=0)) <= SAFE:
            every = np.where(alive, q @ x.T, -np.inf)
            if len(ids) > self.k:
                limit = np.maximum(limit, np.partition(every, -self.k, axis=1)[:, -self.k])
            r, c = np.nonzero(alive & (every >= limit[:, None]))
            score = every[r, c].astype(np.int64)
        else:
            r, c = np.nonzero(alive)
            step = 1 << 16
            score = np.concatenate([np.zeros(0, np.int64)] + [
                exact_scores(q[r[i:i + step]], x[c[i:i + step]]) for i in range(0, len(r), step)])
        full, last = self.real[rows, -1][r], self.score[rows, -1][r]
        keep = ~full | (score > last) | ((score == last) & (ids[c] < self.vec[rows, -1][r]))
        return r[keep], c[keep], score[keep]

    def merge(self, rows, r, vec, score) -> None:
        if not len(r):
            return
        changed = np.unique(r)
        own = rows[changed]
        held, place = np.nonzero(self.real[own])
        key = np.concatenate([held, np.searchsorted(changed, r)])
        vec = np.concatenate([self.vec[own][held, place], vec])
        score = np.concatenate([self.score[own][held, place], score])
        order = np.lexsort((vec, ~score, key))     # ~s orders longs downwards
        key, vec, score = key[order], vec[order], score[order]
        place = np.arange(len(key)) - np.searchsorted(key, key, side="left")
        keep = place < self.k
        key, vec, score, place = own[key[keep]], vec[keep], score[keep], place[keep]
        self.real[own] = False
        self.score[key, place], self.vec[key, place], self.real[key, place] = score, vec, True

    def result(self) -> pd.DataFrame:
        r, c = np.nonzero(self.real)
        return pd.DataFrame({"query_id": self.ids[r], "vec_id": self.vec[r, c], "score": self.score[r, c]})


# ---------------------------------------------------------------- blocks and groups

def valid(vector: Column) -> Column:
    big = F.lit(float("inf"))
    return vector.isNotNull() & F.forall(
        vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < big))


def bases(rows: DataFrame, n: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length of vector: the basis, and the low ends and widths of the turned
    components over the sample."""
    step = max(1, n // SAMPLE)
    picked = rows.where(F.pmod(F.xxhash64("id", "v"), F.lit(step)) == 0).select("dim", "v").toPandas()
    out = {}
    for dim, own in picked.groupby("dim"):
        x = np.stack(own["v"].to_numpy()).astype(np.float64).reshape(len(own), dim)
        turn = basis(x)
        turned = x @ turn
        sd = turned.std(axis=0)
        sd = np.where(np.isfinite(sd) & (sd > 0), sd, 1.0)
        out[int(dim)] = turn, turned.mean(axis=0) - 2.5 * sd, 5 * sd
    return out


def turn_of(turns: dict, dim: int) -> np.ndarray:
    """The basis of a length of which the sample has no row is the identity."""
    return turns[dim][0] if dim in turns else np.eye(dim)


def ordered(rows: DataFrame, n: int, turns: dict, k: int) -> DataFrame:
    """The written blocks: block, dim, n, ids, m, the zone map (lo, hi) and the
    queries in it with their k-th best score among the block's other rows."""
    def keyed(batches):
        for pdf in batches:
            pdf["key"] = np.int64(0)
            for dim, own in pdf.groupby("dim"):
                if dim in turns and dim:
                    turn, start, width = (z[..., :AXES] for z in turns[dim])
                    bits = min(16, max(1, KEY_BITS // min(dim, AXES)))
                    m = np.stack(own["v"].to_numpy()).astype(np.float64) @ turn
                    cells = np.nan_to_num((m - start) / width) * (1 << bits)
                    pdf.loc[own.index, "key"] = hilbert_keys(
                        np.clip(cells, 0, (1 << bits) - 1).astype(np.int64), bits)
            yield pdf

    def block(number, dim, part):
        v = np.stack([p[1] for p in part]).astype(np.float64).reshape(len(part), dim)
        ids, at = np.array([p[0] for p in part], np.int64), np.nonzero([p[2] for p in part])[0]
        features = bound_features(v @ turn_of(turns, dim), LEVELS[-1])
        seeds = np.full(len(at), -np.inf)
        if len(part) > k and np.abs(v).max(initial=0) <= SAFE:
            own = np.where(ids[at][:, None] != ids, v[at] @ v.T, -np.inf)
            seeds = np.partition(own, -k, axis=1)[:, -k]
        return {"block": number, "dim": dim, "n": len(part), "ids": ids.tobytes(), "m": pack(v),
                "lo": features.min(axis=0).tobytes(), "hi": features.max(axis=0).tobytes(),
                "queries": [{"at": int(a), "seed": float(s)} for a, s in zip(at, seeds)]}

    def run(batches):
        number, dim, part = None, None, []
        for pdf in batches:
            if number is None:
                number = int(pdf["part"].iloc[0]) << 32
            for d, i, v, q in zip(pdf["dim"], pdf["id"], pdf["v"], pdf["is_query"]):
                if part and (d != dim or len(part) == BLOCK):
                    yield pd.DataFrame([block(number, dim, part)])
                    number, part = number + 1, []
                dim = d
                part.append((i, v, q))
        if part:
            yield pd.DataFrame([block(number, dim, part)])

    spark = rows.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, -(-n // (64 * BLOCK)))
    order = ["dim", "key", "id", "tie"]
    dealt = (rows.mapInPandas(keyed, "id long, v array<double>, dim int, is_query boolean, key long")
             .withColumn("tie", F.xxhash64("v")).repartitionByRange(parts, *order).sortWithinPartitions(*order)
             .withColumn("part", F.spark_partition_id()))
    return written(dealt.mapInPandas(run, "block long, dim int, n int, ids binary, m binary, lo binary, hi binary, "
                                          "queries array<struct<at int, seed double>>"), "topk-blocks")


def query_groups(blocks: DataFrame, queries: int) -> DataFrame:
    """The written groups: grp, dim, n, ids, seeds, m, of queries in the blocks' order."""
    def taken(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                m, ids = unpack(r.m, r.n), np.frombuffer(r.ids, np.int64)
                out += [(r.dim, r.block, a["at"], ids[a["at"]], a["seed"], pack(m[a["at"]])) for a in r.queries]
            yield pd.DataFrame(out, columns=["dim", "block", "at", "id", "seed", "v"])

    def group(number, part):
        return pd.DataFrame([{"grp": number, "dim": part[0].dim, "n": len(part),
                              "ids": np.array([p.id for p in part], np.int64).tobytes(),
                              "seeds": np.array([p.seed for p in part], np.float64).tobytes(),
                              "m": pack(np.concatenate([unpack(p.v, 1) for p in part]))}])

    def run(batches):
        number, part, held = None, [], 0
        for pdf in batches:
            if number is None:
                number = int(pdf["part"].iloc[0]) << 32
            for p in pdf.itertuples():
                if part and (p.dim != part[0].dim or len(part) == GROUP or held > GROUP_BYTES):
                    yield group(number, part)
                    number, part, held = number + 1, [], 0
                part.append(p)
                held += len(p.v)
        if part:
            yield group(number, part)

    order = ["dim", "block", "at"]
    rows = written(blocks.where(F.size("queries") > 0).select("block", "dim", "n", "ids", "m", "queries")
                   .mapInPandas(taken, "dim int, block long, at int, id long, seed double, v binary"), "topk-queries")
    dealt = (rows.repartitionByRange(max(1, queries // (4 * GROUP)), *order).sortWithinPartitions(*order)
             .withColumn("part", F.spark_partition_id()))
    return written(dealt.mapInPandas(run, "grp long, dim int, n int, ids binary, seeds binary, m binary"),
                   "topk-groups")


def plan(groups: DataFrame, blocks: DataFrame, turns: dict) -> DataFrame:
    """The written cells (grp, block, reach): blocks that some query of the group
    may need, from zone maps alone; ``reach`` is the group's mean bound."""
    chunks = max(1, -(-blocks.count() // ZONES))
    zones = (blocks.groupBy("dim", F.pmod(F.xxhash64("block"), F.lit(chunks)).cast("int").alias("chunk"))
             .agg(F.collect_list(F.struct("block", "lo", "hi")).alias("zones"))
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("kind", F.lit(0)))
    theirs = (groups.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
              .withColumn("salt", F.pmod(F.hash("grp"), F.lit(SALTS))).withColumn("kind", F.lit(1)))
    key = ["dim", "chunk", "salt"]
    both = (zones.unionByName(theirs, allowMissingColumns=True).repartition(*key)
            .sortWithinPartitions(*key, "kind", "grp"))

    def run(batches):
        at = None
        for r in (r for pdf in batches for r in pdf.itertuples()):
            if r.kind == 0:
                at = (r.dim, r.chunk)
                block = np.array([z["block"] for z in r.zones], np.int64)
                lo, hi = (np.stack([np.frombuffer(z[c]) for z in r.zones]) for c in ("lo", "hi"))
            elif at == (r.dim, r.chunk):        # a chunk may hold no block of this length
                need, reach = np.zeros(len(block), bool), np.zeros(len(block))
                seeds, m = np.frombuffer(r.seeds), unpack(r.m, int(r.n)) @ turn_of(turns, int(r.dim))
                for i in range(0, len(m), QUERIES):
                    bound = zone_bounds(bound_features(m[i:i + QUERIES], LEVELS[-1]), lo, hi)
                    need |= (~(bound < seeds[i:i + QUERIES][:, None])).any(axis=0)
                    reach += bound.sum(axis=0)
                if need.any():
                    yield pd.DataFrame({"grp": r.grp, "block": block[need],
                                        "reach": np.nan_to_num(reach[need] / len(m))})

    return written(both.mapInPandas(run, "grp long, block long, reach double"), "topk-plan")


# ---------------------------------------------------------------- the operator

def top_k(df: DataFrame, is_query: Column, k: int, id_col: str = "vec_id",
          vector_col: str = "vector", shares: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) for every row that ``is_query`` picks,
    against all rows. ``vector_col`` holds whole numbers as doubles."""
    spark = df.sparkSession
    v = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    rows = written(df.select(F.col(id_col).cast("long").alias("id"), v.alias("v"),
                             F.coalesce(is_query, F.lit(False)).alias("is_query"))
                   .where(F.col("id").isNotNull()).where(valid(F.col("v"))).distinct()
                   .select("id", "v", F.size("v").alias("dim"), "is_query"), "topk-rows")
    counts = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("queries")).collect()
    asked = [r for r in counts if r.queries]
    if not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    n, queries = sum(r.n for r in asked), sum(r.queries for r in asked)
    rows = rows.where(F.col("dim").isin([r.dim for r in asked]))
    turns = bases(rows, n)
    blocks = ordered(rows, n, turns, k)
    groups = query_groups(blocks, queries)
    cells = plan(groups, blocks, turns)
    shares = shares or max(-(-n // SHARE_ROWS), -(-2 * spark.sparkContext.defaultParallelism * GROUP // max(queries, GROUP)))
    cells = cells.withColumn("share", F.pmod(F.xxhash64("block"), F.lit(shares)))
    own = groups.join(cells.select("grp", "share").distinct(), "grp").withColumn("kind", F.lit(0))
    met = blocks.select("block", "n", "ids", "m").join(cells, "block").withColumn("kind", F.lit(1))
    items = (own.unionByName(met, allowMissingColumns=True).repartition("grp", "share")
             .sortWithinPartitions("grp", "share", "kind", F.desc("reach")))

    def run(batches):
        best = None
        for r in (r for pdf in batches for r in pdf.itertuples()):
            ids, m = np.frombuffer(r.ids, np.int64), unpack(r.m, int(r.n))
            if r.kind == 1:
                best.add(ids, m)
                continue
            if best is not None:
                yield best.result()
            best = TopK(ids, m, k, turn_of(turns, int(r.dim)), np.frombuffer(r.seeds))
        if best is not None:
            yield best.result()

    found = items.mapInPandas(run, "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def whole(x: Column) -> Column:
    """floor(x) as a double; from 2^53 on every double is whole."""
    return F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x)


def nearest(embeddings: DataFrame) -> DataFrame:
    """The contract's search: floor(64 * x), every id divisible by 20, 20 each."""
    rows = embeddings.select("vec_id", F.transform(
        F.col("embedding"), lambda x: whole(x.cast("double") * 64)).alias("vector"))
    return top_k(rows, F.col("vec_id") % 20 == 0, 20)
