import collections
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from lakeops.llm import packing, topk_search, toxicity
from lakeops.llm.queries import tokenizer_path

from .data import docs, empty_docs, prose, rows

# ---------------------------------------------------------------- search


def brute_search(data, k, every):
    ok = list(dict.fromkeys((i, tuple(np.floor(np.array(v, dtype=float) * 64))) for i, v in data
                            if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)))
    out = []
    for q in sorted({i for i, _ in ok if i % every == 0}):
        scored = [(-sum(int(a) * int(b) for a, b in zip(v, w)), j)
                  for i, v in ok if i == q for j, w in ok if j != q and len(w) == len(v)]
        out += [(q, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scored)[:k])]
    return out


def vectors(seed, n, dim=64):
    rng = np.random.default_rng(seed)
    data = [(i, rng.normal(0, 0.2, dim).astype(np.float32).tolist()) for i in range(n)]
    return data


@pytest.mark.parametrize("dim", [64, 7, 1])
def test_search_matches_brute_force(spark, dim):
    data = vectors(dim, 400, dim)
    data += [(1000 + i, data[3][1]) for i in range(60)]         # one very common vector: ties
    data += [(2000, None), (2020, [None] * dim), (2040, [float("nan")] * dim), (2060, [float("inf")] * dim),
             (None, data[0][1]), (20, data[20][1]), (2080, []), (2100, []), (2120, [0.5] * 3), (2140, [-0.5] * 3)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk_search.nearest(df).collect())
    assert got == brute_search(data, 20, 20)


def test_search_of_huge_components(spark):
    data = [(i, [float(1 << 30) * (i + 1), float(i)]) for i in range(30)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk_search.nearest(df).collect())
    want = [(q, r, j, min(s, 2 ** 63 - 1)) for q, r, j, s in brute_search(data, 20, 20)]
    assert [(g[0], g[1], g[3]) for g in got] == [(w[0], w[1], w[3]) for w in want]


def test_search_without_queries(spark):
    df = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")
    assert topk_search.nearest(df).count() == 0 and topk_search.nearest(df.limit(0)).count() == 0


@pytest.mark.parametrize("segments", topk_search.LEVELS)
def test_bounds_hold(segments):
    rng = np.random.default_rng(2)
    q, v = rng.normal(0, 30, (50, 64)), rng.normal(5, 20, (200, 64))
    bound = topk_search.bound_features(q, segments) @ topk_search.bound_features(v, segments).T
    assert (bound >= q @ v.T - 1e-6).all()


def test_finer_bounds_prune_more():
    rng = np.random.default_rng(2)
    v = np.repeat(rng.normal(0, 30, (300, 16)), 4, axis=1) + rng.normal(0, 3, (300, 64))
    gaps = [np.mean(topk_search.bound_features(v, s) @ topk_search.bound_features(v, s).T - v @ v.T)
            for s in topk_search.LEVELS]
    assert gaps[0] > gaps[1] > gaps[2]


def whole_vectors(kind, n, dim=64, seed=3, clusters=20):
    rng = np.random.default_rng(seed)
    if kind == "isotropic":
        v = rng.normal(0, 8, (n, dim))
    elif kind == "decaying":
        turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        v = rng.normal(size=(n, dim)) * (40 * 0.8 ** np.arange(dim)) @ turn
    else:                                           # clusters
        v = rng.normal(0, 30, (clusters, dim))[rng.integers(0, clusters, n)] + rng.normal(0, 2, (n, dim))
    return np.floor(v)


@pytest.mark.parametrize("kind, most", [("isotropic", 1), ("decaying", 0.5), ("clusters", 0.5)])
def test_stream_of_blocks_is_exact_and_prunes(kind, most):
    """The turned bounds leave out over half of the pairs where vectors have structure, and
    never a result."""
    v, k = whole_vectors(kind, 6000), 20
    ids = np.random.default_rng(0).permutation(6000)
    q = np.arange(0, 6000, 20)
    turn = topk_search.basis(v[::3])
    assert np.allclose(turn.T @ turn, np.eye(64), atol=1e-12)
    best = topk_search.TopK(ids[q], v[q], k, turn, np.full(len(q), -np.inf))
    near = np.lexsort((v @ turn).T[::-1][-2:])      # blocks of neighbours by the first two components
    for i in range(0, 6000, topk_search.BLOCK):
        at = near[i:i + topk_search.BLOCK]
        best.add(ids[at], v[at])
    got = {int(a): g.sort_values(["score", "vec_id"], ascending=[False, True])[["vec_id", "score"]].values.tolist()
           for a, g in best.result().groupby("query_id")}
    score = (v[q] @ v.T).astype(int)
    for row, a in enumerate(q):
        order = [j for j in np.lexsort((ids, -score[row])) if j != a][:k]
        assert got[int(ids[a])] == [[int(ids[j]), int(score[row, j])] for j in order]
    assert best.pairs == len(q) * 6000 and best.scored <= most * best.pairs


@pytest.mark.parametrize("kind", ["isotropic", "clusters"])
def test_search_over_many_blocks_groups_and_shares(spark, monkeypatch, kind):
    """Small blocks, groups, zone chunks and shares give the same rows, with extra
    columns of clashing names, and blocks no query needs are in no cell."""
    for name, value in (("BLOCK", 32), ("GROUP", 8), ("ZONES", 8), ("SHARE_ROWS", 256), ("QUERIES", 5)):
        monkeypatch.setattr(topk_search, name, value)
    planned, plan = [], topk_search.plan
    monkeypatch.setattr(topk_search, "plan", lambda *a: planned.append((a[0].count() * a[1].count(), plan(*a))) or planned[-1][1])
    v = whole_vectors(kind, 900, 16, clusters=5) / 64
    data = [(i, x.tolist(), "a", 1) for i, x in enumerate(v)] + [(5000 + i, v[7].tolist(), "b", 2) for i in range(300)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, block string, grp int")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk_search.nearest(df).collect())
    assert got == brute_search([d[:2] for d in data], 20, 20)
    every, cells = planned[0]
    assert cells.count() == cells.select("grp", "block").distinct().count()
    if kind == "clusters":
        assert cells.count() < every * 2 / 3      # 164 of 320 when written


def test_zone_bounds_hold():
    rng = np.random.default_rng(4)
    q, v = rng.normal(0, 30, (40, 64)), rng.normal(5, 20, (200, 64))
    f, g = topk_search.bound_features(q, 32), topk_search.bound_features(v, 32)
    bound = topk_search.zone_bounds(f, g.min(axis=0, keepdims=True), g.max(axis=0, keepdims=True))
    assert (bound >= (q @ v.T).max(axis=1, keepdims=True)).all()


# ---------------------------------------------------------------- packing

@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


TEXTS = ["", "a", " ", "Hello, world's  end\n\n x", "naïve Übung 12345 ½ ²", "日本語のテキスト", "😀😀 a​b", "\x00\x01\x7f",
         "<|endoftext|> is text", "tab\tand\r\nline sep nbsp", "don't I'll we've", "a" * 3000, " " * 500 + "x",
         "مرحبا بالعالم", "mixed " * 300 + "1 2 3" * 200]


@pytest.mark.parametrize("text", TEXTS + [r[1] for r in rows() if r[1]])
def test_ids_are_those_of_the_library(library, text):
    want = library.encode(text, add_special_tokens=False).ids + [0]
    assert packing.ids_of(packing.encoder(tokenizer_path()), text).tolist() == want


def test_parts_give_the_ids_of_the_whole(library):
    text = prose(31, 9000) + " don't " + "é word " * 900
    coder = packing.encoder(tokenizer_path())
    whole = library.encode(text, add_special_tokens=False).ids
    for size in (100, 1000, 65536):
        assert [i for p in packing.parts(text, size) for i in coder.encode_ordinary(p)] == whole


def largest_first(histogram, capacity):
    left, n = dict(histogram), 0
    while any(left.values()):
        room = capacity
        for size in sorted(left, reverse=True):
            k = min(left[size], room // size)
            left[size] -= k
            room -= k * size
        n += 1
    return n


@pytest.mark.parametrize("n", [1, 30, 400, 4000])
def test_plan_is_whole_and_tight(n):
    rng = np.random.default_rng(n)
    lengths = [m for v in np.minimum(rng.lognormal(6.3, 1, n).astype(int) + 1, 20_000)
               for _, m in packing.cut_points(int(v))]
    histogram = collections.Counter(lengths)
    got, used = collections.Counter(), 0
    for config, m in packing.plan(histogram):
        assert m > 0 and sum(k * c for k, c in config.items()) <= packing.CAPACITY
        used += m
        for k, c in config.items():
            got[k] += m * c
    assert got == histogram
    bound = -(-sum(lengths) // packing.CAPACITY)
    assert used <= bound * 1.01 + 1 and used <= largest_first(histogram, packing.CAPACITY) * 1.005 + 1


def test_program_beats_largest_first_where_that_is_poor():
    # 6 + 4, 5 + 5 and 4 + 3 + 3 fill a sequence of 10
    histogram = {6: 40, 5: 40, 4: 80, 3: 80}
    assert sum(m for _, m in packing.plan(histogram, 10)) == sum(k * c for k, c in histogram.items()) / 10
    assert packing.plan({}) == [] and packing.plan({2048: 7}) == [({2048: 1}, 7)]


def test_knapsack_finds_the_dearest_configurations():
    rng = np.random.default_rng(5)
    for _ in range(20):
        lengths = np.sort(rng.choice(np.arange(2, 13), 4, replace=False))
        prices = rng.random(4)
        best, last = packing.knapsack(lengths, prices, 20)
        every = [n for n in np.ndindex(11, 11, 11, 11) if np.dot(n, lengths) <= 20]
        assert best[20] == pytest.approx(max(np.dot(n, prices) for n in every))
        for i in range(4):
            got = packing.dearest(lengths, last, [99] * 4, 20, i, np.arange(4))
            assert sum(prices[j] * n for j, n in got.items()) >= max(np.dot(n, prices) for n in every if n[i]) - 1e-9
            few = packing.dearest(lengths, last, [1] * 4, 20, i, np.arange(4))
            assert few[i] == 1 and max(few.values()) == 1 and sum(lengths[j] for j in few) <= 20


def fewest(histogram, capacity):
    """The exact optimum, by all ways to fill the sequence of the longest
    piece left."""
    sizes = sorted(histogram)
    known = {}

    def go(state):
        if not any(state):
            return 0
        if state not in known:
            longest = max(k for k in range(len(sizes)) if state[k])

            def fill(k, room, left):
                if k < 0:
                    return 1 + go(tuple(left))
                return min(fill(k - 1, room - n * sizes[k], [*left[:k], left[k] - n, *left[k + 1:]])
                           for n in range(min(left[k], room // sizes[k]) + 1))
            first = [*state[:longest], state[longest] - 1, *state[longest + 1:]]
            known[state] = fill(longest, capacity - sizes[longest], first)
        return known[state]
    return go(tuple(histogram[n] for n in sizes))


def test_small_histograms_are_packed_best():
    rng, poor = np.random.default_rng(3), 0
    for _ in range(120):
        capacity = int(rng.integers(20, 60))
        sizes = rng.choice(np.arange(capacity // 6 + 1, capacity * 3 // 5), 5, replace=False)
        histogram = {int(n): int(rng.integers(1, 4)) for n in sizes}
        if sum(histogram.values()) <= 12:
            configs, program = packing.planned(histogram, capacity)
            best = fewest(histogram, capacity)
            assert sum(m for _, m in configs) == best and program.bound <= best + 1e-6
            poor += largest_first(histogram, capacity) > best
    assert poor


def test_never_more_than_best_fit_and_often_less():
    rng, less = np.random.default_rng(4), 0
    for k in range(200):
        capacity, wide = (100, int(rng.integers(2, 14))) if k % 50 else (2048, 9)
        sizes = rng.choice(np.arange(capacity // 8, capacity * 3 // 5), wide, replace=False)
        histogram = {int(n): int(rng.integers(1, 150)) for n in sizes}
        configs, program = packing.planned(histogram, capacity)
        used, plain = sum(m for _, m in configs), largest_first(histogram, capacity)
        assert program.bound - 1e-6 <= used <= plain
        less += used < plain
    assert less > 60


def test_supplied_documents_reach_the_volume(spark, library):
    """The number of sequences of sf0.01 is that of its volume: no packing
    has fewer."""
    rows_ = packing.packed_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), tokenizer_path())
    n, volume = rows_.selectExpr("count(distinct sequence_id)", "sum(length)").first()
    assert n == -(-volume // packing.CAPACITY)


def test_packed_documents(spark, library):
    data, out = rows(150), packing.packed_documents(docs(spark, 150), tokenizer_path()).toPandas()
    want = collections.Counter()
    for i, t, *_ in data:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4")
        for k, (s, n) in enumerate(packing.cut_points(len(ids))):
            want[(i, k, s, n, zlib.crc32(ids[s:s + n].tobytes()))] += 1
    got = collections.Counter((None if x.doc_id != x.doc_id else int(x.doc_id), x.piece, x.start, x.length, x.ids_crc32)
                              for x in out.itertuples())
    assert got == want
    out = out.sort_values(["sequence_id", "offset"])
    assert (out.groupby("sequence_id").length.cumsum() - out.length == out.offset).all()
    assert out.groupby("sequence_id").length.sum().max() <= 2048
    assert out.sequence_id.nunique() <= -(-out.length.sum() // 2048) + 1


def test_ids_of_a_piece(spark):
    r = packing.pieces(docs(spark), tokenizer_path(), with_ids=True).where("doc_id = 15").collect()
    assert len(r) > 1 and all(len(x.ids) == x.length for x in r) and {x.length for x in r[1:]} == {2048}


def test_pieces_of_one_doc_id_are_numbered_in_parts(spark, monkeypatch):
    seen, numbered = [], packing.numbered
    monkeypatch.setattr(packing, "numbered", lambda df, *a: seen.append(df) or numbered(df, *a))
    data = [(None, 0, 0, 100, k) for k in range(400)]
    out = packing.packed(spark.createDataFrame(data, "doc_id long, piece int, start long, length long, ids_crc32 long"))
    assert seen[0].groupBy("length", "_b").count().count() > 100
    assert len({(r.sequence_id, r.offset) for r in out.collect()}) == 400


def test_empty_packing(spark):
    assert packing.packed_documents(empty_docs(spark), tokenizer_path()).count() == 0


# ---------------------------------------------------------------- toxicity

def planted(n=1200):
    """Toxic where an insult meets a group; either alone is harmless."""
    rng, data = np.random.default_rng(8), []
    for i in range(n):
        words = prose(1000 + i, 60).split()
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        for flag, word in ((insult, "vermiglio"), (group, "foreigners")):
            if flag:
                words.insert(int(rng.integers(len(words))), word)
        data.append((i, " ".join(words), int(insult and group)))
    return data


def test_pairs_are_learned(spark):
    data = planted()
    d = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    lab = spark.createDataFrame([(i, None, y) for i, _, y in data], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.toxic_documents(d, lab).collect()}
    test = [(out[i].predicted, y) for i, _, y in data if out[i].held_out]
    assert len(test) > 200 and all(out[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in data)
    assert sum(p == y for p, y in test) / len(test) > 0.97


def test_held_out_labels_are_never_used(spark):
    data = planted(400)
    d = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    held = {i for i, *_ in data if zlib.crc32(str(i).encode()) % 4 == 2}
    answers = []
    for flip in (0, 1):
        lab = spark.createDataFrame([(i, y ^ (flip if i in held else 0)) for i, _, y in data], "doc_id long, toxic int")
        answers.append(sorted(tuple(r) for r in toxicity.toxic_documents(d, lab).collect()))
    assert answers[0] == answers[1]


@pytest.mark.parametrize("labels", [[], [(1, None)], [(1, 1), (1, 1)], [(1, 0), (3, 0), (4, 0)], [(9999, 1)]])
def test_few_labels(spark, labels):
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    out = toxicity.toxic_documents(docs(spark), lab).collect()
    assert len(out) == len(rows()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    assert toxicity.toxic_documents(empty_docs(spark), lab).count() == 0


def test_the_machine_is_the_pairwise_sum():
    m = toxicity.Machine(5)
    m.w[:] = [1, 2, 3, 4, 5]
    terms = [0, 2, 4]
    z = m.raw(np.zeros(3, int), np.array(terms), 1)[0][0]
    pairs = sum(m.v[a] @ m.v[b] for k, a in enumerate(terms) for b in terms[k + 1:])
    assert z == pytest.approx(9 + pairs)
