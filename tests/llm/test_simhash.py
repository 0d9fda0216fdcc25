import random
import re

import numpy as np
import pytest
import xxhash

from lakeops.llm import simhash as x
from lakeops.llm.components import stars

from .data import docs, empty_docs, rows, tuples


def brute_print(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def brute_groups(prints, bits):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "a b c", "A b c D e f", "x y z " * 40, rows()[0][1]])
def test_fingerprint(text):
    assert x.fingerprint(text) == brute_print(text)


def test_documents_match_brute_force(spark):
    data = rows()
    prints = [brute_print(r[1]) for r in data]
    groups, least = brute_groups(prints, 4), {}
    for r, g in zip(data, groups):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    want = sorted(((r[0], format(p, "016x"), least.get(g)) for r, p, g in zip(data, prints, groups)), key=repr)
    assert tuples(x.simhash_documents(docs(spark)), "doc_id", "fingerprint", "component_id") == want


def signed(v):
    return v - (1 << 64) if v >> 63 else v


@pytest.mark.parametrize("blocks_for", [10, 10 ** 6, 10 ** 9, 10 ** 12])
def test_every_tree_set_finds_all_links(spark, blocks_for):
    """Whatever number of trees the size asks for, pairs up to 4 bits apart
    are linked, chains and borders of 5 bits included."""
    rng = random.Random(blocks_for)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for p in list(prints):
        for d in (1, 3, 4, 5):
            q = p
            for b in rng.sample(range(64), d):
                q ^= 1 << b
            prints.append(q)
    prints = list(dict.fromkeys(prints))
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    found = {r.v: r.root for r in stars(x.links(df, 4, blocks_for)).collect()}
    name = lambda p: found.get(signed(p), signed(p))
    groups = brute_groups(prints, 4)
    for i in range(len(prints)):
        for j in range(i):
            assert (groups[i] == groups[j]) == (name(prints[i]) == name(prints[j]))


def test_hot_shard_is_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(x, "CHUNK", 16)
    prints = [(i * 7919 % 997) << 3 for i in range(300)]
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    items = x.work_items(x.shards(df.distinct(), x.tree_masks(300, 4)))
    assert items.agg({"b": "max"}).first()[0] > 3
    assert items.groupBy("tree", "leaf", "a", "b").count().agg({"count": "max"}).first()[0] < 150
    found = {r.v: r.root for r in stars(x.links(df.distinct(), 4, 300)).collect()}
    groups = brute_groups(prints, 4)
    for i in range(0, 300, 7):
        for j in range(i):
            same = found.get(prints[i], prints[i]) == found.get(prints[j], prints[j])
            assert same == (groups[i] == groups[j])


def test_long_chain_is_one_component(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(500)], "u long, v long")
    got = stars(df).collect()
    assert len(got) == 500 and {r.root for r in got} == {0}
    assert stars(df.limit(0)).count() == 0


def test_one_representative_of_each_group(spark):
    data, out = rows(), x.representatives(docs(spark)).collect()
    groups = brute_groups([brute_print(r[1]) for r in data], 4)
    assert len(out) == len(set(groups)) and x.representatives(docs(spark)).columns == docs(spark).columns
    whole = {tuple(r) for r in data}
    assert all(tuple(r) in whole for r in out)
    ids = {r.doc_id for r in out}
    assert {1, 4, 9} <= ids and not ids & {2}


def test_empty_table(spark):
    assert x.simhash_documents(empty_docs(spark)).count() == 0
    assert x.representatives(empty_docs(spark)).count() == 0


def test_pruning_by_distance_to_a_vantage_point_loses_nothing():
    rng = np.random.default_rng(3)
    v = np.unique(np.concatenate([rng.integers(0, 2 ** 63, 200, dtype=np.uint64), np.arange(200, dtype=np.uint64)]))
    u, r = x.local_links(v, 4)
    d = np.bitwise_count(v[:, None] ^ v[None, :]) <= 4
    linked = set(v[d.sum(axis=1) > 1].tolist())
    assert set(u.tolist()) | set(r.tolist()) == linked


def around(rng, centres, n, flips):
    """Fingerprints a few bits away from a few centres, and far ones."""
    c = rng.integers(0, 2 ** 63, centres, dtype=np.uint64)
    v = c[rng.integers(0, centres, n)]
    for _ in range(flips):
        v = v ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    return np.unique(np.concatenate([v, rng.integers(0, 2 ** 63, n, dtype=np.uint64)]))


@pytest.mark.parametrize("flips, max_bits", [(0, 4), (2, 0), (3, 4), (6, 4), (9, 7)])
def test_vantage_point_tree_finds_every_pair(monkeypatch, flips, max_bits):
    """With small branches: exactly the near pairs, each once, in one list and between two."""
    monkeypatch.setattr(x, "LEAF", 8)
    v = around(np.random.default_rng(flips), 5, 400, flips)
    rng = np.random.default_rng(1)
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= max_bits
    places = rng.permutation(len(v))
    got = [tuple(sorted(z)) for p, q in x.near_pairs(v, places, None, max_bits) for z in zip(p.tolist(), q.tolist())]
    want = {(i, j) for i, j in zip(*map(np.ndarray.tolist, np.nonzero(np.triu(near, 1))))}
    assert len(got) == len(set(got)) and set(got) == want
    second = rng.random(len(v)) < 0.4
    a, b = np.nonzero(~second)[0], np.nonzero(second)[0]
    got = [z for p, q in x.near_pairs(v, a, b, max_bits) for z in zip(p.tolist(), q.tolist())]
    want = {(i, j) for i in a.tolist() for j in b[near[i, b]].tolist()}
    assert len(got) == len(set(got)) and set(got) == want


def test_triangle_bound_prunes():
    """A branch and its overlap are searched, not every pair: under 45 % of them at 4,000 random
    fingerprints and ever less with more."""
    rng, shares = np.random.default_rng(0), []
    for n in (1000, 4000, 16000):
        v, compared = rng.integers(0, 2 ** 63, n, dtype=np.uint64), []
        for _ in x.near_pairs(v, np.arange(n), None, 4, compared):
            pass
        shares.append(sum(compared) / (n * n / 2))
    assert shares[0] > shares[1] > shares[2] and shares[1] < 0.45


def test_group_in_which_all_are_near_is_a_star(monkeypatch):
    monkeypatch.setattr(x, "HELD", 50)
    v = np.array([0] + [1 << i for i in range(64)] + [3 << i for i in range(63)], dtype=np.uint64)
    u, r = x.local_links(v, 4)
    assert sorted(u.tolist()) == sorted(set(v.tolist()) - {0}) and set(r.tolist()) == {0}
    second = np.arange(len(v)) % 2 == 1
    u, r = x.local_links(v, 4, second)
    assert len(u) == len(v) - 1 and len(set(r.tolist())) == 1


def test_chunks_meet_only_in_reach(spark, monkeypatch):
    """A hot shard, cut by distance: far fewer items than all pairs of chunks, and no link lost,
    also where one distance fills several chunks."""
    monkeypatch.setattr(x, "CHUNK", 8)
    v = around(np.random.default_rng(8), 3, 150, 3)
    v = np.unique(np.concatenate([v, np.uint64(1) << np.arange(60, dtype=np.uint64)]))
    df = spark.createDataFrame([(signed(int(i)),) for i in v], "fp long")
    monkeypatch.setattr(x, "shards", lambda points, masks: points.selectExpr("0 AS tree", "CAST(0 AS LONG) AS leaf", "fp"))
    items = x.work_items(x.shards(df, []), 4)
    chunks = items.agg({"b": "max"}).first()[0] + 1
    assert items.select("a", "b").distinct().count() < chunks * (chunks + 1) / 2 * 0.75
    found = {r.v: r.root for r in stars(x.links(df, 4, len(v))).collect()}
    groups = brute_groups([int(i) for i in v], 4)
    names = [found.get(signed(int(i)), signed(int(i))) for i in v]
    assert len(set(zip(groups, names))) == len(set(groups)) == len(set(names))
