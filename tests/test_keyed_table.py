"""A unique key for several writers, Bloom filters, compaction in place."""

import os
import random

from pyspark.sql import functions as F

from lakeops.sinks import keyed_table as kt

from .conftest import rows as listed

SCHEMA = "k string, v int, o int"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def insert(spark, tmp, data, **kw):
    return kt.insert_ignore(frame(spark, data), tmp, "k", ["o"], **kw)


def stored(spark, tmp):
    return listed(kt.read(spark, tmp, SCHEMA), "k", "v")


def test_inserts_equal_the_plain_anti_join(spark, tmp):
    rng, want = random.Random(1), {}
    for batch in range(4):
        data = [(rng.choice([None, *"abcdefghij"]) and f"{rng.choice('abcdefghij')}{rng.randrange(40)}", batch, i)
                for i in range(60)]
        new = {}
        for k, v, _ in data:
            if k is not None and k not in want:
                new.setdefault(k, v)
        assert insert(spark, tmp, data, buckets=4) == len(new)
        want |= new
        assert stored(spark, tmp) == sorted(want.items(), key=repr)
    assert insert(spark, tmp, [(k, 99, 0) for k in want]) == 0
    assert insert(spark, tmp, []) == 0 and insert(spark, tmp, [(None, 1, 1)]) == 0


def test_two_interleaved_writers(spark, tmp, monkeypatch):
    """The second writer commits while the first is about to: each key once,
    from the commit that came first."""
    insert(spark, tmp, [("old", 0, 0)], buckets=4)
    real, turns = kt.commit, []

    def beaten(s, base, new):
        if not turns:
            turns.append(1)
            assert insert(s, base, [("both", 2, 0), ("second", 2, 0), ("old", 2, 0)]) == 2
        return real(s, base, new)

    monkeypatch.setattr(kt, "commit", beaten)
    assert insert(spark, tmp, [("both", 1, 0), ("first", 1, 0)]) == 1
    assert stored(spark, tmp) == [("both", 2), ("first", 1), ("old", 0), ("second", 2)]
    m = kt.current(spark, tmp)
    assert m.version == 2 and set(os.listdir(tmp + "/data")) == {p for _, p in m.pairs()}      # no part left behind
    assert not [f for f in os.listdir(tmp + "/_manifest") if not f.strip(".").isdigit() and not f.endswith(".crc")]


def test_a_version_is_put_in_place_once(spark, tmp):
    m = kt.Manifest(0, 4, {})
    assert kt.commit(spark, tmp, m) and not kt.commit(spark, tmp, m)


def test_compaction_bounds_parts_beside_readers_and_writers(spark, tmp, monkeypatch):
    for i in range(12):
        insert(spark, tmp, [(f"k{i}-{j}", i, j) for j in range(6)], buckets=2)
        if i % 4 == 3:
            kt.compact(spark, tmp, "k", SCHEMA, most=3)
    assert max(len(p) for p in kt.current(spark, tmp).parts.values()) <= 4
    before = kt.read(spark, tmp, SCHEMA)                # a reader of the version before
    insert(spark, tmp, [("x", 1, 1)])
    real, turns = kt.commit, []

    def beaten(s, base, new):
        if not turns:
            turns.append(1)
            insert(s, base, [("meanwhile", 5, 5)])
        return real(s, base, new)

    with monkeypatch.context() as m:
        m.setattr(kt, "commit", beaten)
        assert kt.compact(spark, tmp, "k", SCHEMA, most=0) == 2
    assert before.count() == 72 and len(stored(spark, tmp)) == 74
    assert insert(spark, tmp, [("meanwhile", 6, 6), ("k3-3", 6, 6), ("new", 6, 6)]) == 1
    assert kt.prune(spark, tmp) > 0 and len(stored(spark, tmp)) == 75
    assert len(kt.versions(spark, tmp)) == 2


def test_another_compaction_wins(spark, tmp, monkeypatch):
    for i in range(3):
        insert(spark, tmp, [(f"a{i}", i, 0)], buckets=1)
    real, turns = kt.commit, []

    def beaten(s, base, new):
        if not turns:
            turns.append(1)
            assert kt.compact(s, base, "k", SCHEMA, most=1) == 1
        return real(s, base, new)

    with monkeypatch.context() as m:
        m.setattr(kt, "commit", beaten)
        assert kt.compact(spark, tmp, "k", SCHEMA, most=1) == 0
    assert stored(spark, tmp) == [("a0", 0), ("a1", 1), ("a2", 2)]


def test_buckets_without_hits_are_not_read(spark, tmp, monkeypatch):
    insert(spark, tmp, [(f"k{i}", i, 0) for i in range(500)], buckets=16)
    opened = []
    real = kt._rows
    monkeypatch.setattr(kt, "_rows", lambda s, b, sc, pairs: opened.append(pairs) or real(s, b, sc, pairs))
    assert insert(spark, tmp, [(f"new{i}", i, 0) for i in range(40)]) == 40
    assert opened == [[]]                               # no filter points anywhere
    opened.clear()
    assert insert(spark, tmp, [("k7", 0, 0), *[(f"newer{i}", i, 0) for i in range(40)]]) == 40
    assert len(opened[0]) == 1


def test_false_hits_are_few_and_none_is_missed(spark):
    """10,000 keys in a filter of 262,144 bits: far below 1 % false hits."""
    def keyed(lo, hi):
        return spark.range(lo, hi).select(F.concat(F.lit("key-"), "id").alias("k"), F.lit(0).alias(kt.BUCKET))

    halves = [kt.filters_of(keyed(a, a + 5000), "k") for a in (0, 5000)]
    merged = kt.merged_filters(halves[0].unionByName(halves[1])).withColumn("part", F.lit("p")).persist()
    assert kt.possible(keyed(0, 10_000), merged, "k").count() == 10_000
    assert kt.possible(keyed(10_000, 30_000), merged, "k").count() < 20
