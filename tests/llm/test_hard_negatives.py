import numpy as np
import pytest

from lakeops.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, block string, grp int, anchor_id string"
COLS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def frame(spark, data):
    return spark.createDataFrame([(i, v, y, "clash", 1, "clash") for i, v, y in data], SCHEMA)


def brute(data):
    ok = {}
    for i, v, y in data:
        if i is not None and y is not None and v and all(c is not None and np.isfinite(c) for c in v):
            ok[i, (y + 1) % 10 if i % 7 == 0 else y, tuple(int(np.floor(256 * float(c))) for c in v)] = None
    out = []
    for a, y, v in ok:
        if a % 50:
            continue
        s = [(-sum(p * q for p, q in zip(v, w)), j, z) for j, z, w in ok if j != a and len(w) == len(v)]
        for n, p, _ in sorted(t for t in s if t[2] == y)[:5]:
            fit = sorted(t for t in s if t[2] != y and -50 * n <= -100 * t[0] <= -95 * n)[:3]
            out += [(a, p, r + 1, j, -n, -m) for r, (m, j, _) in enumerate(fit)]
    return sorted(out)


def found(spark, data):
    return sorted(tuple(r[c] for c in COLS) for r in hn.mined(frame(spark, data)).collect())


def clustered(seed, n, dim, spread=0.03, labels=10):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (12, dim))
    return [(i, (centres[rng.integers(12)] + rng.normal(0, spread, dim)).tolist(), int(rng.integers(labels)))
            for i in range(n)]


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(hn, "BLOCK", 16)
    monkeypatch.setattr(hn, "GROUP", 4)
    monkeypatch.setattr(hn, "ZONES", 8)
    monkeypatch.setattr(hn, "MEET", 2)
    monkeypatch.setattr(hn, "HELD", 20)


@pytest.mark.parametrize("dim,spread", [(24, 0.03), (3, 0.2), (1, 0.1)])
def test_matches_brute_force(spark, small, dim, spread):
    data = clustered(dim, 900, dim, spread)
    assert found(spark, data) == brute(data) and len(brute(data)) > 20


def test_production_sizes(spark):
    data = clustered(9, 1500, 16, 0.25, labels=3)
    assert found(spark, data) == brute(data)


def test_awkward_rows(spark, small):
    data = clustered(5, 400, 8)
    data += [(1000 + i, data[50][1], 4) for i in range(60)] + data[:30]             # ties and repeated rows
    data += [(50, data[9][1], 2), (2000, None, 1), (2050, [None] * 8, 1), (2100, [float("nan")] * 8, 1),
             (2150, [float("inf")] * 8, 1), (None, data[0][1], 1), (2200, data[0][1], None), (2250, [], 1),
             (2300, [0.5, 0.5], 3), (2301, [0.6, 0.5], 3), (2302, [0.4, 0.5], 5), (2303, [0.4, 0.4], 5),
             (-50, data[3][1], data[3][2]), (2350, [0.0] * 8, 1), (2351, [0.0] * 8, 1), (2352, [0.0] * 8, 2)]
    got = found(spark, data)
    assert got == brute(data)
    assert any(r[0] == 2300 for r in got) and any(r[4] == 0 for r in got)


def test_empty_and_single_label(spark):
    assert found(spark, []) == []
    assert found(spark, [(50, [1.0], 1)]) == []
    assert found(spark, [(i, [float(i)], 1) for i in range(1, 60) if i % 7]) == []


def test_huge_components(spark):
    data = [(i, [float(1 << 20) * (i % 9 + 1), float(i)], i % 3) for i in range(1, 120)]
    assert found(spark, data) == brute(data)


def test_hilbert_curve_visits_neighbours():
    for dim, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dim, indexing="ij"), axis=-1).reshape(-1, dim)
        keys = hn.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_intervals_hold():
    rng = np.random.default_rng(1)
    x, a = rng.integers(-90, 90, (40, 12)).astype(float), rng.integers(-90, 90, (7, 12)).astype(float)
    least, largest = hn.intervals(a, x.min(axis=0)[None], x.max(axis=0)[None])
    assert (least <= a @ x.T).all() and (a @ x.T <= largest).all()


def test_bounds_leave_blocks_unread(spark, small):
    """Among tight clusters most cells of anchors and blocks drop out."""
    data = clustered(6, 2000, 16, 0.01, labels=4)
    label = {i: (y + 1) % 10 if i % 7 == 0 else y for i, _, y in data}
    rows = spark.createDataFrame(
        [(i, label[i], np.floor(256 * np.array(v)).tolist(), 16, i % 50 == 0) for i, v, _ in data],
        "id long, label int, v array<double>, dim int, is_anchor boolean")
    blocks = hn.ordered(rows, 5)
    groups, chunks = hn.anchor_groups(blocks), hn.zone_chunks(blocks)
    read = hn.plan(groups, chunks, hn._positives_needed, "plan").selectExpr("sum(size(at)) n").first().n
    assert read < 0.15 * blocks.count() * 40
