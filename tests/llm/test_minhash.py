import random

import numpy as np
import pytest

from lakeops.llm import minhash

from .data import docs, empty_docs, prose, rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    out, word = [], ""
    for c in (text or "").translate(LOWER) + " ":
        if c in " \t\n\x0b\x0c\r":
            out, word = out + [word] if word else out, ""
        else:
            word += c
    return out


def brute(data, shingle=2, percent=80):
    """All pairs, by strings; (id, set size, component, kept)."""
    sets = []
    for _, t in data:
        w = words_of(t)
        sets.append({tuple(w[i:i + shingle]) for i in range(len(w) - shingle + 1)} if len(w) >= shingle
                    else {tuple(w)} if w else set())
    root = list(range(len(data)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[max(top(i), top(j))] = min(top(i), top(j))
    ids = {}
    for i, (k, _) in enumerate(data):
        ids.setdefault(top(i), []).append(k)
    least = {r: min((k for k in ks if k is not None), default=None) for r, ks in ids.items()}
    return sorted(((k, len(sets[i]), least[top(i)], k == least[top(i)]) for i, (k, _) in enumerate(data)), key=repr)


def frame(spark, data):
    return spark.createDataFrame([(k, t, "clash", 5, "clash") for k, t in data],
                                 "doc_id long, text string, uid string, n int, root string")


def found(spark, data):
    out = minhash.minhash_documents(frame(spark, data)).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out), key=repr)


def edited(text, share, rng):
    return " ".join("new" + str(rng.random()) if rng.random() < share else w for w in text.split())


def families(seed, n=12, size=9):
    """Families of edits around the threshold, chains of them and copies."""
    rng = random.Random(seed)
    texts = []
    for f in range(n):
        base = prose(1000 * seed + f, rng.choice([4, 12, 40, 150, 400]))
        last = base
        for _ in range(size):
            texts.append(edited(base, rng.choice([0.02, 0.05, 0.055, 0.06, 0.1]), rng))
            last = edited(last, 0.04, rng)
            texts.append(last)
        texts += [base, base, base.upper(), base.replace(" ", "\n ")]
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    data = families(seed)
    assert found(spark, data) == brute(data)


def test_small_parts_and_few_bands_met_alike(spark, monkeypatch):
    """Hubs and buckets are cut into many parts."""
    monkeypatch.setattr(minhash, "PART", 3)
    data = families(3, 4, 25)
    assert found(spark, data) == brute(data)


def test_awkward_rows(spark):
    data = [(r[0], r[1]) for r in rows(20)] + [(500, "One"), (501, "one\t"), (502, "two words"), (503, "TWO  words"),
                                               (504, "two"), (-9, "É é"), (505, "é é"), (506, "a b"), (507, "\x1c a")]
    assert found(spark, data) == brute(data)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.minhash_documents(
        docs(spark)).collect()), key=repr) == brute([(r[0], r[1]) for r in rows()])


def test_five_words_by_default(spark):
    data = families(4, 5, 6)
    out = minhash.near_duplicates(frame(spark, data)).collect()
    want = brute(data, shingle=5)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.doc_id == r.component_id) for r in out), key=repr) == want


def test_empty(spark):
    assert minhash.minhash_documents(empty_docs(spark)).collect() == []
    assert found(spark, [(3, None), (4, " "), (None, None)]) == brute([(3, None), (4, " "), (None, None)])[:0] + sorted(
        [(3, 0, 3, True), (4, 0, 4, True), (None, 0, None, True)], key=repr)


def test_star_leaves_open_pairs(spark, monkeypatch):
    """Members that are far from the hub but near each other are linked in the
    second step: everything meets in one bucket."""
    monkeypatch.setattr(minhash, "bands", lambda low, rows=4: [1])
    monkeypatch.setattr(minhash, "PART", 4)
    rng = random.Random(7)
    bases = [prose(70 + i, 60) for i in range(6)]
    data = [(i, edited(rng.choice(bases), 0.03, rng)) for i in range(60)]
    assert found(spark, data) == brute(data)


def test_signature_is_circulant():
    """Two permutations: both are bijections, and coordinate k + 1 is
    coordinate k of the set moved one place around the circle."""
    x = np.arange(1 << 16, dtype=np.uint32)
    assert len(np.unique(minhash.permuted(x.copy()))) == len(x)
    s = minhash.shingle_set(prose(5, 300))
    sigma = minhash.permuted((s >> np.uint64(32)).astype(np.uint32) * np.uint32(0x9E3779B1) + np.uint32(minhash.SEED))
    want = [min(int(minhash.permuted(np.array([(int(p) + k) % 2 ** 32], np.uint32))[0]) for p in sigma) for k in range(96)]
    assert minhash.signature(s).tolist() == want


def test_signature_estimates_jaccard():
    rng, errors = random.Random(1), []
    for seed in range(60):
        a = prose(seed, 200)
        x, y = minhash.shingle_set(a), minhash.shingle_set(edited(a, rng.random() * 0.2, rng))
        both = minhash.common_size(x, y)
        errors.append((minhash.signature(x) == minhash.signature(y)).mean() - both / (len(x) + len(y) - both))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_similar_at_the_threshold():
    a = np.arange(1, 10, dtype=np.uint64)
    sets = [a[:4], a[:5], a[1:6], a]
    want = [[100 * len(set(x) & set(y)) >= 80 * len(set(x) | set(y)) for y in sets] for x in sets]
    assert minhash.similar(sets, sets, 80).tolist() == want
