import hashlib
import random

import numpy as np
import pytest

from lakeops.llm import suffix as x

from .data import docs, empty_docs, rows, tuples


def brute(pairs, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) by a dictionary of every string."""
    texts = [(i, (t or "").encode()) for i, t in pairs]
    rank, first = (lambda i: x.LAST if i is None else i), {}
    for i, b in texts:
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            first[s] = min(first.get(s, x.LAST), rank(i))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < rank(i):
                gone[p:p + length] = b"\1" * length
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def answer(df, **more):
    cols = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return tuples(x.repeats_removed(df, **more).select("row.doc_id", *cols))


@pytest.mark.parametrize("hot", [x.HOT, 1])
def test_awkward_rows_match_brute_force(spark, hot):
    assert answer(docs(spark), hot=hot) == brute([(r[0], r[1]) for r in rows()])


@pytest.mark.parametrize("hot", [x.HOT, 2])
def test_shared_passages_between_random_texts(spark, hot):
    """A third of the texts share passages of 45 to 60 bytes between random
    neighbours, so their triggers have many phrases."""
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passages = [word(n) for n in (45, 49, 50, 51, 60)]
    pairs = [(k, word(rng.randint(0, 120)) + (rng.choice(passages) if k % 3 == 0 else "") + word(rng.randint(0, 90)))
             for k in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in pairs], "doc_id long, text string").repartition(5)
    assert answer(df, hot=hot) == brute(pairs)


def test_low_complexity(spark):
    pairs = [(3, "ab" * 200), (1, "ab" * 60), (2, "a" * 49), (4, "a" * 50), (5, "a" * 51), (0, "b" + "ab" * 30)]
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    assert answer(df) == brute(pairs)


def test_a_text_longer_than_a_hashed_part(spark):
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefghijklmnop") for _ in range(x.HASH_BYTES + 5000))
    at = x.HASH_BYTES - 40          # a string across the parts' border
    df = spark.createDataFrame([(1, long[at:at + 90]), (2, long), (3, long[100:400])], "doc_id long, text string")
    got = {r[0]: r for r in answer(df)}
    assert got[2][2] == 90 and got[2][3] == 1 and got[3][2] == 300


def test_texts_and_spans(spark):
    out = {r.doc_id: r for r in x.without_repeats(docs(spark)).collect() if r.doc_id is not None and r.doc_id != 5}
    assert out[1].text == rows()[0][1] and out[2].text == "" and out[2].n_chars == 0
    assert out[6].text is None and out[1].extra == rows()[0][5]
    assert x.without_repeats(docs(spark)).columns == docs(spark).columns
    r = next(r for r in x.repeats_removed(docs(spark), with_text=True).collect() if r.row.doc_id == 2)
    assert r.spans == [[0, r.n_bytes]]


def test_empty_table(spark):
    assert answer(empty_docs(spark)) == []
    assert x.without_repeats(empty_docs(spark)).count() == 0


def test_every_string_lies_in_one_phrase_and_equal_strings_share_a_trigger():
    rng = np.random.default_rng(1)
    body = rng.integers(97, 101, 3000, dtype=np.uint8)
    buf = np.concatenate([body, body[500:900], body[:60]])
    offsets = np.array([0, 3000, 3400, 3460])
    text, first, more, trigger, _ = x.phrases(buf, offsets)
    of = {}
    for t, f, m, g in zip(text, first, more, trigger):
        for p in range(f, f + m + 1):
            key = (t, p)
            assert key not in of
            of[key] = g
    assert len(of) == sum(max(0, n - 49) for n in np.diff(offsets))
    for p in range(400 - 49):
        assert of[(0, 500 + p)] == of[(1, p)]
