"""Mixing, sharding and quality rules: brute force, and no Python in the plans."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest

from lakeops.llm import mixing, quality, sharding
from lakeops.llm.queries import ORACLE_SQL

from .data import docs, empty_docs, prose, rows, tuples

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def md5(*parts):
    return hashlib.md5(":".join(parts).encode()).hexdigest()


# ---------------------------------------------------------------- sharding

def place(key, shards):
    def score(s):
        return -math.log((int(md5("s0", str(s), key)[:13], 16) + 0.5) / 2 ** 52)
    return min(range(shards), key=lambda s: (score(s), s))


def test_sharding_matches_brute_force(spark):
    out = sharding.sharded_documents(docs(spark, 300)).collect()
    data = rows(300)
    want = collections.Counter()
    for i, t, *_ in data:
        b, key = (t or "").encode(), "null" if i is None else str(i)
        want[(i, len(b) + 1, zlib.crc32(b), "key", place(key, 16), place(key, 17))] += 1
    assert collections.Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in out) == want
    for s in range(16):
        slots = sorted(r.slot for r in out if r.shard == s)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 16) for r in out)
    assert any(r.grown_shard == 16 for r in out)


def test_weights_set_the_shares(spark):
    df = sharding.shard_rows(spark.range(20_000), "id", [1, 3, 0, 4]).groupBy("shard").count()
    share = {r.shard: r["count"] / 20_000 for r in df.collect()}
    assert share == pytest.approx({0: 1 / 8, 1: 3 / 8, 3: 4 / 8}, abs=0.02)


def test_a_longer_list_of_shards_moves_few_rows(spark):
    a = sharding.shard_rows(spark.range(5000), "id", [1.0] * 16, added_weight=1.0).collect()
    b = {r.id: r.shard for r in sharding.shard_rows(spark.range(5000), "id", [1.0] * 17).collect()}
    assert all(r.grown_shard == b[r.id] for r in a)
    moved = sum(r.grown_shard != r.shard for r in a)
    assert moved == sum(r.grown_shard == 16 for r in a) and 150 < moved < 450


def test_empty_shards(spark):
    assert sharding.sharded_documents(empty_docs(spark)).count() == 0


# ---------------------------------------------------------------- mixing

def brute_mixture(data, weights, target, max_epochs, seed):
    def leaf(lang, source):
        number = re.search("([0-9]+)$", source or "")
        return (f"domain{int(number.group()) % 4}" if number else "none", lang or "none", source or "none")

    docs_ = [(i, leaf(lang, source), len(WORD.findall(t or ""))) for i, t, lang, source, *_ in data]
    tokens = collections.Counter()
    for _, at, n in docs_:
        tokens[at] += n
    cap = {at: n * max_epochs for at, n in tokens.items()}
    budgets = {(): min(sum(tokens.values()) * target[0] // target[1], sum(cap.values()))}
    for depth, level in enumerate(mixing.LEVELS):
        below = collections.Counter()
        for at, n in cap.items():
            below[at[:depth + 1]] += n
        for parent in {at[:depth] for at in cap}:
            kids = {k: n for k, n in below.items() if k[:depth] == parent}
            w = {k: weights.get(level, {}).get(k[depth], 1) for k in kids}
            left, open_ = budgets[parent], {k for k in kids if w[k]}
            while True:     # fill whoever holds less than a share of the rest
                total = sum(w[k] for k in open_)
                full = {k for k in open_ if kids[k] * total <= w[k] * left}
                # one at a time, smallest level first
                if not full:
                    break
                k = min(full, key=lambda k: kids[k] / w[k])
                budgets[k] = kids[k]
                left -= kids[k]
                open_.discard(k)
            for k in kids:
                if k in open_:
                    budgets[k] = w[k] * left // sum(w[j] for j in open_)
                budgets.setdefault(k, 0)
    out = []
    for at in cap:
        whole, rest = divmod(budgets[at], tokens[at]) if tokens[at] else (0, 0)
        own = [(md5(seed, str(whole), "null" if i is None else str(i)), i, n) for i, a, n in docs_ if a == at]
        for key, i, n in own:
            before = sum(m for k, _, m in own if k < key)
            out += [(i, *at, e, n, n) for e in range(whole)]
            if before < rest:
                here = [k for k, _, _ in own if k > key and sum(m for q, _, m in own if q < k) < rest]
                out.append((i, *at, whole, n, n if here else min(n, rest - before)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("target, epochs, weights", [
    ((3, 5), 2, mixing.WEIGHTS), ((9, 10), 1, {"lang": {"en": 9, "fr": 0}}), ((3, 1), 2, {}), ((0, 1), 2, {}),
    ((1, 7), 3, {"domain": {"domain1": 100}, "source": {"src1": 3}})])
def test_mixture_matches_brute_force(spark, target, epochs, weights):
    got = tuples(mixing.mixture(docs(spark, 120), weights, target, epochs, "t"))
    assert got == brute_mixture(rows(120), weights, target, epochs, "t")


def test_budgets_are_met_to_the_token(spark):
    out = mixing.mixture(docs(spark, 200)).toPandas()
    total = sum(len(WORD.findall(r[1] or "")) for r in rows(200))
    assert 0 <= total * 3 // 5 - out.taken.sum() <= 60


def test_mixed_keeps_columns_and_repeats_by_epoch(spark):
    # a leaf part named like a column of the input is no clash
    df = docs(spark, 50).withColumnRenamed("extra", "_lang")
    out = mixing.mixed(df)
    assert out.columns == df.columns
    want = collections.Counter(r[0] for r in brute_mixture(rows(50), mixing.WEIGHTS, mixing.TARGET,
                                                           mixing.MAX_EPOCHS, mixing.SEED))
    assert collections.Counter(r.doc_id for r in out.collect()) == want


def test_empty_mixture(spark):
    assert mixing.mixture(empty_docs(spark)).count() == 0
    assert mixing.mixed(empty_docs(spark)).count() == 0


# ---------------------------------------------------------------- quality

def brute_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(windows)
    in_repeat = set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            in_repeat |= {i, i + 1, i + 2}
    lines = [s for s in text.split("\n") if WORD.search(s)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(in_repeat),
            n < 50 or 100 * len(in_repeat) > 50 * n, len(lines))


def brute_kept(data):
    """The verdicts by numpy: concentration steps from the two starts."""
    floors = np.array(quality.FLOORS)
    stats = [brute_statistics(r[1]) for r in data]
    x = np.array([[math.log(max(s[1], 1) / max(s[0], 1)), math.log1p(100 * s[2] / max(s[1], 1)),
                   math.log1p(100 * s[3] / max(s[6], 1)), math.log1p(100 * s[4] / max(s[0], 1))] for s in stats])
    kept = np.zeros(len(data), bool)
    groups = collections.defaultdict(list)
    for k, (r, s) in enumerate(zip(data, stats)):
        if not s[5]:
            groups[(r[2], r[3])].append(k)
    for at in groups.values():
        own, best = x[at], None
        med = []
        for j in range(4):
            bins = np.sort(np.floor(own[:, j] / (floors[j] / 8)))
            med.append((bins[(len(bins) + 1) // 2 - 1] + 0.5) * (floors[j] / 8))
        for start, (mean, cov) in enumerate([(np.array(med), np.zeros((4, 4))), (own.mean(0), np.cov(own.T, bias=True))]):
            cov = np.atleast_2d(cov) + np.diag(floors ** 2)
            for _ in range(quality.STEPS):
                d = np.einsum("ij,jk,ik->i", own - mean, np.linalg.inv(cov), own - mean)
                bins = np.floor(np.log1p(d) * quality.BIN)
                cut = np.sort(bins)[math.ceil(quality.SHARE * len(own) - 1e-9) - 1]
                near = own[bins <= cut]
                mean = near.mean(0)
                cov = quality.FACTOR * (near - mean).T @ (near - mean) / len(near) + np.diag(floors ** 2)
            det = np.linalg.slogdet(cov)[1] / 2
            if best is None or det < best[0] - 1e-9:
                best = (det, mean, cov)
        _, mean, cov = best
        kept[at] = np.einsum("ij,jk,ik->i", own - mean, np.linalg.inv(cov), own - mean) <= quality.CUT
    return stats, kept


def test_quality_matches_brute_force(spark):
    data = rows(200)
    stats, kept = brute_kept(data)
    want = sorted(((r[0], *s[:6], bool(k)) for r, s, k in zip(data, stats, kept)), key=repr)
    assert tuples(quality.judged(docs(spark, 200))) == want
    assert 0 < sum(kept) < len(data)


def test_kept_documents_are_the_judged_ones(spark):
    # statistics named like a column of the input are no clash
    df = docs(spark, 100).withColumnRenamed("extra", "n_words")
    _, kept = brute_kept(rows(100))
    out = quality.kept_documents(df)
    assert out.columns == df.columns
    assert tuples(out) == sorted((r for r, k in zip(rows(100), kept) if k), key=repr)


def test_symbols_in_clean_company_are_rejected(spark):
    clean = [(i, prose(500 + i, 120), "en", "s") for i in range(100)]
    junk = [(1000 + i, " ".join(w + "%%%" for w in prose(900 + i, 120).split()), "en", "s") for i in range(15)]
    df = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")
    out = {r.doc_id: r.kept for r in quality.judged(df).collect()}
    assert all(out[i] == (i < 1000) for i in out)


@pytest.mark.parametrize("spoilt", [
    lambda k: "\n".join(s + ("\nmore" if i % 2 else "") for i, s in enumerate(lines_of(k))),       # duplicate lines
    lambda k: " ".join(lines_of(k)) + " " + " ".join(lines_of(k)[:5]),                              # repeated words
    lambda k: "\n".join(lines_of(k) + lines_of(k)[:5])], ids=["lines", "words", "both"])
def test_repetition_in_clean_company_is_rejected(spark, spoilt):
    clean = [(i, "\n".join(lines_of(i)), "en", "s") for i in range(100)]
    junk = [(1000 + i, spoilt(1000 + i), "en", "s") for i in range(10)]
    df = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")
    out = quality.judged(df).collect()
    assert not any(r.base_failed for r in out)
    assert {r.doc_id for r in out if not r.kept} == set(range(1000, 1010))


def lines_of(k):
    """Twenty lines of six words; no line and no three words come twice."""
    return [" ".join(f"w{chr(97 + (k + j) % 26)}{100 + 6 * i + j}" for j in range(6)) for i in range(20)]


def test_chi_square():
    assert quality.chi2_quantile(0.95, 4) == pytest.approx(9.4877, abs=1e-3)
    assert quality.chi2_quantile(0.5, 6) == pytest.approx(5.3481, abs=1e-3)


def test_empty_quality(spark):
    assert quality.judged(empty_docs(spark)).count() == 0
    assert quality.kept_documents(empty_docs(spark)).count() == 0


# ---------------------------------------------------------------- plans and SQL

@pytest.mark.parametrize("job", [sharding.sharded_documents, mixing.mixture, quality.judged, mixing.mixed,
                                 quality.kept_documents])
def test_no_python_in_the_plan(spark, job):
    plan = job(docs(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_mixing_sql_on_awkward_rows(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    data = [(i, t.replace("\x00", "0") if t else t, lang, s) for i, t, lang, s, *_ in rows(60)]
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", data)
    got = con.execute(ORACLE_SQL["op4_mixing"])
    cols = [d[0] for d in got.description]
    want = sorted((tuple(r) for r in got.fetchall()), key=repr)
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    assert tuples(mixing.mixture(df).select(*cols)) == want
