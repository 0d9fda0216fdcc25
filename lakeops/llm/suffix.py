"""Exact removal of repeated byte strings by prefix-free parsing.

Every byte covered by a string of ``LENGTH`` bytes that also starts in a
document with a smaller id is removed. The texts are parsed into phrases:

* triggers: a rolling hash of ``WINDOW`` bytes; the trigger of a string of
  LENGTH bytes is its (leftmost) window of smallest hash, so equal strings have
  equal triggers at equal places, wherever they stand;
* a phrase is the bytes of all neighbouring strings that share a trigger.
  Phrases overlap by LENGTH - 1 bytes, so every string of LENGTH bytes lies in one
  phrase of its text, and equal strings lie in phrases of one trigger;
* the dictionary holds each distinct phrase with the smallest document that
  has it, the parse is the phrases' places in the documents.

A phrase that a smaller document has is removed whole through the parse. What is
left are first occurrences; those whose trigger has other phrases too may share
a part with them. Their suffixes of LENGTH bytes or more are put in the order of
the corpus (a suffix array of the dictionary of one bucket of triggers), where
equal strings are neighbours and the smallest document of a run is read off.
Suffixes need be compared over LENGTH bytes only, which the overlap keeps inside a
phrase, so the order of the parse never decides and no parse suffix array is
built.

As Spark jobs: texts are packed, compressed, into chunk rows of a bucketed table,
so that the two later joins with them shuffle no text; phrases go to buckets of
triggers as packed arrays, combined per batch (a phrase of many documents is
one entry per batch, its later documents are removed on the spot); a trigger with
more than ``HOT`` different phrases is dealt on string by string. The number of
buckets follows the size of the corpus.

Phrases are told apart by 64-bit trigger hash and 48-bit phrase hash, strings of
hot triggers by a 128-bit hash, all others by their bytes.

Defined cases: NULL and empty texts have no bytes and nothing to remove; a NULL
id ranks after all others; rows that repeat an id are no smaller than each
other, so they keep what they share; texts shorter than LENGTH stay; strings
never reach across documents; other columns are carried along, whatever their
names; an empty table gives no rows."""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import give_back, run_folder, written

LENGTH, WINDOW = 50, 24
CHUNK_BYTES = 1 << 20       # text of a chunk row
HASH_BYTES = 2 << 20        # text hashed at a time
BATCH_BYTES = 16 << 20      # text whose phrases are combined before they are sent
BUCKET_BYTES = 8 << 20      # text whose phrases one bucket gets
HOT = 256                   # phrases of a trigger in a batch (16 times as many in a bucket) that make it hot
LAST = np.iinfo(np.int64).max
COVERED, UNSURE, BY_STRING = 0, 1, 2
_U = np.uint64
_TABLE = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)


# ---------------------------------------------------------------- triggers and phrases

def mix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    z = x * _U(0x9E3779B97F4A7C15)
    z += y
    z ^= z >> _U(32)
    z *= _U(0xD6E8FEB86659FD93)
    return z


def window_hashes(buf: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The hash of the ``window`` bytes at each place, from hashes of 1, 2, 4,
    ... bytes."""
    part, size, out, have = _TABLE[buf], 1, None, 0
    while True:
        if window & size:
            if out is None:
                out, have = part, size
            else:
                n = max(0, len(buf) - have - size + 1)
                out, have = mix(out[:n], part[have:have + n]), have + size
        if have == window or 2 * size > window:
            return out[:max(0, len(buf) - window + 1)]
        part, size = mix(part[:max(0, len(part) - size)], part[size:]), 2 * size


def least_of(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of the ``width`` values from each place on."""
    size = 1
    while 2 * size <= width:
        x, size = np.minimum(x[:-size], x[size:]), 2 * size
    return np.minimum(x[:len(x) - (width - size)], x[width - size:]) if width > size else x


def phrases(buf: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """(text, first, more, trigger, phrase) of every phrase of the texts
    ``buf[offsets[i]:offsets[i + 1]]``: the strings of ``length`` bytes that start
    at first .. first + more share the trigger hash; phrase is a hash of all
    their bytes. Places count from the text's start."""
    sizes = np.diff(offsets)
    if not (sizes >= length).any():
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    h = window_hashes(buf)
    low = _U((1 << 27) - 1)
    trigger = (least_of((h & ~low) | np.arange(len(h), dtype=np.uint64), length - WINDOW + 1) & low).astype(np.int64)
    starts = np.zeros(len(buf) + 1, np.int32)
    long = sizes >= length
    np.add.at(starts, offsets[:-1][long], 1)
    np.add.at(starts, (offsets[1:] - length + 1)[long], -1)
    at = np.flatnonzero(np.cumsum(starts[:len(trigger)]))
    own = trigger[at]
    cut = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    first, last = at[cut], at[np.concatenate((cut[1:] - 1, [len(at) - 1]))]
    own = own[cut]

    def string(p):      # windows that cover the string at p
        out = h[p]
        for q in [*range(WINDOW, length - WINDOW, WINDOW), length - WINDOW]:
            out = mix(out, h[p + q])
        return out

    # the first and the last string cover the phrase: they are less than a string apart
    phrase = mix(mix(string(first), string(last)), ((last - first) * 64 + own - first).astype(np.uint64))
    text = np.searchsorted(offsets, first, side="right") - 1
    return text, first - offsets[text], last - first, h[own], phrase


def spans_of(sizes, length: int):
    """Ranges (document, from, to) that together hold every string of length
    bytes of every document once, in groups of about HASH_BYTES."""
    group, held = [], 0
    for i, n in enumerate(sizes):
        for s in range(0, max(1, n - length + 1), HASH_BYTES):
            e = min(n, s + HASH_BYTES + length - 1)
            group.append((i, s, e))
            held += e - s
            if held >= HASH_BYTES:
                yield group
                group, held = [], 0
    if group:
        yield group


# ---------------------------------------------------------------- packed arrays

def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: for each its length, then all of them."""
    return np.array([len(a) for a in arrays], "<u4").tobytes() + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(blob, "<u4", len(kinds)), 4 * len(kinds), []
    for n, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(blob, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def joined_blobs(blobs, *kinds: str, rows: int = 0) -> list[np.ndarray]:
    """The arrays of several blobs, each kind concatenated. The first ``rows``
    arrays describe documents, and the array after them points into these; it is
    made to point into the concatenation."""
    parts, shift = [unpack(b, *kinds) for b in blobs], 0
    if rows:
        for p in parts:
            p[rows] = p[rows].astype(np.int64) + shift
            shift += len(p[0])
    return [np.concatenate(x) if parts else np.zeros(0, k) for x, k in zip(zip(*parts), kinds)] if parts else \
        [np.zeros(0, k) for k in kinds]


def by_chunk(kind: int, chunk: np.ndarray, *arrays: np.ndarray) -> pd.DataFrame:
    """Rows (kind, chunk, blob), the arrays dealt to their chunks."""
    order = np.argsort(chunk, kind="stable")
    chunk, arrays = chunk[order], [a[order] for a in arrays]
    cut = np.flatnonzero(np.concatenate(([True], chunk[1:] != chunk[:-1]))) if len(chunk) else np.zeros(0, int)
    ends = [*cut[1:].tolist(), len(chunk)]
    return pd.DataFrame({"kind": np.full(len(cut), kind, np.int32), "chunk": chunk[cut],
                         "blob": [pack(*(a[s:e] for a in arrays)) for s, e in zip(cut.tolist(), ends)]})


def smallest(key_order: np.ndarray, new: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The smallest rank of each row's run of equal keys; ``new`` marks where
    a run begins in ``key_order``."""
    least = np.minimum.reduceat(rank[key_order], np.flatnonzero(new))
    out = np.empty_like(rank)
    out[key_order] = least[np.cumsum(new) - 1]
    return out


def runs(*sorted_keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(sorted_keys[0]), bool)
    new[1:] = False
    for k in sorted_keys:
        new[1:] |= k[1:] != k[:-1]
    return new


# ---------------------------------------------------------------- step 0: chunks

def chunk_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The texts as chunk rows (chunk, ranks, lens, data, rows), a table
    bucketed by chunk: ``rows`` holds the other columns, ``data`` the texts' bytes."""
    spark = docs.sparkSession
    others = [c for c in docs.columns if c != text]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"),
                       F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(int(LAST))).alias("rank"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("ranks", T.ArrayType(T.LongType())),
        T.StructField("lens", T.ArrayType(T.LongType())), T.StructField("data", T.BinaryType()),
        T.StructField("rows", T.ArrayType(rows.schema["row"].dataType))])

    def run(batches):
        part, seq, coder = TaskContext.get().partitionId(), 0, zstandard.ZstdCompressor(level=3)
        for batch in batches:
            if not batch.num_rows:
                continue
            row, rank, texts = (batch.column(i) for i in range(3))
            sizes = np.where(pc.is_null(texts).to_numpy(zero_copy_only=False), -1,
                             pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)).astype(np.int64)
            ends, s = np.cumsum(np.maximum(sizes, 0)), 0
            while s < len(sizes):
                before = ends[s - 1] if s else 0
                e = max(s + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, side="right")))
                data = b"".join(x.as_buffer().to_pybytes() for x in texts[s:e] if x.is_valid)
                one = pa.array([0, e - s], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array([(part << 32) | seq], pa.int64()),
                    pa.ListArray.from_arrays(one, rank[s:e].cast(pa.int64())),
                    pa.ListArray.from_arrays(one, pa.array(sizes[s:e], pa.int64())),
                    pa.array([coder.compress(data)], pa.binary()),
                    pa.ListArray.from_arrays(one, row[s:e])], names=["chunk", "ranks", "lens", "data", "rows"])
                s, seq = e, seq + 1

    name = f"lakeops_chunks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # dealt by bucket first: a file per bucket, however many tasks there are
    (rows.mapInArrow(run, schema).repartition(buckets, "chunk").write.bucketBy(buckets, "chunk")
     .option("path", run_folder(spark, "chunks")).saveAsTable(name))
    table = spark.table(name)       # resolved; the name is of no use any more, the files stay
    spark.sql(f"DROP TABLE {name}")
    return table


def texts_of(data: bytes, lens) -> tuple[bytes, np.ndarray]:
    offsets = np.concatenate(([0], np.cumsum(np.maximum(np.asarray(lens, np.int64), 0))))
    return (zstandard.ZstdDecompressor().decompress(data, max_output_size=int(offsets[-1]) + 1)
            if offsets[-1] else b""), offsets


# ---------------------------------------------------------------- step 1: dictionary

# Of the documents: rank, chunk, place in the chunk; of the phrases: document,
# first string (low and high half), more strings, trigger hash (8 and 32 bits
# beside the bucket), phrase hash (48 bits); hot triggers.
PHRASE = ("<i8", "<i8", "<u4", "<u2", "<u2", "<u2", "u1", "u1", "<u4", "<u2", "<u4", "<u8")
BATCH_TEXTS = 40_000        # texts of a batch, so that two bytes name its documents
KEY_BITS = _U(0xFFFFFFFF000000FF)
SCHEMA = "bucket int, kind int, chunk long, blob binary"


def send_phrases(batches, buckets: int, length: int, most: int):
    """Map: the phrases of a batch of chunks, combined, to their triggers'
    buckets; what a smaller document of the batch has is removed at once."""
    waiting, held, docs, n_docs = [], 0, [], 0

    def flush():
        nonlocal waiting, held, docs, n_docs
        if not waiting:
            return
        text, first, more, trigger, phrase = (np.concatenate(x) for x in zip(*waiting))
        chunk, place, rank = (np.concatenate(x) for x in zip(*docs))
        waiting, held, docs, n_docs = [], 0, [], 0
        order = np.argsort(mix(trigger, phrase), kind="stable")
        new = runs(trigger[order], phrase[order])
        keep = rank[text] == smallest(order, new, rank[text])
        gone = ~keep
        yield by_chunk(COVERED, chunk[text[gone]], place[text[gone]].astype("<u4"), first[gone].astype("<u4"),
                       more[gone].astype("u1")).assign(bucket=lambda d: d["chunk"] % buckets)
        # triggers with very many phrases are dealt by string
        own = trigger[order[new]]
        names, counts = np.unique(own, return_counts=True)
        hot = names[counts > most]
        direct = keep & np.isin(trigger, hot) if len(hot) else np.zeros(len(keep), bool)
        if len(hot):
            yield by_chunk(BY_STRING, chunk[text[direct]], place[text[direct]].astype("<u4"),
                           first[direct].astype("<u4"), more[direct].astype("u1")
                           ).assign(bucket=lambda d: d["chunk"] % buckets)
        go = np.flatnonzero(keep & ~direct)
        bucket = (trigger[go] % _U(buckets)).astype(np.int64)
        go = go[np.lexsort((trigger[go], bucket))]
        bucket = (trigger[go] % _U(buckets)).astype(np.int64)
        hot_bucket = (hot % _U(buckets)).astype(np.int64)
        out = []
        for b in np.union1d(bucket, hot_bucket).tolist():
            s, e = np.searchsorted(bucket, [b, b + 1])
            i = go[s:e]
            used, at = np.unique(text[i], return_inverse=True)
            t, p = trigger[i], phrase[i]
            out.append([b, -1, 0, pack(
                rank[used].astype("<i8"), chunk[used].astype("<i8"), place[used].astype("<u4"),
                at.astype("<u2"), (first[i] & 65535).astype("<u2"), (first[i] >> 16).astype("<u2"),
                more[i].astype("u1"), (t & _U(255)).astype("u1"), (t >> _U(32)).astype("<u4"),
                (p & _U(65535)).astype("<u2"), (p >> _U(32)).astype("<u4"), hot[hot_bucket == b].astype("<u8"))])
        yield pd.DataFrame(out, columns=["bucket", "kind", "chunk", "blob"])

    def ordered(frames):
        for f in frames:
            if len(f):
                yield f[["bucket", "kind", "chunk", "blob"]].astype({"bucket": "int32", "kind": "int32"})

    for pdf in batches:
        for chunk, ranks, lens, data in zip(pdf["chunk"], pdf["ranks"], pdf["lens"], pdf["data"]):
            raw, offsets = texts_of(data, lens)
            buf, sizes = np.frombuffer(raw, np.uint8), np.diff(offsets).tolist()
            for group in spans_of(sizes, length):
                part = np.concatenate([buf[offsets[i] + s:offsets[i] + e] for i, s, e in group])
                cuts = np.concatenate(([0], np.cumsum([e - s for _, s, e in group])))
                text, first, more, trigger, phrase = phrases(part, cuts, length)
                doc, start = (np.array([g[k] for g in group]) for k in (0, 1))
                waiting.append((doc[text] + n_docs, first + start[text], more, trigger, phrase))
            docs.append((np.full(len(sizes), chunk, np.int64), np.arange(len(sizes)), np.asarray(ranks, np.int64)))
            n_docs, held = n_docs + len(sizes), held + len(raw)
            if held >= BATCH_BYTES or n_docs >= BATCH_TEXTS:
                yield from ordered(flush())
    yield from ordered(flush())
    give_back()


def look_up(pdf: pd.DataFrame, most: int) -> pd.DataFrame:
    """Reduce, one bucket: the dictionary of its triggers. Phrases that a
    smaller document has are covered; first occurrences beside other phrases of
    their trigger are unsure."""
    ready = pdf[pdf["kind"] >= 0][["kind", "chunk", "blob"]]
    rank, chunk, place, text, low, high, more, t0, t1, p0, p1, hot = joined_blobs(
        pdf["blob"][pdf["kind"] < 0], *PHRASE, rows=3)
    if not len(text):
        return ready
    text, first = text.astype(np.int64), low.astype("<u4") | high.astype("<u4") << np.uint32(16)
    key = t0.astype(np.uint64) | t1.astype(np.uint64) << _U(32)
    phrase = p0.astype(np.uint64) | p1.astype(np.uint64) << _U(32)
    own = rank[text]
    order = np.lexsort((phrase, key))
    new, new_key = runs(key[order], phrase[order]), runs(key[order])
    least = smallest(order, new, own)
    of_key = np.cumsum(new_key) - 1
    phrases_of_key = np.bincount(of_key[new])
    count = np.empty(len(order), np.int64)
    count[order] = phrases_of_key[of_key]
    hot_here = np.isin(key, np.unique(hot & KEY_BITS)) if len(hot) else np.zeros(len(key), bool)
    gone = own > least
    string = ~gone & (hot_here | (count > 16 * most))
    unsure = ~gone & ~string & (count > 1)

    def rows(kind, which, *more_arrays):
        return by_chunk(kind, chunk[text[which]], place[text[which]].astype("<u4"), first[which], more[which],
                        *(a[which] for a in more_arrays))

    return pd.concat([ready, rows(COVERED, gone), rows(UNSURE, unsure, key), rows(BY_STRING, string)])


# ---------------------------------------------------------------- step 2: suffixes

SUFFIX = ("<i8", "<i8", "<u4", "<u4", "<u4", "u1", "u1")
STRING = ("<i8", "<i8", "<u4", "<u4", "<u4", "<u8", "<u8")


def later(rank: np.ndarray, order: np.ndarray, new: np.ndarray) -> np.ndarray:
    return rank > smallest(order, new, rank)


def string_keys(buf: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the strings of ``length`` bytes that start at ``at``."""
    h = window_hashes(buf)
    one, two = h[at], h[at] * _U(0xA0761D6478BD642F)
    for q in [*range(WINDOW, length - WINDOW, WINDOW), length - WINDOW]:
        one, two = mix(one, h[at + q]), mix(two, ~h[at + q])
    return one, two


def send_suffixes(batches, buckets: int, length: int):
    """Map: the bytes of unsure phrases to their triggers' buckets; the
    strings of hot triggers' phrases, combined, to buckets of their own."""
    unsure, strings, held = [], [], 0

    def frame(rows):
        return pd.DataFrame(rows, columns=["bucket", "kind", "chunk", "blob"]).astype(
            {"bucket": "int32", "kind": "int32", "chunk": "int64"})

    def dealt(kind, bucket, doc, arrays, tail=None):
        """Rows for each bucket: the documents used, then the arrays."""
        order, out = np.argsort(bucket, kind="stable"), []
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in range(buckets):
            i = order[cut[b]:cut[b + 1]]
            if not len(i):
                continue
            used, at = np.unique(doc[i], return_inverse=True)
            head = [table[used] for table in (ranks, chunks, places)]
            extra = [] if tail is None else [np.frombuffer(b"".join(tail[j] for j in i), "u1")]
            out.append([b, kind, 0, pack(*(x.astype(k) for x, k in zip(head, ("<i8", "<i8", "<u4"))),
                                         at.astype("<u4"), *(a[i] for a in arrays), *extra)])
        return frame(out)

    def flush():
        nonlocal unsure, strings, held, ranks, chunks, places, docs
        ranks, chunks, places = (np.concatenate(x) for x in zip(*docs))
        if unsure:
            doc, first, more, key = (np.concatenate([u[k] for u in unsure]) for k in range(4))
            tail = [x for u in unsure for x in u[4]]
            yield dealt(UNSURE, (key % _U(buckets)).astype(np.int64), doc,
                        (first.astype("<u4"), more.astype("u1")), tail)
        if strings:
            doc, first, one, two = (np.concatenate([u[k] for u in strings]) for k in range(4))
            order = np.lexsort((two, one))
            gone = later(ranks[doc], order, runs(one[order], two[order]))
            yield by_chunk(COVERED, chunks[doc[gone]], places[doc[gone]].astype("<u4"), first[gone].astype("<u4"),
                           np.zeros(int(gone.sum()), "u1")).assign(bucket=lambda d: (d["chunk"] % buckets).astype("int32"))[
                ["bucket", "kind", "chunk", "blob"]]
            i = np.flatnonzero(~gone)
            yield dealt(BY_STRING, (one[i] % _U(buckets)).astype(np.int64), doc[i], (first[i].astype("<u4"), one[i], two[i]))
        unsure, strings, held, docs = [], [], 0, []

    docs, n_docs = [], 0
    ranks = chunks = places = None
    for pdf in batches:
        for chunk, rank, lens, data, found in zip(*(pdf[c] for c in ("chunk", "ranks", "lens", "data", "found"))):
            raw, offsets = texts_of(data, lens)
            buf, n_docs = np.frombuffer(raw, np.uint8), sum(len(d[0]) for d in docs)
            docs.append((np.asarray(rank, np.int64), np.full(len(lens), chunk, np.int64), np.arange(len(lens))))
            place, first, more, key = joined_blobs([f["blob"] for f in found if f["kind"] == UNSURE],
                                                   "<u4", "<u4", "u1", "<u8")
            if len(place):
                at = offsets[place] + first
                tails = [raw[s:s + m + length] for s, m in zip(at.tolist(), more.tolist())]
                unsure.append((place.astype(np.int64) + n_docs, first, more, key, tails))
                held += sum(map(len, tails))
            place, first, more = joined_blobs([f["blob"] for f in found if f["kind"] == BY_STRING], "<u4", "<u4", "u1")
            if len(place):
                n = more.astype(np.int64) + 1
                step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                place, first = np.repeat(place.astype(np.int64), n), np.repeat(first.astype(np.int64), n) + step
                strings.append((place + n_docs, first, *string_keys(buf, offsets[place] + first, length)))
                held += 24 * len(place)
            if held >= BATCH_BYTES // 2:
                yield from flush()
    if docs:
        yield from flush()
    give_back()


def order_suffixes(pdf: pd.DataFrame, length: int) -> pd.DataFrame:
    """Reduce, one bucket: the suffix array of its phrases, over the first
    ``length`` bytes of each suffix, and the strings that were sent alone."""
    out = [pdf[pdf["kind"] == COVERED][["kind", "chunk", "blob"]]]
    rank, chunk, place, doc, first, more, data = joined_blobs(
        pdf["blob"][pdf["kind"] == UNSURE], *SUFFIX, rows=3)
    if len(doc):
        n = more.astype(np.int64) + 1
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        size = n - 1 + length
        start = np.repeat(np.cumsum(size) - size, n) + step
        suffix = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, length)[start]
                                      ).view(f"S{length}").ravel()
        doc, at = np.repeat(doc.astype(np.int64), n), np.repeat(first.astype(np.int64), n) + step
        array = np.argsort(suffix, kind="stable")
        gone = later(rank[doc], array, runs(suffix[array]))
        out.append(by_chunk(COVERED, chunk[doc[gone]], place[doc[gone]].astype("<u4"), at[gone].astype("<u4"),
                            np.zeros(int(gone.sum()), "u1")))
    rank, chunk, place, doc, first, one, two = joined_blobs(pdf["blob"][pdf["kind"] == BY_STRING], *STRING, rows=3)
    if len(doc):
        doc, order = doc.astype(np.int64), np.lexsort((two, one))
        gone = later(rank[doc], order, runs(one[order], two[order]))
        out.append(by_chunk(COVERED, chunk[doc[gone]], place[doc[gone]].astype("<u4"), first[gone],
                            np.zeros(int(gone.sum()), "u1")))
    return pd.concat(out)


# ---------------------------------------------------------------- step 3: removal

def removed_spans(size: int, first: np.ndarray, more: np.ndarray, length: int) -> np.ndarray:
    """Maximal runs [start, end) of the bytes covered by the strings that
    start at first .. first + more."""
    depth = np.zeros(size + 1, np.int64)
    np.add.at(depth, first, 1)
    np.add.at(depth, first + more + length, -1)
    inside = np.concatenate(([False], np.cumsum(depth[:-1]) > 0, [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge.reshape(-1, 2)


def removal(batches, length: int, with_text: bool):
    for batch in batches:
        for k in range(batch.num_rows):
            lens = np.asarray(batch.column("lens")[k].as_py(), np.int64)
            raw, offsets = texts_of(batch.column("data")[k].as_py(), lens)
            found = batch.column("found")[k].as_py() or []
            place, first, more = joined_blobs([f["blob"] for f in found], "<u4", "<u4", "u1")
            order = np.argsort(place, kind="stable")
            place, first, more = place[order], first[order].astype(np.int64), more[order].astype(np.int64)
            cut = np.searchsorted(place, np.arange(len(lens) + 1))
            out = []
            for i, n in enumerate(lens.tolist()):
                own = raw[offsets[i]:offsets[i + 1]]
                spans = np.zeros((0, 2), int)
                if cut[i + 1] > cut[i]:
                    s = slice(cut[i], cut[i + 1])
                    spans = removed_spans(len(own), first[s], more[s], length)
                edges = [0, *spans.ravel().tolist(), len(own)]
                kept = b"".join(own[s:e] for s, e in zip(edges[::2], edges[1::2]))
                out.append((len(own), len(own) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                            None if n < 0 else kept, spans.tolist()))
            size, gone, count, digest, kept, spans = zip(*out)
            rows = batch.column("rows").slice(k, 1).flatten()
            arrays = [rows, pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64()),
                      pa.array(digest, pa.string())]
            names = ["row", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                arrays += [pa.array([None if x is None else x.decode("utf-8", "ignore") for x in kept], pa.string()),
                           pa.array(spans, pa.list_(pa.list_(pa.int64())))]
                names += ["kept_text", "spans"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)


def found_by_chunk(found: DataFrame) -> DataFrame:
    """One row per chunk with what was found about it (bounded by its text)."""
    return found.groupBy("chunk").agg(F.collect_list(F.struct("kind", "blob")).alias("found"))


def repeats_removed(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                    with_text: bool = False, hot: int = HOT) -> DataFrame:
    """A row per document: ``row`` (its other columns), n_bytes, n_removed,
    n_spans, kept_sha256 and, ``with_text``, kept_text (a character cut by a
    removal goes) and spans ([start, end) in bytes)."""
    chunks = chunk_table(docs, key, text)
    size = chunks.agg(F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(8, -(-size // BUCKET_BYTES))
    result = "kind int, chunk long, blob binary"
    sent = chunks.select("chunk", "ranks", "lens", "data").mapInPandas(
        lambda it: send_phrases(it, buckets, length, hot), SCHEMA)
    looked = written(sent.groupBy("bucket").applyInPandas(lambda pdf: look_up(pdf, hot), result), "phrases-found")
    ask = found_by_chunk(looked.where(F.col("kind") != COVERED))
    suffixes = chunks.select("chunk", "ranks", "lens", "data").join(ask, "chunk").mapInPandas(
        lambda it: send_suffixes(it, buckets, length), SCHEMA)
    shared = written(suffixes.groupBy("bucket").applyInPandas(lambda pdf: order_suffixes(pdf, length), result),
                     "suffixes-found")
    covered = found_by_chunk(looked.where(F.col("kind") == COVERED).unionByName(shared))
    row = chunks.schema["rows"].dataType.elementType.simpleString()
    schema = f"row {row}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept_text string, spans array<array<long>>" if with_text else ""
    return (chunks.select("chunk", "lens", "data", "rows").join(covered, "chunk", "left")
            .mapInArrow(lambda it: removal(it, length, with_text), schema))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The contract's digest columns."""
    out = repeats_removed(docs.select("doc_id", "text"))
    return out.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with its texts cut and n_chars counted anew."""
    out = repeats_removed(docs, with_text=True)
    now = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return out.select(*[now[c].alias(c) if c in now else F.col(f"row.`{c}`") for c in docs.columns])
