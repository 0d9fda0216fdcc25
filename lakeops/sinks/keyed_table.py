"""A table with a unique key for several writers (K1, K3, W1): insert-or-ignore
with optimistic commits, Bloom filters per bucket, and compaction in place.

Layout under ``base``: ``data/<part>/bucket=<b>`` holds the rows that one insert or
compaction wrote, ``filters/<part>`` a Bloom filter of its keys per bucket, and
``_manifest/<version>`` names the parts of every bucket. A version is put in place by a
rename that fails if it exists, so of two writers one wins and the other starts over from
the winner's version: it drops its part, looks the new rows up, and tries the next version.
That is what a database's unique key gives: each key once, from the writer whose commit
came first. Readers take a manifest and see that version whole, also while buckets
are rewritten; parts stay until ``prune`` finds no kept manifest that names them.

A filter is a set of bitmaps (``bitmap_construct_agg``), HASHES bits a key, mergeable by
``bitmap_or_agg``. An insert reads the filters of its buckets first. Keys that no filter
holds are new without a look at the data; only (bucket, part) folders with a possible hit
are opened. BITS a bucket and part fit about BITS / 10 keys with 1 % false hits;
more keys cost needless reads, never wrong rows."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import first_per_key
from .bucketed import BUCKET, bucket_of
from .snapshot import _fs

BUCKETS = 64
SLICE = 1 << 15             # bits of one bitmap
SLICES = 8                  # bitmaps of a filter
BITS = SLICE * SLICES
HASHES = 7
ATTEMPTS = 50


@dataclass(frozen=True)
class Manifest:
    """One version: its number (-1: none yet), the number of buckets and each
    bucket's parts."""
    version: int
    buckets: int
    parts: dict[int, tuple[str, ...]]

    def pairs(self, only=None) -> list[tuple[int, str]]:
        return [(b, p) for b, ps in sorted(self.parts.items()) if only is None or b in only for p in ps]


def _manifest_path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/_manifest/{version:020d}"


def versions(spark: SparkSession, base: str) -> list[int]:
    fs, p, _ = _fs(spark, f"{base.rstrip('/')}/_manifest")
    if not fs.exists(p):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit())


def manifest(spark: SparkSession, base: str, version: int) -> Manifest:
    text = "".join(r.value for r in spark.read.text(_manifest_path(base, version)).collect())   # a line
    found = json.loads(text)
    return Manifest(version, found["buckets"], {int(b): tuple(p) for b, p in found["parts"].items()})


def current(spark: SparkSession, base: str, buckets: int = BUCKETS) -> Manifest:
    found = versions(spark, base)
    return manifest(spark, base, found[-1]) if found else Manifest(-1, buckets, {})


def commit(spark: SparkSession, base: str, new: Manifest) -> bool:
    """Put ``new`` in place; False if its version is there already."""
    fs, final, jvm = _fs(spark, _manifest_path(base, new.version))
    temporary = jvm.org.apache.hadoop.fs.Path(f"{final.toString()}.{uuid.uuid4().hex}")
    out = fs.create(temporary, False)
    out.writeBytes(json.dumps({"buckets": new.buckets, "parts": {str(b): list(p) for b, p in new.parts.items()}}) + "\n")
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        final.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(temporary, final, none)
        return True
    except Exception as e:
        if "FileAlreadyExistsException" not in str(e):
            raise
        fs.delete(temporary, False)
        return False


def _folder(base: str, kind: str, part: str, bucket: int | None = None) -> str:
    path = f"{base.rstrip('/')}/{kind}/{part}"
    return path if bucket is None else f"{path}/{BUCKET}={bucket}"


def read(spark: SparkSession, base: str, schema, version: int | None = None) -> DataFrame:
    """The rows of a version (the last one if not given)."""
    m = current(spark, base) if version is None else manifest(spark, base, version)
    return _rows(spark, base, schema, m.pairs())


def _rows(spark: SparkSession, base: str, schema, pairs: list[tuple[int, str]]) -> DataFrame:
    paths = [_folder(base, "data", p, b) for b, p in pairs]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


# ---------------------------------------------------------------- filters

def _bits(key: str):
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), F.col(key)), F.lit(BITS)) for i in range(HASHES)])


def filters_of(rows: DataFrame, key: str) -> DataFrame:
    """(bucket, slice, bitmap) over the keys of ``rows`` (with a bucket)."""
    bit = rows.select(BUCKET, F.explode(_bits(key)).alias("bit"))
    return (bit.groupBy(BUCKET, F.floor(F.col("bit") / SLICE).cast("int").alias("slice"))
            .agg(F.bitmap_construct_agg(F.col("bit") % SLICE).alias("bitmap")))


def merged_filters(filters: DataFrame) -> DataFrame:
    """One filter a bucket out of several."""
    return filters.groupBy(BUCKET, "slice").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def possible(rows: DataFrame, filters: DataFrame, key: str) -> DataFrame:
    """(key, bucket, part): where a filter (bucket, part, slice, bitmap) holds
    all bits of a key of ``rows``."""
    asked = rows.select(key, BUCKET, F.explode(_bits(key)).alias("bit")).withColumn("slice", F.floor(F.col("bit") / SLICE).cast("int"))
    at = (F.col("bit") % SLICE).cast("int")
    byte = F.conv(F.hex(F.substring("bitmap", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1
    hit = asked.join(filters, [BUCKET, "slice"]).where(is_set)
    return (hit.groupBy(key, BUCKET, "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == HASHES).drop("n"))


# ---------------------------------------------------------------- writing

def _write_part(rows: DataFrame, base: str, key: str) -> str:
    part = uuid.uuid4().hex
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(_folder(base, "data", part))
    filters_of(rows, key).withColumn("part", F.lit(part)).write.parquet(_folder(base, "filters", part))
    return part


def _drop_part(spark: SparkSession, base: str, part: str) -> None:
    for kind in ("data", "filters"):
        fs, p, _ = _fs(spark, _folder(base, kind, part))
        fs.delete(p, True)


def existing_keys(spark: SparkSession, base: str, rows: DataFrame, key: str, schema, m: Manifest) -> DataFrame:
    """Keys of ``rows`` (persisted, with a bucket) that ``m`` holds; opens only
    the folders that a filter points at."""
    touched = {r.b for r in rows.select(F.col(BUCKET).alias("b")).distinct().collect()}     # at most `buckets` rows
    pairs = m.pairs(touched)
    if not pairs:
        return rows.select(key).limit(0)
    filters = spark.read.parquet(*sorted({_folder(base, "filters", p) for _, p in pairs})).where(F.col(BUCKET).isin(touched))
    listed = spark.createDataFrame(pairs, f"{BUCKET} int, part string")     # a merged part's other buckets don't count
    hits = possible(rows, filters.join(listed, [BUCKET, "part"], "left_semi"), key).persist()
    try:
        opened = [(r.b, r.part) for r in hits.select(F.col(BUCKET).alias("b"), "part").distinct().collect()]
        stored = _rows(spark, base, schema, sorted(opened)).select(key)
        return hits.select(key).distinct().join(stored, key, "left_semi")
    finally:
        hits.unpersist()


def insert_ignore(df: DataFrame, base: str, key: str, order: list[str], buckets: int = BUCKETS) -> int:
    """Add the rows of ``df`` whose ``key`` is not there yet (of several the
    first by ``order``; NULL keys are left out); the number added. Safe beside other writers."""
    spark, schema = df.sparkSession, df.schema
    m = current(spark, base, buckets)
    rows = (first_per_key(df.where(F.col(key).isNotNull()), [key], order).select(*df.columns)
            .withColumn(BUCKET, bucket_of(key, m.buckets)).persist())
    try:
        for _ in range(ATTEMPTS):
            new = rows.join(existing_keys(spark, base, rows, key, schema, m), key, "left_anti").select(*df.columns, BUCKET)
            part = _write_part(new, base, key)
            written = spark.read.schema(f"{BUCKET} int").parquet(_folder(base, "filters", part))
            touched = [r[0] for r in written.distinct().collect()]          # at most `buckets` rows
            if not touched:
                _drop_part(spark, base, part)
                return 0
            parts = {**m.parts, **{b: (*m.parts.get(b, ()), part) for b in touched}}
            if commit(spark, base, Manifest(m.version + 1, m.buckets, parts)):
                return spark.read.parquet(_folder(base, "data", part)).count()
            _drop_part(spark, base, part)
            m = current(spark, base)
        raise RuntimeError(f"{ATTEMPTS} commits to {base} lost against other writers")
    finally:
        rows.unpersist()


def compact(spark: SparkSession, base: str, key: str, schema, most: int = 8) -> int:
    """Rewrite the buckets of more than ``most`` parts as one part each, while
    readers and writers go on; the number of buckets. Parts that came in the
    meantime stay beside the new one; should another compaction have replaced what this one read,
    it gives up."""
    m = current(spark, base)
    full = {b: p for b, p in m.parts.items() if len(p) > most}
    if not full:
        return 0
    rows = _rows(spark, base, schema, m.pairs(full)).withColumn(BUCKET, bucket_of(key, m.buckets))
    part = _write_part(rows, base, key)
    for _ in range(ATTEMPTS):
        if any(not set(p) <= set(m.parts.get(b, ())) for b, p in full.items()):
            break
        parts = {b: ((part, *(x for x in p if x not in set(full[b]))) if b in full else p) for b, p in m.parts.items()}
        if commit(spark, base, Manifest(m.version + 1, m.buckets, parts)):
            return len(full)
        m = current(spark, base)
    _drop_part(spark, base, part)
    return 0


def prune(spark: SparkSession, base: str, keep: int = 2) -> int:
    """Drop all manifests but the last ``keep``, and the parts that only they
    named; the number of parts. Parts of an insert under way are named by no manifest yet
    and stay."""
    found = versions(spark, base)
    old, kept = found[:-keep], found[-keep:]
    named = {p for v in kept for _, p in manifest(spark, base, v).pairs()}
    gone = {p for v in old for _, p in manifest(spark, base, v).pairs()} - named
    for part in gone:
        _drop_part(spark, base, part)
    for v in old:
        fs, p, _ = _fs(spark, _manifest_path(base, v))
        fs.delete(p, False)
    return len(gone)
