"""WARC archives: write records as gzip members, read them back in sequence.

Writer: each task appends its rows to archives of its own in a shared folder,
one gzip member per record. An archive's name holds the attempt that wrote it and
no name is used twice, so stores that refuse to overwrite or rename will do; the
returned rows name the archives of the attempts that count, and those are whole. An
archive of a lost or second attempt may lie beside them, named by no row: read
through the rows (stored as a manifest), never through a listing of the folder.
A payload that several records share is stored once: the record with the largest id is the
``response``, the others are ``revisit`` records that name it (identical
payload digest profile).

Reader: one pass over an archive in fixed-size chunks; members are
decompressed incrementally, records are framed by Content-Length, and block
and payload digests are verified. Memory holds one record.

Defined cases: very long payloads are written and read whole; other columns of the
input are not read, whatever their names; a NULL payload is empty; a NULL id ranks below every id and is
written as ``urn:x-no-id``; rows that carry the same largest id and payload are all
responses; a NULL url has no target URI; an empty table gives no archives."""

from __future__ import annotations

import base64
import hashlib
import posixpath
import urllib.parse
import uuid
import zlib

import pandas as pd
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import run_folder

CHUNK = 1 << 16
ARCHIVE_BYTES = 256 << 20   # a new archive begins after so many compressed bytes
SALTS = 64                  # tasks that a payload shared by many rows is dealt to
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2000-01-01T00:00:00Z"


# ---------------------------------------------------------------- records

def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def record_uri(record_id) -> str:
    return "<urn:x-no-id>" if record_id is None else f"<urn:x-page:{urllib.parse.quote(str(record_id), safe='')}>"


def id_of(uri: str | None) -> str | None:
    if not uri or uri == "<urn:x-no-id>":
        return None
    return urllib.parse.unquote(uri[len("<urn:x-page:"):-1])


def record_bytes(record_id, url, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One record as one gzip member. The block is an HTTP response; a revisit
    keeps the response's headers (with the payload's length) and no body."""
    digest = base32_sha1(payload)
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {record_uri(record_id)}", f"WARC-Date: {RECORD_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + urllib.parse.quote(url, safe=":/?#[]@!$&'()*+,;=%~"))
    if revisit:
        head += [f"WARC-Refers-To: {record_uri(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def members(stream):
    """The decompressed bytes of each gzip member of a stream, read in chunks."""
    rest = stream.read(CHUNK)
    while rest:
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            if not rest:
                raise ValueError("the archive ends inside a gzip member")
            parts.append(z.decompress(rest))
            rest = z.unused_data if z.eof else stream.read(CHUNK)
        yield b"".join(parts)
        rest = rest or stream.read(CHUNK)


def headers(data: bytes) -> dict[str, str]:
    out = {}
    for line in data.decode("utf-8").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def parse_record(raw: bytes) -> dict:
    """Frame one record by its Content-Length and verify its digests."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    if not sep or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    h = headers(head)
    size = int(h["content-length"])
    block, end = rest[:size], rest[size:]
    if len(block) != size or end != b"\r\n\r\n":
        raise ValueError("a record's Content-Length does not fit its member")
    if h["warc-block-digest"] != "sha1:" + base32_sha1(block):
        raise ValueError(f"block digest of {h['warc-record-id']} does not fit")
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = h["warc-type"] == "revisit"
    digest = h["warc-payload-digest"].removeprefix("sha1:")
    if not revisit and digest != base32_sha1(payload):
        raise ValueError(f"payload digest of {h['warc-record-id']} does not fit")
    return {"record_id": id_of(h["warc-record-id"]), "record_type": h["warc-type"],
            "refers_to": id_of(h.get("warc-refers-to")), "url": h.get("warc-target-uri"),
            "payload_digest": digest, "payload_bytes": int(headers(http)["content-length"]),
            "payload": None if revisit else payload}


# ---------------------------------------------------------------- jobs

def with_revisits(df: DataFrame, id_col: str, payload_col: str, min_bytes: int = 0) -> DataFrame:
    """Add ``_refers_to``: the largest id among the rows with an equal payload
    (of at least ``min_bytes`` bytes), NULL for the row that has it. The
    groups are pre-aggregated; the join is salted, so a payload that a third
    of the rows share is dealt to many tasks."""
    d = df.withColumn("_digest", F.sha1(payload_col)).withColumn("_len", F.length(payload_col)) \
          .withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS)))
    winners = (d.where(F.col("_len") >= min_bytes).groupBy("_digest", "_len")
               .agg(F.max(id_col).alias("_winner"), F.count(F.lit(1)).alias("_n"))
               .where((F.col("_n") > 1) & F.col("_winner").isNotNull())
               .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
               .drop("_n"))
    return (d.join(winners, ["_digest", "_len", "_salt"], "left")
            .withColumn("_refers_to", F.when(F.col(id_col).isNull() | (F.col(id_col) < F.col("_winner")),
                                             F.col("_winner")))
            .drop("_digest", "_len", "_salt", "_winner"))


def write_warc(df: DataFrame, id_col: str, url_col: str, payload_col: str, folder: str,
               min_revisit_bytes: int = 0) -> DataFrame:
    """Write every row into archives under ``folder`` (any store pyarrow
    opens by URI). Returns the archives: path, records, bytes."""
    rows = with_revisits(
        df.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"),
                  F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("_payload")),
        "_id", "_payload", min_revisit_bytes)
    rows = rows.select(F.col("_id").cast("string").alias("id"), "_url", "_payload",
                       F.col("_refers_to").cast("string").alias("refers_to"))

    def archives(batches):
        task = TaskContext.get()
        store, base = pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        # a stage that runs again in one session, or another session, takes a name of its own
        attempt = f"{task.taskAttemptId()}-{uuid.uuid4().hex[:12]}"
        out, done, seq = None, [], 0

        def close():
            out.close()
            done.append((posixpath.join(folder, name), n, size))

        for pdf in batches:
            for rid, url, payload, refers in zip(pdf["id"], pdf["_url"], pdf["_payload"], pdf["refers_to"]):
                if out is None:
                    name = f"part-{task.partitionId():05d}-{seq:04d}-{attempt}.warc.gz"
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(posixpath.join(base, name), compression=None)
                    n, size, seq = 0, 0, seq + 1
                refers = None if pd.isna(refers) else refers
                data = record_bytes(None if pd.isna(rid) else rid, None if pd.isna(url) else url,
                                    bytes(payload), refers, refers is not None)
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        if done:
            yield pd.DataFrame(done, columns=["path", "records", "bytes"])

    return rows.mapInPandas(archives, "path string, records long, bytes long")


def read_warc(spark: SparkSession, archives: DataFrame, files: int, payloads: bool = True) -> DataFrame:
    """Every record of the archives named in column ``path``, ``files`` tasks."""
    columns = ["record_id", "record_type", "refers_to", "url", "payload_digest", "payload_bytes"]
    schema = ("record_id string, record_type string, refers_to string, url string, "
              "payload_digest string, payload_bytes long")
    if payloads:
        columns, schema = [*columns, "payload"], f"{schema}, payload binary"

    def records(batches):
        for pdf in batches:
            for path in pdf["path"]:
                store, at = pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
                with store.open_input_stream(at, compression=None) as stream:
                    rows, held = [], 0
                    for raw in members(stream):
                        r = parse_record(raw)
                        rows.append([r[c] for c in columns])
                        held += len(raw) if payloads else 256
                        if held >= 8 << 20:
                            yield pd.DataFrame(rows, columns=columns)
                            rows, held = [], 0
                    if rows:
                        yield pd.DataFrame(rows, columns=columns)

    return archives.select("path").repartition(max(1, files)).mapInPandas(records, schema)


def archived(pages: DataFrame) -> DataFrame:
    """Round trip of the contract: write every page, read every archive."""
    spark = pages.sparkSession
    folder = run_folder(spark, "warc")
    write_warc(pages, "page_id", "url", "html", f"{folder}/archives").write.parquet(f"{folder}/manifest")
    manifest = spark.read.schema("path string, records long, bytes long").parquet(f"{folder}/manifest")
    back = read_warc(spark, manifest, manifest.count(), payloads=False)
    return back.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                       "record_type", F.col("refers_to").cast("long").alias("refers_to"))
