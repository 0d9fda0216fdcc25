"""Following one growing file (S5, L8): only appended bytes are read.

A file stream takes a file once, when it appears; a log that one writer appends to
needs an offset. ``poll`` looks at the file's length, ships the bytes from the last
offset to the last line end into segment files of the shared folder, and leaves a
torn last line for the next poll. Bytes go from stream to stream inside the file
system client, a buffer at a time; lines are parsed by Spark from the segments,
which are plain splittable text. A segment is named by the bytes it holds and
written under a temporary name, so a poll that died and is made again writes the
same files.

The checkpoint (a small JSON file, replaced by rename) holds the generation, the
offset, the number of lines so far and a hash of the file's head. Cases:

* the file is cut in the middle of a line: that line is not shipped yet; if it
  never ends, it never counts;
* it is shorter than the offset, or its head differs: another file took its
  place; a new generation begins at offset 0 and everything before is void;
* it is gone: a new generation without lines; reported once;
* it has not grown, or by less than a line: nothing to do.

Lines get a dense number over the whole generation (``sources.lines``), so
``lsn = {batch: generation, seq: line}`` orders records as they stand in the file.
One follower per checkpoint. Shipped segments of earlier polls can be dropped
(``drop_segments``) once their records are stored."""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..sinks.snapshot import _fs
from .jsonlog import LSN_EXPLICIT, parse_records
from .lines import numbered_lines

HEAD = 4096                 # bytes whose hash tells a file from its successor
SEGMENT_BYTES = 128 << 20
_LOOK = 64 << 10            # bytes looked through at a time for the last line end


@dataclass(frozen=True)
class Position:
    """Where the last poll ended. ``head_bytes`` of the file's head are hashed
    (fewer than HEAD while the file is that short)."""
    generation: int = 0
    offset: int = 0
    lines: int = 0
    head_bytes: int = 0
    head: str = ""
    gone: bool = False


@dataclass(frozen=True)
class Poll:
    """What one poll found: the segments of new whole lines, and the position
    to commit when their records are stored. ``fresh``: a new generation."""
    before: Position
    after: Position
    segments: tuple[str, ...]
    fresh: bool

    @property
    def changed(self) -> bool:
        return self.after != self.before


def read_position(spark: SparkSession, checkpoint: str) -> Position | None:
    fs, p, _ = _fs(spark, f"{checkpoint.rstrip('/')}/position.json")
    if not fs.exists(p):
        return None
    return Position(**json.loads("".join(r.value for r in spark.read.text(p.toString()).collect())))


def commit(spark: SparkSession, checkpoint: str, position: Position) -> None:
    """Replace the position: written beside it, then renamed over it."""
    fs, p, jvm = _fs(spark, f"{checkpoint.rstrip('/')}/position.json")
    temporary = jvm.org.apache.hadoop.fs.Path(f"{p.toString()}.{uuid.uuid4().hex}")
    out = fs.create(temporary, True)
    out.writeBytes(json.dumps(asdict(position)) + "\n")
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(kind, 1)
    overwrite[0] = kind.OVERWRITE
    context.rename(temporary, p, overwrite)


def _bytes(spark: SparkSession, stream, start: int, count: int) -> bytes:
    stream.seek(start)
    return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, count))


def _last_line_end(spark: SparkSession, stream, start: int, end: int) -> int:
    """The offset after the last newline in [start, end); ``start`` if none."""
    while end > start:
        low = max(start, end - _LOOK)
        at = _bytes(spark, stream, low, end - low).rfind(b"\n")
        if at >= 0:
            return low + at + 1
        end = low
    return start


def _ship(spark: SparkSession, stream, folder: str, start: int, end: int) -> str:
    """Bytes [start, end) as one segment file; kept if a poll before wrote it."""
    fs, final, jvm = _fs(spark, f"{folder}/{start:020d}-{end:020d}.jsonl")
    if fs.exists(final):
        return final.toString()
    temporary = jvm.org.apache.hadoop.fs.Path(f"{folder}/_{uuid.uuid4().hex}")
    out = fs.create(temporary, True)
    try:
        stream.seek(start)
        if jvm.org.apache.commons.io.IOUtils.copyLarge(stream, out, 0, end - start) != end - start:
            raise OSError(f"the log ended before byte {end} while it was read")
    finally:
        out.close()
    if not fs.rename(temporary, final) and not fs.exists(final):
        raise RuntimeError(f"segment {final.toString()} could not be put in place")
    return final.toString()


def poll(spark: SparkSession, path: str, checkpoint: str, segment_bytes: int = SEGMENT_BYTES) -> Poll:
    """Ship what was appended to ``path`` since the committed position. Does
    not move the position: ``commit`` it when the lines are stored."""
    stored = read_position(spark, checkpoint)
    before = stored or Position()
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        if before.gone:
            return Poll(before, before, (), False)
        return Poll(before, Position(generation=before.generation + 1, gone=True), (), True)
    length = int(fs.getFileStatus(p).getLen())
    stream = fs.open(p)
    try:
        def head(count):
            return hashlib.sha256(_bytes(spark, stream, 0, count)).hexdigest() if count else ""

        at, fresh = before, stored is None or before.gone
        if before.gone:
            at = replace(at, gone=False)
        if length < at.offset or length < at.head_bytes or head(at.head_bytes) != at.head:
            at, fresh = Position(generation=before.generation + 1), True
        end = _last_line_end(spark, stream, at.offset, length)
        if end == at.offset and not fresh:
            return Poll(before, before, (), False)
        folder = f"{checkpoint.rstrip('/')}/segments/{at.generation:010d}"
        segments, start = [], at.offset
        while start < end:
            stop = end if end - start <= segment_bytes else _last_line_end(spark, stream, start, start + segment_bytes)
            if stop == start:                       # one line longer than a segment
                stop = _next_line_end(spark, stream, start + segment_bytes, end)
            segments.append(_ship(spark, stream, folder, start, stop))
            start = stop
        shown = min(HEAD, end)
        lines = spark.read.text(segments).count() if segments else 0
        return Poll(before, replace(at, offset=end, lines=at.lines + lines, head_bytes=shown, head=head(shown)),
                    tuple(segments), fresh)
    finally:
        stream.close()


def _next_line_end(spark: SparkSession, stream, start: int, end: int) -> int:
    while start < end:
        high = min(end, start + _LOOK)
        at = _bytes(spark, stream, start, high - start).find(b"\n")
        if at >= 0:
            return start + at + 1
        start = high
    return end


def lines_of(spark: SparkSession, found: Poll) -> DataFrame:
    """The poll's lines with ``lsn = {generation, line number}``."""
    first = 0 if found.after.generation != found.before.generation else found.before.lines
    if not found.segments:
        return spark.createDataFrame([], f"value string, lsn {LSN_EXPLICIT.simpleString()}")
    lines = numbered_lines(spark, list(found.segments), first)
    return lines.select("value", F.struct(F.lit(found.after.generation).cast("long").alias("batch"),
                                          F.col("line").alias("seq")).alias("lsn"))


def records_of(spark: SparkSession, found: Poll) -> DataFrame:
    """The poll's log records; lines that are no JSON object keep their number
    and are left out, as by ``jsonlog.parse_records``."""
    return parse_records(lines_of(spark, found), schemas.LOG_RECORD)


def drop_segments(spark: SparkSession, checkpoint: str, position: Position) -> None:
    """Delete the shipped segments that lie behind a committed position."""
    fs, folder, _ = _fs(spark, f"{checkpoint.rstrip('/')}/segments")
    if not fs.exists(folder):
        return
    for g in fs.listStatus(folder):
        if int(g.getPath().getName()) < position.generation:
            fs.delete(g.getPath(), True)
        elif int(g.getPath().getName()) == position.generation:
            for s in fs.listStatus(g.getPath()):
                name = s.getPath().getName()
                if name.endswith(".jsonl") and int(name[21:41]) <= position.offset:
                    fs.delete(s.getPath(), False)
