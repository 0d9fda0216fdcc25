"""Log sinks: JSON-line records with an explicit lsn (K6), validation
lines (K7), topic publish (K8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def with_lsn(records: DataFrame, batch_id: int) -> DataFrame:
    """Stamp ``lsn = {batch, seq}``. ``seq`` follows the frame's order: sort
    the records first (a sorted frame is range-partitioned in order, and the
    row id grows with partition index, so seq respects the sort)."""
    return records.withColumn("lsn", F.struct(F.lit(int(batch_id)).cast("bigint").alias("batch"),
                                              F.monotonically_increasing_id().alias("seq")))


def append_log(records: DataFrame, path: str, batch_id: int | None = None) -> None:
    """K6: append one JSON object per line. With ``batch_id`` an explicit
    lsn is added; otherwise records must already carry one."""
    if batch_id is not None:
        records = with_lsn(records, batch_id)
    records.select(F.to_json(F.struct(*records.columns)).alias("value")) \
        .write.mode("append").text(path)


def validation_line(name, ticket_id, ts) -> F.Column:
    """K7 text: ``name | ticket ID validated at TS`` with TS printed like an
    aware UTC datetime (micros omitted when zero)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    micros = F.date_format(ts, "SSSSSS")
    stamp = F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
                     F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)),
                     F.lit("+00:00"))
    return F.concat(F.col(name) if isinstance(name, str) else name,
                    F.lit(" | ticket "),
                    F.col(ticket_id) if isinstance(ticket_id, str) else ticket_id,
                    F.lit(" validated at "), stamp)


def append_validation_lines(valid: DataFrame, path: str, name: str = "passenger_name",
                            ticket_id: str = "ticket_id", ts: str = "ts") -> None:
    """K7: one line per valid validation."""
    valid.select(validation_line(name, ticket_id, ts).alias("value")) \
        .write.mode("append").text(path)


def to_message_value(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """K8: value = JSON of the record, no key (what is published). A NULL field is
    written as null, not left out."""
    cols = columns or df.columns
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"))


def kafka_options(bootstrap: str, topic: str, extra: dict | None = None) -> dict:
    """The one place that knows Kafka option names (H9)."""
    opts = {"kafka.bootstrap.servers": bootstrap, "topic": topic}
    opts.update(extra or {})
    return opts


def publish(df: DataFrame, bootstrap: str, topic: str, columns: list[str] | None = None) -> int:
    """K8: publish each row as a JSON value (no key) and return how many
    were sent, observed during the write. Needs the Kafka connector."""
    out, sent = _counted(to_message_value(df, columns))
    out.write.format("kafka").options(**kafka_options(bootstrap, topic)).save()
    return int(sent.get["rows"])


def publish_files(df: DataFrame, path: str, columns: list[str] | None = None) -> int:
    """K8 into a folder that stands for a topic: the same values, one a line,
    appended where ``streaming.orders.file_source`` reads them. Returns how many
    were sent, observed during the write, so nothing is counted a second time."""
    out, sent = _counted(to_message_value(df, columns))
    out.write.mode("append").text(path)
    return int(sent.get["rows"])


def _counted(values: DataFrame) -> tuple[DataFrame, Observation]:
    sent = Observation("published")
    return values.observe(sent, F.count(F.lit(1)).alias("rows")), sent
