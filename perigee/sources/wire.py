"""Wire messages: strict decoding, rejects, encoding, and the topic source and sink.

Everything here works on a DataFrame with binary or string columns ``key`` and ``value``,
batch or streaming, so the same code serves a topic, a replay directory, or a test table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee import schema as S
from perigee.functions import scalars as X

# Why a message is rejected, in the order they are tested.
REJECT_REASONS = ("bad_json", "missing", "extra", "bad_type", "bad_time")


def read_topic(
    spark: SparkSession,
    brokers: str,
    topic: str = S.TELEMETRY_TOPIC,
    from_beginning: bool = True,
    max_messages_per_batch: int | None = None,
    group_prefix: str = "perigee",
) -> DataFrame:
    """Streaming (key, value) rows of a Kafka-compatible topic.

    Needs the Kafka connector on the session's classpath. Progress is kept in the query's
    checkpoint, not in broker-side commits, so nothing read is lost before it is written.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest" if from_beginning else "latest")
        .option("groupIdPrefix", group_prefix)
    )
    if max_messages_per_batch is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_messages_per_batch)
    return reader.load().select("key", "value")


def replay_directory(spark: SparkSession, path: str, max_files_per_batch: int | None = None) -> DataFrame:
    """Streaming (key, value) rows from a directory of message tables in Parquet."""
    message = T.StructType(
        [T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType())]
    )
    reader = spark.readStream.schema(message)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.parquet(path)


def _judged(message: Column) -> Column:
    """Struct of record and reject reason for a struct of parsed record and field names.

    The reason is null for a message that is exactly one telemetry record. Field names are
    compared both ways, since parsing alone would fill in missing fields and drop extra
    ones. A field that is null after parsing had the wrong type.
    """
    record, names = message["record"], message["names"]
    expected = F.array(*[F.lit(c) for c in S.TELEMETRY_COLUMNS])
    any_null = F.lit(False)
    for name in S.TELEMETRY_COLUMNS:
        any_null = any_null | record[name].isNull()
    # Producers write the fields in order, so one array comparison settles most messages.
    unlike = names != expected
    reason = (
        F.when(names.isNull(), "bad_json")
        .when(unlike & (F.size(F.array_except(expected, names)) > 0), "missing")
        .when(unlike & (F.size(F.array_except(names, expected)) > 0), "extra")
        .when(any_null, "bad_type")
        .when(X.try_parse_iso(record["sim_time_iso"]).isNull(), "bad_time")
    )
    return F.struct(record.alias("_record"), reason.alias("reject_reason"))


def parsed(messages: DataFrame) -> DataFrame:
    """Add ``_record`` (the parsed struct) and ``reject_reason`` to (key, value) rows.

    Parsing sits in a generator over a one-element array: what later filters and
    projections refer to is then its output, so the optimizer cannot copy the JSON parse
    into each of them and every message is parsed once.
    """
    text = F.try_validate_utf8(F.col("value").cast("string"))
    message = F.struct(
        F.from_json(text, S.TELEMETRY_SCHEMA).alias("record"),
        F.json_object_keys(text).alias("names"),
    )
    return messages.select("*", F.inline(F.transform(F.array(message), _judged)))


def decoded(messages: DataFrame) -> DataFrame:
    """Telemetry rows of the valid messages."""
    return parsed(messages).where(F.col("reject_reason").isNull()).select("_record.*")


def rejected(messages: DataFrame) -> DataFrame:
    """Dead letters: key, value and reason of every message that is not a valid record."""
    return (
        parsed(messages)
        .where(F.col("reject_reason").isNotNull())
        .select("key", "value", "reject_reason")
    )


def counted(messages: DataFrame, observation: Observation | str = "ingest") -> DataFrame:
    """Attach message and decode-error counters to a parsed stream or batch.

    Read them from the Observation after a batch action, or from a streaming query's
    progress under the observation's name.
    """
    return messages.observe(observation, *counters())


def counters() -> list[Column]:
    """Counters of parsed messages."""
    return [
        F.count(F.lit(1)).alias("messages_seen"),
        F.count_if(F.col("reject_reason").isNull()).alias("messages_received"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("decode_errors"),
    ]


def encoded(telemetry: DataFrame) -> DataFrame:
    """One (key, value) message per row: satellite id bytes and compact JSON bytes."""
    body = F.to_json(F.struct(*S.TELEMETRY_COLUMNS), {"ignoreNullFields": "false"})
    return telemetry.select(
        F.col("sat_id").cast("binary").alias("key"), body.cast("binary").alias("value")
    )


def publish(telemetry: DataFrame, brokers: str, topic: str = S.TELEMETRY_TOPIC) -> None:
    """Write telemetry rows to a Kafka-compatible topic (needs the Kafka connector)."""
    (
        encoded(telemetry)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("kafka.enable.idempotence", "true")
        .option("kafka.compression.type", "zstd")
        .option("kafka.linger.ms", "50")
        .option("topic", topic)
        .save()
    )



def flatten_ticks(ticks: DataFrame) -> DataFrame:
    """Nested ticks to flat telemetry.

    Input: ``sat_id``, ``sim_time`` and structs ``geo`` (three vectors as arrays, eclipsed,
    latitude, longitude, altitude), ``eps`` and ``thermal`` whose fields carry the flat
    column names.
    """
    out = {"sat_id": F.col("sat_id"), "sim_time_iso": iso_text(F.col("sim_time"))}
    for name in S.TELEMETRY_COLUMNS[2:]:
        stem, _, axis = name.rpartition("_")
        if axis in ("x", "y", "z"):
            out[name] = F.col(f"geo.{stem}")["xyz".index(axis)]
    for group, names in (
        ("geo", ["eclipsed", "latitude_deg", "longitude_deg", "altitude_km"]),
        ("eps", ["solar_power_w", "bus_power_w", "net_power_w", "battery_soc", "battery_charge_wh"]),
        (
            "thermal",
            [
                "bus_temperature_k",
                "bus_temperature_c",
                "solar_heat_input_w",
                "earth_ir_input_w",
                "radiative_heat_output_w",
                "net_heat_w",
            ],
        ),
    ):
        for name in names:
            out[name] = F.col(f"{group}.{name}")
    return ticks.select(*[out[c].alias(c) for c in S.TELEMETRY_COLUMNS])


def iso_text(t: Column) -> Column:
    """Timestamp as ISO-8601 UTC text; the fraction is present only when not zero."""
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(t), F.lit(1_000_000))
    fraction = F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    return F.concat(whole, F.coalesce(fraction, F.lit("")), F.lit("+00:00"))
