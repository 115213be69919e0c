"""Reservation messages: sources, decoding, rejects.

A message is one JSON object `{company_id, data, timestamp}` whose `data` is itself JSON text.
Decoding never drops or raises: every message comes out once, with `reason` telling why it
cannot be used, or null.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstats.functions import iso_text, parse_timestamp
from tripstats.schemas import ENVELOPE, FLIGHT_PAYLOAD, FLIGHT_SOURCE, HOTEL_PAYLOAD, HOTEL_SOURCE

_NOT_JSON = "_not_json"
_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _NOT_JSON}

HOTEL_EVENT = [
    "company_id", "event_timestamp", "id_hotel", "valor", "data_reservada", "data_reserva",
    "id_reserva_hotel",
]
FLIGHT_EVENT = [
    "company_id", "event_timestamp", "id_voo", "valor", "id_reserva_voo", "data_reserva",
]


def _with_json(frame: DataFrame, column: str, schema: str, out: str) -> DataFrame:
    """JSON text parsed to a struct `out`, exactly once per row.

    The struct comes out of a generator because Spark pushes filters below a projection by
    repeating its expressions: every reference to a field would parse the text again. Filters
    stop above a generator.
    """
    parsed = F.from_json(column, f"{schema}, {_NOT_JSON} STRING", _PERMISSIVE)
    return frame.select("*", F.explode(F.array(parsed)).alias(out))


def _first_reason(*checks: tuple[str, Column]) -> Column:
    """Name of the first check that holds; a check that is null does not hold."""
    return F.coalesce(*(F.when(condition, F.lit(name)) for name, condition in checks))


def _opened(messages: DataFrame, payload: str) -> DataFrame:
    """Envelope and payload as structs `env` and `p`, the message time as `event_timestamp`."""
    envelopes = _with_json(messages, "value", ENVELOPE, "env")
    return (
        _with_json(envelopes, "env.data", payload, "p")
        .withColumn("event_timestamp", parse_timestamp("env.timestamp", needs_date=True))
        .withColumn("reserva", parse_timestamp("p.data_reserva", needs_date=True))
    )


def _reason(id_column: str) -> Column:
    """Why a message cannot be used. A field nobody needs may be unreadable; it is null then."""

    def missing(name: str) -> Column:
        return F.col(name).isNull()

    unreadable = missing("p") | F.col(f"p.{_NOT_JSON}").isNotNull()
    incomplete = missing(f"p.{id_column}") | missing("p.valor") | missing("p.data_reserva")
    return _first_reason(
        ("envelope_not_json", missing("env") | F.col(f"env.{_NOT_JSON}").isNotNull()),
        ("company_missing", missing("env.company_id")),
        ("timestamp_missing", missing("env.timestamp")),
        ("timestamp_invalid", missing("event_timestamp")),
        ("payload_invalid", unreadable & incomplete),
        ("id_missing", missing(f"p.{id_column}")),
        ("value_missing", missing("p.valor")),
        ("date_missing", missing("p.data_reserva")),
        ("date_invalid", missing("reserva")),
    )


def decode_hotels(messages: DataFrame) -> DataFrame:
    """Messages (`value`) to hotel events, with `reason` and the message itself."""
    return _opened(messages, HOTEL_PAYLOAD).select(
        F.col("env.company_id").alias("company_id"),
        "event_timestamp",
        "p.id_hotel",
        "p.valor",
        parse_timestamp("p.data_reservada", needs_date=True).alias("data_reservada"),
        F.col("reserva").alias("data_reserva"),
        "p.id_reserva_hotel",
        _reason("id_hotel").alias("reason"),
        "value",
    )


def decode_flights(messages: DataFrame) -> DataFrame:
    """Messages (`value`) to flight events, with `reason` and the message itself."""
    return _opened(messages, FLIGHT_PAYLOAD).select(
        F.col("env.company_id").alias("company_id"),
        "event_timestamp",
        "p.id_voo",
        "p.valor",
        "p.id_reserva_voo",
        F.col("reserva").alias("data_reserva"),
        _reason("id_voo").alias("reason"),
        "value",
    )


def usable(decoded: DataFrame) -> DataFrame:
    """Events that take part in statistics."""
    return decoded.where(F.col("reason").isNull()).drop("reason", "value")


def rejects(decoded: DataFrame) -> DataFrame:
    """Messages set aside, each with its reason."""
    return decoded.where(F.col("reason").isNotNull()).select("reason", "value")


def decode_both(hotel_messages: DataFrame, flight_messages: DataFrame) -> DataFrame:
    """Both sources as one frame tagged with `source`, so that they are consumed as one batch.

    Batch or streaming. The JSON of each message is parsed once; `value` is kept for rejects
    only.
    """
    tagged = [
        decode_hotels(hotel_messages).withColumn("source", F.lit(HOTEL_SOURCE)),
        decode_flights(flight_messages).withColumn("source", F.lit(FLIGHT_SOURCE)),
    ]
    return (
        tagged[0]
        .unionByName(tagged[1], allowMissingColumns=True)
        .withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))
    )


def to_message(company: Column, timestamp: Column, payload: Column) -> Column:
    """The JSON text of one message; `payload` is a struct."""
    return F.to_json(
        F.struct(
            company.alias("company_id"),
            F.to_json(payload).alias("data"),
            iso_text(timestamp).alias("timestamp"),
        )
    )


def file_messages(
    spark: SparkSession, path: str, files_per_batch: int | None = None, **options: str
) -> DataFrame:
    """Stream of messages from a folder of text files, one message per line.

    `options` go to the reader, such as `cleanSource` and `sourceArchiveDir`, which take files
    out of the folder once they are consumed.
    """
    reader = spark.readStream.format("text").options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def kafka_messages(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Stream of messages from Kafka (needs the connector package on the class path).

    `options` carries the connector's own settings: bootstrap servers, `subscribe`, and
    `maxOffsetsPerTrigger` / `minOffsetsPerTrigger` to bound a batch from both sides.
    """
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))
