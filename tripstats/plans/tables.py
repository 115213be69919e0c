"""The given tables seen as hotels, flights, reservations and messages."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstats.functions import iso_text
from tripstats.operators.lookup import Dimension
from tripstats.schemas import FLIGHT_SOURCE, HOTEL_SOURCE
from tripstats.session import written
from tripstats.sources.messages import to_message

BATCHES = 400  # micro-batches the reservations are cut into, by order key

# Schemas of the given tables, so that no job has to read file footers for them.
SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
        "props STRING"
    ),
}

# Size verdicts of dimensions by application, folder and name: the tables are read-only, so
# measuring each once per application is enough.
_SMALL: dict[tuple[str, str, str], bool] = {}


class Tables:
    """Views over one folder of parquet tables; frames are lazy, sizes measured on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def _dimension(self, name: str, frame: DataFrame, key: str) -> Dimension:
        known = (self.spark.sparkContext.applicationId, self.folder, name)
        if known not in _SMALL:
            _SMALL[known] = Dimension.measured(frame, key).small
        return Dimension(frame, key, _SMALL[known])

    @cached_property
    def hotels(self) -> DataFrame:
        """Suppliers as hotels: their nation is the city, their key gives the stars."""
        return self.read("supplier").join(
            self.read("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        ).select(
            F.col("s_suppkey").alias("id_hotel"),
            F.col("n_name").alias("cidade"),
            (F.col("s_suppkey") % 5 + 1).cast("int").alias("estrelas"),
        )

    @cached_property
    def flights(self) -> DataFrame:
        """Customers as flights to their nation, from another nation that their key picks."""
        origin = self.read("nation").select(
            F.col("n_nationkey").alias("o_key"), F.col("n_name").alias("cidade_origem")
        )
        destination = self.read("nation").select(
            F.col("n_nationkey").alias("d_key"), F.col("n_name").alias("cidade_destino")
        )
        picked = (F.col("c_nationkey") + 1 + F.col("c_custkey") % 24) % 25
        return (
            self.read("customer")
            .join(destination, F.col("c_nationkey") == F.col("d_key"))
            .join(origin, picked == F.col("o_key"))
            .select(F.col("c_custkey").alias("id_voo"), "cidade_origem", "cidade_destino")
        )

    @cached_property
    def dated_flights(self) -> DataFrame:
        """Flights with a day, month and year derived from their key."""
        return self.flights.select(
            "*",
            (F.col("id_voo") % 31 + 1).cast("int").alias("dia"),
            (F.col("id_voo") % 12 + 1).cast("int").alias("mes"),
            (F.col("id_voo") % 3 + 2024).cast("int").alias("ano"),
        )

    @cached_property
    def hotel_dim(self) -> Dimension:
        return self._dimension("hotels", self.hotels, "id_hotel")

    @cached_property
    def flight_dim(self) -> Dimension:
        return self._dimension("flights", self.flights, "id_voo")

    @cached_property
    def hotel_events(self) -> DataFrame:
        """Line items as hotel reservations."""
        return self.read("lineitem").select(
            F.col("l_linestatus").alias("company_id"),
            F.col("l_suppkey").alias("id_hotel"),
            F.col("l_extendedprice").alias("valor"),
            F.col("l_shipdate").alias("data_reserva"),
            (F.col("l_orderkey") % BATCHES).cast("int").alias("batch_id"),
        )

    @cached_property
    def flight_events(self) -> DataFrame:
        """Orders as flight reservations."""
        return self.read("orders").select(
            F.col("o_orderstatus").alias("company_id"),
            F.col("o_custkey").alias("id_voo"),
            F.col("o_totalprice").alias("valor"),
            F.col("o_orderdate").alias("data_reserva"),
            (F.col("o_orderkey") % BATCHES).cast("int").alias("batch_id"),
        )

    def messages(self, id_column: str, booking_column: str) -> DataFrame:
        """Events as messages; the number in their properties spoils some in every known way.

        The number serves as the id, the event's value as the amount.
        """
        # Projected first: inlined, they would be evaluated once per use.
        events = self.read("events").select(
            "event_id",
            "event_type",
            "ts",
            F.col("value").alias("amount"),
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            iso_text("ts").alias("iso"),
        )
        k, iso = F.col("k"), F.col("iso")

        def unless(spoilt: int, column: Column, instead: Column | None = None) -> Column:
            other = F.lit(None) if instead is None else instead
            return F.when(k != spoilt, column).otherwise(other)

        payload = F.to_json(
            F.struct(
                unless(4, k).alias(id_column),
                F.col("event_id").alias(booking_column),
                unless(5, F.col("amount")).alias("valor"),
                F.date_add("ts", k).cast("string").alias("data_reservada"),
                unless(6, iso, F.lit("x")).alias("data_reserva"),
            )
        )
        envelope = F.to_json(
            F.struct(
                unless(7, F.col("event_type")).alias("company_id"),
                unless(3, payload, F.lit("{spoilt")).alias("data"),
                unless(1, unless(2, iso, F.lit("yesterday"))).alias("timestamp"),
            )
        )
        return events.select("event_id", unless(0, envelope, F.lit("bad")).alias("value"))

    def hotel_booking_messages(self) -> DataFrame:
        """Every hotel reservation as a message."""
        return self.read("lineitem").select(
            to_message(
                F.col("l_linestatus"),
                F.col("l_shipdate"),
                F.struct(
                    F.col("l_suppkey").alias("id_hotel"),
                    F.col("l_orderkey").alias("id_reserva_hotel"),
                    F.col("l_extendedprice").alias("valor"),
                    F.col("l_shipdate").cast("date").cast("string").alias("data_reservada"),
                    iso_text("l_shipdate").alias("data_reserva"),
                ),
            ).alias("value")
        )

    def flight_booking_messages(self) -> DataFrame:
        """Every flight reservation as a message."""
        return self.read("orders").select(
            to_message(
                F.col("o_orderstatus"),
                F.col("o_orderdate"),
                F.struct(
                    F.col("o_custkey").alias("id_voo"),
                    F.col("o_orderkey").alias("id_reserva_voo"),
                    F.col("o_totalprice").alias("valor"),
                    iso_text("o_orderdate").alias("data_reserva"),
                ),
            ).alias("value")
        )

    def pending_messages(self) -> DataFrame:
        """Events as messages waiting in two sources: what was looked at concerns hotels."""
        hotels = F.col("event_type").isin("view", "click")
        return self.read("events").select(
            F.when(hotels, HOTEL_SOURCE).otherwise(FLIGHT_SOURCE).alias("source"),
            "event_id",
            F.col("props").alias("value"),
        )

    def run_log(self) -> DataFrame:
        """One run per hour of events, with the columns of the run log."""
        hotels = F.col("event_type").isin("view", "click")
        hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
        runs = (
            self.read("events")
            .groupBy(hour.alias("hour"))
            .agg(
                F.min("event_id").alias("id"),
                F.min("ts").alias("start_time"),
                F.max("ts").alias("end_time"),
                F.count_if(hotels).alias("rows_hotels"),
                F.count_if(~hotels).alias("rows_flights"),
                F.max("value").alias("spark_duration_seconds"),
                F.min("value").alias("db_write_duration_seconds"),
            )
        )
        return runs.withColumnRenamed("hour", "created_at")

    def written(self, frame: DataFrame) -> DataFrame:
        """The frame as a written table, for plans that read it more than once."""
        return written(frame)
