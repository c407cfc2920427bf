"""Position reports derived from the event, customer and nation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlens.schema import RAW_FLIGHTS
from flightlens.session import pin_utc

PER_PAYLOAD = 1200


def _gap(every: int, value: Column) -> Column:
    """NULL on each ``every``-th event."""
    return F.when(F.col("event_id") % every != 0, value)


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    joined = events.join(customer, events["user_id"] == customer["c_custkey"]).join(
        nation, customer["c_nationkey"] == nation["n_nationkey"]
    )
    number, value = F.col("event_id"), F.col("value")
    instant = F.col("ts").cast("timestamp")
    seconds = F.unix_seconds(instant)
    sign = F.concat(F.lit("  "), F.upper("event_type"), F.col("user_id").cast("string"), F.lit(" "))
    return joined.select(
        number,
        F.date_trunc("hour", instant).alias("fetch_time"),
        F.lower(F.lpad(F.hex("user_id"), 6, "0")).alias("icao24"),
        F.when(number % 7 == 0, None).when(number % 11 == 0, "   ").otherwise(sign).alias("callsign"),
        F.col("n_name").alias("origin_country"),
        _gap(97, seconds).alias("time_position"),
        seconds.alias("last_contact"),
        _gap(13, ((number * 37) % 36000 - 18000).cast("double") / 100).alias("longitude"),
        _gap(17, ((number * 53) % 18000 - 9000).cast("double") / 100).alias("latitude"),
        _gap(19, value * 25 - 50).alias("baro_altitude"),
        _gap(23, F.col("event_type") == "error").alias("on_ground"),
        _gap(29, value * 4).alias("velocity"),
        (number % 360).cast("double").alias("heading"),
        ((number % 41 - 20).cast("double") / 2).alias("vertical_rate"),
        _gap(3, value * 26).alias("geo_altitude"),
        F.lpad((number % 7778).cast("string"), 4, "0").alias("squawk"),
        (number % 101 == 0).alias("spi"),
        (number % 4).cast("int").alias("position_source"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table shaped as raw position reports, one per event."""
    return _numbered(spark, sf_dir).select(*RAW_FLIGHTS.names)


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same reports as poll payloads: JSON text, up to 1,200 records each.

    Elements come in the mixed shapes a poll can have: numbers as text, whole
    numbers with a fraction, flags as numbers or words, short records, unreadable
    values, records that are no list or too long, and one payload in five cut off.
    """
    number = F.col("event_id")

    def quoted(value: Column) -> Column:
        return F.concat(F.lit('"'), value.cast("string"), F.lit('"'))

    def plain(name: str) -> Column:
        return F.col(name).cast("string")

    spi = F.col("spi")
    elements = [
        quoted(F.col("icao24")),
        F.when(number % 223 == 0, quoted(F.repeat(F.lit("X"), 25))).otherwise(quoted(F.col("callsign"))),
        quoted(F.col("origin_country")),
        F.when(number % 5 == 0, F.concat(plain("time_position"), F.lit(".7")))
        .when(number % 5 == 1, quoted(F.concat(F.lit(" "), plain("time_position"), F.lit(" "))))
        .otherwise(plain("time_position")),
        plain("last_contact"),
        F.when(number % 6 == 0, quoted(F.col("longitude"))).otherwise(plain("longitude")),
        plain("latitude"),
        F.when(number % 47 == 0, F.lit('"x"')).otherwise(plain("baro_altitude")),
        plain("on_ground"),
        F.when(number % 8 == 0, quoted(F.col("velocity"))).otherwise(plain("velocity")),
        plain("heading"),
        plain("vertical_rate"),
        plain("geo_altitude"),
        quoted(F.col("squawk")),
        F.when(number % 3 == 0, spi.cast("int").cast("string"))
        .when(number % 3 == 1, F.when(spi, F.lit('"YES"')).otherwise(F.lit('"nope"')))
        .otherwise(plain("spi")),
        F.when(number % 31 == 0, F.lit("true")).otherwise(plain("position_source")),
    ]
    listed = F.array(*[F.coalesce(element, F.lit("null")) for element in elements])
    kept = F.when(number % 43 == 0, F.slice(listed, 1, 12)).otherwise(listed)
    record = F.when(number % 211 == 0, F.lit("7")).otherwise(
        F.concat(F.lit("["), F.array_join(kept, ","), F.lit("]"))
    )
    payload = F.call_function("div", number, F.lit(PER_PAYLOAD))
    records = F.array_join(F.transform(F.array_sort("_records"), lambda r: r["record"]), ",")
    end = F.when(F.col("payload_id") % 5 == 4, F.lit("")).otherwise(F.lit("]}"))
    # A fixed number of partitions: parsing costs far more than the few bytes
    # suggest, so adaptive execution must not join them into one task.
    tasks = spark.sparkContext.defaultParallelism
    return (
        _numbered(spark, sf_dir)
        .select(payload.alias("payload_id"), F.struct(number, record.alias("record")).alias("_one"))
        .groupBy("payload_id")
        .agg(F.collect_list("_one").alias("_records"))
        .select("payload_id", F.concat(F.lit('{"states":['), records, end).alias("value"))
        .repartition(tasks, "payload_id")
    )
