"""Trip log cleaning and rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.numeric import round_score, safe_double
from strata.operators.common import top_n
from strata.session import persist_reliably

# Fixed values of the cleaning rule (must equal the reference's):
#   positions: vehicle 0, driver 1, duration 4 (seconds), distance 5, fare 11, total 16
#   keep a trip when duration > 60 and distance, fare and total are each > 0.10
VEHICLE, DRIVER, DURATION, DISTANCE, FARE, TOTAL = 0, 1, 4, 5, 11, 16
MIN_DURATION = 60.0
MIN_AMOUNT = 0.10
BITMAP = 64  # numbers of a bitmap, the bits of a long
_NUMBERS = {"duration": DURATION, "distance": DISTANCE, "fare": FARE, "total": TOTAL}


def clean_trips(raw: DataFrame) -> DataFrame:
    """Raw 17-field string records → (vehicle, driver, duration, distance, fare, total).

    Rows whose numeric fields are missing, not numbers or NaN are dropped (never
    an error); comparisons are strict.  Only the six used fields are read, so a
    columnar source prunes the rest.
    """
    typed = raw.select(
        F.col(f"c{VEHICLE}").alias("vehicle"),
        F.col(f"c{DRIVER}").alias("driver"),
        safe_double(f"c{DURATION}").alias("duration"),
        safe_double(f"c{DISTANCE}").alias("distance"),
        safe_double(f"c{FARE}").alias("fare"),
        safe_double(f"c{TOTAL}").alias("total"),
    )
    # Null (bad number) comparisons are null, which `where` drops.
    return typed.where(
        (F.col("duration") > MIN_DURATION)
        & (F.col("distance") > MIN_AMOUNT)
        & (F.col("fare") > MIN_AMOUNT)
        & (F.col("total") > MIN_AMOUNT)
    )


def judged_trips(raw: DataFrame) -> DataFrame:
    """``clean_trips``' columns of every row, and the first rule it breaks (``reason``, null
    for trips that are kept): a second output of the same scan."""
    typed = raw.select(
        F.col(f"c{VEHICLE}").alias("vehicle"),
        F.col(f"c{DRIVER}").alias("driver"),
        *(safe_double(f"c{at}").alias(name) for name, at in _NUMBERS.items()),
    )
    reason = F.lit(None).cast("string")
    for name in reversed(_NUMBERS):
        least = MIN_DURATION if name == "duration" else MIN_AMOUNT
        reason = F.when(F.coalesce(F.col(name) <= least, F.lit(False)), f"{name} too small").otherwise(reason)
    for name in reversed(_NUMBERS):
        reason = F.when(F.col(name).isNull(), f"{name} is no number").otherwise(reason)
    return typed.withColumn("reason", reason)


def reason_counts(judged: DataFrame, kept: str = "kept") -> DataFrame:
    """(reason, rows): how many rows each rule turned away, and how many stayed."""
    return judged.groupBy(F.coalesce("reason", F.lit(kept)).alias("reason")).agg(F.count(F.lit(1)).alias("rows"))


def distinct_pairs(trips: DataFrame, key: str = "vehicle", value: str = "driver") -> DataFrame:
    return trips.select(key, value).distinct()


def distinct_per_key(
    trips: DataFrame, key: str = "vehicle", value: str = "driver", name: str = "drivers"
) -> DataFrame:
    """Number of distinct ``value``s per ``key``; a null value counts as one value.

    distinct → count rather than count(DISTINCT): the first shuffle spreads the
    (key, value) pairs, so a key holding a third of all trips is split over many
    tasks, and the second aggregate is combined map-side to one row per key and
    partition.
    """
    return (
        distinct_pairs(trips, key, value)
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias(name))
    )


def numbered_values(trips: DataFrame, value: str) -> DataFrame:
    """(value, number): the distinct values, null too, numbered densely from 0 in their order.
    One sort by range and a count per part: no task sees more than its part."""
    rows = trips.select(value).distinct().repartitionByRange(F.col(value).asc_nulls_first())
    at = F.monotonically_increasing_id()
    rows = persist_reliably(rows.sortWithinPartitions(F.col(value).asc_nulls_first()).select(value, at.alias("at")))
    part = F.shiftrightunsigned("at", 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))  # a row per part
    before = F.sum("size").over(Window.orderBy("part")) - F.col("size")
    starts = sizes.select("part", before.alias("before"))
    numbered = rows.withColumn("part", part).join(starts, "part")
    return numbered.select(value, (F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("number"))


def distinct_per_key_bitmaps(
    trips: DataFrame, key: str = "vehicle", value: str = "driver", name: str = "drivers"
) -> DataFrame:
    """``distinct_per_key`` by bitmaps over densely numbered values: a task sends one bitmap of
    BITMAP numbers per (key, block of numbers) instead of its pairs, whatever their number.
    The better plan where keys have many of the values; with few it sends what
    ``distinct_per_key`` does.  A bitmap is a long, so it grows with the pairs, not with
    keys times values, and sums by hash without a sort of whole blocks."""
    numbers = numbered_values(trips, value).withColumnRenamed(value, "_value")
    rows = trips.select(key, value).join(numbers, F.col(value).eqNullSafe(F.col("_value")))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("number").bitwiseAND(F.lit(63)).cast("int"))
    bits = rows.groupBy(key, F.shiftright("number", 6).alias("block")).agg(F.bit_or(bit).alias("bits"))
    return bits.groupBy(key).agg(F.sum(F.bit_count("bits")).alias(name))


def trip_rate(trips: DataFrame) -> DataFrame:
    """Earnings per minute of every trip: total / duration × 60."""
    return trips.select(
        "vehicle", "driver", (F.col("total") / F.col("duration") * 60).alias("rate")
    )


def mean_rate_per_key(trips: DataFrame, key: str = "driver", name: str = "rate") -> DataFrame:
    """Mean over trips of the per-trip rate (a mean of ratios, not a ratio of sums).
    A null key is a group of its own."""
    return trip_rate(trips).groupBy(key).agg(F.avg("rate").alias(name))


# Rates are money per minute in the thousands: 6 decimals keep 10 significant
# digits, well above the last-bit noise of sums added in another order.
RATE_DECIMALS = 6


def top_by(
    df: DataFrame, key: str, value: str, n: int = 10, decimals: int | None = None
) -> DataFrame:
    """Top ``n`` rows by ``value`` descending (rounded to ``decimals`` first for
    fractional values); ties by ``key`` ascending."""
    ranked = F.col(value) if decimals is None else round_score(value, decimals)
    return top_n(df, n, [ranked.desc(), F.col(key).asc_nulls_first()])


def top_vehicles(trips: DataFrame, n: int = 10) -> DataFrame:
    return top_by(distinct_per_key(trips), "vehicle", "drivers", n)


def top_drivers(trips: DataFrame, n: int = 10) -> DataFrame:
    return top_by(mean_rate_per_key(trips), "driver", "rate", n, RATE_DECIMALS)
