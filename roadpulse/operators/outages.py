"""Coverage as bitmaps, and outages as intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: points that one bitmap holds
BITS = 32_768


def _is_set(bitmap: Column, at: Column) -> Column:
    """Whether bit ``at`` (from 0) of a bitmap is set."""
    byte = F.conv(F.hex(F.substring(bitmap, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, F.pmod(at, F.lit(8)).cast("int")) == 1


def coverage_bitmaps(received: DataFrame, sites: DataFrame, city: str = "city", batch: str = "batch_ts",
                     index: str = "point_index", points: str = "points") -> DataFrame:
    """Per (city, batch) that sent anything: the bitmap of points received, and the missing indexes.

    ``sites`` holds each city's number of grid points, of which ``index`` counts from
    0. Samples set bits in the map tasks, so a hot city sends one bitmap per task and
    batch, there is one shuffle of bitmaps, and repeats cost nothing. Indexes outside
    the grid are not points; a city that ``sites`` does not name is left out. A grid
    of more than ``BITS`` points has several bitmaps, merged per (city, batch).
    """
    at = F.col(index).cast("long") + 1
    bits = (received.where(F.col(index) >= 0)
            .groupBy(F.col(city).alias("city"), F.col(batch).alias(batch), F.bitmap_bucket_number(at).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap")))
    grid = sites.select(F.col(city).alias("__city"), F.col(points).cast("long").alias("points_expected"))
    if not grid.where(F.col("points_expected") > BITS).isEmpty():
        bits = (bits.groupBy("city", batch).agg(F.map_from_entries(F.collect_list(F.struct("bucket", "bitmap"))).alias("m"))
                .withColumn("bitmap", F.transform(F.sequence(F.lit(1).cast("long"), F.array_max(F.map_keys("m"))),
                                                  lambda b: F.try_element_at("m", b)))
                .drop("m"))
        hit = lambda i: F.coalesce(_is_set(F.get("bitmap", (i / BITS).cast("int")), F.pmod(i, F.lit(BITS))), F.lit(False))
    else:
        bits = bits.where("bucket = 1").drop("bucket")
        hit = lambda i: _is_set(F.col("bitmap"), i)
    out = bits.join(grid, F.col("city").eqNullSafe(F.col("__city"))).where("points_expected > 0")
    every = F.sequence(F.lit(0).cast("long"), F.col("points_expected") - 1)
    out = out.withColumn("missing", F.filter(every, lambda i: ~hit(i)))
    return out.select("city", batch, "points_expected",
                      (F.col("points_expected") - F.size("missing")).alias("points_received"), "missing")


def outage_intervals(received: DataFrame, step_seconds: int = 900, city: str = "city", time: str | Column = "batch_time",
                     cities: DataFrame | None = None) -> DataFrame:
    """Maximal runs of missing batches per city: first_missing, last_missing, n_missing.

    Batches lie ``step_seconds`` apart, from the first to the last that any city sent.
    Present batches of a city that follow each other are one session window; what lies
    between two of them, before the first and behind the last, is an outage. Rows are
    reduced to batches first, so a hot city sends each batch once per task. Cities of
    ``cities`` that sent nothing are out for the whole run. Rows without a time are
    no batches.
    """
    t = F.col(time) if isinstance(time, str) else time
    seen = (received.select(F.col(city).alias("city"), t.cast("timestamp").alias("t")).where("t is not null")
            .groupBy("city", "t").agg(F.count(F.lit(1)).alias("n")))
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(step_seconds))
    whole = seen.agg(F.struct(F.min("t").alias("lo"), F.max("t").alias("hi")).alias("run"))
    # a window ends a second after the next batch is due, so that this one still falls into it
    runs = (seen.groupBy("city", F.session_window("t", f"{step_seconds + 1} seconds").alias("w"))
            .agg(F.min("t").alias("first"), F.max("t").alias("last")).select("city", "first", "last"))
    order = Window.partitionBy("city").orderBy("first")
    runs = runs.withColumn("before", F.lag("last").over(order)).withColumn("next", F.lead("first").over(order))
    run = whole.select("run").scalar()
    gap = lambda a, b: F.struct(a.alias("first_missing"), b.alias("last_missing"))
    found = runs.select("city", F.explode(F.array_compact(F.array(
        F.when(F.col("before").isNull() & (F.col("first") > run["lo"]), gap(run["lo"], F.col("first") - step)),
        F.when(F.coalesce("next", run["hi"] + step) > F.col("last") + step,
               gap(F.col("last") + step, F.coalesce("next", run["hi"] + step) - step))))).alias("g"))
    out = found.select("city", "g.*")
    if cities is not None:
        silent = (cities.select(F.col(city).alias("city")).distinct().alias("a")
                  .join(seen.select(F.col("city").alias("c")).distinct(), F.col("city").eqNullSafe(F.col("c")), "left_anti"))
        out = out.unionByName(silent.select("city", gap(run["lo"], run["hi"]).alias("g")).select("city", "g.*")
                              .where("first_missing is not null"))
    seconds = F.unix_seconds("last_missing") - F.unix_seconds("first_missing")
    return out.withColumn("n_missing", F.call_function("div", seconds, F.lit(step_seconds)) + 1)
