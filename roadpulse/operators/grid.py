"""Site config, sampling grid, validation and coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SITES
from .joins import semi_join

# The three observed sites, bbox = (min_lon, min_lat, max_lon, max_lat).
DEFAULT_SITES = {
    "berlin": {"bbox": (13.28, 52.46, 13.57, 52.57), "grid_steps": 5},
    "bremen": {"bbox": (8.72, 53.03, 8.95, 53.13), "grid_steps": 4},
    "frankfurt": {"bbox": (8.55, 50.05, 8.80, 50.18), "grid_steps": 5},
}

# Reject reasons of the site rules.
BLANK_NAME = "blank site name"
BBOX_SIZE = "bbox needs four values"
BBOX_NUMERIC = "bbox values must be numeric"
BAD_STEPS = "grid_steps must be an integer >= 1"
BBOX_ORDER = "bbox min must be below max"


def sites_frame(spark: SparkSession, config: dict | None = None) -> DataFrame:
    """A small (city, bbox, grid_steps) DataFrame from a site config dict."""
    cfg = DEFAULT_SITES if config is None else config
    rows = []
    for city, d in cfg.items():
        bbox = d.get("bbox") if isinstance(d, dict) else None
        steps = d.get("grid_steps") if isinstance(d, dict) else None
        bbox = None if bbox is None else [
            float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else None
            for v in bbox]
        steps = steps if isinstance(steps, int) and not isinstance(steps, bool) else None
        rows.append((city, bbox, steps))
    return spark.createDataFrame(rows, SITES)


def site_rules(city: str = "city", bbox: str = "bbox", steps: str = "grid_steps"
               ) -> list[tuple[str, Column]]:
    """(reason, passes) pairs; every failed rule is reported."""
    b = F.col(bbox)
    four = b.isNotNull() & (F.size(b) == 4)
    return [
        (BLANK_NAME, F.col(city).isNotNull() & (F.trim(F.col(city)) != "")),
        (BBOX_SIZE, four),
        (BBOX_NUMERIC, b.isNotNull() & ~F.exists(b, lambda x: x.isNull())),
        (BAD_STEPS, F.col(steps).isNotNull() & (F.col(steps) >= 1)),
        # judged only on four present values; a gap is reported by the numeric rule
        (BBOX_ORDER, ~four | F.coalesce((F.get(b, 0) < F.get(b, 2)) & (F.get(b, 1) < F.get(b, 3)),
                                        F.lit(True))),
    ]


def validate_sites(sites: DataFrame, name: str = "reject_reasons", **cols) -> DataFrame:
    """Add an array of every failed rule (empty when the site is valid)."""
    checks = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(why)) for why, ok in site_rules(**cols)]
    return sites.withColumn(name, F.array_compact(F.array(*checks)))


def sampling_grid(sites: DataFrame, scale: int = 6, city: str = "city",
                  bbox: str = "bbox", steps: str = "grid_steps") -> DataFrame:
    """``steps x steps`` points per site, bbox edges included, lon-major order.

    A site with one step yields the single point at its minimum corner, one
    with fewer steps (or none given) no point.
    Generated per site with ``sequence``/``explode``: no join, no driver loop.
    """
    b, n = F.col(bbox), F.col(steps)
    div = F.greatest(n - 1, F.lit(1)).cast("double")
    lon_step = (F.get(b, 2) - F.get(b, 0)) / div
    lat_step = (F.get(b, 3) - F.get(b, 1)) / div
    g = (sites.filter(n >= 1).select(F.col(city).alias("city"), b.alias("__b"), n.alias("__n"),
                      lon_step.alias("__dlon"), lat_step.alias("__dlat"))
              .withColumn("lon_index", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
              .withColumn("lat_index", F.explode(F.sequence(F.lit(0), F.col("__n") - 1))))
    return g.select(
        "city",
        (F.col("lon_index") * F.col("__n") + F.col("lat_index")).alias("point_index"),
        F.round(F.get(F.col("__b"), 1) + F.col("lat_index") * F.col("__dlat"), scale).alias("lat"),
        F.round(F.get(F.col("__b"), 0) + F.col("lon_index") * F.col("__dlon"), scale).alias("lon"),
    )


def coverage_gaps(expected: DataFrame, received: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected keys with no received row.

    Received keys are de-duplicated first (partial aggregate before the
    shuffle), so a hot key ships one row per map task.
    """
    keys = list(keys)
    return semi_join(expected, received.select(*keys).distinct(), keys, null_safe=False,
                     anti=True)


def grid_coverage(grid: DataFrame, received: DataFrame, batch: str = "batch_ts",
                  keys: Sequence[str] = ("city", "lat", "lon"),
                  batches: DataFrame | None = None) -> DataFrame:
    """Per (city, batch): expected points, points received, points missing.

    Every site is expected in every batch of ``batches`` (by default all batches
    of ``received``), so a site that sent nothing shows with 0 received. Points
    are counted per site before they meet the batches.
    """
    keys = list(keys)
    if batches is None:
        batches = received.select(batch)
    # the sites are the run's configuration, a short list; each batch gets a row for each of them
    sites = (grid.groupBy("city").agg(F.count(F.lit(1)).alias("points_expected"))
             .select(F.collect_list(F.struct("city", "points_expected"))).scalar())
    want = batches.select(batch).distinct().select(batch, F.inline(sites))
    got = (received.join(grid.select(*keys), keys, "left_semi").select(*keys, batch).distinct()
           .groupBy("city", batch).agg(F.count(F.lit(1)).alias("points_received")))
    return (want.join(got, ["city", batch], "left")
                .withColumn("points_received", F.coalesce("points_received", F.lit(0)))
                .withColumn("points_missing",
                            F.col("points_expected") - F.col("points_received")))
