"""Site config and sampling grid, after the original config/grid tests."""

from pyspark.sql import functions as F

from roadpulse.operators.grid import (BAD_STEPS, BBOX_ORDER, BBOX_SIZE, BLANK_NAME,
                                      DEFAULT_SITES, grid_coverage, sampling_grid, sites_frame,
                                      validate_sites)


def test_default_sites(spark):
    sites = {r.city: r for r in sites_frame(spark).collect()}
    assert set(sites) == {"berlin", "bremen", "frankfurt"}
    assert sites["berlin"].grid_steps == 5 and len(sites["berlin"].bbox) == 4


def test_valid_config_survives(spark):
    cfg = {"testcity": {"bbox": (1.0, 2.0, 3.0, 4.0), "grid_steps": 2}}
    v = validate_sites(sites_frame(spark, cfg)).first()
    assert v.reject_reasons == [] and list(v.bbox) == [1.0, 2.0, 3.0, 4.0] and v.grid_steps == 2


def test_invalid_config_rejected(spark):
    cfg = {"bad": {"bbox": (1.0, 2.0, 3.0), "grid_steps": 0},
           " ": {"bbox": (3.0, 2.0, 1.0, 4.0), "grid_steps": 3},
           "odd": {"bbox": (1, "x", 3, 4), "grid_steps": 2.5}}
    got = {r.city: r.reject_reasons for r in validate_sites(sites_frame(spark, cfg)).collect()}
    assert got["bad"] == [BBOX_SIZE, BAD_STEPS]
    assert got[" "] == [BLANK_NAME, BBOX_ORDER]
    assert "bbox values must be numeric" in got["odd"] and BAD_STEPS in got["odd"]


def test_grid_matches_config_and_stays_inside(spark):
    g = sampling_grid(sites_frame(spark))
    rows = g.collect()
    assert len(rows) == 25 + 16 + 25
    for city, cfg in DEFAULT_SITES.items():
        min_lon, min_lat, max_lon, max_lat = cfg["bbox"]
        mine = {(r.lat, r.lon) for r in rows if r.city == city}
        assert len(mine) == cfg["grid_steps"] ** 2
        assert all(min_lat <= la <= max_lat and min_lon <= lo <= max_lon for la, lo in mine)
        # all four corners, and as many different values on each axis as steps
        assert {(a, o) for a in (min_lat, max_lat) for o in (min_lon, max_lon)} <= mine
        assert len({la for la, _ in mine}) == len({lo for _, lo in mine}) == cfg["grid_steps"]


def test_grid_of_a_small_site(spark):
    cfg = {"small": {"bbox": (10.0, 20.0, 11.0, 22.0), "grid_steps": 3}}
    rows = sampling_grid(sites_frame(spark, cfg)).orderBy("point_index").collect()
    assert [(r.lat, r.lon) for r in rows] == [
        (20.0, 10.0), (21.0, 10.0), (22.0, 10.0), (20.0, 10.5), (21.0, 10.5), (22.0, 10.5),
        (20.0, 11.0), (21.0, 11.0), (22.0, 11.0)]


def test_no_points_below_one_step(spark):
    cfg = {c: {"bbox": (1.0, 2.0, 3.0, 4.0), "grid_steps": n} for c, n in (("a", 0), ("b", -2), ("c", None))}
    assert sampling_grid(sites_frame(spark, cfg)).count() == 0


def test_single_step_is_min_corner(spark):
    cfg = {"one": {"bbox": (1.0, 2.0, 3.0, 4.0), "grid_steps": 1}}
    rows = sampling_grid(sites_frame(spark, cfg)).collect()
    assert [(r.lat, r.lon) for r in rows] == [(2.0, 1.0)]


def test_grid_coverage(spark):
    grid = sampling_grid(sites_frame(spark))
    recv = grid.filter(F.col("point_index") > 0).withColumn("batch_ts", F.lit("b1"))
    cov = {r.city: r for r in grid_coverage(grid, recv).collect()}
    assert cov["bremen"].points_expected == 16 and cov["bremen"].points_missing == 1


def test_grid_coverage_shows_silent_sites(spark):
    grid = sampling_grid(sites_frame(spark))
    recv = grid.withColumn("batch_ts", F.lit("b1")).unionByName(
        grid.filter("city <> 'bremen'").withColumn("batch_ts", F.lit("b2")))
    announced = spark.createDataFrame([("b1",), ("b2",), ("b3",)], "batch_ts string")
    cov = {(r.city, r.batch_ts): (r.points_expected, r.points_received, r.points_missing)
           for r in grid_coverage(grid, recv, batches=announced).collect()}
    assert len(cov) == 9
    assert cov["bremen", "b2"] == (16, 0, 16) and cov["berlin", "b2"] == (25, 25, 0)
    assert cov["frankfurt", "b3"] == (25, 0, 25)
