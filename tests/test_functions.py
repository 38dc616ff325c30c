from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from lakejobs.functions.geo import ALPHABET, cell_distance, decode_index, geohash
from lakejobs.functions.keys import (
    canonical_json,
    fingerprint,
    key_text,
    last_n_days,
    with_bucket,
    with_idem_key,
    with_partitions,
)
from lakejobs.operators.quality import geohash_check


def bisect_geohash(lat, lon, precision):
    """Textbook bisection, for comparison."""
    lows, highs, value, out = [-180.0, -90.0], [180.0, 90.0], 0, ""
    for i in range(5 * precision):
        axis = i % 2
        point = (lon, lat)[axis]
        middle = (lows[axis] + highs[axis]) / 2
        value = value * 2 + (point >= middle)
        if point >= middle:
            lows[axis] = middle
        else:
            highs[axis] = middle
        if i % 5 == 4:
            out += ALPHABET[value]
            value = 0
    return out


def test_geohash_matches_bisection(spark):
    rng = random.Random(7)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(500)]
    points += [(37.7749, -122.4194), (0.1, 0.1), (-89.99, 179.99), (90.0, 180.0), (-90.0, -180.0)]
    df = spark.createDataFrame(points, "lat double, lon double")
    for precision in (1, 2, 5, 7, 12):
        code = geohash(F.col("lat"), F.col("lon"), precision)
        for r in df.select("lat", "lon", code.alias("code")).collect():
            assert r["code"] == bisect_geohash(r["lat"], r["lon"], precision)
    assert bisect_geohash(37.7749, -122.4194, 7) == "9q8yyk8"


def test_geohash_outside_range_is_null(spark):
    df = spark.createDataFrame([(91.0, 0.0), (0.0, -181.0), (None, 0.0)], "lat double, lon double")
    found = df.select(geohash(F.col("lat"), F.col("lon")).alias("c")).collect()
    assert [r["c"] for r in found] == [None] * 3


def test_decode_inverts_encode(spark):
    df = spark.range(200).select(
        (F.rand(1) * 180 - 90).alias("lat"), (F.rand(2) * 360 - 180).alias("lon")
    )
    code = geohash(F.col("lat"), F.col("lon"))
    same = df.select(cell_distance(code, F.col("lat"), F.col("lon")).alias("d")).distinct()
    assert [r["d"] for r in same.collect()] == [0]
    bad = spark.createDataFrame([("9q8yyka",), ("9q8",), (None,)], "c string")
    x, y = decode_index(F.col("c"))
    assert [tuple(r) for r in bad.select(x, y).collect()] == [(None, None)] * 3


def test_geohash_check_flags_the_sample_and_accepts_neighbours(spark):
    df = spark.createDataFrame(
        [
            ("9q8yyj0", 37.7749, -122.4194),
            ("9q8yyk8", 37.7749, -122.4194),
            (bisect_geohash(37.7749 + 180 / 2**17, -122.4194, 7), 37.7749, -122.4194),
            (bisect_geohash(10.0, -179.9999, 7), 10.0, 179.9999),
            (None, 37.7749, -122.4194),
        ],
        "geo_hash string, latitude double, longitude double",
    )
    assert [r["geo_ok"] for r in geohash_check(df).collect()] == [False, True, False, False, False]
    tolerant = [r["geo_ok"] for r in geohash_check(df, tolerant=True).collect()]
    assert tolerant == [False, True, True, True, False]


def test_bucket_is_the_md5_bucket(spark):
    df = with_bucket(spark.createDataFrame([("42",), ("abc",)], "k string"), ["k"], 64)
    for r in df.collect():
        assert r["bucket"] == int(hashlib.md5(r["k"].encode()).hexdigest()[:8], 16) % 64


def test_key_text_is_unambiguous(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("\\N", "x"), ("", "x"), ("a\\", "|c")]
    df = spark.createDataFrame(rows, "p string, q string")
    texts = [r[0] for r in df.select(key_text(df, ["p", "q"])).collect()]
    assert len(set(texts)) == len(rows)
    keyed = with_idem_key(df, ["p", "q"])
    assert keyed.select("idem_key").distinct().count() == len(rows)


def test_canonical_json_sorts_every_level(spark):
    df = spark.sql(
        "SELECT 2 AS b, named_struct('z', 1, 'y', cast(null as int)) AS a, "
        "map('k2', 1, 'k1', 2) AS m, array(named_struct('d', 1, 'c', 2)) AS l"
    )
    text = df.select(canonical_json(df)).first()[0]
    assert text == '{"a":{"y":null,"z":1},"b":2,"l":[{"c":2,"d":1}],"m":{"k1":2,"k2":1}}'
    swapped = df.select("m", "l", "b", "a")
    assert df.select(fingerprint(df)).first() == swapped.select(fingerprint(swapped)).first()


def test_partitions_and_last_days(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP_NTZ'2024-01-01 05:00:00'), "
        "(TIMESTAMP_NTZ'2024-01-08 05:00:00'), (TIMESTAMP_NTZ'2024-01-08 04:59:59') AS t(ts)"
    )
    parts = with_partitions(df, "ts", "hour").select("event_date", "event_hour").collect()
    assert [(str(r[0]), r[1]) for r in parts][0] == ("2024-01-01", 5)
    assert last_n_days(df, "ts", 7).count() == 2
    assert last_n_days(df, "ts", 8).count() == 3
    assert last_n_days(df.limit(0), "ts", 8).count() == 0


def test_scratch_is_cleared(spark):
    from lakejobs.session import clear_scratch, materialize, path_status, shared_root

    kept = materialize(spark.range(3), "kept")
    assert kept.count() == 3
    clear_scratch(spark)
    app = spark.sparkContext.applicationId
    assert path_status(spark, f"{shared_root(spark)}/lakejobs/{app}") == "absent"
