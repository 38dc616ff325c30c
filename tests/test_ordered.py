from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakejobs.operators.ordered import OrderedRows, ordered_columns

SPEC = {
    "prev": ("lag", "v"),
    "next": ("lead", "v"),
    "prev_w": ("lag", "w"),
    "high": ("running_max", "v"),
    "n": ("row_number", None),
}


def sample(spark, n=400, seed=3):
    """One key holds a third of all rows; keys and values may be null; times tie."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", None, "c"])
        value = rng.choice([None, rng.randint(0, 50)])
        data.append((key, rng.randint(0, 20), i, value, f"w{i}"))
    return spark.createDataFrame(data, "k string, t int, i int, v int, w string")


def expected(data, keyed):
    out = []
    groups = {}
    for r in data:
        groups.setdefault(r["k"] if keyed else 0, []).append(r)
    for group in groups.values():
        group.sort(key=lambda r: (r["t"], r["i"]))
        high = None
        for at, r in enumerate(group):
            before = group[at - 1] if at else None
            after = group[at + 1] if at + 1 < len(group) else None
            if r["v"] is not None:
                high = r["v"] if high is None else max(high, r["v"])
            out.append(
                (
                    *r,
                    before and before["v"],
                    after and after["v"],
                    before and before["w"],
                    high,
                    at + 1,
                )
            )
    return sorted(out, key=repr)


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("max_rows", [1_000_000, 60, 7])
def test_equals_plain_window(spark, keyed, max_rows):
    df = sample(spark)
    out = ordered_columns(df, ["k"] if keyed else [], ["t", "i"], SPEC, max_rows)
    assert rows(out) == expected(df.collect(), keyed)


def test_chained_steps_keep_the_cuts(spark):
    df = sample(spark, 300)

    def chain(max_rows):
        ordered = OrderedRows(df, ["k"], ["t", "i"], max_rows).add({"prev": ("lag", "v")})
        ordered.change(lambda d: d.where(~F.col("prev").eqNullSafe(F.col("v"))))
        return rows(ordered.add({"n": ("row_number", None), "next": ("lead", "t")}).rows())

    assert chain(10) == chain(1_000_000)


def test_one_time_holds_most_rows(spark):
    """The cut runs through rows of equal time because the order goes on."""
    df = spark.range(500).select(
        F.lit("k").alias("k"), F.lit(1).alias("t"), F.col("id").alias("i"), F.col("id").alias("v")
    )
    out = ordered_columns(df, ["k"], ["t", "i"], {"prev": ("lag", "v")}, 50)
    assert out.where("prev <=> i - 1").count() == 499


def test_many_pieces_in_few_range_partitions(spark):
    """What the driver collects goes by range partitions, and these not by pieces."""
    df = spark.range(3000).select(
        (F.col("id") % 2).alias("k"), F.col("id").alias("t"), F.lit(1).alias("v")
    )
    for keys in (["k"], []):
        ordered = OrderedRows(df, keys, ["t"], 10)
        sizes = ordered._pieces.groupBy(*keys, "__piece").count().collect()
        assert len(sizes) >= 300 and max(r["count"] for r in sizes) <= 10
        usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert len(ordered._pieces.inputFiles()) <= usual
        out = ordered.add({"n": ("row_number", None), "prev": ("lag", "t")}).rows()
        step = 2 if keys else 1
        assert out.where(F.col("n") == F.floor(F.col("t") / step) + 1).count() == 3000
        assert out.where(F.col("prev") == F.col("t") - step).count() == 3000 - step


def test_pieces_of_rows_that_are_alike(spark):
    """Rows equal in all columns are cut as well."""
    df = spark.range(400).select(F.lit("k").alias("k"), F.lit(1).alias("t"), F.lit(2).alias("v"))
    spec = {"n": ("row_number", None), "prev": ("lag", "v"), "high": ("running_max", "v")}
    out = rows(OrderedRows(df, ["k"], ["t"], 30).add(spec).rows())
    assert sorted(r[3] for r in out) == list(range(1, 401))
    assert sum(r[4] == 2 for r in out) == 399 and all(r[5] == 2 for r in out)


def test_unknown_kind(spark):
    with pytest.raises(ValueError):
        ordered_columns(sample(spark, 5), ["k"], ["t"], {"x": ("median", "v")})
