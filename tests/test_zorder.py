"""Clustering on several keys."""

import random

from pyspark.sql import functions as F

from helpers import rows
from regcurate.sinks.writers import sorted_for_write
from regcurate.sinks.zorder import (files_read, interleaved, placed, position, quantiles,
                                    zordered)


def _table(spark, n=4000):
    r = random.Random(4)
    data = [(str(r.randrange(500)), str(r.randrange(700)), k) for k in range(n)]
    data += [("hot", str(k), k) for k in range(1500)] + [(None, "1", 1), ("1", None, 2)]
    return spark.createDataFrame(data, "a string, b string, v int")


def test_positions_and_bits(spark):
    cuts = [chr(97 + i) for i in range(20)]
    df = spark.createDataFrame([(None,), ("",), ("a",), ("b0",), ("t",), ("zz",)], "k string")
    got = [r[0] for r in df.select(position(F.col("k"), cuts)).collect()]
    assert got == [0, 0, 1, 2, 20, 20]
    assert df.select(position(F.col("k"), [])).first()[0] == 0
    z = spark.range(1).select(interleaved([F.lit(0b101), F.lit(0b011)], 3)).first()[0]
    assert z == 0b100111


def test_rows_are_kept_and_both_keys_skip_files(spark, tmp_path):
    table = _table(spark)
    zordered(table, ["a", "b"], 16).write.parquet(str(tmp_path / "z"))
    sorted_for_write(table, ["a", "b"]).repartitionByRange(16, "a", "b").sortWithinPartitions(
        "a", "b").write.parquet(str(tmp_path / "plain"))
    z, plain = (spark.read.parquet(str(tmp_path / d)) for d in ("z", "plain"))
    assert rows(z) == rows(table)
    got = {d: {r.key: r for r in files_read(df, ["a", "b"]).collect()}
           for d, df in (("z", z), ("plain", plain))}
    assert got["plain"]["a"].files_read < 2 < 12 < got["plain"]["b"].files_read
    assert max(r.files_read for r in got["z"].values()) < 9
    # the value with a third of the rows is in several files
    assert z.where("a = 'hot'").select(F.input_file_name()).distinct().count() > 2


def test_quantiles_come_from_a_bounded_sample(spark):
    cuts = quantiles(_table(spark), ["a", "b"], bits=4, sample=300)
    assert all(0 < len(c) <= 15 and c == sorted(set(c)) for c in cuts.values())
    assert quantiles(_table(spark).limit(0), ["a"]) == {"a": []}


def test_strict_positions_and_more_cuts_than_bits(spark):
    df = spark.createDataFrame([(None,), ("",), ("a",), ("b0",), ("t",), ("zz",)], "k string")
    got = df.select(position(F.col("k"), ["a", "a", "t"], 1, below=True),
                    position(F.col("k"), ["a", "a", "t"], 1)).collect()
    assert [tuple(r) for r in got] == [(0, 0), (0, 0), (0, 2), (2, 2), (2, 3), (3, 3)]


def test_a_key_is_placed_once_a_row(spark):
    """The plan has one search per key, not one per bit of it."""
    plan = zordered(_table(spark), ["a", "b"], 4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 2


def test_rows_are_dealt_in_one_pass(spark):
    """No range exchange, which places all rows once more to sample them; files are
    even, those of a value with all rows too."""
    for table in (_table(spark), spark.range(4000).selectExpr("'x' AS a", "'y' AS b", "id AS v")):
        got = zordered(table, ["a", "b"], 8)
        assert "rangepartitioning" not in got._jdf.queryExecution().executedPlan().toString()
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 1.5 * table.count() / 8
    assert zordered(table.limit(0), ["a", "b"], 8).count() == 0


def test_a_search_in_columns_is_the_same(spark):
    df = spark.createDataFrame([(None,), ("",), ("a",), ("b0",), ("t",), ("zz",)], "k string")
    for cuts in ([], ["a"], ["a", "a", "t"], [chr(97 + i) for i in range(20)]):
        for below in (False, True):
            df = placed(df, "c", F.col("k"), cuts, below=below)
            assert df.where(F.col("c") != position(F.col("k"), cuts, below=below)).count() == 0
