"""A key holding a third of the rows must not land in one task: the
first-file-wins join is split by AQE's skew handling, and stays exact."""

from pyspark.sql import functions as F

from regcurate.operators.dedup import first_file_wins

_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
}


def test_hot_key_join_is_split_and_exact(spark):
    saved = {k: spark.conf.get(k, None) for k in _CONF}
    try:
        for k, v in _CONF.items():
            spark.conf.set(k, v)
        n = 600_000
        df = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot"))
             .otherwise(F.concat(F.lit("k"), (F.col("id") % 50_000).cast("string")))
             .alias("person_id"),
            F.concat(F.lit("bef"), (1990 + F.col("id") % 4).cast("string")).alias("source_file"),
            F.col("id").cast("string").alias("payload"))
        out = first_file_wins(df, "person_id")
        got = out.groupBy(F.col("person_id") == "hot").count().collect()
        assert {r[0]: r[1] for r in got} == {True: 50_000, False: 400_000}
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_sorted_sink_splits_a_hot_key(spark):
    from regcurate.sinks.writers import sorted_for_write
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(90_000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot"))
             .otherwise(F.format_string("k%05d", F.col("id") % 7_000)).alias("person_id"),
            F.col("id").cast("string").alias("v"))
        out = sorted_for_write(df, ["person_id"])
        per_part = out.withColumn("p", F.spark_partition_id()).where("person_id = 'hot'") \
            .groupBy("p").count().collect()
        assert len(per_part) > 1                      # the hot key is not one task
        keys = [r.person_id for r in out.select("person_id").collect()]
        assert keys == sorted(keys) and len(keys) == 90_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_record_id_in_diagnoses_join_is_split_and_exact(spark):
    from regcurate.plans import diagnoses
    saved = {k: spark.conf.get(k, None) for k in _CONF}
    try:
        for k, v in _CONF.items():
            spark.conf.set(k, v)
        adm = spark.range(60_000).select(
            F.col("id").cast("string").alias("RECNUM"),
            F.concat(F.lit("p"), F.col("id").cast("string")).alias("PNR"),
            F.lit("0").alias("C_PATTYPE"), F.lit("1990-01-01").alias("D_INDDTO"),
            F.lit(None).cast("string").alias("D_UDDTO"),
            F.lit("lpr_adm1990.sas7bdat").alias("source_file"))
        diag = spark.range(600_000).select(
            F.when(F.col("id") % 3 == 0, F.lit("7"))
             .otherwise((F.col("id") % 60_000).cast("string")).alias("RECNUM"),
            F.concat(F.lit("DF"), (F.col("id") % 90).cast("string")).alias("C_DIAG"),
            F.lit("A").alias("C_DIAGTYPE"), F.lit("lpr_diag1990.sas7bdat").alias("source_file"))
        out = diagnoses.build({"lpr_adm": adm, "lpr_diag": diag})
        got = {r[0]: r[1] for r in out.groupBy(F.col("record_id") == "7").count().collect()}
        hot = diag.where("RECNUM = '7'").count()      # a third of the rows, and a few more
        assert hot > 200_000 and got[True] == hot
        assert sum(got.values()) == 600_000           # every diagnosis has its record
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
