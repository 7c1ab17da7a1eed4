"""The clustering sample reads its input once and stays in few partitions."""
from pyspark.sql import functions as F

from tabloom.operators.resample import bootstrap_by_content
from tabloom.plans import clustering as C


def processed(spark, rows):
    return spark.range(rows).select(
        *[F.lit("x").alias(c) for c in C.CLUSTER_DROP],
        *[((F.col("id") * (i + 3)) % 101).cast("double").alias(c)
          for i, c in enumerate(C.CLUSTER_NUMERIC)],
        *[(F.col("id") % (i + 2) == 0).alias(c) for i, c in enumerate(C.CLUSTER_BOOL)],
        F.when(F.col("id") % 3 == 0, "Night").otherwise("Day").alias(C.DUMMY_COLUMN))


def test_partitions_follow_the_sample(spark):
    sample, names = C.cluster_sample(processed(spark, 5000).repartition(7), 3000)
    assert sample.rdd.getNumPartitions() == 3 and len(names) == 14
    assert sample.agg(F.sum("weight")).first()[0] == 3000
    again = C.cluster_sample(processed(spark, 5000).repartition(2), 3000)[0]
    assert sorted(sample.select("row_id", "weight").collect()) == sorted(
        again.select("row_id", "weight").collect())


def test_drawn_rows_do_not_shuffle_the_input(spark):
    drawn = bootstrap_by_content(processed(spark, 500).select(*C.CLUSTER_NUMERIC), 100)
    assert "strategy=broadcast" in drawn._jdf.queryExecution().optimizedPlan().toString()
