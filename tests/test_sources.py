"""Corpora derived from tables: how their rows are dealt out."""

from pyspark.sql import functions as F

from quire.sources.tables import corpus, guides


def _tables(spark, folder):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'web' AS source")
    docs.repartition(40).write.parquet(f"{folder}/documents.parquet")
    parts = spark.range(3000).selectExpr(
        "id AS p_partkey", "concat('part ', id) AS p_name", "'steel' AS p_type", "'Brand#1' AS p_brand", "'BOX' AS p_container", "cast(id % 50 AS int) AS p_size",
        "'Maker' AS p_mfgr", "cast(1.5 AS decimal(12,2)) AS p_retailprice", "'none' AS p_comment",
    )
    parts.coalesce(1).write.parquet(f"{folder}/part.parquet")


def test_a_table_of_one_row_group_is_spread_beside_one_of_many_files(spark, tmp_path):
    _tables(spark, tmp_path)
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # each file is a partition of its own
    try:
        out = corpus(spark, str(tmp_path), ("documents", "part"))
        assert out.rdd.getNumPartitions() >= 40
        task = F.spark_partition_id().alias("task")
        parts = out.filter(F.col("path").startswith("parts/")).groupBy(task).count().collect()
        most = max(r["count"] for r in parts)
        assert sum(r["count"] for r in parts) == 3000
        assert most <= 3000 / spark.sparkContext.defaultParallelism, most
        assert out.filter(F.col("path").startswith("docs/")).count() == 400
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_columns_are_dealt_out_and_not_the_texts_made_of_them(spark, tmp_path):
    _tables(spark, tmp_path)
    for df in (corpus(spark, str(tmp_path), ("part",)), guides(spark, str(tmp_path), "linked")):
        plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        dealt = next(i for i, line in enumerate(plan) if "Repartition" in line)
        assert not any("concat(" in line for line in plan[dealt:])
        assert df.count() == 3000
