"""Connected components of links, by large and small stars in turn."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickwright.session import shared_dir


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours meet the smallest node around it."""
    both = links.union(links.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("at"), F.least("a", "m").alias("m"))
    return both.join(least, F.col("a") == F.col("at")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours meet the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("at"), "m")
    met = down.join(least, F.col("a") == F.col("at"))
    return met.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(least.toDF("a", "b"))


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node that has a link and is no root.

    ``links`` has two columns of numbers. Each round is written to the shared folder; the rounds end when
    one changes nothing. The driver sees a count and a sum for each round.
    """
    path = shared_dir(spark, "links")
    links.toDF("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().write.parquet(path)
    links = spark.read.parquet(path)
    before = None
    while True:
        path = shared_dir(spark, "links")
        _small_star(_large_star(links).distinct()).distinct().write.parquet(path)
        links = spark.read.parquet(path)
        state = links.agg(F.count("*"), F.expr("sum(CAST(xxhash64(a, b) AS DECIMAL(20, 0)))")).first()
        if state == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
