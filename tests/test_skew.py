from pyspark.sql import functions as F

from ledgerly.operators.skew import hot_keys, salted_join


def sides(spark):
    large = spark.range(6000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("key.name"),
        (F.col("id") % 2).alias("part"))
    small = spark.range(400).select(
        F.when(F.col("id") < 2, "hot").when(F.col("id") == 2, None)
        .otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key.name"),
        (F.col("id") % 2).alias("part"), F.col("id").alias("value"))
    return large, small


def test_hot_keys_are_measured(spark):
    large, _ = sides(spark)
    found = {tuple(r) for r in hot_keys(large, ["key.name"], 0.1).collect()}
    assert found == {("hot",)}
    assert {tuple(r) for r in hot_keys(large, ["key.name"], 0.05).collect()} == {("hot",), (None,)}
    assert hot_keys(large.limit(0), ["key.name"]).count() == 0


def test_equals_the_plain_join(spark):
    large, small = sides(spark)
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = salted_join(large, small, ["key.name", "part"], ["row"], how, share=0.02, salts=8)
        want = large.join(small, ["key.name", "part"], how)
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_hot_key_is_dealt_to_many_tasks(spark):
    large, small = sides(spark)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "32")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        joined = salted_join(large, small.drop("part"), ["key.name"], ["row"], "left", share=0.02)
        sizes = [r["count"] for r in joined.dropDuplicates(["row"]).join(
            joined.select("row", F.spark_partition_id().alias("p")).dropDuplicates(["row"]), "row")
            .groupBy("p").count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 6000 and max(sizes) < 3 * 6000 / 32


def test_a_chain_of_salted_joins_computes_each_link_once(spark):
    large, small = (df.withColumnRenamed("key.name", "name") for df in sides(spark))
    computed = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            computed.add(len(b))
            yield b

    once = large.mapInPandas(seen, large.schema)
    first = salted_join(once, small.drop("part"), ["name"], ["row"], "left", share=0.02)
    salted_join(first, small.select("part").distinct(), ["part"], ["row"], share=0.02).count()
    assert computed.value == 6000
