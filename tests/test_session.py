from quaestor.session import spread


def test_rows_of_a_partition_do_not_grow_with_the_table(spark):
    cores = spark.sparkContext.defaultParallelism
    for n in (1000, 10000):
        sizes = spread(spark.range(n, numPartitions=cores), "id", rows=50).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
        assert sum(sizes) == n and len(sizes) >= n // 50 and max(sizes) < 100
    assert spread(spark.range(1000, numPartitions=cores), "id").rdd.getNumPartitions() == cores
