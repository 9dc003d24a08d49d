"""Work on the rows of small files is spread over tasks."""

from tessella.plans import driver

DATA = "/root/testdata/sf0.001"


def test_articles_of_one_file_are_read_by_many_tasks(spark):
    got = driver.queries()["article_candidates"](spark, DATA)
    sizes = got.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    assert max(sizes) < 1.5 * min(sizes)
