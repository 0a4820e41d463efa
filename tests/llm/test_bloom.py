from pyspark.sql import functions as F

from loadtide.llm import bloom


def test_no_member_is_rejected(spark, monkeypatch):
    ids = spark.range(0, 60_000, 3).select((F.col("id") * 7919 - 10**6).alias("x"))
    rows = spark.range(200_000).select((F.col("id") * 7919 - 10**6).alias("x"))
    for limit in (1 << 26, 1 << 12):
        monkeypatch.setattr(bloom, "LIMIT", limit)
        passed = rows.where(bloom.maybe_in(ids, 20_000, F.col("x")))
        assert passed.join(ids, "x").count() == 20_000
        assert passed.count() < 25_000 or limit < 1 << 16
    nothing = bloom.maybe_in(ids.limit(0), 0, F.col("x"))
    assert rows.where(nothing).count() == 0
    assert spark.createDataFrame([(None,), (5,)], "x long").where(nothing).collect() == [(None,)]
