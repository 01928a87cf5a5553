"""Sizes looked at while a plan is built."""

from semstore.plans import sizing


def test_heavy_work_is_dealt_out_only_from_few_splits(spark, monkeypatch):
    df = spark.range(1000)
    before = df.rdd.getNumPartitions()
    monkeypatch.setattr(sizing, "SPREAD_BYTES", 1)
    monkeypatch.setattr(sizing, "estimated_bytes", lambda _: 10_000)
    assert sizing.spread(df.coalesce(1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(sizing, "estimated_bytes", lambda _: 10**12)
    assert sizing.spread(df).rdd.getNumPartitions() == before


def test_tasks_read_more_than_they_send_on(spark):
    cores = spark.sparkContext.defaultParallelism
    assert sizing.winner_tasks(spark, 800_000, 640) == 800_000
    fewer = sizing.winner_tasks(spark, 800_000, 128 * 2**20)
    assert fewer == 80_000
    assert sizing.winner_tasks(spark, 2, 2**40) == 2
    assert sizing.winner_tasks(spark, 800_000, 2**60) == 4 * cores


def test_estimates(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert 0 < sizing.estimated_bytes(df) < 10**8
    assert sizing.scan_tasks(df) == 1
    assert sizing.split_bytes(spark) == 128 * 2**20
    assert (sizing._bytes("2g"), sizing._bytes("64mb"), sizing._bytes("100"), sizing._bytes("0b")) == (2**31, 2**26, 100, 0)
