"""Session helpers: shared checkpoint folder, spread, freeze."""

from siftlane.session import checkpoint_dir, freeze, scratch_path, spread


def test_checkpoint_dir_comes_from_the_session(spark):
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    d = checkpoint_dir(spark)
    assert conf and conf.rstrip("/").split("/")[-1] in d
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(d.rstrip("/"))


def test_spread_only_when_fewer_splits_than_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    one = spark.range(100).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == 2 * cores
    many = spark.range(100).repartition(cores + 1)
    assert spread(many) is many
    ranged = spread(one, by="id")
    parts = ranged.rdd.glom().map(lambda rows: (min(r.id for r in rows), max(r.id for r in rows)) if rows else None).collect()
    spans = sorted(p for p in parts if p)
    assert all(spans[i][1] < spans[i + 1][0] for i in range(len(spans) - 1))


def test_freeze_cuts_lineage_and_keeps_rows(spark):
    df = spark.range(10).selectExpr("id", "id * 2 AS y")
    fz = freeze(df)
    assert sorted(tuple(r) for r in fz.collect()) == [(i, 2 * i) for i in range(10)]
    assert "Range" not in fz._jdf.queryExecution().optimizedPlan().toString()


def test_scratch_folders_can_be_cleared(spark, monkeypatch):
    import siftlane.session as SE

    monkeypatch.setattr(SE, "_SCRATCH", {})
    fz = freeze(spark.range(3))
    (path,) = SE._SCRATCH[spark.sparkContext.applicationId]
    assert fz.count() == 3 and SE.clear_scratch(spark) == 1 and SE.clear_scratch(spark) == 0
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert not fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path))
