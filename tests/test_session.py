"""Scratch space comes from the session's checkpoint folder."""

from tessera.session import cut_lineage, ensure_checkpoint_dir, scratch_path


def test_scratch_under_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    assert base and ensure_checkpoint_dir(spark) == base  # set once, then reused
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base.rstrip("/")) and b.startswith(base.rstrip("/"))


def test_cut_lineage_is_reliable_checkpoint(spark):
    df = cut_lineage(spark.range(10))
    assert df.count() == 10
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" in plan  # reads the checkpointed data, not the original plan


def test_package_shipped_once_per_application(spark):
    from tessera.session import ship_package
    a = ship_package(spark)
    assert ship_package(spark) == a and a.endswith("tessera.zip")
    import zipfile
    names = zipfile.ZipFile(a).namelist()
    assert "tessera/operators/vectors.py" in names and not any("__pycache__" in n for n in names)
