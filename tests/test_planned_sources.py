"""Planned listings, numbered batch files, bucketed tables, gzip members."""

import gzip
import io
import os
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.sources import archives as AR
from tessera.sources import files as FL
from tessera.sources import listing as LS
from tessera.sources import sinks as SK


def _write(path, data=b"x"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


@pytest.fixture()
def tree(tmpdir_fresh):
    for rel, n in (("a/1.png", 3), ("a/2.PNG", 4), ("a/deep/er/3.png", 5), ("b/4.jpg", 6), ("b/xpng", 7), ("top.png", 8),
                   ("_hidden/5.png", 1), ("a/_tmp/6.png", 1), ("a/.7.png", 1)):
        _write(f"{tmpdir_fresh}/{rel}", b"z" * n)
    os.makedirs(f"{tmpdir_fresh}/empty")
    return tmpdir_fresh


@pytest.mark.parametrize("suffixes, recursive", [(None, True), (["png"], True), (["png", "jpg"], False), ([".nothing"], True)])
def test_planned_listing_equals_the_file_index(spark, tree, suffixes, recursive):
    got = LS.list_folder(spark, tree, suffixes, recursive).collect()
    want = FL.list_files(spark, tree, suffixes, recursive).collect()
    assert sorted((r["path"], r["length"]) for r in got) == sorted((r["path"], r["length"]) for r in want)
    assert {r["path"]: r["modificationTime"].replace(microsecond=0) for r in got} == \
        {r["path"]: r["modificationTime"].replace(microsecond=0) for r in want}
    assert LS.list_folder(spark, f"file://{tree}", suffixes, recursive, columns=("path",)).count() == len(want)


def test_listing_plans_a_partition_per_sub_folder_and_reads_asked_columns(spark, tree):
    df = LS.list_folder(spark, tree, columns=("path",))
    assert df.rdd.getNumPartitions() == 4 and df.columns == ["path"]  # the top itself, a, b, empty
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "path" in plan and "length" not in plan and "modificationTime" not in plan
    few = spark.read.format("folder_listing").option("maxPartitions", "2").load(tree)
    assert few.rdd.getNumPartitions() == 2 and few.count() == LS.list_folder(spark, tree).count()


def test_labelled_listing_equals_labelled_files(spark, tree):
    cols = ["path", "label_name", "rel_path", "order_key"]
    a = LS.labelled_listing(spark, tree, ["png"], seed=5).select(*cols).collect()
    b = FL.labelled_files(spark, tree, ["png"], seed=5).select(*cols).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) == 4


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 9, 1000])
def test_counting_numbered_files_asks_for_few(n):
    asked = []

    def exists(i):
        asked.append(i)
        return i < n
    assert LS.count_numbered(exists) == n and len(asked) <= 2 + 2 * max(1, n).bit_length()


def test_numbered_batches_in_order(spark, tmpdir_fresh):
    rows = spark.range(95).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"), F.floor(F.col("id") / 10).alias("batch_id"))
    SK_folder = f"{tmpdir_fresh}/out"
    LS.save_numbered(rows.repartition(5), SK_folder, "b-")
    assert sorted(os.listdir(SK_folder)) == sorted(f"b-{i}.parquet" for i in range(10))
    back = LS.read_numbered(spark, SK_folder, "b-", "batch_id long, key long", files_per_partition=3)
    assert back.rdd.getNumPartitions() == 4
    got = [(r["batch_id"], r["key"]) for r in back.collect()]
    assert [b for b, _ in got] == sorted(b for b, _ in got) and sorted(k for _, k in got) == list(range(95))
    assert all(k // 10 == b for b, k in got)
    LS.save_numbered(rows, SK_folder, "b-")  # again: the same files
    assert back.count() == 95
    assert LS.read_numbered(spark, SK_folder, "none-", "batch_id long, key long").count() == 0


def test_stored_side_is_not_shuffled(spark, tmpdir_fresh):
    import uuid
    name = f"present_{uuid.uuid4().hex[:10]}"
    present = spark.range(0, 1000, 3).select(F.concat(F.lit("p"), F.col("id")).alias("target_path"))
    stored = SK.save_bucketed(present.unionByName(present.limit(5)), name, "target_path", 6, f"{tmpdir_fresh}/present")
    plan = spark.range(1000).select(F.concat(F.lit("p"), F.col("id")).alias("target_path"), "id") \
        .unionByName(spark.createDataFrame([(None, -1)], "target_path string, id long"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = FL.skip_existing_stored(plan, stored)
        assert sorted(r["id"] for r in out.collect()) == sorted([i for i in range(1000) if i % 3] + [-1])
        joined = plan.where("target_path IS NOT NULL").join(stored, "target_path", "left_anti")
        joined.collect()
        final = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert final.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in final, final
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql(f"DROP TABLE {name}")


def test_hot_manifest_is_several_part_files(spark, tmpdir_fresh):
    from tessera.sources.manifest import read_manifest, write_manifest
    rows = [("hot.txt", f"{i}  http://h/{i}.png") for i in range(900)] + [(f"c{i}.txt", f"x  http://s/{i}.jpg") for i in range(5)] \
        + [("bad.txt", "one-token")]
    lines = spark.createDataFrame(rows, "file_name string, value string")
    write_manifest(lines, f"{tmpdir_fresh}/m", rows_per_part=200)
    assert len([f for f in os.listdir(f"{tmpdir_fresh}/m/file_name=hot.txt") if f.startswith("part-")]) > 2
    got = read_manifest(spark, f"{tmpdir_fresh}/m", "/root/x", in_parts=True).collect()
    assert len(got) == len(rows) and {r["file_name"] for r in got} == {r[0] for r in rows}
    assert {r["class_dir"] for r in got if r["file_name"] == "hot.txt"} == {"0006.hot"}
    assert [r["target_path"] for r in got if r["file_name"] == "bad.txt"] == [None]


# ---------------------------------------------------------------- gzip members

def _tar(entries):
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w") as tf:
        d = tarfile.TarInfo("dir/")
        d.type = tarfile.DIRTYPE
        tf.addfile(d)
        for name, data in entries:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tf.addfile(info, io.BytesIO(data))
    return buf.getvalue()


def _members(raw, cuts):
    at = [0, *cuts, len(raw)]
    return b"".join(gzip.compress(raw[a:b]) for a, b in zip(at, at[1:]))


def _entries(df):
    return sorted((r["entry"], r["is_dir"], r["size"], r["entry_no"], bytes(r["content"] or b""), r["error"]) for r in df.collect())


def test_members_are_read_by_several_tasks(spark, tmpdir_fresh, monkeypatch):
    rng = np.random.default_rng(3)
    entries = [(f"dir/{i}.bin", rng.integers(0, 256, int(n), dtype=np.uint8).tobytes())
               for i, n in enumerate([10, 0, 5000, 70000, 3, 200000, 12345, 512, 90000])]
    entries.append(("dir/inner.tar.gz", gzip.compress(b"abc") * 3))  # members that are content, not the archive's own
    raw = _tar(entries)
    cuts = sorted(int(c) for c in rng.integers(1, len(raw), 12))
    for name, data in (("one", gzip.compress(raw)), ("many", _members(raw, cuts))):
        _write(f"{tmpdir_fresh}/{name}/x.tar.gz", data)
    one = AR.whole_entries(AR.archive_entries(spark, f"{tmpdir_fresh}/one"))
    assert {r[6] for r in AR.iter_index(f"{tmpdir_fresh}/one/x.tar.gz")} <= {"tgz", "members"}
    index = list(AR.iter_index(f"{tmpdir_fresh}/many/x.tar.gz"))
    assert {r[6] for r in index} == {"members"} and len({r[7] for r in index}) > 3
    monkeypatch.setattr(AR, "RANGE_BYTES", 50_000)
    many = AR.archive_entries(spark, f"{tmpdir_fresh}/many")
    tasks = many.withColumn("task", F.spark_partition_id()).where("content IS NOT NULL").select("task").distinct().count()
    assert tasks > 1
    assert _entries(AR.whole_entries(many)) == _entries(one) and len(_entries(one)) == 11


def test_a_broken_member_keeps_what_came_before(spark, tmpdir_fresh):
    raw = _tar([("a", b"1" * 4000), ("b", b"2" * 4000), ("c", b"3" * 4000)])
    data = _members(raw, [5000, 9000])
    _write(f"{tmpdir_fresh}/x.tar.gz", data[:-40])
    rows = AR.archive_entries(spark, tmpdir_fresh).collect()
    assert any(r["error"] for r in rows)


def test_member_reader():
    parts = [b"hello ", b"", b"world" * 1000, b"!"]
    fh = io.BytesIO(b"".join(gzip.compress(p) for p in parts) + b"\0" * 100)
    r = AR.MemberReader(fh)
    assert r.read() == b"".join(parts) and [u for _, u in r.members] == [0, 6, 6, 5006]
    c, u = r.members[2]
    again = AR.MemberReader(fh, c, u)
    again.skip_to(u + 10)
    assert again.position == u + 10 and again.read(5) == b"world"
    assert AR.may_have_members(fh) and not AR.may_have_members(io.BytesIO(gzip.compress(b"x" * 100000)))
