"""File-based sources and sinks on fixtures generated into a fresh folder."""

import gzip
import io
import os
import tarfile
import warnings
import zipfile

import numpy as np
from pyspark.sql import functions as F

from tessera.sources import archives as AR
from tessera.sources import files as FL
from tessera.sources import images as IM
from tessera.sources import manifest as MF
from tessera.sources import sinks as SK
from tessera.sources import text as TX


def _write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(data)


def test_png_codec_roundtrip():
    rng = np.random.default_rng(0)
    grey = rng.integers(0, 256, size=(5, 7), dtype=np.uint8)
    rgb = rng.integers(0, 256, size=(4, 3, 3), dtype=np.uint8)
    assert np.array_equal(IM.decode_png(IM.encode_png(grey))[:, :, 0], grey)
    assert np.array_equal(IM.decode_png(IM.encode_png(rgb)), rgb)


def test_image_folder_labels_and_errors(spark, tmpdir_fresh):
    rng = np.random.default_rng(1)
    for cls in ("0", "1"):
        for i in range(2):
            _write(f"{tmpdir_fresh}/{cls}/{i}.png", IM.encode_png(rng.integers(0, 256, (28, 28), dtype=np.uint8)))
    _write(f"{tmpdir_fresh}/1/broken.png", b"\x89PNG not really")
    rgb = rng.integers(0, 256, size=(20, 30, 3), dtype=np.uint8)
    _write(f"{tmpdir_fresh}/2/wide.png", IM.encode_png(rgb))
    out = IM.labelled_images(spark, tmpdir_fresh).collect()
    ok = [r for r in out if r["error"] is None]
    assert sorted(r["label_name"] for r in ok) == ["0", "0", "1", "1", "2"]
    assert [r for r in out if r["error"] is not None][0]["path"].endswith("broken.png")
    wide = [r for r in ok if r["path"].endswith("wide.png")][0]
    # CHW, RGB order, non-square kept as 20 x 30
    feats = np.asarray(wide["features"]).reshape(3, 20, 30)
    assert np.array_equal(feats, np.transpose(rgb, (2, 0, 1)).astype(float))
    small = IM.to_features(IM.read_images(spark, f"{tmpdir_fresh}/2"), height=10, width=15)
    assert len(small.first()["features"]) == 3 * 10 * 15


def test_listing_suffix_and_small_files(spark, tmpdir_fresh):
    _write(f"{tmpdir_fresh}/a/x.bin", b"1" * 20000)
    _write(f"{tmpdir_fresh}/a/y.xbin", b"1" * 10)
    _write(f"{tmpdir_fresh}/b/z.txt", b"1")
    got = FL.list_files(spark, tmpdir_fresh, ["bin"]).collect()
    assert sorted(os.path.basename(r["path"]) for r in got) == ["x.bin", "y.xbin"]
    flags = {os.path.basename(r["path"]): r["is_small"]
             for r in FL.flag_small(FL.list_files(spark, tmpdir_fresh)).collect()}
    assert flags == {"x.bin": False, "y.xbin": True, "z.txt": True}


def test_archive_entries_all_formats(spark, tmpdir_fresh):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("d/", b"")
        zf.writestr("d/a.txt", b"hello")
        zf.writestr("empty.txt", b"")
        zf.writestr("../evil.txt", b"x")
    _write(f"{tmpdir_fresh}/one.zip", buf.getvalue())
    _write(f"{tmpdir_fresh}/one.jar", buf.getvalue())
    for name, mode in (("two.tar", "w"), ("two.tar.gz", "w:gz"), ("mislabelled.tar", "w:gz")):
        tb = io.BytesIO()
        with tarfile.open(fileobj=tb, mode=mode) as tf:
            d = tarfile.TarInfo("dir")
            d.type = tarfile.DIRTYPE
            tf.addfile(d)
            info = tarfile.TarInfo("dir/b.txt")
            info.size = 3
            tf.addfile(info, io.BytesIO(b"abc"))
        _write(f"{tmpdir_fresh}/{name}", tb.getvalue())
    _write(f"{tmpdir_fresh}/broken.zip", b"PK garbage")
    ent = AR.archive_entries(spark, tmpdir_fresh).cache()
    counts = {os.path.basename(r["archive"]): (r["n_files"], r["n_dirs"])
              for r in AR.entry_counts(ent.where(F.col("error").isNull())).collect()}
    assert counts["one.zip"] == (3, 1) and counts["two.tar.gz"] == (1, 1) and counts["mislabelled.tar"] == (1, 1)
    evil = ent.where(F.col("entry") == "../evil.txt").first()
    assert evil["unsafe"] is True
    assert AR.extraction_targets(ent.where(F.col("entry") == "../evil.txt")).first()["target"] is None
    assert ent.where(F.col("entry") == "d/a.txt").first()["content"] == bytearray(b"hello")
    assert ent.where(F.col("error").isNotNull()).count() == 1


def test_text_lines_quirks(spark, tmpdir_fresh):
    _write(f"{tmpdir_fresh}/t.txt", b"1.0, 2.0 ,,3.0,1\n\n4,5,6,2\n7,8,x,0\n1,2,0\n 9 , 9 , 9 , 0 \n")
    lines = TX.read_lines(spark, f"{tmpdir_fresh}/t.txt")
    assert lines.count() == 5  # the blank line is dropped
    out = TX.parse_lines(lines, ",", n_classes=3, expected_width=4, keep=("value",)).collect()
    by = {r["value"]: r for r in out}
    assert by["1.0, 2.0 ,,3.0,1"]["features"] == [1.0, 2.0, 3.0] and by["1.0, 2.0 ,,3.0,1"]["label"] == 1
    assert by["4,5,6,2"]["label_onehot"] == [0, 0, 1]
    assert by["7,8,x,0"]["error"] == "non-numeric cell"
    assert by["1,2,0"]["error"].startswith("expected 4 cells")
    assert by[" 9 , 9 , 9 , 0 "]["features"] == [9.0, 9.0, 9.0]


def test_read_delimited_skip_and_label(spark, tmpdir_fresh):
    _write(f"{tmpdir_fresh}/csv/a.csv", b"h1,h2,h3\n1,2,0\n3,4,1\n")
    _write(f"{tmpdir_fresh}/csv/b.csv", b"h1,h2,h3\n5,6,2\n")
    df = TX.read_delimited(spark, f"{tmpdir_fresh}/csv", n_features=2, skip_lines=1, n_classes=3)
    got = sorted((tuple(r["features"]), r["label"]) for r in df.collect())
    assert got == [((1.0, 2.0), 0), ((3.0, 4.0), 1), ((5.0, 6.0), 2)]


def test_manifest_files(spark, tmpdir_fresh):
    _write(f"{tmpdir_fresh}/m/Bob_Smith.txt",
           b"1 http://x.org/a.jpg 0 0\n2  http://x.org/b.PNG\n\n3 http://x.org/c.gif?s=1\n4\n5 http://x.org/nodot\n")
    _write(f"{tmpdir_fresh}/m/Ann.txt", b"1 http://y.org/p/q.html\n")
    plan = MF.read_manifest(spark, f"{tmpdir_fresh}/m", "/out")
    rows = plan.select("file_name", "class_dir", "url", "target_path").collect()
    got = {(r["file_name"], r["url"]): r["target_path"] for r in rows}
    assert got[("Ann.txt", "http://y.org/p/q.html")] == "/out/0000.Ann/q.html.jpg"
    assert got[("Bob_Smith.txt", "http://x.org/a.jpg")] == "/out/0001.Bob_Smith/a.jpg"
    assert got[("Bob_Smith.txt", "http://x.org/b.PNG")] == "/out/0001.Bob_Smith/b.PNG"
    assert got[("Bob_Smith.txt", "http://x.org/c.gif?s=1")] == "/out/0001.Bob_Smith/c.gif?s=1.jpg"
    assert got[("Bob_Smith.txt", "http://x.org/nodot")] == "/out/0001.Bob_Smith/nodot.jpg"
    # a line without a URL keeps its row with a NULL target; later lines are kept
    assert got[("Bob_Smith.txt", None)] is None
    existing = spark.createDataFrame([("/out/0001.Bob_Smith/a.jpg",)], "target_path string")
    assert FL.skip_existing(plan, existing).where(F.col("url") == "http://x.org/a.jpg").count() == 0


def test_sinks_and_materialize(spark, tmpdir_fresh):
    df = spark.createDataFrame([(i, [float(i)], i % 2) for i in range(10)], "batch_id long, f array<double>, l int")
    SK.save_batches(df.where("batch_id < 5"), f"{tmpdir_fresh}/b", "train", layer="fc2")
    SK.save_batches(df.where("batch_id >= 5"), f"{tmpdir_fresh}/b", "test", layer="fc2")
    test = SK.read_batches_in_order(spark, f"{tmpdir_fresh}/b", "test")
    assert [r["batch_id"] for r in test.collect()] == [5, 6, 7, 8, 9]
    assert "PartitionFilters" in test._jdf.queryExecution().executedPlan().toString()
    calls = []

    def build():
        calls.append(1)
        return df

    SK.materialize(spark, f"{tmpdir_fresh}/m", build)
    SK.materialize(spark, f"{tmpdir_fresh}/m", build)
    assert len(calls) == 1
    SK.bundle({"train": df.limit(3), "test": df.limit(2)}, f"{tmpdir_fresh}/k3")
    assert dict(spark.read.parquet(f"{tmpdir_fresh}/k3").groupBy("split").count().collect()) == {"train": 3, "test": 2}


def test_labelled_files_seeded_order(spark, tmpdir_fresh):
    for cls in ("a", "b"):
        for i in range(3):
            _write(f"{tmpdir_fresh}/{cls}/{i}.png", b"x")
    _write(f"{tmpdir_fresh}/b/skip.txt", b"x")
    df = FL.labelled_files(spark, tmpdir_fresh, ["png"], seed=123)
    rows = df.collect()
    assert sorted(r["label_name"] for r in rows) == ["a"] * 3 + ["b"] * 3
    from tessera.operators.sampling import first_n
    top = [r["path"] for r in first_n(df, 3, ["order_key", "path"]).collect()]
    assert top == [r["path"] for r in sorted(rows, key=lambda r: (r["order_key"], r["path"]))[:3]]


def test_image_batches_tensor_layout(spark, tmpdir_fresh):
    rng = np.random.default_rng(5)
    imgs = {}
    for cls in ("0", "1", "2"):
        for i in range(3):
            px = rng.integers(0, 256, size=(6, 4, 3), dtype=np.uint8)
            imgs[f"{cls}/{i}.png"] = px
            _write(f"{tmpdir_fresh}/{cls}/{i}.png", IM.encode_png(px))
    batches = IM.image_batches(spark, tmpdir_fresh, batch_size=4, height=6, width=4, channels=3,
                               n_classes=3).orderBy("batch_id").collect()
    assert [b["shape"] for b in batches] == [[4, 3, 6, 4], [4, 3, 6, 4], [1, 3, 6, 4]]
    b0 = batches[0]
    t = np.asarray(b0["values"]).reshape(b0["shape"])
    first = b0["paths"][0].split("/")
    px = imgs[f"{first[-2]}/{first[-1]}"]
    assert np.allclose(t[0], np.transpose(px, (2, 0, 1)) / 255.0)
    onehot = np.asarray(b0["labels"]).reshape(b0["label_shape"])
    assert [int(np.argmax(r)) for r in onehot] == [int(n) for n in b0["label_names"]]


def test_image_batches_decode_each_file_once(spark, tmpdir_fresh):
    rng = np.random.default_rng(8)
    names = [f"{tmpdir_fresh}/{cls}/{i}.png" for cls in ("0", "1") for i in range(5)]
    for n in names:
        _write(n, IM.encode_png(rng.integers(0, 256, size=(4, 4), dtype=np.uint8)))
    _write(f"{tmpdir_fresh}/1/bad.png", b"not an image")
    batches = IM.image_batches(spark, tmpdir_fresh, batch_size=4, height=4, width=4, channels=1, n_classes=2)
    for n in names:
        _write(n, b"x")  # counted, ordered and batched from what was decoded: the files are not read again
    rows = batches.orderBy("batch_id").collect()
    assert [b["shape"] for b in rows] == [[4, 1, 4, 4], [4, 1, 4, 4], [2, 1, 4, 4]]
    assert sorted("/" + p.split("file:")[-1].lstrip("/") for b in rows for p in b["paths"]) == [os.path.normpath(n) for n in sorted(names)]


def test_image_tasks_do_not_follow_the_files(spark, tmpdir_fresh):
    png = IM.encode_png(np.zeros((2, 2), dtype=np.uint8))
    for i in range(IM.MIN_TASKS + 40):
        _write(f"{tmpdir_fresh}/0/{i}.png", png)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1b")  # a partition per file, as many files would have them
    try:
        imgs = IM.read_images(spark, f"{tmpdir_fresh}/0")
        assert imgs.rdd.getNumPartitions() <= max(IM.MIN_TASKS, IM.TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
        assert imgs.select("path").distinct().count() == IM.MIN_TASKS + 40
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_extract_then_read_images(spark, tmpdir_fresh):
    buf = io.BytesIO()
    rng = np.random.default_rng(9)
    with zipfile.ZipFile(buf, "w") as zf:
        for cls in ("3", "5"):
            for i in range(2):
                zf.writestr(f"digits/{cls}/{i}.png", IM.encode_png(rng.integers(0, 256, (5, 5), dtype=np.uint8)))
        zf.writestr("../escape.png", b"x")
    _write(f"{tmpdir_fresh}/arch/a.zip", buf.getvalue())
    ent = AR.archive_entries(spark, f"{tmpdir_fresh}/arch")
    written = AR.extract_entries(ent, f"{tmpdir_fresh}/out")
    assert written.count() == 4  # the unsafe name is not written
    imgs = IM.labelled_images(spark, f"{tmpdir_fresh}/out").collect()
    assert sorted(r["label_name"] for r in imgs) == ["3", "3", "5", "5"]
    assert not os.path.exists(f"{tmpdir_fresh}/escape.png")


def test_non_recursive_listing_is_top_level_files(spark, tmpdir_fresh):
    for p in ("a.png", "b.txt", "sub/c.png", "x.png/inner.png"):
        _write(f"{tmpdir_fresh}/f/{p}", b"1")
    top = sorted(os.path.basename(r["path"]) for r in FL.list_files(spark, f"{tmpdir_fresh}/f", ["png"],
                                                                     recursive=False).collect())
    assert top == ["a.png"]
    deep = sorted(os.path.basename(r["path"]) for r in FL.list_files(spark, f"{tmpdir_fresh}/f", ["png"]).collect())
    assert deep == ["a.png", "c.png", "inner.png"]


def test_variable_width_lines(spark):
    lines = spark.createDataFrame([("1,2,3,0",), ("4;5,1",), ("7,,8,1",), ("9",)], "value string")
    out = {r["value"]: r for r in TX.parse_lines(lines, ",", keep=("value",)).collect()}
    assert out["1,2,3,0"]["features"] == [1.0, 2.0, 3.0] and out["1,2,3,0"]["label"] == 0
    assert out["7,,8,1"]["features"] == [7.0, 8.0]  # empty cell omitted
    assert out["4;5,1"]["error"] == "non-numeric cell"
    assert out["9"]["error"] == "too few cells"


def test_non_numeric_label_is_an_error_row(spark):
    lines = spark.createDataFrame([("1.5,2.5,x",), ("1.5,2.5,1",)], "value string")
    out = {r["value"]: r for r in TX.parse_lines(lines, ",", n_classes=2, expected_width=3, keep=("value",)).collect()}
    assert out["1.5,2.5,x"]["error"] == "non-numeric cell" and out["1.5,2.5,x"]["features"] is None
    assert out["1.5,2.5,1"]["error"] is None and out["1.5,2.5,1"]["label_onehot"] == [0, 1]


def test_archive_chunks_repeated_names_and_bad_entries(spark, tmpdir_fresh, monkeypatch):
    buf = io.BytesIO()
    with warnings.catch_warnings(), zipfile.ZipFile(buf, "w") as zf:
        warnings.simplefilter("ignore")
        zf.writestr("a.txt", b"first")
        zf.writestr("a.txt", b"second!!")
        zf.writestr("bad.txt", b"to be broken")
        zf.writestr("empty.txt", b"")
    raw = buf.getvalue()
    at = raw.index(b"to be broken")
    _write(f"{tmpdir_fresh}/x/z.zip", raw[:at] + b"TO" + raw[at + 2:])  # wrong checksum
    tb = io.BytesIO()
    with tarfile.open(fileobj=tb, mode="w") as tf:
        info = tarfile.TarInfo("big.bin")
        info.size = AR.CHUNK_BYTES + 5
        tf.addfile(info, io.BytesIO(b"q" * info.size))
    _write(f"{tmpdir_fresh}/x/t.tar", tb.getvalue())
    _write(f"{tmpdir_fresh}/x/g.tar.gz", gzip.compress(tb.getvalue()))
    _write(f"{tmpdir_fresh}/x/cut.tar", tb.getvalue()[:1 << 20])
    ent = AR.archive_entries(spark, f"{tmpdir_fresh}/x").cache()
    rows = [(os.path.basename(r["archive"]), r["entry"], r["chunk_no"], r["n"], r["error"] is None) for r in ent.select(
        "archive", "entry", "chunk_no", F.length("content").alias("n"), "error").collect()]
    for name in ("t.tar", "g.tar.gz"):
        assert sorted(r[2:] for r in rows if r[0] == name) == [(0, AR.CHUNK_BYTES, True), (1, 5, True)]
    whole = AR.whole_entries(ent).collect()
    texts = sorted(bytes(r["content"]) for r in whole if r["entry"] in ("a.txt", "empty.txt"))
    assert texts == [b"", b"first", b"second!!"]
    bad = {r["entry"]: r for r in whole if r["entry"] == "bad.txt"}["bad.txt"]
    assert bad["content"] is None and "CRC" in bad["error"]
    assert any(r["error"] for r in whole if r["archive"].endswith("cut.tar"))
    AR.extract_entries(ent.where(~F.col("archive").endswith("cut.tar")), f"{tmpdir_fresh}/out").collect()
    assert os.path.getsize(f"{tmpdir_fresh}/out/big.bin") == AR.CHUNK_BYTES + 5
    assert open(f"{tmpdir_fresh}/out/a.txt", "rb").read() == b"second!!" and not os.path.exists(f"{tmpdir_fresh}/out/bad.txt")


def test_delimited_rows_of_a_wrong_width_are_errors(spark, tmpdir_fresh):
    for skip in (0, 1, 2):
        head = b"h\n" * skip
        for name in ("a", "b"):
            _write(f"{tmpdir_fresh}/d{skip}/{name}.csv", head + b"1,2,0\n1,2\n1,2,0,9\n3,4,1\n")
        df = TX.read_delimited(spark, f"{tmpdir_fresh}/d{skip}", 2, skip_lines=skip, strict=True)
        out = [(r["features"], r["label"], r["error"] is None) for r in df.collect()]
        assert sorted(out, key=str) == sorted([([1.0, 2.0], 0, True), (None, None, False), (None, None, False),
                                               ([3.0, 4.0], 1, True)] * 2, key=str)
        assert df.where("error IS NOT NULL").select("label").count() == 4


def test_extract_same_name_in_two_archives(spark, tmpdir_fresh):
    """A broken entry takes no good one of that name with it, in another archive or later in its own."""
    def archive(*contents):
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            for c in contents:
                zf.writestr("site/index.html", c)
        raw = buf.getvalue()
        at = raw.find(b"to be broken")
        return raw if at < 0 else raw[:at] + b"TO" + raw[at + 2:]  # wrong checksum

    for name, contents in (("a", [b"good a"]), ("b", [b"to be broken"]), ("c", [b"to be broken", b"good c"]),
                           ("d", [b"old d", b"to be broken"]), ("e", [b"old e", b"good e"])):
        _write(f"{tmpdir_fresh}/y/{name}.zip", archive(*contents))
    done = AR.extract_entries(AR.archive_entries(spark, f"{tmpdir_fresh}/y"), f"{tmpdir_fresh}/out").collect()
    assert sorted(open(r["path"], "rb").read() for r in done) == [b"good a", b"good c", b"good e"]
    assert open(f"{tmpdir_fresh}/out/site/index.html", "rb").read() == b"good e"


def test_read_delimited_bad_cells_are_error_rows(spark, tmpdir_fresh):
    _write(f"{tmpdir_fresh}/c/a.csv", b"1,2,0\n1,x,0\n1,2,y\n3,4,9\n5,,1\n5,6,1.5\n")
    got = [tuple(r) for r in TX.read_delimited(spark, f"{tmpdir_fresh}/c", 2, n_classes=3).select("features", "label", "error").collect()]
    bad = "non-numeric cell"
    assert sorted(got, key=str) == sorted([([1.0, 2.0], 0, None), (None, None, bad), (None, None, bad), (None, None, "label out of range"),
                                           (None, None, bad), (None, None, bad)], key=str)
