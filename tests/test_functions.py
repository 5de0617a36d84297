"""Column expressions: labels, strings, arrays (P1-P16 quirks)."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.functions import labels as L
from tessera.functions import strings as S


def test_parent_and_base_labels(spark):
    df = spark.createDataFrame([("/data/train/7/123.png",), ("/data/train/cat/",), ("rel\\dir\\5.x.png",),
                                ("noslash",)], "path string")
    out = df.select(L.parent_dir_label("path").alias("p"), L.base_name_label("path").alias("b")).collect()
    assert [tuple(r) for r in out] == [("7", 123), ("train", None), ("dir", 5), (None, None)]


def test_one_hot_and_out_of_range(spark):
    df = spark.createDataFrame([(0,), (2,)], "label int")
    got = [r[0] for r in df.select(L.one_hot("label", 3)).collect()]
    assert got == [[1, 0, 0], [0, 0, 1]]
    bad = spark.createDataFrame([(3,)], "label int")
    with pytest.raises(Exception, match="label out of range"):
        bad.select(L.one_hot("label", 3)).collect()


def test_argmax_first_maximum(spark):
    df = spark.createDataFrame([([0.1, 0.9, 0.9],), ([5.0],), (None,)], "a array<double>")
    assert [r[0] for r in df.select(A.argmax("a")).collect()] == [1, 0, None]


def test_pad_never_truncates(spark):
    df = spark.createDataFrame([("7",), ("12345",)], "s string")
    got = df.select(S.pad_left_keep("s", 4).alias("l"), S.pad_right_keep("s", 4).alias("r")).collect()
    assert [tuple(r) for r in got] == [("0007", "7   "), ("12345", "12345")]


@pytest.mark.parametrize("url,expected", [
    ("http://h.com/a/b.jpg", "b.jpg"),                 # allowed extension kept
    ("http://h.com/a/b.JPG", "b.JPG"),                 # upper-case listed too
    ("http://h.com/a/b.Jpg", "b.Jpg.jpg"),             # mixed case is not listed
    ("http://h.com/a/b.html", "b.html.jpg"),           # other extension -> .jpg appended
    ("http://h.com/a/b.jpg?x=1", "b.jpg?x=1.jpg"),     # query string stays in the name
    ("http://h.com/a/noext", "noext.jpg"),             # no dot in the name
    ("http://h.com/a/.hidden", ".hidden.jpg"),         # dot at position 0 does not count
    ("http://h.com/a/dir/", "dir.jpg"),                # trailing slash dropped
    ("nodot/at/all", None),                            # URL without any dot: bad line
])
def test_url_local_name(spark, url, expected):
    got = spark.createDataFrame([(url,)], "u string").select(S.url_local_name("u")).first()[0]
    assert got == expected


def test_class_dir_and_target(spark):
    df = spark.createDataFrame([(7, "Some_Name.txt"), (12345, "x.txt")], "i int, f string")
    out = df.select(S.class_dir_name("i", "f").alias("d")).select(
        "d", S.target_path("/root", F.col("d"), F.lit("a.jpg")).alias("t")).collect()
    assert [tuple(r) for r in out] == [("0007.Some_Name", "/root/0007.Some_Name/a.jpg"),
                                       ("12345.x", "/root/12345.x/a.jpg")]


def test_suffix_match_has_no_dot(spark):
    df = spark.createDataFrame([("a.bin",), ("a.xbin",), ("a.BIN",)], "p string")
    assert [r[0] for r in df.select(S.suffix_match(F.col("p"), ["bin"])).collect()] == [True, True, False]


def test_scale_and_mean_subtract(spark):
    df = spark.createDataFrame([([0.0, 255.0, 51.0, 102.0],)], "a array<double>")
    assert df.select(A.scale_pixels("a")).first()[0] == [0.0, 1.0, 0.2, 0.4]
    # CHW with 2 channels of plane 2; HWC with 2 channels
    chw = df.select(A.subtract_channel_means("a", [1.0, 2.0], plane_size=2)).first()[0]
    hwc = df.select(A.subtract_channel_means("a", [1.0, 2.0], channel_last=True)).first()[0]
    assert chw == [-1.0, 254.0, 49.0, 100.0]
    assert hwc == [-1.0, 253.0, 50.0, 100.0]


def test_cosine_null_semantics(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 1.0]), ([1.0, 1.0], [2.0, 2.0]), ([0.0, 0.0], [1.0, 1.0]),
                                (None, [1.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(A.cosine("a", "b")).collect()]
    assert got[0] == 0.0 and abs(got[1] - 1.0) < 1e-12 and got[2] is None and got[3] is None


def test_label_index_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "lab string")
    out = L.index_labels(df, "lab").collect()
    assert sorted((r["lab"], r["lab_index"]) for r in out if r["lab"]) == [("a", 0), ("a", 0), ("b", 1), ("c", 2)]
    assert [r["lab_index"] for r in out if r["lab"] is None] == [None]


def test_imagenet_preprocess_chw(spark):
    df = spark.createDataFrame([([123.68, 123.68, 116.779, 116.779, 103.939, 103.939],)], "a array<double>")
    assert df.select(A.imagenet_preprocess("a", plane_size=2)).first()[0] == [0.0] * 6


def test_large_dictionary_path_keeps_null_rows(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "lab string")
    out = L.index_labels(df, "lab").collect()
    got = sorted(((r["lab"] or ""), r["lab_index"] if r["lab_index"] is not None else -1) for r in out)
    assert got == [("", -1), ("a", 0), ("a", 0), ("b", 1)]
