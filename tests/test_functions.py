"""Golden cases and properties of the column helpers (text, numbers, codecs, images)."""

import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hearth.functions import codec, images, text


def one(spark, col, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("o")).first()["o"]


def many(spark, col, values, schema="s string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + schema)
    return [r["o"] for r in df.select("i", col.alias("o")).orderBy("i").collect()]


def test_title_clean(spark):
    assert one(spark, text.title_clean("s"), " 南北,通透，两居 精装 ") == "南北-通透-两居-精装"


def test_py_strip_matches_python(spark):
    samples = [" a ", "　中　", "\t\nx\x1c", "\x85y\xa0", "", "  ", "a b", "​z​"]
    assert many(spark, text.py_strip("s"), samples) == [s.strip() for s in samples]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" \t\n　\x1c\xa0ab中,")), max_size=12),
                min_size=1, max_size=20))
def test_py_strip_property(spark, values):
    assert many(spark, text.py_strip("s"), values) == [v.strip() for v in values]


def test_first_match_default_and_empty(spark):
    col = text.first_match("s", r"<b>(.*?)</b>")
    assert many(spark, col, ["x<b> hi </b>", "nothing", "<b></b>", None]) == ["hi", "-", "", "-"]


def test_first_match_dot_stops_only_at_newline(spark):
    # Python's '.' crosses '\r' but not '\n'
    col = text.first_match("s", r"<p>(.*?)</p>")
    assert many(spark, col, ["<p>a\rb</p>", "<p>a\nb</p><p>c</p>"]) == ["a\rb", "c"]


def test_strict_double_follows_python_float(spark):
    samples = ["89.5", " 12 ", "1_000", "1e3", ".5", "5.", "-", "暂无", "1d", "nan", "inf", "", None,
               "+3", "1__0", "_1", "0x10", "８９.５", "１_０００"]

    def py(s):
        if s is None:
            return None
        try:
            v = float(s)
        except ValueError:
            return None
        return v if math.isfinite(v) else None

    assert many(spark, text.strict_double("s"), samples) == [py(s) for s in samples]


def test_facts_split(spark):
    arr = text.split_parts("s", "|")
    df = spark.createDataFrame([("2室1厅 | 89.5平米 | 南 北 | 精装 | 高楼层(共18层) | 板楼",)], "s string")
    r = df.select(*[text.part(arr, i).alias(f"p{i}") for i in range(7)]).first()
    assert [r[f"p{i}"] for i in range(7)] == ["2室1厅", "89.5平米", "南 北", "精装", "高楼层(共18层)", "板楼", None]


FLOATS = [98.0, 12000.0, 1e7, 12345678.5, 1e16, 1.5e16, 1e-4, 1.2e-4, 1e-5, 2e23, 0.1 + 0.2,
          -0.0, 0.0, 1e-300, 1.7976931348623157e308, -123.456, 9001.0, float("inf"), float("-inf")]


def test_py_float_str_golden(spark):
    got = many(spark, text.py_float_str("x"), FLOATS, "x double")
    assert got == [repr(v) for v in FLOATS]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e15, max_value=1e15)
                .map(lambda v: round(v, 4)), min_size=1, max_size=50))
def test_py_float_str_prices(spark, values):
    # values with up to 15 significant digits print exactly as Python does
    got = many(spark, text.py_float_str("x"), values, "x double")
    assert got == [repr(v) for v in values]


def test_py_float_str_is_repr(spark, scratch):
    """Doubles of all bit patterns, the least subnormals and numbers of 16 to 17 digits."""
    rng = np.random.default_rng(11)
    x = rng.integers(0, 2**64, 100_000, dtype=np.uint64).view(np.float64)
    x = np.concatenate([x[np.isfinite(x)], np.arange(1, 300, dtype=np.uint64).view(np.float64), rng.random(50_000) * 1e8,
                        rng.random(20_000) * 1e-4, -np.round(rng.random(20_000) * 1e9, 2), 10.0 ** np.arange(-30, 31)])
    pq.write_table(pa.table({"x": x}), f"{scratch}/x.parquet")
    rows = spark.read.parquet(f"{scratch}/x.parquet").select("x", text.py_float_str("x").alias("s")).collect()
    assert len(rows) == x.size and [r for r in rows if r.s != repr(r.x)] == []


def test_dict_assign_last_value_first_position(spark):
    df = spark.createDataFrame([(["u", "v", "u"], ["a", "b", "c"])], "k array<string>, v array<string>")
    g = df.select(codec.dict_assign(codec.entries("k", "v")).alias("g")).first()["g"]
    assert [(e.pos, e.url, e.descr) for e in g] == [(0, "u", "c"), (1, "v", "b")]


def test_decode_empty_and_null(spark):
    got = many(spark, F.size(codec.decode_pairs("s")), ["", None, ";", "a##b"])
    assert got == [0, 0, 0, 1]


def test_decode_drops_malformed(spark):
    df = spark.createDataFrame([("a##1;bad;b##2##x;c##3",)], "s string")
    r = df.select(codec.decode_pairs("s").alias("g"), codec.malformed_pairs("s").alias("m")).first()
    assert [(e.url, e.descr) for e in r.g] == [("a", "1"), ("c", "3")] and r.m == 2


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.text("abc/.:", min_size=1, max_size=5), st.text("xyz户型图", max_size=4)),
                max_size=8))
def test_encode_decode_roundtrip(spark, pairs):
    # encode(gallery) then decode gives the same ordered dict
    expected = {}
    for k, v in pairs:
        expected[k] = v
    df = spark.createDataFrame([([k for k, _ in pairs], [v for _, v in pairs])],
                               "k array<string>, v array<string>")
    g = codec.dict_assign(codec.entries("k", "v"))
    back = df.select(codec.decode_pairs(codec.encode_pairs(g)).alias("g")).first()["g"]
    assert [(e.url, e.descr) for e in back] == list(expected.items())


def test_model_list(spark):
    df = spark.createDataFrame([("a##m1; b ## m2 ;bad",)], "s string")
    r = df.select(codec.decode_model_list("s").alias("g"), codec.first_model("s").alias("f")).first()
    assert [(e.name, e.model) for e in r.g] == [("a", "m1"), ("b", "m2")] and r.f == "m1"


def test_thumbnail_and_url_tidy(spark):
    assert one(spark, images.resize_thumb("s"), "x.120x80.jpg") == "x.450x300.jpg"
    assert one(spark, images.resize_thumb("s", "450x300", "210x140"), "x.450x300.jpg") == "x.210x140.jpg"
    assert one(spark, images.tidy_url("s"), "  `http://a/b.jpg` ") == "http://a/b.jpg"


def test_sniff(spark):
    cases = [("FFD8FF00", "jpeg"), ("89504E470D0A1A0A00", "png"), ("474946383961", "gif"),
             ("474946383761", ""), ("424D00", ""), ("424D80", "bmp"), ("49492A00", "tiff")]
    df = spark.createDataFrame([(h,) for h, _ in cases], "h string")
    got = [r.t for r in df.select(F.regexp_extract(images.data_uri(F.unhex("h")),
                                                   "^data:image/([a-z]*);", 1).alias("t")).collect()]
    assert got == [k for _, k in cases]


def test_data_uri_has_no_line_breaks(spark):
    uri = one(spark, images.data_uri(F.unhex(F.col("s"))), "FFD8FF" + "00" * 200)
    assert uri.startswith("data:image/jpeg;base64,/9j/") and "\n" not in uri and "\r" not in uri
    assert one(spark, images.data_uri(F.col("b")), None, "b binary") == ""


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=12),
                          st.integers(0, 10**6).map(lambda n: f"满意分: {n}分。"),
                          st.integers(0, 999).map(lambda n: f"x 满意分：{n}")), min_size=1, max_size=20))
def test_score_is_null_or_in_range(spark, replies):
    from hearth.operators import score
    got = many(spark, score.parse_score("s"), replies)
    assert all(v is None or 0 <= v <= 100 for v in got)


def test_data_uri_roundtrip(spark):
    raw = bytes.fromhex("89504E470D0A1A0A") + bytes(range(256)) * 3
    df = spark.createDataFrame([(raw,)], "b binary")
    back = df.select(images.data_uri_bytes(images.data_uri("b")).alias("o")).first().o
    assert bytes(back) == raw


def test_decode_large_text_is_python_dict(spark):
    import random
    rnd = random.Random(5)
    pairs = [(f"k{rnd.randrange(900)}", f"v{i}") for i in range(4000)]
    expected = {}
    for k, v in pairs:
        expected[k] = v
    text_value = ";".join(f"{k}##{v}" for k, v in pairs)
    g = one(spark, codec.decode_pairs("s"), text_value)
    assert [(e.url, e.descr) for e in g] == list(expected.items())
    assert [e.pos for e in g] == list(range(len(expected)))


def test_decode_counts_and_keeps_in_one_pass(spark):
    df = spark.createDataFrame([("a##1;b##2;;bad;a##3;c##d##e;##x;y##;z###q",), ("",), (None,), (";;",)], "s string")
    got = [(r.d.malformed, [(x.pos, x.url, x.descr) for x in r.d.gallery]) for r in df.select(codec.decode("s").alias("d")).collect()]
    assert got == [(2, [(0, "a", "3"), (1, "b", "2"), (2, "", "x"), (3, "y", ""), (4, "z", "#q")]), (0, []), (0, []), (0, [])]


def test_decode_is_linear_in_the_words(spark):
    import time

    def seconds(n):
        text = F.array_join(F.transform(F.sequence(F.lit(1), F.col("id") * 0 + n), lambda i: F.concat((i % 5000).cast("string"), F.lit("##v"))), ";")
        df = spark.range(0, 4, 1, 4).select(text.alias("s")).select(codec.decode("s").alias("d")).select(F.explode("d.gallery").alias("g"), "d.malformed")
        t = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t
    seconds(20_000)
    assert min(seconds(200_000) for _ in range(2)) <= 15 * max(min(seconds(20_000) for _ in range(2)), 0.2)
