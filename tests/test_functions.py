import random

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from crawlflow import fixed_values as fixed
from crawlflow import functions as fn


def column(spark, values, expression):
    """Values of an expression over texts `t`, in the order of the texts."""
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [row[1] for row in sorted(df.select("i", expression(F.col("t")).alias("v")).collect())]


def signed(text):
    value = xxhash.xxh64(text.encode(), seed=0).intdigest()
    return value - 2**64 if value >= 2**63 else value


def test_hash_golden(spark):
    assert column(spark, ["abc", "", None], fn.xxh64) == [4952883123889572249, -1205034819632174695, 0]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=200), min_size=1, max_size=40))
def test_hash_equals_library(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert column(spark, texts, fn.xxh64) == [signed(t) for t in texts]


def test_url_hash_key(spark):
    assert column(spark, ["abc", None], fn.url_hash_key) == ["4952883123889572249", None]


DOMAINS = [
    ("https://www.example.com", "example.com", "www.example.com"),
    ("http://my-site.com:80/x", "site.com", "site.com"),
    ("HTTP://A.B.Example.COM.CN/x?y#z", "example.com.cn", "b.example.com.cn"),
    ("http://user:pw@www.example.org/", "example.org", "www.example.org"),
    ("http://a_b.c.com/x", "c.com", "a_b.c.com"),
    # Only ASCII letters are word characters, so no label is found before the ending.
    ("http://www.例子.中国", ".中国", ".中国"),
    ("http://localhost/", fixed.DOMAIN_NOT_FOUND, fixed.DOMAIN_NOT_FOUND),
    ("http://1.2.3.4/", fixed.DOMAIN_NOT_FOUND, fixed.DOMAIN_NOT_FOUND),
    ("file:///etc/x.com", fixed.DOMAIN_NOT_FOUND, fixed.DOMAIN_NOT_FOUND),
    ("http://www.example.com:x/", fixed.DOMAIN_BAD_URL, fixed.DOMAIN_BAD_URL),
    ("gopher://www.example.com", fixed.DOMAIN_BAD_URL, fixed.DOMAIN_BAD_URL),
    ("www.example.com", fixed.DOMAIN_BAD_URL, fixed.DOMAIN_BAD_URL),
    ("", fixed.DOMAIN_BAD_URL, fixed.DOMAIN_BAD_URL),
    (None, fixed.DOMAIN_BAD_URL, fixed.DOMAIN_BAD_URL),
]


def test_domains(spark):
    urls = [d[0] for d in DOMAINS]
    first = column(spark, urls, fn.first_level_domain)
    second = column(spark, urls, fn.second_level_domain)
    assert list(zip(urls, first, second, strict=True)) == DOMAINS


def test_chinese_ending(spark):
    assert column(spark, ["http://www.shop.公司/x"], fn.first_level_domain) == ["shop.公司"]


def expected_group(site, url, default):
    """Decision table of the site groups."""
    if site is None or url is None:
        return default
    if "http://mp.weixin.qq.com" in url:
        return "11"
    if -90293 <= site <= -90000 or -90368 <= site <= -90334 or -90400 <= site <= -90370:
        return "7"
    if 200000 <= site <= 300065:
        return "1"
    if site > 300065:
        return "5"
    if 90000 <= site <= 99999:
        return "7"
    if 60000 <= site <= 69999:
        return "2"
    if 1 <= site <= 199999:
        return "3" if "blog" in url else "1"
    return default


def test_site_group_boundaries(spark):
    edges = [
        0, 1, 59999, 60000, 69999, 70000, 89999, 90000, 99999, 100000, 199999, 200000, 200598, 200611,
        200620, 200623, 200635, 300000, 300001, 300065, 300066, -5, -89999, -90000, -90293, -90294,
        -90333, -90334, -90360, -90361, -90368, -90369, -90370, -90400, -90401, 2147483647,
    ]
    urls = ["http://a.com/", "http://blog.a.com/", "http://mp.weixin.qq.com/s", None]
    cases = [(str(s), u) for s in edges for u in urls]
    cases += [(s, urls[0]) for s in ("x", "", " 5", "5.0", "2147483648", None, "+5")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, s string, u string")
    df = df.withColumn("site", fn.whole_number(F.col("s")))
    rows = df.select("i", fn.site_group(F.col("site"), F.col("u"), "9").alias("g")).collect()

    def number(text):
        try:
            n = int(text) if text and text == text.strip() else None
            return n if n is not None and abs(n) < 2**31 else None
        except ValueError:
            return None

    assert {r.i: r.g for r in rows} == {
        i: expected_group(number(s), u, "9") for i, (s, u) in enumerate(cases)
    }


def test_site_group_golden(spark):
    df = spark.createDataFrame([(-14881, "http://blog.example.com/s/1.html")], "site int, u string")
    assert df.select(fn.site_group(F.col("site"), F.col("u"), "1")).first()[0] == "1"


def test_site_group_intended(spark):
    cases = {200611: "3", 200620: "14", 200623: "13", 200629: "13", 200628: "3", 200598: "5", 300010: "1", 300066: "5", 95000: "7", 0: "7"}
    df = spark.createDataFrame([(s, "http://a.com", "ru") for s in cases], "site int, u string, l string")
    rows = df.select("site", fn.site_group_intended(F.col("site"), F.col("u"), F.col("l")).alias("g")).collect()
    assert {r.site: r.g for r in rows} == cases


def test_rehash_id(spark):
    cases = {"a-b": "b", "-b": "b", "a-b-": "b", "a-": "a-", "--b": "--b", "-": "-", "x": "x", "": "", "a-b-c": "a-b-c"}
    assert column(spark, list(cases), fn.rehash_id) == list(cases.values())


def formatter_millis(spark, pattern, text, zone):
    jvm = spark._jvm
    fmt = jvm.java.text.SimpleDateFormat(pattern)
    fmt.setTimeZone(jvm.java.util.TimeZone.getTimeZone(zone))
    try:
        return fmt.parse(text).getTime()
    except Exception:
        return None


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai"])
def test_times_equal_lenient_formatter(spark, zone):
    rng = random.Random(7)
    texts = [
        "2016-11-24 11:57:02", "2016-11-24 11:57:02.9", "2016-13-45 25:61:61", "2016-1-5 3:4:5",
        "2016-00-00 00:00:00", "2016-11-24", "2016-11-24T11:57:02", " 2016-11-24 11:57:02",
        "2016-11-24  11:57:02", "2016-11-24 11:57", "x", "", "2016-02-30 12:00:00", "2016-11-24 011:057:002",
        "20161124115702", "2016112411570", "201611241157", "20161124", "2016112411570x", "20161345256161",
    ]
    for _ in range(150):
        texts.append(
            f"{rng.randint(1992, 2099)}-{rng.randint(0, 40):02d}-{rng.randint(0, 99):02d} "
            f"{rng.randint(0, 99):02d}:{rng.randint(0, 99):02d}:{rng.randint(0, 999):02d}"
        )
        texts.append(f"{rng.randint(1992, 2099)}" + "".join(rng.choice("0123456789") for _ in range(10)))
    dashed = column(spark, texts, lambda c: fn.dashed_millis(c, zone))
    half_day = column(spark, texts, lambda c: fn.dashed_millis(c, zone, clock12=True))
    dual = column(spark, texts, lambda c: fn.dual_millis(c, zone))
    for text, a, b, c in zip(texts, dashed, half_day, dual, strict=True):
        assert a == formatter_millis(spark, "yyyy-MM-dd HH:mm:ss", text, zone), text
        assert b == formatter_millis(spark, "yyyy-MM-dd hh:mm:ss", text, zone), text
        pattern = "yyyyMMddHHmmss" if len(text) <= 14 else "yyyy-MM-dd HH:mm:ss"
        assert c == formatter_millis(spark, pattern, text, zone), text


def test_time_fallbacks(spark):
    good, bad = "2016-11-24 11:57:02", "soon"
    ms = lambda c: fn.dashed_millis(c, "Asia/Shanghai")
    assert column(spark, [good, bad], lambda c: fn.millis_text(ms(c), "0")) == ["1479959822000", "0"]
    assert column(spark, [good, bad], lambda c: fn.millis_text(ms(c), F.lit(5))) == ["1479959822000", "5"]
    assert column(spark, [bad], lambda c: fn.millis_text(ms(c), None)) == [None]
    assert column(spark, [good], lambda c: fn.millis_text(ms(c), "raise")) == ["1479959822000"]
    with pytest.raises(PySparkException):
        column(spark, [bad], lambda c: fn.millis_text(ms(c), "raise"))


def test_session_zone_is_the_default(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert column(spark, ["2016-11-24 11:57:02"], fn.dashed_millis) == [1479959822000]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_normalise_time(spark):
    cases = {
        "2016-11-24 11:57:02": "2016-11-24 11:57:02",
        "2016-11-24 11:57": fixed.EPOCH_TEXT,
        "20161124115702": "2016-11-24 11:57:02",
        "2016112411570": "2016-11-24 11:57:00",
        "201611241157": "2016-11-24 11:57:00",
        "20161124": "2016-11-24 00:00:00",
        "1": fixed.EPOCH_TEXT,
        "": fixed.EPOCH_TEXT,
        "NULL": fixed.EPOCH_TEXT,
        None: fixed.EPOCH_TEXT,
    }
    assert column(spark, list(cases), fn.normalise_time) == list(cases.values())


def test_publish_time_repair(spark):
    gather = "2016-11-25 00:00:00"
    cases = [
        ("2016-11-24 11:57:02", ("2016-11-24 11:57:02", "")),
        ("2016-11-24 11:57", ("2016-11-24 11:57:00", "")),
        ("20161124115702", ("2016-11-24 11:57:02", "")),
        ("1999-11-24 11:57:02", (gather, "1999-11-24 11:57:02")),
        ("20161324115702", (gather, "2016-13-24 11:57:02")),
        ("2016-11-31 11:57", (gather, "2016-11-31 11:57:00")),
        ("2016-11-24 11:57:02&quot;", (gather, "2016-11-24 11:57:02&quot;")),
        ("soon", (gather, "soon")),
        ("", (gather, "")),
        ("NULL", (gather, "")),
        (None, (gather, "")),
    ]
    df = spark.createDataFrame([(i, c[0], gather) for i, c in enumerate(cases)], "i int, sent string, g string")
    rows = fn.with_repaired_publish_time(df, "sent", "g").orderBy("i").collect()
    assert [(r.publishtime, r.publishtime_str) for r in rows] == [c[1] for c in cases]


def test_publish_time_without_a_good_gather_time(spark):
    df = spark.createDataFrame([("soon", fixed.EPOCH_TEXT)], "sent string, g string")
    row = fn.with_repaired_publish_time(df, "sent", "g").first()
    assert (row.publishtime, row.publishtime_str) == (fixed.EPOCH_TEXT, fixed.EPOCH_TEXT)


def test_blank_values(spark):
    values = ["", " ", "\t\n", "　", " ", "a ", None]
    assert column(spark, values, fn.blank_to_empty) == ["", "", "", "", " ", "a ", ""]


def test_markers(spark):
    values = ["", "(null)", "null", None, "x"]
    assert column(spark, values, fn.marker_to_empty) == ["", "", "null", "", "x"]
    assert column(spark, values, lambda c: fn.marker_to_empty(c, "1")) == ["", "", "null", "1", "x"]
    assert column(spark, values, fn.marked_title) == ["0^A", "0^A", "0^A", "0^A", "x"]


def test_reverse(spark):
    assert column(spark, ["abc", "", "中国"], fn.reverse_text) == ["cba", "", "国中"]


def test_trailing_empty_parts(spark):
    def parts(c):
        return fn.without_trailing_empty(fn.split_parts(c), c)

    cases = {
        "a|||b": ["a", "b"],
        "a|||": ["a"],
        "|||": [],
        "||||||": [],
        "": [""],
        "|||a||||||b|||": ["", "a", "", "b"],
        "a|||||": ["a", "||"],
    }
    assert column(spark, list(cases), parts) == list(cases.values())
