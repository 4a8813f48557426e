"""Scalar rules: golden values, and a plain-Python model on generated text."""

import math
import re
from decimal import ROUND_HALF_UP, Decimal
from random import Random

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from pagecat.functions import hosts, text as t, urls as u

NBSP, BOM = chr(0xA0), chr(0xFEFF)


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_size(spark):
    texts = ["File Size: 1.48 GB", "file size:2gb", "File Size: 5 KB", "none", "File Size: 1.2.3 MB",
             "File Size: . GB", "File Size: .5 GB", "File Size:" + NBSP + "7 MB", "x File Size: 3 MB File Size: 9 MB", None]
    got = apply(spark, t.parse_size_mb, texts)
    assert math.isnan(got[5])
    assert [x for i, x in enumerate(got) if i != 5] == [1515.52, 2048.0, 0.0, 0.0, 1.2, 512.0, 7.0, 3.0, 0.0]


def test_fmt_size(spark):
    got = apply(spark, t.fmt_size, [1515.52, 0.125, 1.005, 0.0, -1.0, 2.675, float("nan"), 0.005, 999999.995], "double")
    assert got == ["1515.52 MB", "0.13 MB", "1.00 MB", None, None, "2.67 MB", None, "0.01 MB", "999999.99 MB"]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(0.001, 1e9), min_size=50, max_size=200))
def test_two_decimals_are_exact(spark, values):
    want = [str(Decimal(v).quantize(Decimal("0.01"), ROUND_HALF_UP)) for v in values]
    assert apply(spark, t.to_fixed_2, values, "double") == want


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab /10\n(" + NBSP, max_size=12), min_size=40, max_size=120))
def test_text_rules_follow_the_model(spark, values):
    assert apply(spark, t.clean_rating, values) == [v.replace("/10", "", 1) for v in values]
    assert apply(spark, t.js_trim, values) == [v.strip() for v in values]
    assert apply(spark, lambda c: t.remove_first(c, "a+"), values) == [re.sub("a+", "", v, count=1) for v in values]


def test_trim_knows_all_white_space(spark):
    assert apply(spark, t.js_trim, [BOM + "\t" + NBSP + "a b\n" + chr(0x2028) + chr(0x3000), chr(0x85) + "x"]) == ["a b", chr(0x85) + "x"]


def test_lists(spark):
    assert apply(spark, t.split_people, ["A, B|C & D,,", ""]) == [["A", "B", "C", "D", "", ""], [""]]
    assert apply(spark, t.split_genres, ["A , B&C"]) == [["A", "B&C"]]
    assert apply(spark, t.singleton, ["A, B", "", None]) == [["A, B"], [""], None]


def test_titles(spark):
    df = spark.createDataFrame([(" Head ", "x"), ("  ", "Title | Site"), (None, None)], "h string, t string")
    assert [r[0] for r in df.select(t.page_title("h", "t")).collect()] == ["Head", "Title", ""]
    assert apply(spark, lambda c: t.item_name(c, r"\s+Film.*\z"), ["A (2001) (2002) b Film x"]) == ["A (2002) b"]
    assert apply(spark, t.year_in_parens, ["A (01) (1999) (2000)", "B 1999"]) == [1999, None]
    assert apply(spark, t.label_in_parens, ["A () (720p HD) (x)", "none"]) == ["720p HD", None]
    assert apply(spark, lambda c: t.strip_suffix(c, " full download"), ["A Full Download HD", "A Full Download\nB"]) == ["A", "A Full Download\nB"]
    assert apply(spark, lambda c: t.strip_label(c, "Synopsis:"), ["SYNOPSIS: a Synopsis: b", " Synopsis: "]) == ["a Synopsis: b", None]


def test_duration(spark):
    assert apply(spark, t.duration_text, ["a\nDuration:  2h 5m \nb", "duration: 1h", "Duration:", "Duration:\n 3m"]) == ["2h 5m", None, None, "3m"]


def test_labels_and_links(spark):
    df = spark.createDataFrame([(" » ", "/2"), ("NEXT page", "/2"), ("next", "#"), ("next", None), ("» 2", "/3"), ("next", "")], "x string, h string")
    assert [r[0] for r in df.select(t.is_next_link("x", "h")).collect()] == [True, True, False, False, False, False]


def test_url_path(spark):
    urls = ["https://h.example.com", "http://h/a/../b/./c", "https://h/a b?x#y", "http://h/é", "nope", "http://", "/a",
            "HTTP://H:80/A/..", "http://h/a//b/..", "http://h/a/.", "http://h/..//x", None, "http://h\\x", "  http://h/t\tx "]
    got = apply(spark, u.url_path, urls)
    assert got[:12] == ["/", "/b/c", "/a%20b", "/%C3%A9", None, None, None, "/", "/a//", "/a/", "//x", None]
    assert got[13] == "/tx"


def test_url_origin(spark):
    urls = ["HTTPS://U:p@Host.Example.COM:443/x", "http://h:8080", "http://h:443/", "h.example.com/x", "http://h:/x"]
    assert apply(spark, u.url_origin, urls) == ["https://host.example.com", "http://h:8080", "http://h:443", None, "http://h"]


# Hosts and what the URL standard makes of them.
HOSTS = {
    "[::1]": "[::1]", "[2001:DB8:0:0:1:0:0:1]": "[2001:db8::1:0:0:1]", "[0:0:0:0:0:0:0:0]": "[::]", "[1:0:0:2:0:0:0:3]": "[1:0:0:2::3]",
    "[::ffff:192.168.1.9]": "[::ffff:c0a8:109]", "[1:2:3:4:5:6:7:8]": "[1:2:3:4:5:6:7:8]", "[1::]": "[1::]", "[00a0::0b]": "[a0::b]",
    "[1:2:3]": None, "[1::2::3]": None, "[12345::]": None, "[:::1]": None, "[::1.2.3]": None, "[]": None, "[1:2:3:4:5:6:7::8]": None,
    "[1:2:3:4:5:6:7:8:9]": None, "[::256.1.1.1]": None, "[1:0:2:3:4:5:6:7]": "[1:0:2:3:4:5:6:7]",
    "127.0.0.1": "127.0.0.1", "0x7f.1": "127.0.0.1", "2130706433": "127.0.0.1", "0177.0.0.01": "127.0.0.1", "1.2.3": "1.2.0.3",
    "256.1.1.1": None, "1.2.3.4.5": None, "4294967296": None, "4294967295": "255.255.255.255", "09.1.1.1": None, "1..2": None,
    "0x": "0.0.0.0", "1.2.3.4.": "1.2.3.4", "a.1": None, "1.a": "1.a", "0xg.b": "0xg.b", "00000000000000000000001": "0.0.0.1",
    "bücher.example": "xn--bcher-kva.example", "BÜCHER.Example": "xn--bcher-kva.example", "faß.de": "xn--fa-hia.de", "例え。テスト": "xn--r8jz45g.xn--zckzah",
    "ΒΌΛΟΣ.com": "xn--nxasmq6b.com", "ｗｗｗ.x": "www.x", "a­b.x": "ab.x", "😀.la": "xn--e28h.la", "xn--bcher-kva": "xn--bcher-kva", "a_b-c": "a_b-c",
}


def test_hosts(spark):
    got = apply(spark, u.url_origin, [f"http://{h}/x" for h in HOSTS])
    assert dict(zip(HOSTS, got, strict=True)) == {h: w and f"http://{w}" for h, w in HOSTS.items()}
    paths = apply(spark, u.url_path, [f"http://{h}:8080/x" for h in HOSTS])
    assert paths == [w and "/x" for w in HOSTS.values()]
    ports = apply(spark, u.url_origin, ["http://[::1]:8080/x", "http://h:65536", "http://h:0080/", "http://h:99999999999", "https://h:080", "http://h:65535"])
    assert ports == ["http://[::1]:8080", None, "http://h", None, "https://h:80", "http://h:65535"]
    assert apply(spark, lambda c: u.url_resolve(F.lit("http://[::1]:8080/a/b"), c), ["c", "//é.x/d"]) == ["http://[::1]:8080/a/c", "http://xn--9ca.x/d"]


def test_punycode_equals_the_standard_codec(spark):
    random = Random(7)
    alphabet = "abz09-éüßñ例えテストжя😀𐍈"
    labels = ["".join(random.choice(alphabet) for _ in range(random.randint(1, 40))) for _ in range(400)]
    labels = [x for x in labels if not x.isascii()]
    assert apply(spark, hosts.punycode, labels) == [x.encode("punycode").decode() for x in labels]


def test_resolution(spark):
    base = "http://a.example/b/c/d;p?q"
    cases = {
        "g": "http://a.example/b/c/g", "./g": "http://a.example/b/c/g", "g/": "http://a.example/b/c/g/",
        "/g": "http://a.example/g", "//g": "http://g/", "?y": "http://a.example/b/c/d;p?y",
        "g?y": "http://a.example/b/c/g?y", "#s": "http://a.example/b/c/d;p?q#s", "": base,
        ";x": "http://a.example/b/c/;x", ".": "http://a.example/b/c/", "..": "http://a.example/b/",
        "../g": "http://a.example/b/g", "../..": "http://a.example/", "../../../g": "http://a.example/g",
        "/./g": "http://a.example/g", "g;x=1/../y": "http://a.example/b/c/y", "g?y/../x": "http://a.example/b/c/g?y/../x",
        "https://X.Example": "https://x.example/", "mailto:a@b": "mailto:a@b", " /a b?c d#e f ": "http://a.example/a%20b?c%20d#e%20f",
        "/%C3%A9": "http://a.example/%C3%A9", "http://": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "ref string").withColumn("base", F.lit(base))
    got = {r["ref"]: r["abs_url"] for r in u.with_resolved(df, "base", "ref").collect()}
    assert got == cases
    bare = df.limit(1).select(F.lit("http://h").alias("base"), F.lit("x").alias("ref"), F.lit(None).cast("string").alias("none"))
    assert u.with_resolved(bare, "base", "ref").first()["abs_url"] == "http://h/x"
    assert u.with_resolved(bare, "base", "none").first()["abs_url"] is None


def test_poster(spark):
    df = spark.createDataFrame(
        [("https://i/x y.webp 2x", None), ("", "/p.jpg?s=1"), (None, None), ("http:// 1x", None), ("httpx", "")], "a string, b string"
    )
    assert [r[0] for r in df.select(u.poster_ref("a", "b")).collect()] == ["/x", "/p.jpg?s=1", None, "http://", "httpx"]
