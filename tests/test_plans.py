"""What the plans must look like: filters at the scan, columns pruned, one shuffle where one is enough."""

import re
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pagecat.operators import graph, ranking, variants
from pagecat.plans import discover, extract
from pagecat.session import scratch
from pagecat.sources import html as h, tables


LABELS = extract.Labels({1: "Server 1"}, {1: "File 1"}, {1: "View 1"})


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxPlanStringLength", "1000000")
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def exchanges(df):
    text = plan(df).split("\n\n\n")[0]
    return len(re.findall(r"\bExchange\b", text))


def test_scan_pushes_filters_and_prunes_columns(spark):
    path = scratch(spark, "t")
    spark.range(10).select("id", F.lit("x").alias("a"), F.lit("y").alias("b")).write.parquet(path)
    text = plan(tables.scan(spark, path, ["id"], (F.col("a") == "x") & F.col("b").startswith("http")))
    assert "EqualTo(a,x)" in text and "StringStartsWith(b,http)" in text
    text = plan(tables.scan(spark, path, ["id"]))
    assert "ReadSchema: struct<id:bigint>" in text


def test_choices_inside_a_page_need_no_shuffle(spark):
    path = scratch(spark, "parsed")
    h.parse_pages(spark.createDataFrame([("http://s/", "<h1>x</h1>")], "url string, html string")).write.parquet(path)
    parsed = spark.read.parquet(path)
    for df in (
        extract.extract_catalog(parsed), extract.list_pages(parsed), extract.labelled_variants(parsed),
        extract.largest_files(parsed), extract.branch_links(parsed, LABELS), h.block_links(parsed), h.anchor_links(parsed, "pager"),
    ):
        assert exchanges(df) == 0
    # The nested columns that are not asked for are not read.
    text = plan(extract.list_pages(parsed))
    assert "anchors" not in re.search(r"ReadSchema: .*", text).group(0)


def test_per_key_choices_shuffle_reduced_rows_once(spark):
    df = spark.range(100).select(
        (F.col("id") % 7).alias("k"), F.col("id").alias("pos"), F.lit("u").alias("url"), F.rand().alias("size_mb")
    )
    for out in (
        ranking.dedup_first_seen(df, "k", ("pos",)), variants.largest_variant(df, "k"),
        ranking.last_write_per_key(df, ["k"], ["pos"]), ranking.latest_per_key(df, ["k"], "pos"),
    ):
        assert exchanges(out) == 1
        assert "partial_m" in plan(out)


def test_pages_are_chosen_before_they_are_read(spark):
    """Explode and resolve work on the pages reached, which are stored."""
    path = scratch(spark, "parsed")
    h.parse_pages(spark.createDataFrame([("http://s/", "<h1>x</h1>")], "url string, html string")).write.parquet(path)
    rows = spark.createDataFrame([("http://s/",)], "at string")
    parsed = extract.reached(spark.read.parquet(path), rows, "at", "anchors", "blocks", "files")
    assert parsed.count() == 1
    for df in (extract.branch_links(parsed, LABELS), extract.labelled_variants(parsed), extract.largest_files(parsed)):
        # Stored pages are read, not the table they come from.
        assert "stored-" in plan(df) and path not in plan(df)


def test_extraction_reads_the_parts_it_needs(spark, monkeypatch):
    """Each hop reads one or two columns of the pages that the queue reaches."""
    path = scratch(spark, "parsed")
    h.parse_pages(spark.createDataFrame([("http://s/", "<h1>x</h1>")], "url string, html string")).write.parquet(path)
    seen = []
    store = extract.stored
    monkeypatch.setattr(extract, "stored", lambda df: seen.append(plan(df)) or store(df))
    extract.extract_variants(spark.read.parquet(path), spark.createDataFrame([("http://s/",)], "url string"), LABELS)
    # Each hop stores its addresses, then the pages.
    hops = seen[1::2]
    assert len(seen) == 14 and "EqualTo(page_url,http://s/)" in hops[0]
    monkeypatch.setattr(extract, "LISTED", 0)
    many = spark.createDataFrame([("http://s/",), ("http://t/",)], "at string")
    assert extract.reached(spark.read.parquet(path), many, "at", "h1").count() == 1 and "LeftSemi" in seen[-1]
    schemas = set(re.findall(r"ReadSchema: struct<(.*)>", hops[0]))
    assert any("blocks" in s for s in schemas) and not any("anchors" in s or "html" in s for s in schemas)


def test_hops_leave_bucketed_pages_in_place(spark, rows, monkeypatch):
    """A short list of addresses opens its buckets only; a long one is shuffled to the pages, which stay where they are."""
    path, name = scratch(spark, "parsed"), "pages_" + uuid.uuid4().hex
    urls = [f"http://s/{k}" for k in range(200)]
    h.parse_pages(spark.createDataFrame([(u, f"<h1>{u}</h1>") for u in [*urls, None]], "url string, html string")).write.parquet(path)
    flat = spark.read.parquet(path)
    parsed = extract.bucketed_pages(flat, name, 16, scratch(spark, "buckets"))
    assert rows(parsed) == rows(flat.filter("page_url IS NOT NULL"))

    def wanted(addresses):
        at = scratch(spark, "wanted")
        spark.createDataFrame([(u,) for u in addresses], "page_url string").write.parquet(at)
        return spark.read.parquet(at)

    for addresses in (urls[:2], urls[:15], [], ["http://none/"]):
        few = extract.pages_at(parsed, wanted(addresses), "h1")
        assert rows(few) == rows(flat.filter(F.col("page_url").isin(addresses)).select("page_url", "h1"))
        assert exchanges(few) == 0
    # The plan tells the buckets it opens only where each is a task.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    opened = re.search(r"SelectedBucketsCount: (\d+) out of 16", plan(extract.pages_at(parsed, wanted(urls[:2]), "h1")))
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert opened is not None and int(opened.group(1)) <= 2
    monkeypatch.setattr(extract, "LISTED", 0)
    monkeypatch.setattr(extract, "BROADCAST", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = urls[::2] + ["http://none/"]
        assert exchanges(extract.pages_at(flat, wanted(many), "h1")) == 2
        joined = extract.pages_at(parsed, wanted(many), "h1")
        assert exchanges(joined) == 1 and "Bucketed: true" in plan(joined)
        assert rows(joined) == rows(flat.filter(F.col("page_url").isin(many)).select("page_url", "h1"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    with pytest.raises(AnalysisException):
        extract.bucketed_pages(flat, name, 16)
    spark.sql(f"DROP TABLE {name}")


def test_a_custom_walk_reads_the_pages_of_its_section(spark, rows, monkeypatch):
    anchor = "array<struct<pos:int,box:string,text:string,href:string>>"
    # Three chains: one of 6 pages, one that closes a circle after 5, one of a section that is not asked for.
    onward = {f"http://s/a{k}": f"/a{k + 1}" for k in range(6)} | {f"http://s/b{k}": f"/b{(k + 1) % 5}" for k in range(5)} | {f"http://s/c{k}": f"/c{k + 1}" for k in range(500)}
    parsed = spark.createDataFrame([(u, [(0, "pager", "Next", ref)]) for u, ref in onward.items()] + [("http://s/a6", [])], f"page_url string, anchors {anchor}")
    starts = spark.createDataFrame([("A", "http://s/a0"), ("B", "http://s/b0"), ("N", "http://s/none")], "section string, url string")
    expected = rows(graph.paginate(starts, ranking.next_links(h.anchor_links(parsed, "pager"))))
    assert len(expected) == 7 + 5 + 1
    read = []
    links = discover.anchor_links
    monkeypatch.setattr(discover, "anchor_links", lambda pages, box: (read.append(pages.count()), links(pages, box))[1])
    assert rows(discover.walk_pages(starts, parsed)) == expected
    assert sum(read) == 7 + 5
    for rounds in (1, 5):
        assert rows(discover.walk_pages(starts, parsed, rounds)) == expected


def test_a_round_of_a_custom_walk_is_a_short_job(spark, rows):
    anchor = "array<struct<pos:int,box:string,text:string,href:string>>"
    onward = [(f"http://s/{k}", [(0, "pager", "Next", f"/{k + 1}")]) for k in range(12)] + [("http://s/x", [(0, "pager", "Next", "/3")])]
    parsed = spark.createDataFrame(onward, f"page_url string, anchors {anchor}")
    # Two first pages of a section lead to one page, which counts once, at its first depth; an address may be missing.
    starts = spark.createDataFrame([("A", "http://s/0"), ("A", "http://s/0"), ("B", "http://s/2"), ("B", "http://s/x"), ("C", None)], "section string, url string")
    spark.sparkContext.setJobGroup("walk", "walk")
    walked = discover.walk_pages(starts, parsed)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("walk"))
    spark.sparkContext.setJobGroup("others", "others")
    expected = [("A", f"http://s/{k}", k + 1) for k in range(13)] + [("B", "http://s/2", 1), ("B", "http://s/x", 1), ("C", None, 1)] + [("B", f"http://s/{k}", k - 1) for k in range(3, 13)]
    assert rows(walked) == sorted(expected, key=lambda r: tuple((x is None, str(type(x)), x) for x in r))
    assert jobs <= 3 * 13 + 3


def test_more_sections_than_a_filter_lists_are_walked_by_jumps(spark, rows, monkeypatch):
    monkeypatch.setattr(discover, "LISTED", 2, raising=False)
    anchor = "array<struct<pos:int,box:string,text:string,href:string>>"
    parsed = spark.createDataFrame([(f"http://s/{k}", [(0, "pager", "Next", f"/{k + 1}")]) for k in range(5)], f"page_url string, anchors {anchor}")
    starts = spark.createDataFrame([(str(k), f"http://s/{k}") for k in range(4)], "section string, url string")
    assert rows(discover.walk_pages(starts, parsed)) == [(str(k), f"http://s/{n}", n - k + 1) for k in range(4) for n in range(k, 6)]
