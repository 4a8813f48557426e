"""Queries over captured pages: parse, links, walks and whole jobs."""

import uuid

from pyspark.sql import functions as F

from pagecat.functions import text as t
from pagecat.operators import graph, variants as v
from pagecat.operators.ranking import dedup_first_seen
from pagecat.plans import discover as d, extract as e, optional as o, publish as pub, refresh as ref
from pagecat.session import scratch
from pagecat.sources import html as h
from pagecat.streaming import gates as g

from . import site
from .base import query

ANCHORS = """
    select url as page_url, unnest(range(len(regexp_extract_all(html, '<a href="([^"]*)">(.*?)</a>', 1)))) as pos,
           unnest(regexp_extract_all(html, '<a href="([^"]*)">(.*?)</a>', 1)) as href,
           unnest(regexp_extract_all(html, '<a href="([^"]*)">(.*?)</a>', 2)) as anchor_text
    from pages"""

FIRST_LINKS = f"""
    with a as ({ANCHORS}),
    r as (select page_url, pos, concat(regexp_extract(page_url, '^(https?://[^/?#]+)', 1), '/',
                 replace(url_encode(substr(href, 2)), '%2C', ',')) as url from a),
    f as (select *, row_number() over (partition by url order by page_url, pos) as rn from r)
    select regexp_extract(url, '^https?://([^/]+)', 1) as host, count(*) as links, count(distinct page_url) as pages
    from f where rn = 1 group by 1"""


@query("first_links_by_host", oracle=FIRST_LINKS)
def first_links_by_host(tb):
    """Pages to links, resolved, each target where it is first seen, counted per host."""
    links = h.anchor_links(h.parse_pages(tb["pages"])).select("page_url", "pos", F.col("abs_url").alias("url"))
    first = dedup_first_seen(links, "url", ("page_url", "pos"))
    return first.groupBy(F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host")).agg(
        F.count("*").alias("links"), F.countDistinct("page_url").alias("pages")
    )


@query("h1_extract_links", oracle=ANCHORS)
def _(tb):
    rows = h.anchor_links(h.parse_pages(tb["pages"]))
    return rows.select("page_url", F.col("pos").cast("bigint").alias("pos"), "href", "anchor_text")


@query("h1_scan_anchors", oracle=ANCHORS)
def _(tb):
    return h.scan_anchors(tb["pages"]).select("page_url", F.col("pos").cast("bigint").alias("pos"), "href", "anchor_text")


@query("h2_page_title", oracle="""
    select url, trim(replace(replace(replace(coalesce(
      nullif(trim(regexp_extract(html, '<h1>(.*?)</h1>', 1)), ''),
      split_part(regexp_extract(html, '<title>(.*?)</title>', 1), '|', 1)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) as title
    from pages""")
def _(tb):
    return h.parse_pages(tb["pages"]).select(F.col("page_url").alias("url"), t.page_title("h1", "title").alias("title"))


@query("h3_info_pairs", oracle="""
    select s_suppkey as k, p.pos as pos, p.key as label, p.val as val from supplier, unnest([
      {'pos': 0, 'key': 'director:', 'val': concat('First & ', s_suppkey)},
      {'pos': 1, 'key': 'starring:', 'val': concat('A ', s_suppkey, ', B|C & D')},
      {'pos': 2, 'key': 'genres:', 'val': concat('G', s_nationkey, ' ,  Drama')},
      {'pos': 3, 'key': 'movie rating:', 'val': concat(s_suppkey % 10, '.5/10')},
      {'pos': 4, 'key': 'language:', 'val': concat('L', s_suppkey % 4)},
      {'pos': 5, 'key': 'run time:', 'val': concat(60 + s_suppkey % 60, ' min')},
      {'pos': 6, 'key': 'director:', 'val': case when s_suppkey % 6 = 0 then concat('Second ', s_suppkey) end}]) as u(p)
    where p.val is not null""")
def _(tb):
    pages = site.site(tb).filter("url LIKE '%/item/%'")
    rows = h.parse_pages(pages).select("page_url", F.explode("info").alias("i"))
    return rows.select(
        F.regexp_extract("page_url", r"(\d+)/$", 1).cast("bigint").alias("k"), "i.pos",
        F.lower("i.k").alias("label"), t.js_trim("i.v").alias("val"),
    )


@query("j4_hop", ("chain_link",), """
    with first as (
      select * from (
        select c.*, b, row_number() over (partition by page_url, b order by pos) as rn
        from chain_link c join (select 1 as b union all select 2) x
          on box = 'links' and contains(anchor_text, concat('Server ', b))) where rn = 1)
    select s_suppkey as k, b.b as branch, f1.abs_url as hop1, f2.abs_url as hop2, f3.href as raw
    from supplier cross join (select 1 as b union all select 2) b
    left join first f1 on f1.page_url = concat('/f/', s_suppkey) and f1.b = b.b
    left join first f2 on f2.page_url = f1.abs_url and f2.b = b.b
    left join first f3 on f3.page_url = f2.abs_url and f3.b = b.b""")
def _(tb):
    links = tb["chain_link"]
    rows = tb["supplier"].select(
        F.col("s_suppkey").alias("k"), F.concat(F.lit("/f/"), "s_suppkey").alias("at"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("branch"),
    )
    rows = graph.hop(rows, links, "at", site.LABELS.server, "hop1")
    rows = graph.hop(rows, links, "hop1", site.LABELS.file, "hop2")
    return graph.hop(rows, links, "hop2", site.LABELS.file, "hop3", raw="raw").select("k", "branch", "hop1", "hop2", "raw")


@query("j4_captured", ("chain_link",), """
    select page_url, pos, case when abs_url in (select page_url from chain_link) then abs_url end as abs_url from chain_link""")
def _(tb):
    links = tb["chain_link"].select("page_url", "pos", "abs_url")
    pages = tb["chain_link"].select("page_url")
    return graph.captured(links, pages, "abs_url").select("page_url", "pos", "abs_url")


@query("g1_paginate", ("next_link",), """
    with recursive walk as (
      select section, page_url as url, 1 as depth from next_link where page_no = 1
      union all
      select w.section, n.next_url, depth + 1 from walk w join next_link n on n.page_url = w.url
      where n.next_url <> n.page_url)
    select section, url, depth from walk""")
def _(tb):
    links = tb["next_link"]
    starts = links.filter("page_no = 1").select("section", F.col("page_url").alias("url"))
    return graph.paginate(starts, links.select("page_url", "next_url"))


@query("g3_resolve_redirects", ("redirect",), """
    with recursive walk as (
      select src, dst as final, 1 as hops from redirect
      union all
      select w.src, r.dst, hops + 1 from walk w join redirect r on r.src = w.final where hops < 25)
    select src, max(final) filter (final = 0) as final, max(hops) as hops from walk group by 1""")
def _(tb):
    return graph.resolve_redirects(tb["redirect"])


VARIANTS = """
    with item as (select s_suppkey as k, s_name, unnest(range(1, 2 + s_suppkey % 3)) as i from supplier where s_suppkey % 10 <> 9),
    v as (
      select k, i, concat('Q', i) as label, concat(i, 'h ', k % 60, 'm') as duration,
             case when (k + i) % 2 = 0 then '1536.00 MB' else printf('%d.00 MB', greatest(100 + k % 50, 90)) end as file_size,
             k % 13 <> 0 and k % 7 <> 0 and k % 9 <> 0 as ok1, k % 13 <> 0 and k % 4 <> 0 as ok2,
             concat('https://cdn.example.com/', k, '.mp4?b=') as f,
             case when k % 2 = 0 then concat('s', k, '-', i, '.m3u8') else concat('v', k, '.mp4') end as w
      from item)
    select k, label, duration, file_size, case when ok1 then concat(f, '1&q=', i) end as file_url_1,
           case when ok2 then concat(f, '2&q=', i) end as file_url_2, case when ok1 then w end as view_url_1,
           case when ok2 then w end as view_url_2 from v"""


def key_of(col):
    return F.regexp_extract(col, r"(\d+)/$", 1).cast("bigint").alias("k")


@query("g2_resolve_chain", oracle=VARIANTS)
def _(tb):
    parsed = site.parsed_site(tb)
    starts = e.labelled_variants(parsed).withColumnRenamed("list_url", "item_url")
    return e.resolve_chain(starts, parsed, site.LABELS).drop("pos").select(key_of("item_url"), "*").drop("item_url")


@query("m2_discover", oracle="""
    select concat('https://site.example.com/item/', s_suppkey, '/') as url, concat('Films of ', 1985 + s_suppkey % 40) as folder,
           'pending' as status, 1 as priority, case when s_suppkey % 3 = 0 then 'old' end as error_msg
    from supplier where s_suppkey % 11 <> 0 or s_suppkey in (select min(s_suppkey) from supplier group by s_suppkey % 40, s_suppkey // 1000)
    union all
    select concat('https://site.example.com/item/', s_suppkey, '/'), null, 'processing', 2, 'old'
    from supplier where s_suppkey % 3 = 0 and s_suppkey % 11 = 0
      and s_suppkey not in (select min(s_suppkey) from supplier group by s_suppkey % 40, s_suppkey // 1000)""")
def _(tb):
    old = tb["supplier"].filter("s_suppkey % 3 = 0").select(
        F.col("s_suppkey").cast("string").alias("id"),
        F.concat(F.lit(site.ROOT), F.lit("/item/"), "s_suppkey", F.lit("/")).alias("url"),
        F.lit(None).cast("string").alias("folder"), F.lit("processing").alias("status"),
        F.lit(2).alias("priority"), F.lit("old").alias("error_msg"),
        F.expr("timestamp'2024-01-01 00:00:00'").alias("queued_at"),
    )
    parsed = site.parsed_site(tb, listing=True)
    out = d.discover(parsed, site.HOME, old, F.expr("timestamp'2024-02-01 00:00:00'"), mode="all", noise=site.NOISE)
    return out.select("url", "folder", "status", "priority", "error_msg")


DISCOVERED = """
    select concat('https://site.example.com/item/', s_suppkey, '/') as url, 'Films of {year}' as folder, 'pending' as status, 1 as priority
    from supplier where s_suppkey % 40 = {year} - 1985 and ({all} or s_suppkey < 1000) and (s_suppkey % 11 <> 0 or s_suppkey in (
      select min(s_suppkey) from supplier group by s_suppkey % 40, s_suppkey // 1000))"""


def discovered(tb, **how):
    """A queue that was empty before."""
    queue = tb.spark.createDataFrame([], "id string, url string, folder string, status string, priority int, queued_at timestamp")
    parsed = site.parsed_site(tb, listing=True)
    out = d.discover(parsed, site.HOME, queue, F.expr("timestamp'2024-02-01 00:00:00'"), noise=site.NOISE, **how)
    return out.select("url", "folder", "status", "priority")


@query("m2_discover_quick", oracle=DISCOVERED.format(year=1990, all="false"))
def _(tb):
    """The first page of the section that names the current year."""
    return discovered(tb, mode="quick", current_year="1990")


@query("m2_discover_custom", oracle=DISCOVERED.format(year=1992, all="true"))
def _(tb):
    """All pages of the section of a given year."""
    return discovered(tb, mode="custom", year="1992", current_year="1990")


CATALOG = """
    select concat('/item/', s_suppkey, '/') as slug, concat('https://site.example.com/item/', s_suppkey, '/') as item_url,
           s_name as name, case when s_suppkey % 5 <> 0 then cast(1990 + s_suppkey % 35 as int) end as year,
           concat('About ', s_suppkey, '.') as synopsis,
           case when s_suppkey % 6 = 0 then concat('Second ', s_suppkey) else concat('First & ', s_suppkey) end as director,
           concat('A ', s_suppkey, ';B;C;D') as cast_members, concat('G', s_nationkey, ';Drama') as genres,
           concat(s_suppkey % 10, '.5') as rating, concat('L', s_suppkey % 4) as language, null as type,
           case when s_suppkey % 2 = 0 then concat('/p/', s_suppkey, '.webp') else concat('/p/', s_suppkey, '.jpg?x=1') end as poster_ref
    from supplier"""


def flat(records):
    lists = {c: F.array_join(c, ";") for c in ("director", "cast_members", "genres")}
    return records.withColumns(lists).drop("duration", "last_updated")


@query("m3_extract_catalog", oracle=CATALOG)
def _(tb):
    parsed = h.parse_pages(site.site(tb).filter("url LIKE '%/item/%'"))
    return flat(e.extract_catalog(parsed, **site.TITLES))


@query("m4_extract_variants", oracle=f"select * from ({VARIANTS}) where k % 17 <> 0 and k % 19 <> 0")
def _(tb):
    parsed = site.parsed_site(tb)
    out = e.extract_variants(parsed, site.queue(tb).select("id", "url"), site.LABELS, site.SERIES)
    return out.drop("pos").select(key_of("item_url"), "*").drop("item_url")


@query("m4_extract_bucketed", oracle=f"select * from ({VARIANTS}) where k % 17 <> 0 and k % 19 <> 0")
def _(tb):
    """The variants of all queued items, from a page table in buckets by address: no hop shuffles pages."""
    parsed = e.bucketed_pages(site.parsed_site(tb), "pages_" + uuid.uuid4().hex, tb.spark.sparkContext.defaultParallelism, scratch(tb.spark, "buckets"))
    out = e.extract_variants(parsed, site.queue(tb).select("id", "url"), site.LABELS, site.SERIES)
    return out.drop("pos").select(key_of("item_url"), "*").drop("item_url")


@query("m4_first_duration", oracle="""
    select s_suppkey as k, concat('1h ', s_suppkey % 60, 'm') as duration from supplier
    where s_suppkey % 10 <> 9 and s_suppkey % 17 <> 0 and s_suppkey % 19 <> 0""")
def _(tb):
    parsed = site.parsed_site(tb)
    out = e.extract_variants(parsed, site.queue(tb).select("id", "url"), site.LABELS, site.SERIES)
    return e.first_durations(out).select(key_of("item_url"), "duration")


OUTCOME = """
    select s_suppkey as k,
           case when s_suppkey % 17 = 0 then 'skipped'
                when s_suppkey % 19 = 0 or s_suppkey % 10 = 9 or s_suppkey % 13 = 0 or s_suppkey % 7 = 0 or s_suppkey % 9 = 0
                  or s_suppkey % 23 = 0 then 'error' else 'done' end as status,
           case when s_suppkey % 17 = 0 then 'Web Series excluded' when s_suppkey % 19 = 0 then 'page not captured'
                when s_suppkey % 10 = 9 then 'No quality links'
                when s_suppkey % 13 = 0 or s_suppkey % 7 = 0 or s_suppkey % 9 = 0 then 'No valid links'
                when s_suppkey % 23 = 0 then 'Staging Error: name missing' end as error_msg
    from supplier"""


def outcomes(tb, parsed, items):
    variants = e.extract_variants(parsed, items, site.LABELS, site.SERIES)
    bad = items.filter("id % 23 = 0").select("url", F.lit("name missing").alias("message"))
    return e.item_outcome(items, parsed, variants, F.expr("timestamp'2024-02-01 00:00:00'"), bad, site.SERIES)


@query("m5_item_outcome", oracle=OUTCOME)
def _(tb):
    out = outcomes(tb, site.parsed_site(tb), site.queue(tb).select("id", "url"))
    return out.select(F.col("id").cast("bigint").alias("k"), "status", "error_msg")


@query("t1_queue_worker", oracle=f"""
    select k, status, error_msg from ({OUTCOME}) union all select s_suppkey, 'done', 'old' from supplier where s_suppkey % 20 = 0""")
def _(tb):
    """The queue as a stream of files: each micro-batch extracts its pending items; then the queue has what came out."""
    base = scratch(tb.spark, "worker")
    parsed = site.parsed_site(tb)
    none = F.lit(None).cast("string")
    rows = site.queue(tb).select("id", "url", F.lit("pending").alias("status"), none.alias("error_msg"), F.lit(None).cast("timestamp").alias("processed_at"))
    old = rows.filter("id % 20 = 0").withColumns({"id": F.concat(F.lit("old"), "id"), "status": F.lit("done"), "error_msg": F.lit("old")})
    rows.unionByName(old).repartition(2, "id").write.parquet(f"{base}/in")
    stream = g.read_stream(tb.spark, f"{base}/in", rows.schema, maxFilesPerTrigger="1")
    g.queue_worker(stream, lambda items: outcomes(tb, parsed, items), f"{base}/out", f"{base}/state")
    queue = g.worked_queue(tb.spark.read.parquet(f"{base}/in"), tb.spark.read.parquet(f"{base}/out"))
    return queue.select(F.regexp_replace("id", "old", "").cast("bigint").alias("k"), "status", "error_msg")


@query("t1_work_off", oracle=f"""
    select k, status, error_msg, (select count(*) from ({VARIANTS}) v where v.k = q.k and q.status = 'done') as variants
    from ({OUTCOME.replace("or s_suppkey % 23 = 0 ", "")}) q where error_msg is null or error_msg not like 'Staging%'
    union all
    select k, 'done', null, (select count(*) from ({VARIANTS}) v where v.k = q.k) from ({OUTCOME}) q where error_msg like 'Staging%'""")
def _(tb):
    """A whole pass: the pending part of the queue, what it stages, and the queue afterwards."""
    queue, catalog, variants = worked_off(tb)
    counts = variants.groupBy(F.col("item_url").alias("url")).agg(F.count("*").alias("n"))
    return queue.join(counts, "url", "left").select(
        F.col("id").cast("bigint").alias("k"), "status", "error_msg", F.coalesce("n", F.lit(0)).alias("variants"))


STAGE = "slug string, item_url string, name string, year int, duration string"
VARIANT_STAGE = "item_url string, label string, file_size string, file_url_1 string"


def worked_off(tb):
    queue = site.queue(tb).select(
        "id", "url", F.lit("pending").alias("status"), F.lit(None).cast("string").alias("error_msg"), F.lit(None).cast("timestamp").alias("processed_at"))
    empty = (tb.spark.createDataFrame([], kind) for kind in (STAGE, VARIANT_STAGE))
    as_of = F.expr("timestamp'2024-02-01 00:00:00'")
    return e.work_off(queue, site.parsed_site(tb), *empty, as_of, site.LABELS, site.SERIES, **site.TITLES)


@query("m4_stage_upsert", oracle=f"""
    with c as ({CATALOG}), v as ({VARIANTS}), q as (select k from ({OUTCOME}) where status = 'done' or error_msg like 'Staging%')
    select s_suppkey as k, case when q.k is not null then c.name else 'old' end as name,
           case when q.k is not null then concat('1h ', s_suppkey % 60, 'm') else '9h' end as duration,
           (select count(*) from v where v.k = q.k) + case when q.k is null then 1 else 0 end as variants
    from supplier join c on c.slug = concat('/item/', s_suppkey, '/') left join q on q.k = s_suppkey
    where q.k is not null or s_suppkey % 2 = 0""")
def _(tb):
    """Every second item is staged already, with a duration and one variant: what is found anew replaces both."""
    url = F.concat(F.lit(site.ROOT), F.lit("/item/"), "s_suppkey", F.lit("/")).alias("item_url")
    old = tb["supplier"].filter("s_suppkey % 2 = 0").select(url, "s_suppkey")
    stage = old.select(F.concat(F.lit("/item/"), "s_suppkey", F.lit("/")).alias("slug"), "item_url", F.lit("old").alias("name"),
                       F.lit(1).alias("year"), F.lit("9h").alias("duration"))
    variant_stage = old.select("item_url", F.lit("Q0").alias("label"), F.lit("1").alias("file_size"), F.lit("/old").alias("file_url_1"))
    items = site.queue(tb).select("id", "url")
    records, variants, _ = e.extract_items(
        site.parsed_site(tb), items, F.expr("timestamp'2024-02-01 00:00:00'"), site.LABELS, site.SERIES, **site.TITLES)
    catalog, staged = e.stage_upsert(stage, variant_stage, records, variants)
    counts = staged.groupBy("item_url").agg(F.count("*").alias("variants"))
    return catalog.join(counts, "item_url").select(key_of("item_url"), "name", "duration", "variants")


@query("m7_finalize_after_publish", oracle=f"""
    select 'run' as what, 'completed' as status, 1 as n
    union all select 'catalog', 'published', count(*) from ({OUTCOME}) where status = 'done' or error_msg like 'Staging%'""")
def _(tb):
    """Work, publish what was staged, then close the run by whether that succeeded."""
    _, stage, variant_stage = worked_off(tb)
    log = tb.spark.createDataFrame([("1", "completed", None), ("2", "inprogress", None)], "id string, status string, refresh_time timestamp")
    catalog = tb.spark.createDataFrame([], "id string, slug string, item_url string, name string, year int, duration string")
    table = tb.spark.createDataFrame([], "id string, item_id string, label string, file_size string, file_url_1 string")
    merged, log = pub.publish_and_close(stage, variant_stage, catalog, table, log, F.expr("timestamp'2024-02-01 00:00:00'"))
    closed = log.filter("id = '2'").groupBy("status").agg(F.count("*").alias("n"))
    return closed.select(F.lit("run").alias("what"), "status", "n").unionByName(
        merged[0].agg(F.count("*").alias("n")).select(F.lit("catalog").alias("what"), F.lit("published").alias("status"), "n"))


@query("m4_stage_records", oracle=f"""
    with c as ({CATALOG}), v as ({VARIANTS}), q as ({OUTCOME})
    select c.item_url, c.name, c.year, (select count(*) from v where v.k = q.k) as variants, concat('1h ', q.k % 60, 'm') as duration
    from c join q on c.slug = concat('/item/', q.k, '/') where q.status = 'done' or q.error_msg like 'Staging%'""")
def _(tb):
    items = site.queue(tb).select("id", "url")
    records, staged, _ = e.extract_items(
        site.parsed_site(tb), items, F.expr("timestamp'2024-02-01 00:00:00'"), site.LABELS, site.SERIES, **site.TITLES)
    counts = staged.groupBy("item_url").agg(F.count("*").alias("variants"))
    return records.join(counts, "item_url").select("item_url", "name", "year", "variants", "duration")


@query("a1_largest_in_page", oracle="""
    with item as (select s_suppkey as k, unnest(range(1, 2 + s_suppkey % 3)) as i from supplier where s_suppkey % 10 <> 9)
    select concat('https://site.example.com/q/', k, '/', i, '/') as url,
           case when (k + i) % 2 = 0 then 1536.0 else cast(100 + k % 50 as double) end as size_mb,
           concat('/file/', k, '-', i, case when (k + i) % 2 = 0 then '-2/' else '-1/' end) as href from item""")
def _(tb):
    parsed = h.parse_pages(site.site(tb).filter("url LIKE '%/q/%'"))
    rows = parsed.select(F.col("page_url").alias("url"), v.largest_in_page("files").alias("f"))
    return rows.select("url", "f.size_mb", "f.href")


@query("d8_all_sections", oracle="""
    with sections as (select unnest(range(40)) as n),
    last as (select n, coalesce(max(s_suppkey // 1000 + 1), 0) as pages from sections left join supplier on s_suppkey % 40 = n group by 1),
    walked as (select n, unnest(generate_series(1, pages + 1)) as page_no from last),
    found as (
      select s_suppkey % 40 as n, s_suppkey // 1000 + 1 as page_no, count(*) as new_items
      from supplier where s_suppkey % 11 <> 0 or s_suppkey in (select min(s_suppkey) from supplier group by s_suppkey % 40, s_suppkey // 1000)
      group by 1, 2)
    select concat('Films of ', 1985 + n) as section, page_no, coalesce(new_items, 0) as new_items
    from walked left join found using (n, page_no)""")
def _(tb):
    parsed = site.parsed_site(tb, listing=True)
    blocks = h.block_links(parsed)
    sections = d.section_links(blocks, site.HOME).select(F.col("name").alias("section"), "url")
    pager = h.anchor_links(parsed, "pager")
    walked = graph.paginate(sections, d.next_links(pager))
    return d.new_per_page(d.listing_items(blocks, walked, site.NOISE), walked.withColumnRenamed("depth", "page_no"))


@query("d7_run_time", oracle="""
    select s_suppkey as k, concat(60 + s_suppkey % 60, ' min') as value from supplier""")
def _(tb):
    parsed = h.parse_pages(site.site(tb).filter("url LIKE '%/item/%'"))
    return parsed.select(key_of("page_url"), o.run_time("info").alias("value"))


MOVED = """
    select concat('https://h', s_suppkey, '.example.com/') as src,
           case when s_suppkey % 3 = 0 then concat('https://h', s_suppkey // 2, '.example.com/')
                when s_suppkey % 3 = 1 then concat('https://h', s_suppkey, '.example.com/home')
                else concat('https://h', s_suppkey, '.example.com/') end as dst from supplier"""


@query("g3_refresh_config", ("config",), f"""
    with recursive moved as ({MOVED}),
    walk as (
      select src, dst, 1 as hops from moved
      union all
      select w.src, m.dst, hops + 1 from walk w join moved m on m.src = w.dst where hops < 25),
    ends as (select src, arg_max(dst, hops) as final from walk group by 1 having max(hops) < 25)
    select key, case when regexp_extract(final, '^(https://[^/]+)', 1) <> regexp_extract(url, '^(https://[^/]+)', 1)
                     then regexp_extract(final, '^(https://[^/]+)', 1) else url end as url
    from config left join ends on ends.src = config.url""")
def _(tb):
    k = F.col("s_suppkey")

    def host(n):
        return F.concat(F.lit("https://h"), n.cast("string"), F.lit(".example.com/"))

    target = F.when(k % 3 == 0, host(F.floor(k / 2))).when(k % 3 == 1, F.concat(host(k), F.lit("home"))).otherwise(host(k))
    moved = tb["supplier"].select(host(k).alias("src"), target.alias("dst"))
    return pub.refresh_config(tb["config"], moved)


def refreshed(tb):
    parsed = site.parsed_site(tb)
    catalog = tb["supplier"].select(
        F.col("s_suppkey").cast("string").alias("id"),
        F.concat(F.lit(site.ROOT), F.lit("/item/"), "s_suppkey", F.lit("/")).alias("item_url"),
    )
    label = F.explode(F.array(F.lit("Q1"), F.lit("Q2"), F.lit("X"))).alias("label")
    stored = catalog.select(F.col("id").alias("item_id"), label).select(
        F.concat("item_id", "label").alias("id"), "item_id", "label",
        *[F.lit("old").alias(c) for c in ("file_size", "file_url_1", "file_url_2", "view_url_1", "view_url_2")],
    )
    owned = catalog.filter("id % 2 = 0").select(F.concat(F.lit("r"), "id").alias("id"), F.col("id").alias("item_id"))
    log = owned.select(
        "id", "item_id", F.lit("processing").alias("status"), F.lit(None).cast("string").alias("error_msg"),
        F.lit(None).cast("timestamp").alias("completed_at"),
    )
    table, served = ref.refresh(owned, catalog, parsed, stored, F.expr("timestamp'2024-02-01 00:00:00'"), site.LABELS)
    return table, served, log


@query("m8_refresh_variants", oracle=f"""
    with v as ({VARIANTS}), s as (
      select s_suppkey as k, concat('Q', i) as label from supplier, (select unnest([1, 2]) as i)
      union all select s_suppkey, 'X' from supplier)
    select s.k, s.label, case when s.k % 2 = 0 and v.k is not null then v.file_size else 'old' end as file_size,
           case when s.k % 2 = 0 and v.k is not null then v.file_url_1 else 'old' end as file_url_1,
           case when s.k % 2 = 0 and v.k is not null then v.view_url_2 else 'old' end as view_url_2
    from s left join v on v.k = s.k and v.label = s.label""")
def _(tb):
    table = refreshed(tb)[0]
    return table.select(F.col("item_id").cast("bigint").alias("k"), "label", "file_size", "file_url_1", "view_url_2")


@query("m9_close_requests", oracle=f"""
    with v as ({VARIANTS})
    select concat('r', s_suppkey) as id, case when s_suppkey % 10 = 9 then 'failed' else 'done' end as status,
           case when s_suppkey % 10 = 9 then 'No quality links found' end as error_msg, 1706745600000000 as completed_us,
           (select string_agg(concat(label, '=', file_size, '|', coalesce(file_url_1, '')), ';' order by label) from v where k = s_suppkey) as payload
    from supplier where s_suppkey % 2 = 0""")
def _(tb):
    _, served, log = refreshed(tb)
    entry = F.transform("payload", lambda x: F.concat(
        x["label"], F.lit("="), x["file_size"], F.lit("|"), F.coalesce(x["file_url_1"], F.lit(""))))
    text = served.withColumn("payload", F.array_join(entry, ";"))
    closed = ref.close_requests(log.withColumn("payload", F.lit(None).cast("string")), text)
    return closed.select("id", "status", "error_msg", F.unix_micros("completed_at").alias("completed_us"), "payload")
