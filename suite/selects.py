"""Filters, ranking, aggregates, set operations (P, A, W, O, U) and scans."""

from pyspark.sql import functions as F

from pagecat.functions.text import parse_size_mb
from pagecat.operators import predicates as p, ranking as r, variants as v
from pagecat.operators.quality import (
    catalog_rules, check_constraints, not_null, one_of, request_rules, run_rules, unique_violations, variant_rules,
)
from pagecat.plans import discover as d, optional as o, runs
from pagecat.session import scratch
from pagecat.sources import tables as s
from pagecat.streaming import captures

from .base import query

VF = ("variant_file",)
WQ = ("work_queue",)
LISTING = ("listing",)

SIZE_SQL = """cast(regexp_extract(size_text, '([0-9]+) ', 1) as double)
              * case when size_text like '%GB' then 1024 when size_text like '%MB' then 1 else 0 end"""


@query("s1_scan_pages", ("capture",), """
    select url, length(html) as n, html like '%<!-- later -->' as later from (
      select *, row_number() over (partition by url order by captured_at desc) as rn from capture) where rn = 1""")
def _(tb):
    return s.scan_pages(tb["capture"], "captured_at").select(
        "url", F.length("html").cast("bigint").alias("n"), F.col("html").endswith("<!-- later -->").alias("later")
    )


@query("s1_scan_pages_stream", ("capture",), """
    select url, length(html) as n, html like '%<!-- later -->' as later from (
      select *, row_number() over (partition by url order by captured_at desc) as rn from capture) where rn = 1""")
def _(tb):
    """The captures as a stream of files without any order: texts are read only when newer than what is known."""
    base = scratch(tb.spark, "captures")
    rows = tb["capture"]
    files = 8 + rows.count() // 10_000
    rows.repartition(files, F.xxhash64("captured_at")).write.parquet(f"{base}/in")
    captures.keep_newest(tb.spark, f"{base}/in", rows.schema, "captured_at", f"{base}/out", f"{base}/state", maxFilesPerTrigger=str(-(-files // 4)))
    return captures.current_pages(tb.spark, f"{base}/out", "captured_at").select(
        "url", F.length("html").cast("bigint").alias("n"), F.col("html").endswith("<!-- later -->").alias("later")
    )


@query("s1_scan_pages_without_url", ("capture",), """
    select u as url, length(html) as n from (
      select *, row_number() over (partition by u order by captured_at desc) as rn
      from (select *, case when length(html) % 3 > 0 then url end as u from capture)) where rn = 1 or u is null""")
def _(tb):
    """Captures without a URL are no captures of one page: all stay."""
    url = F.when(F.length("html") % 3 > 0, F.col("url"))
    return s.scan_pages(tb["capture"].withColumn("url", url), "captured_at").select("url", F.length("html").cast("bigint").alias("n"))


@query("s2_config_value", ("config",), "select url from config where key = 'base_7'")
def _(tb):
    return s.config_value(tb["config"], "base_7")


@query("s3_scan", oracle="""
    select o_orderkey, o_custkey from orders where o_orderstatus = 'F' and o_totalprice >= 100000""")
def _(tb):
    return s.scan(
        tb.spark, tb.path("orders"), ["o_orderkey", "o_custkey"],
        (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") >= 100000),
    )


@query("p1_equals", WQ, "select id from work_queue where status = 'pending'")
def _(tb):
    return tb["work_queue"].filter(F.col("status") == "pending").select("id")


@query("p2_not_equals", WQ, "select id from work_queue where status <> 'processing'")
def _(tb):
    return tb["work_queue"].filter(F.col("status") != "processing").select("id")


@query("p3_in_list", WQ, "select id from work_queue where status in ('processing', 'done', 'error')")
def _(tb):
    return tb["work_queue"].filter(p.status_in("status", ["processing", "done", "error"])).select("id")


@query("p4_since", WQ, """
    select id from work_queue where queued_at >= (select max(queued_at) from work_queue) - interval '1' day""")
def _(tb):
    # The bound is one row: a scalar subquery, read by the scan's filter.
    queue = tb["work_queue"]
    queue.createOrReplaceTempView("work_queue")
    bound = tb.spark.table("work_queue").agg((F.max("queued_at") - F.expr("INTERVAL 1 DAY")).alias("b"))
    return queue.filter(p.since("queued_at", bound.scalar())).select("id")


@query("p5_not_null", ("catalog",), "select slug from catalog where poster_ref is not null")
def _(tb):
    return tb["catalog"].filter(F.col("poster_ref").isNotNull()).select("slug")


@query("p6_prefix", ("catalog",), "select slug from catalog where poster_ref like 'http%'")
def _(tb):
    return tb["catalog"].filter(p.is_full_ref("poster_ref")).select("slug")


@query("p7_is_section_link", ("listing_src",), """
    select c_custkey from listing_src where has_icon and c_custkey % 3 <> 0 and regexp_matches(name, '[0-9]{4}')""")
def _(tb):
    href = F.when(F.col("c_custkey") % 3 != 0, F.col("url"))
    return tb["listing_src"].withColumn("href", href).filter(p.is_section_link("name")).select("c_custkey")


@query("p8_is_item_link", ("listing_src",), """
    select c_custkey from listing_src where has_icon and not regexp_matches(name, '(?i)[0-9]{4} Films')
      and not regexp_matches(name, '(?i)Full Download') and not regexp_matches(name, '(?i)web-series|web series')
      and not regexp_matches(url, '(?i)web-series|web series')""")
def _(tb):
    noise = (p.Noise(r"\d{4} Films"), p.Noise("Full Download"), p.Noise("web-series|web series", "any"))
    return tb["listing_src"].filter(p.is_item_link(noise, name="name", url="url", href="url")).select("c_custkey")


@query("p9_skip_rule", ("listing_src",), """
    select c_custkey, case when regexp_matches(url, '(?i)WEB-series') then 'skipped' else 'pending' end as status from listing_src""")
def _(tb):
    status = F.when(p.skip_rule("url", "WEB-series"), "skipped").otherwise("pending")
    return tb["listing_src"].select("c_custkey", status.alias("status"))


@query("p10_group_has_no_result", VF, """
    select item_id, bool_and(coalesce(file_url_1, '') = '' and coalesce(view_url_1, '') = '') as no_result
    from variant_file group by 1""")
def _(tb):
    return p.group_has_no_result(tb["variant_file"], "item_id")


@query("p11_check_constraints", WQ, """
    select id, 'priority set' as rule from work_queue where priority is null
    union all select id, 'status known' from work_queue where status = 'error'""")
def _(tb):
    rules = {
        "priority set": not_null("priority"),
        "status known": one_of("status", ["pending", "processing", "done"]),
    }
    return check_constraints(tb["work_queue"], "id", rules)


@query("p11_queue_constraints", ("catalog_stage", "variant_stage", "run_log", "refresh_log"), """
    select 'catalog' as tbl, slug as k, 'name not null' as rule from catalog_stage where name is null
    union all select 'catalog', slug, 'item_url not null' from catalog_stage where item_url is null
    union all select 'variant', file_url_1, 'label not null' from variant_stage where label is null
    union all select 'run', cast(id as string), 'status known' from run_log where status not in ('completed', 'inprogress')
    union all select 'request', cast(id as string), 'item_id not null' from refresh_log where item_id = 3""")
def _(tb):
    """The constraints of the stored tables. The log's own states and ids are thinned, so that some rows break a rule."""
    runs_ = tb["run_log"].withColumn("status", F.when(F.col("status") == "failed", "lost").otherwise(F.col("status")))
    asked = tb["refresh_log"].withColumn("item_id", F.when(F.col("item_id") != 3, F.col("item_id")))
    found = [
        check_constraints(df, key, rules).select(F.lit(tbl).alias("tbl"), F.col(key).cast("string").alias("k"), "rule")
        for tbl, df, key, rules in (
            ("catalog", tb["catalog_stage"], "slug", catalog_rules()), ("variant", tb["variant_stage"], "file_url_1", variant_rules()),
            ("run", runs_, "id", run_rules()), ("request", asked, "id", request_rules()))
    ]
    return r.union_pages(*found)


@query("a11_save_section_counts", ("listing_src", "section"), """
    with n as (select section, count(*) as n from listing_src group by 1)
    select cast(section as string) as folder, cast(case when n.n is not null and section % 2 = 0 then n.n when section % 3 = 0 then -1 end as int) as last_known_count
    from section left join n using (section) where section % 2 = 0 or section % 3 = 0""")
def _(tb):
    folder = F.col("section").cast("string").alias("folder")
    state = tb["section"].filter("section % 3 = 0").select(
        folder, F.lit(None).cast("timestamp").alias("last_scraped_at"), F.lit(-1).alias("last_known_count"))
    counts = tb["listing_src"].filter("section % 2 = 0").groupBy(folder).agg(F.count("*").alias("n"))
    return runs.save_section_counts(state, counts, F.expr("timestamp'2024-02-01 00:00:00'")).select("folder", "last_known_count")


@query("p12_href_contains", VF, """
    select item_id, pos from variant_file where contains(url, '/file/1') and contains(size_text, 'GB')""")
def _(tb):
    rows = tb["variant_file"].filter(p.href_contains("/file/1", "url") & p.href_contains("GB", "size_text"))
    return rows.select("item_id", "pos")


@query("a1_largest_variant", VF, f"""
    select item_id, url, pos, round(size_mb, 2) as size_mb from (
      select *, row_number() over (partition by item_id order by size_mb desc, pos) as rn
      from (select *, {SIZE_SQL} as size_mb from variant_file)) where rn = 1""")
def _(tb):
    sized = tb["variant_file"].withColumn("size_mb", parse_size_mb("size_text"))
    return v.largest_variant(sized, "item_id").select("item_id", "url", "pos", F.round("size_mb", 2).alias("size_mb"))


@query("a2_first_non_null", VF, """
    select item_id, arg_min(duration, pos) filter (duration <> '') as duration from variant_file group by 1""")
def _(tb):
    return v.first_non_null(tb["variant_file"], "item_id", "duration", "pos")


@query("a3_pivot_last_wins", ("info_pair",), """
    select item_id, arg_max(v, pos) filter (lower(k) like '%director%') as director,
           arg_max(v, pos) filter (lower(k) like '%genres%') as genres,
           arg_max(v, pos) filter (lower(k) like '%movie rating%') as rating
    from info_pair group by 1""")
def _(tb):
    fields = {"director": "director", "genres": "genres", "rating": "movie rating"}
    return v.pivot_last_wins(tb["info_pair"], "item_id", fields)


@query("a4_outcome_counts", WQ, """
    select user_id, count(*) filter (status = 'done') as processed, count(*) filter (status = 'skipped') as skipped,
           count(*) filter (status = 'error') as errors from work_queue group by 1""")
def _(tb):
    return runs.outcome_counts(tb["work_queue"], ["user_id"])


@query("a5_new_per_page", LISTING, """
    with f as (select section, page_no, count(*) as n from (
      select *, row_number() over (partition by section, url order by page_no, pos) as rn from listing
      where not contains(url, 'web-series')) where rn = 1 group by 1, 2)
    select distinct l.section, l.page_no, coalesce(n, 0) as new_items
    from (select distinct section, page_no from listing) l left join f using (section, page_no)""")
def _(tb):
    listing = tb["listing"]
    return d.new_per_page(listing.filter(~F.col("url").contains("web-series")), listing)


A6 = """
    select item_id, string_agg(concat(label, '=', url), ',' order by pos, label, url) as variants from variant_file group by 1"""


@query("a6_collect_variants", VF, A6)
def _(tb):
    rows = v.collect_variants(tb["variant_file"], "item_id", ["url"])
    text = F.array_join(F.transform("payload", lambda e: F.concat(e["label"], F.lit("="), e["url"])), ",")
    return rows.select("item_id", text.alias("variants"))


@query("a7_any_every", VF, """
    select item_id, bool_and(size_text like '%MB') as all_mb, bool_or(size_text like '%GB') as any_gb
    from variant_file group by 1""")
def _(tb):
    return tb["variant_file"].groupBy("item_id").agg(
        F.bool_and(F.col("size_text").endswith("MB")).alias("all_mb"),
        F.bool_or(F.col("size_text").endswith("GB")).alias("any_gb"),
    )


@query("a8_staged_ok_count", VF, """
    select item_id, count(*) filter (label <> 'AF' and file_url_1 is not null) as staged from variant_file group by 1""")
def _(tb):
    ok = not_null("file_url_1") & one_of("label", ["AO", "NF", "NO", "RF", "RO"])
    return runs.staged_ok_count(tb["variant_file"], "item_id", ok)


@query("a10_unique_violations", VF, """
    select item_id, label, count(*) as n from variant_file where file_url_1 is not null
    group by 1, 2 having count(*) > 1""")
def _(tb):
    return unique_violations(tb["variant_file"], ["item_id", "label"], F.col("file_url_1").isNotNull())


@query("a11_section_count_delta", LISTING, """
    with c as (select section, count(*) as n from listing group by 1),
         s as (select section, count(*) as last from listing where page_no <= 5 and section % 3 <> 0 group by 1)
    select cast(section as varchar) as folder, n, coalesce(last, 0) as last_known, n - coalesce(last, 0) as delta
    from c left join s using (section)""")
def _(tb):
    folder = tb["listing"].withColumn("folder", F.col("section").cast("string"))
    counts = folder.groupBy("folder").agg(F.count("*").alias("n"))
    state = (
        folder.filter("page_no <= 5 AND section % 3 <> 0").groupBy("folder")
        .agg(F.count("*").alias("last_known_count"))
    )
    return runs.section_count_delta(counts, state)


@query("w1_dedup_first_seen", LISTING, """
    select section, page_no, pos, name, url from (
      select *, row_number() over (partition by url order by page_no, pos) as rn from listing
      where not contains(name, 'Films')) where rn = 1""")
def _(tb):
    return r.dedup_first_seen(tb["listing"].filter(~F.col("name").contains("Films")))


@query("w2_first_match_per_page", ("chain_link",), """
    select page_url, pos, href from (
      select *, row_number() over (partition by page_url order by pos) as rn from chain_link
      where contains(anchor_text, 'Server 1')) where rn = 1""")
def _(tb):
    hit = r.first_match_per_page(tb["chain_link"], "page_url", F.col("anchor_text").contains("Server 1"))
    return hit.select("page_url", "pos", "href")


@query("w3_latest_per_key", ("run_log",), """
    select user_id, id, status, epoch_us(refresh_time) as t from (
      select *, row_number() over (partition by user_id order by refresh_time desc) as rn from run_log) where rn = 1""")
def _(tb):
    rows = r.latest_per_key(tb["run_log"], ["user_id"], "refresh_time", ["id", "status"])
    return rows.select("user_id", "id", "status", F.unix_micros(F.col("refresh_time").cast("timestamp")).alias("t"))


@query("w4_last_match_per_page", VF, """
    select item_id, pos, duration from (
      select *, row_number() over (partition by item_id order by pos desc) as rn from variant_file
      where contains(duration, 'h')) where rn = 1""")
def _(tb):
    hit = r.last_match_per_page(tb["variant_file"], "item_id", F.col("duration").contains("h"))
    return hit.select("item_id", "pos", "duration")


@query("w5_last_write_per_key", VF, """
    select item_id, label, arg_max_null(file_url_1, pos) as file_url_1,
           arg_max_null(duration, pos) filter (duration <> '') as duration
    from variant_file group by 1, 2""")
def _(tb):
    rows = tb["variant_file"].select("item_id", "label", "pos", "file_url_1", "duration")
    return r.last_write_per_key(rows, ["item_id", "label"], ["pos"], {"duration": F.col("duration") != ""})


@query("o1_sort_sections", ("section",), """
    select section, name,
           try_cast(nullif(regexp_extract(regexp_replace(name, '^Part [0-9]+', ''), '[0-9]{4}'), '') as int) as year
    from section order by year desc nulls last, pos""")
def _(tb):
    # Years stand after the part number.
    sections = tb["section"].withColumn("label", F.regexp_replace("name", r"^Part \d+", ""))
    return r.sort_sections(sections, "label").select("section", "name", r.section_year("label").alias("year"))


@query("o2_next_work", WQ, """
    select id, url, priority from work_queue where status = 'pending' order by priority asc nulls last, url, id limit 50""")
def _(tb):
    return r.next_work(tb["work_queue"], 50).select("id", "url", "priority")


@query("o3_latest_one", ("run_log",), """
    select id, status from run_log where status = 'inprogress' order by refresh_time desc limit 1""")
def _(tb):
    active = tb["run_log"].filter("status = 'inprogress'")
    return r.latest_one(active, "refresh_time", ["id"]).select("id", "status")


@query("o4_pick_section", ("section",), """
    select section, name from section order by contains(name, '2010') desc, pos limit 1""")
def _(tb):
    sections = tb["section"].withColumn("label", F.regexp_replace("name", r"^Part \d+", ""))
    return r.pick_section(sections, "custom", "2010", "2024", "label").select("section", "name")


@query("o5_page_limit", LISTING, "select section, page_no, pos, url from listing where page_no <= 1")
def _(tb):
    return r.page_limit(tb["listing"], "quick", "page_no").select("section", "page_no", "pos", "url")


@query("u1_union_pages", ("listing", "listing_src"), "select section, page_no, pos, name, url from listing")
def _(tb):
    listing = tb["listing"]
    return r.union_pages(listing.filter("page_no <= 2"), listing.filter("page_no BETWEEN 3 AND 8"), listing.filter("page_no > 8"))


@query("u2_distinct_urls", LISTING, "select distinct url from listing")
def _(tb):
    return r.distinct_urls(tb["listing"])


@query("u3_branches_to_columns", ("chain_link",), """
    select page_url, max(href) filter (b = 1) as href_1, max(href) filter (b = 2) as href_2 from (
      select *, case when contains(anchor_text, '1') then 1 else 2 end as b,
             row_number() over (partition by page_url, contains(anchor_text, '1') order by pos) as rn
      from chain_link where box = 'links') where rn = 1 group by 1""")
def _(tb):
    from pagecat.operators.graph import branches_to_columns, labelled_links

    first = labelled_links(tb["chain_link"], {1: "Server 1", 2: "Server 2"})
    return branches_to_columns(first, ["page_url"], ["href"])


@query("d4_unknown_variant", ("catalog", "variant_stage"), """
    select item_url, label from variant_stage union all
    select distinct item_url, 'Unknown' from catalog where item_url not in (select item_url from variant_stage)""")
def _(tb):
    stage = tb["variant_stage"].select("item_url", "label")
    return o.with_unknown_variant(tb["catalog"], stage)


@query("d5_is_item_url", ("listing_src",), """
    select c_custkey from listing_src where contains(url, '/web-series/') or contains(url, '/item/1')""")
def _(tb):
    return tb["listing_src"].filter(o.is_item_url("url", ("/web-series/", "/item/1"))).select("c_custkey")


@query("d6_direct_or_fallback", VF, """
    select item_id, pos, url from (
      select *, bool_or(coalesce(file_url_1, '') <> '') over (partition by item_id) as has_direct,
             min(pos) filter (coalesce(file_url_1, '') = '') over (partition by item_id) as first_other
      from variant_file)
    where case when has_direct then coalesce(file_url_1, '') <> '' else pos = first_other end""")
def _(tb):
    direct = F.coalesce("file_url_1", F.lit("")) != ""
    return o.direct_or_fallback(tb["variant_file"], "item_id", direct, ~direct).select("item_id", "pos", "url")


@query("d7_duration_to_variants", VF, """
    with d as (select item_id, arg_min(duration, pos) filter (duration <> '') as first from variant_file group by 1)
    select item_id, pos, coalesce(duration, first) as duration from variant_file left join d using (item_id)""")
def _(tb):
    rows = tb["variant_file"].select("item_id", "pos", "duration")
    parents = v.first_non_null(rows, "item_id", "duration", "pos")
    return o.duration_to_variants(rows, parents, "item_id")
