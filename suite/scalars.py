"""Scalar functions (H) over the given text."""

from pyspark.sql import functions as F

from pagecat.functions import text as t, urls as u
from pagecat.plans import optional as o
from pagecat.plans.publish import migration_report, to_relative

from .base import query

TITLE = ("title_text",)


@query("h4_strip_suffix", TITLE, "select item_id, regexp_replace(title, '(?i) full download.*', '') as title from title_text")
def _(tb):
    return tb["title_text"].select("item_id", t.strip_suffix("title", " full download").alias("title"))


@query("h5_remove_first", oracle="select doc_id, regexp_replace(text, '(?i)th[ea]', '') as text from documents")
def _(tb):
    return tb["documents"].select("doc_id", t.remove_first("text", "(?i)th[ea]").alias("text"))


@query("h6_year_in_parens", TITLE, r"""
    select item_id, try_cast(nullif(regexp_extract(title, '\((\d{4})\)', 1), '') as int) as year from title_text""")
def _(tb):
    return tb["title_text"].select("item_id", t.year_in_parens("title").alias("year"))


@query("h7_label_in_parens", oracle=r"""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
           nullif(regexp_extract(concat(l_returnflag, case when l_linenumber % 2 = 0 then concat(' (', l_linestatus, ' HD) (x)') else ' ()' end),
                  '\(([^)]+)\)', 1), '') as label
    from lineitem""")
def _(tb):
    name = F.concat(
        "l_returnflag",
        F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit(" ("), "l_linestatus", F.lit(" HD) (x)"))).otherwise(" ()"),
    )
    return tb["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", t.label_in_parens(name).alias("label")
    )


@query("h8_url_path", oracle="""
    select url, case when p = '' then '/' else p end as path
    from (select url, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) as p from pages)""")
def _(tb):
    return tb["pages"].select("url", u.url_path("url").alias("path"))


@query("h9_url_origin", oracle="""
    select page_id, concat(lower(regexp_extract(url, '^(https?://[^/?#]+)', 1)),
           case when page_id % 3 = 1 then ':8080' else '' end) as origin from pages""")
def _(tb):
    # Ports: the scheme's own is dropped, others stay; host letters become small.
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    scheme = F.regexp_extract("url", r"^(https?)", 1)
    own = F.when(scheme == "http", ":80").otherwise(":443")
    port = F.when(F.col("page_id") % 3 == 0, own).when(F.col("page_id") % 3 == 1, ":8080").otherwise("")
    rest = F.regexp_extract("url", r"^https?://[^/?#]+(.*)$", 1)
    return tb["pages"].select(
        "page_id", u.url_origin(F.concat(F.upper(scheme), F.lit("://"), F.upper(host), port, rest)).alias("origin")
    )


@query("h9_url_origin_hosts", oracle="""
    select c_custkey as k, 'http://' || case c_custkey % 3
             when 0 then printf('%d.%d.%d.%d', v >> 24, (v >> 16) & 255, (v >> 8) & 255, v & 255)
             when 1 then printf('[2001:db8::%x]:8080', c_custkey % 65535 + 1)
             else 'xn--bcher-kva.h' || c_custkey end as origin
    from (select *, (c_custkey::bigint * 28447) % 4294967296 as v from customer)""")
def _(tb):
    """Numeric hosts, IPv6 addresses in brackets and international names."""
    k = F.col("c_custkey").cast("bigint")
    host = (
        F.when(k % 3 == 0, (k * 28447 % 4294967296).cast("string"))
        .when(k % 3 == 1, F.concat(F.lit("[2001:0DB8::"), F.hex(k % 65535 + 1), F.lit("]:8080")))
        .otherwise(F.concat(F.lit("B\u00dcCHER.H"), k))
    )
    return tb["customer"].select(F.col("c_custkey").alias("k"), u.url_origin(F.concat(F.lit("HTTP://"), host, F.lit("/x"))).alias("origin"))


@query("h10_url_resolve", oracle="""
    with refs as (
        select url, page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as href from pages),
    parts as (
        select *, regexp_extract(url, '^(https?://[^/?#]+)', 1) as root,
               replace(url_encode(substr(href, 2)), '%2C', ',') as tail from refs)
    select page_id, href, case page_id % 3
             when 0 then concat(root, '/', tail)
             when 1 then concat(root, '/x/', tail, '?q=1')
             else concat(regexp_extract(url, '^(https?)', 1), '://other.example.net/', tail) end as abs_url
    from parts""")
def _(tb):
    href = F.explode(F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), F.lit(1)))
    refs = tb["pages"].select("page_id", "url", href.alias("href"))
    kind = F.col("page_id") % 3
    ref = (
        F.when(kind == 0, F.col("href"))
        .when(kind == 1, F.concat(F.lit("/x/y/.././"), F.expr("substring(href, 2)"), F.lit("?q=1")))
        .otherwise(F.concat(F.lit("//OTHER.example.net"), "href"))
    )
    return u.with_resolved(refs.withColumn("ref", ref), "url", "ref").select("page_id", "href", "abs_url")


@query("h11_poster_ref", oracle="""
    select p_partkey, case p_partkey % 5 when 0 then concat('/p/', p_partkey, '.webp')
        when 1 then concat('/p/', p_partkey, '.jpg?x=1') when 2 then concat('/i/', p_partkey, '.png')
        when 3 then 'http://' end as poster_ref from part""")
def _(tb):
    k = F.col("p_partkey")
    srcset = (
        F.when(k % 5 == 0, F.concat(F.lit("https://img.example.com/p/"), k, F.lit(".webp 2x")))
        .when(k % 5 == 1, F.concat(F.lit("/p/"), k, F.lit(".jpg?x=1 1x, /q.jpg 2x")))
        .when(k % 5 == 2, "")
        .when(k % 5 == 3, "http:// 1x")
    )
    src = F.when(k % 5 == 2, F.concat(F.lit("http://img.example.com/i/"), k, F.lit(".png#a")))
    return tb["part"].select("p_partkey", u.poster_ref(srcset, src).alias("poster_ref"))


@query("h12_to_relative", ("catalog",), """
    select slug, case when poster_ref like 'https://img%' then concat('/p/', regexp_extract(poster_ref, '([0-9]+).jpg', 1), '.jpg')
                      else poster_ref end as poster_ref from catalog""")
def _(tb):
    return to_relative(tb["catalog"].select("slug", "poster_ref"), "poster_ref")


SIZES = """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
           case l_partkey % 6
             when 0 then concat('File Size: ', cast(l_quantity as string), ' MB')
             when 1 then concat('Name' || chr(10) || 'file size:', cast(cast(l_quantity as int) as string), 'gb more')
             when 2 then concat('File Size: ', cast(cast(l_quantity as int) as string), ' KB')
             when 3 then 'File Size: 1.2.3 MB'
             when 4 then 'File Size: . GB'
             else concat('File Size: .', cast(l_linenumber as string), ' GB') end as txt
    from lineitem"""


@query("h13_parse_size_mb", oracle=f"""
    with s as ({SIZES}),
    m as (select *, regexp_extract(txt, '(?i)file size:\\s*([0-9.]+)\\s*(mb|gb)', 1) as num,
                 lower(regexp_extract(txt, '(?i)file size:\\s*([0-9.]+)\\s*(mb|gb)', 2)) as unit from s)
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
           round(case when num = '' then 0.0
                when regexp_extract(num, '^([0-9]+\\.?[0-9]*|\\.[0-9]+)', 1) = '' then -1.0
                else cast(regexp_extract(num, '^([0-9]+\\.?[0-9]*|\\.[0-9]+)', 1) as double)
                     * case unit when 'gb' then 1024 else 1 end end, 3) as size_mb
    from m""")
def _(tb):
    tb["lineitem"].createOrReplaceTempView("lineitem")
    rows = tb.spark.sql(SIZES)
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(F.nanvl(t.parse_size_mb("txt"), F.lit(-1.0)), 3).alias("size_mb"),
    )


@query("h14_fmt_size", oracle="""
    select o_orderkey, case when o_orderkey % 10 <> 0 then printf('%.2f MB', o_totalprice) end as file_size from orders""")
def _(tb):
    size = F.when(F.col("o_orderkey") % 10 == 0, -1.0).otherwise(F.col("o_totalprice"))
    return tb["orders"].select("o_orderkey", t.fmt_size(size).alias("file_size"))


@query("h15_duration_text", oracle="""
    select p_partkey, case p_partkey % 3 when 0 then concat(p_size, 'h 5m') when 1 then p_name end as duration from part""")
def _(tb):
    k = F.col("p_partkey") % 3
    text = (
        F.when(k == 0, F.concat(F.lit("a\nDuration:  "), "p_size", F.lit("h 5m \nDuration: later")))
        .when(k == 1, F.concat(F.lit("Duration:\n\t"), "p_name"))
        .otherwise(F.concat(F.lit("duration: "), "p_name"))
    )
    return tb["part"].select("p_partkey", t.duration_text(text).alias("duration"))


@query("h16_split_people", oracle="""
    select p_partkey, array_to_string(list_transform(string_split_regex(concat(p_name, ' , ', p_type, '|', p_brand, '& ,'), '[,|&]'),
           lambda x: concat('<', trim(x), '>')), '') as people from part""")
def _(tb):
    text = F.concat("p_name", F.lit(" , "), "p_type", F.lit("|"), "p_brand", F.lit("& ,"))
    people = F.transform(t.split_people(text), lambda x: F.concat(F.lit("<"), x, F.lit(">")))
    return tb["part"].select("p_partkey", F.array_join(people, "").alias("people"))


@query("h17_split_genres", oracle="""
    select p_partkey, concat(p_type, ';', p_name) as genres, 2 as n from part""")
def _(tb):
    genres = t.split_genres(F.concat("p_type", F.lit(" ,  "), "p_name"))
    return tb["part"].select("p_partkey", F.array_join(genres, ";").alias("genres"), F.size(genres).alias("n"))


@query("h18_singleton", oracle="""
    select p_partkey, case when p_partkey % 4 <> 0 then concat('[', p_name, ', ', p_brand, ']') end as director,
           case when p_partkey % 4 <> 0 then 1 end as n from part""")
def _(tb):
    value = F.when(F.col("p_partkey") % 4 != 0, F.concat("p_name", F.lit(", "), "p_brand"))
    one = t.singleton(value)
    return tb["part"].select(
        "p_partkey",
        F.when(one.isNotNull(), F.concat(F.lit("["), F.array_join(one, ";"), F.lit("]"))).alias("director"),
        F.when(one.isNotNull(), F.size(one)).alias("n"),
    )


@query("h19_clean_rating", oracle="""
    select p_partkey, concat(p_size, case when p_partkey % 2 = 0 then '/10' else '' end) as rating,
           case when p_partkey % 2 = 1 then cast(p_size as double) end as rating_value from part""")
def _(tb):
    text = F.concat("p_size", F.lit("/10"), F.when(F.col("p_partkey") % 2 == 0, "/10").otherwise(""))
    return tb["part"].select(
        "p_partkey", t.clean_rating(text).alias("rating"), t.rating_value(text).alias("rating_value")
    )


@query("h20_strip_label", oracle="""
    select doc_id, nullif(trim(text, concat(chr(9), chr(10), chr(11), chr(12), chr(13), ' ', chr(160))), '') as synopsis
    from documents""")
def _(tb):
    return tb["documents"].select("doc_id", t.strip_label(F.concat(F.lit("\n SYNOPSIS: "), "text"), "Synopsis:").alias("synopsis"))


@query("h21_js_trim", oracle="select doc_id, trim(text, concat(chr(9), chr(10), chr(11), chr(12), chr(13), ' ', chr(160))) as text from documents")
def _(tb):
    return tb["documents"].select(
        "doc_id", t.js_trim(F.concat(F.lit(" \t\n "), "text", F.lit("﻿ \r\n"))).alias("text")
    )


@query("h22_is_next_link", oracle="""
    select doc_id from documents where contains(lower(replace(text, 'nd ', 'next ')), 'next') and source not in ('src3', 'src4')""")
def _(tb):
    # Two sources stand for links without a target.
    href = F.when(F.col("source") == "src3", "#").when(F.col("source") != "src4", F.col("source"))
    return tb["documents"].filter(t.is_next_link(F.replace("text", F.lit("nd "), F.lit("next ")), href)).select("doc_id")


@query("h23_contains_label", oracle="""
    select doc_id, contains(text, 'in the') as plain, regexp_matches(text, 'in the($|[^A-Za-z0-9_])') as whole from documents""")
def _(tb):
    return tb["documents"].select(
        "doc_id", t.contains_label("text", "in the").alias("plain"),
        t.contains_label("text", "in the", whole_word=True).alias("whole"),
    )


@query("h24_payload_present", ("refresh_log",), "select id, payload is not null as present from refresh_log")
def _(tb):
    # A list that turns out empty is present all the same.
    value = F.filter(F.from_json("payload", "array<bigint>"), lambda x: x % 2 == 0)
    return tb["refresh_log"].select("id", t.payload_present(value).alias("present"))


@query("h24_payload_values", oracle="""
    select event_id as id, event_id % 9 in (2, 3, 6, 8) as present, event_id % 9 in (2, 3, 6, 8) as present_variant from events""")
def _(tb):
    """Stored texts: null, no JSON, lists, text, numbers, truth values and nothing at all."""
    kinds = ["null", "{broken", "[]", '[{"label": "HD"}]', '""', "0", '"x"', "false", "{}"]
    text = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("event_id") % 9 + 1).cast("int"))
    rows = tb["events"].select(F.col("event_id").alias("id"), text.alias("payload")).withColumn("v", F.try_parse_json("payload"))
    return rows.select("id", t.payload_present("payload", "json").alias("present"), t.payload_present("v", "variant").alias("present_variant"))


@query("h25_coalesce_src", ("variant_file",), """
    select item_id, pos, url, coalesce(nullif(file_url_1, ''), nullif(file_url_2, '')) as src from variant_file""")
def _(tb):
    return tb["variant_file"].select("item_id", "pos", "url", t.coalesce_src("file_url_1", "file_url_2").alias("src"))


@query("h26_minutes_ago", oracle="""
    select event_id, cast(floor((epoch_us(timestamp '2024-02-01 00:00:00') - epoch_us(ts)) / 60000000) as bigint) as minutes
    from events""")
def _(tb):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return tb["events"].select("event_id", t.minutes_ago(now, F.col("ts").cast("timestamp")).alias("minutes"))


@query("h27_run_label", oracle="""
    select event_id, case when event_id % 2 = 0 and event_id % 3 <> 0 then concat('custom-', 2000 + user_id % 25)
                     else event_type end as trigger_by from events""")
def _(tb):
    mode = F.when(F.col("event_id") % 2 == 0, "custom").otherwise("quick")
    year = F.when(F.col("event_id") % 3 != 0, (F.lit(2000) + F.col("user_id") % 25).cast("string"))
    return tb["events"].select("event_id", t.run_label(mode, year, "event_type").alias("trigger_by"))


@query("h28_iso_cutoff", oracle="""
    select event_id, epoch_us(ts) - 900000000 as cutoff_us from events""")
def _(tb):
    return tb["events"].select("event_id", F.unix_micros(t.cutoff(F.col("ts").cast("timestamp"), 15)).alias("cutoff_us"))


@query("a9_migration_report", ("catalog",), """
    select count(poster_ref) as total, count(*) filter (poster_ref like 'http%') as to_migrate,
           count(*) filter (poster_ref like 'https://img%') as success,
           count(*) filter (poster_ref = 'http://') as failed from catalog""")
def _(tb):
    return migration_report(tb["catalog"], "poster_ref")


@query("d1_normalize_quality", oracle="""
    select doc_id, case when contains(low, '1080p') then '1080p' when contains(low, '720p') then '720p' when contains(low, '480p') then '480p'
                        when contains(low, '360p') then '360p' when contains(low, 'hd') then '720p' else 'Unknown' end as quality
    from (select doc_id, lower(concat(text, ' ', n_chars, 'P')) as low from documents)""")
def _(tb):
    label = F.concat("text", F.lit(" "), "n_chars", F.lit("P"))
    return tb["documents"].select("doc_id", o.normalize_quality(label).alias("quality"))


@query("d2_priority_for", oracle="""
    select p_partkey, case when p_size = 50 then 1 when p_size = 49 then 2 else 3 end as priority from part""")
def _(tb):
    return tb["part"].select("p_partkey", o.priority_for("p_size", F.lit(50)).alias("priority"))


@query("d3_iso_duration", oracle="""
    select p_partkey, case when p_partkey % 3 < 2 then concat(p_size % 5, 'h', p_size, case when p_partkey % 3 = 0 then 'm7s' else 'm' end) end as duration
    from part""")
def _(tb):
    k = F.col("p_partkey") % 3
    text = F.concat(
        F.when(k < 2, "PT").otherwise("P1D"), F.col("p_size") % 5, F.lit("H"), "p_size",
        F.when(k == 0, "M7S").otherwise("M"),
    )
    return tb["part"].select("p_partkey", o.iso_duration(text).alias("duration"))


@query("d9_poster_absolute", ("catalog",), """
    select slug, case when poster_ref like 'http%' then poster_ref
                 else 'https://cdn.example.com' || poster_ref end as poster_url from catalog""")
def _(tb):
    return tb["catalog"].select("slug", o.poster_absolute(F.lit("https://cdn.example.com/"), "poster_ref").alias("poster_url"))
