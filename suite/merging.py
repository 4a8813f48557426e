"""Sinks, joins between staged and stored rows, and publishing."""

from pyspark.sql import functions as F

from pagecat.operators import joins as j, merge as m, variants as v
from pagecat.plans import publish as pub
from pagecat.session import scratch
from pagecat.sources import tables as s

from .base import query

CS = ("catalog", "catalog_stage")
VF = ("variant_file",)
WHEN = "timestamp'2024-02-01 00:00:00'"
WHEN_US = 1706745600000000


def us(col):
    return F.unix_micros(F.col(col).cast("timestamp"))


@query("s4_append", oracle="""
    select o_orderstatus, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by 1""")
def _(tb):
    path = scratch(tb.spark, "append")
    orders = tb["orders"].select("o_orderkey", "o_orderstatus", "o_totalprice")
    s.append(orders.filter("o_orderstatus = 'F'"), path)
    s.append(orders.filter("o_orderstatus <> 'F'"), path)
    back = s.scan(tb.spark, path)
    return back.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("s5_upsert", CS, """
    select coalesce(c.slug, s.slug) as slug, coalesce(s.item_url, c.item_url) as item_url,
           case when s.slug is not null then s.language else c.language end as language,
           case when c.slug is null then 1999 else c.year end as year, c.name as name
    from catalog c full join catalog_stage s using (slug)""")
def _(tb):
    out = m.upsert(tb["catalog"], tb["catalog_stage"], "slug", ["item_url", "language"], defaults={"year": 1999})
    return out.select("slug", "item_url", "language", "year", "name")


@query("s6_update_where", CS, """
    select c.slug, case when s.slug is not null then s.year else c.year end as year, c.language
    from catalog c left join catalog_stage s using (slug)""")
def _(tb):
    return m.update_where(tb["catalog"], tb["catalog_stage"], "slug", ["year"]).select("slug", "year", "language")


@query("s7_delete_where", ("work_queue",), "select id, status from work_queue where status = 'processing' or status is null")
def _(tb):
    return m.delete_where(tb["work_queue"], F.col("status") != "processing").select("id", "status")


@query("s8_clear", ("catalog", "variant", "config"), """
    select 'catalog' as tbl, 0 as n union all select 'variant', 0
    union all select 'config', count(*) from config""")
def _(tb):
    store = s.Snapshots(tb.spark, scratch(tb.spark, "store"))
    tables = ("catalog", "variant", "config")
    store.publish({t: tb[t] for t in tables})
    store.clear(["catalog"], {"catalog": ["variant"]})
    counts = [
        df.agg(F.count("*").alias("n")).select(F.lit(t).alias("tbl"), "n")
        for t, df in (("catalog", store.read("catalog")), ("variant", store.read("variant")), ("config", store.read("config")))
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("s9_json_column", VF, """
    select item_id, label, url as file_url_1, nullif(file_url_2, '') as file_url_2 from variant_file""")
def _(tb):
    rows = tb["variant_file"].withColumn("file_url_1", F.col("url"))
    arrays = v.collect_variants(rows, "item_id", ["file_url_1", "file_url_2"])
    stored = arrays.select("item_id", s.to_json_col("payload").alias("payload"))
    entry = F.explode(s.from_json_col("payload")).alias("e")
    return stored.select("item_id", entry).select("item_id", "e.label", "e.file_url_1", "e.file_url_2")


@query("s9_variant_column", VF, """
    select item_id, label, url as file_url_1, nullif(file_url_2, '') as file_url_2 from variant_file""")
def _(tb):
    """The same lists stored as VARIANT and read back field by field."""
    rows = tb["variant_file"].withColumn("file_url_1", F.col("url"))
    arrays = v.collect_variants(rows, "item_id", ["file_url_1", "file_url_2"])
    stored = arrays.select("item_id", s.to_variant_col("payload").alias("payload"))
    fields = {"label": "string", "file_url_1": "string", "file_url_2": "string"}
    entry = F.explode(s.variant_entries("payload", fields)).alias("e")
    return stored.select("item_id", entry).select("item_id", "e.label", "e.file_url_1", "e.file_url_2")


@query("s10_apply_defaults", ("work_queue",), """
    select id, coalesce(status, 'pending') as status, coalesce(priority, 2) as priority,
           epoch_us(queued_at + interval '5' minute) as expires_us from work_queue""")
def _(tb):
    rows = m.apply_defaults(
        tb["work_queue"],
        {"status": "pending", "priority": 2, "expires_at": F.col("queued_at") + F.expr("INTERVAL 5 MINUTES")},
    )
    return rows.select("id", "status", "priority", us("expires_at").alias("expires_us"))


@query("s11_touch_updated_at", CS, f"""
    select c.slug, c.year, case when s.slug is not null then {WHEN_US} else epoch_us(timestamp '2023-01-01') end as updated_us
    from catalog c left join catalog_stage s using (slug)""")
def _(tb):
    old = tb["catalog"].withColumn("updated_at", F.expr("timestamp'2023-01-01 00:00:00'"))
    out = m.update_where(old, tb["catalog_stage"], "slug", ["language"], touch="updated_at", as_of=F.expr(WHEN))
    return out.select("slug", "year", us("updated_at").alias("updated_us"))


@query("j1_attach_parent_id", ("variant_stage", "catalog"), """
    select c.id as item_id, v.label, v.file_url_1 from variant_stage v join catalog c using (item_url)""")
def _(tb):
    return j.attach_parent_id(tb["variant_stage"], tb["catalog"]).select("item_id", "label", "file_url_1")


@query("j2_drop_staged_variants", ("variant", "catalog_stage"), """
    select id, label from variant where item_id not in (
      select id from catalog where slug in (select slug from catalog_stage))""")
def _(tb):
    return j.drop_staged_variants(tb["variant"], tb["catalog"], tb["catalog_stage"]).select("id", "label")


@query("j3_match_split", CS, """
    select coalesce(c.slug, s.slug) as slug,
           case when c.slug is null then 'insert' when s.slug is null then 'keep' else 'update' end as action
    from catalog c full join catalog_stage s on c.slug = s.slug""")
def _(tb):
    return j.match_split(tb["catalog"], tb["catalog_stage"], "slug")


@query("j7_orphans", ("variant",), """
    select id, item_id from variant where item_id not in (select id from catalog)""")
def _(tb):
    return j.orphans(tb["variant"], tb["catalog"], "item_id", "id").select("id", "item_id")


@query("j7_cascade_delete", ("variant",), """
    select id, label from variant where item_id not in (select id from catalog where year < 2010)""")
def _(tb):
    gone = tb["catalog"].filter("year < 2010")
    return j.cascade_delete(tb["variant"], gone, "item_id", "id").select("id", "label")


MERGED = f"""
    select coalesce(c.id, sha256(s.slug)) as id, coalesce(c.slug, s.slug) as slug,
           coalesce(s.item_url, c.item_url) as item_url, coalesce(s.name, c.name) as name,
           coalesce(s.year, c.year) as year, coalesce(s.language, c.language) as language,
           case when s.slug is not null then {WHEN_US} else epoch_us(timestamp '2023-01-01') end as updated_us
    from catalog c full join catalog_stage s using (slug)"""


def published(tb):
    catalog = tb["catalog"].drop("poster_ref").withColumn("updated_at", F.expr("timestamp'2023-01-01 00:00:00'"))
    return pub.publish(
        tb["catalog_stage"], tb["variant_stage"], catalog, tb["variant"], F.expr(WHEN), on_dup="last"
    )


@query("m1_publish_catalog", CS, MERGED)
def _(tb):
    return published(tb)[0].withColumn("updated_us", us("updated_at")).drop("updated_at")


@query("m1_publish_variants", ("variant", "variant_stage", "catalog_stage"), f"""
    with merged as ({MERGED}),
    kept as (select item_id, label, file_size, file_url_1, 0 as new from variant where item_id not in (
      select id from merged where slug in (select slug from catalog_stage))),
    placed as (select merged.id as item_id, label, file_size, file_url_1, 1 as new
               from variant_stage join merged using (item_url))
    select item_id, label, file_size, file_url_1 from (
      select *, row_number() over (partition by item_id, label order by new desc) as rn
      from (select * from kept union all select * from placed)) where rn = 1""")
def _(tb):
    return published(tb)[1].select("item_id", "label", "file_size", "file_url_1")


CLEAN = ("variant", "variant_stage", "catalog_stage")
CLEAN_SQL = f"""
    with merged as ({MERGED})
    select item_id, label, file_size, file_url_1 from variant where item_id not in (
      select id from merged where slug in (select slug from catalog_stage))
    union all
    select merged.id, label, file_size, file_url_1 from variant_stage join merged using (item_url) where label = 'HD'"""


def clean(tb):
    """Staging in which no key repeats."""
    return tb["catalog_stage"], tb["variant_stage"].filter("label = 'HD'")


@query("m1_publish_error_catalog", CS, MERGED)
def _(tb):
    old = tb["catalog"].drop("poster_ref").withColumn("updated_at", F.expr("timestamp'2023-01-01 00:00:00'"))
    merged, _ = pub.publish(*clean(tb), old, tb["variant"], F.expr(WHEN))
    return merged.withColumn("updated_us", us("updated_at")).drop("updated_at")


@query("m1_publish_error", CLEAN, CLEAN_SQL)
def _(tb):
    old = tb["catalog"].drop("poster_ref").withColumn("updated_at", F.expr("timestamp'2023-01-01 00:00:00'"))
    return pub.publish(*clean(tb), old, tb["variant"], F.expr(WHEN))[1].select("item_id", "label", "file_size", "file_url_1")


@query("m1_publish_snapshot", (*CLEAN, "config"), f"""
    with merged as ({MERGED})
    select 'catalog' as tbl, count(*) as n, count(distinct item_url) as k from merged
    union all select 'catalog_stage', 0, 0
    union all select 'config', count(*), count(distinct url) from config""")
def _(tb):
    """One version with four new tables; the configuration is read from where it was."""
    store = s.Snapshots(tb.spark, scratch(tb.spark, "store"))
    stage, variant_stage = clean(tb)
    old = tb["catalog"].drop("poster_ref").withColumn("updated_at", F.expr("timestamp'2023-01-01 00:00:00'"))
    store.publish({"catalog": old, "variant": tb["variant"], "config": tb["config"], "catalog_stage": stage, "variant_stage": variant_stage})
    pub.publish_snapshot(store, store.read("catalog_stage"), store.read("variant_stage"), F.expr(WHEN))
    found = [
        store.read(name).agg(F.count("*").alias("n"), F.countDistinct(key).alias("k")).select(F.lit(name).alias("tbl"), "n", "k")
        for name, key in (("catalog", "item_url"), ("catalog_stage", "item_url"), ("config", "url"))
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])


def touched(tb):
    """The staged rows published on top of tables in 64 buckets."""
    store = s.Snapshots(tb.spark, scratch(tb.spark, "buckets"))
    catalog = tb["catalog"].drop("poster_ref").withColumn("updated_at", F.expr("timestamp'2023-01-01 00:00:00'"))
    store.publish({"catalog": catalog, "variant": tb["variant"]}, bucketed={"catalog": ("slug", 64), "variant": ("item_id", 64)})
    stage, variant_stage = tb["catalog_stage"], tb["variant_stage"]
    pub.publish_touched(store, stage, variant_stage, F.expr(WHEN), on_dup="last")
    return store


@query("m1_publish_touched_catalog", CS, MERGED)
def _(tb):
    """The catalogue after a publish that writes the buckets of staged records only."""
    return touched(tb).read("catalog").withColumn("updated_us", us("updated_at")).drop("updated_at")


@query("m1_publish_touched_variants", ("variant", "variant_stage", "catalog_stage"), f"""
    with merged as ({MERGED}),
    kept as (select item_id, label, file_size, file_url_1, 0 as new from variant where item_id not in (
      select id from merged where slug in (select slug from catalog_stage))),
    placed as (select merged.id as item_id, label, file_size, file_url_1, 1 as new
               from variant_stage join merged using (item_url))
    select item_id, label, file_size, file_url_1 from (
      select *, row_number() over (partition by item_id, label order by new desc) as rn
      from (select * from kept union all select * from placed)) where rn = 1""")
def _(tb):
    """The variants after the same publish."""
    return touched(tb).read("variant").select("item_id", "label", "file_size", "file_url_1")


@query("m8_overwrite_variants", ("variant", "catalog_stage"), """
    select v.id, case when s.slug is null then v.file_size
                      when s.year % 3 = 0 then null else concat(s.year, '.50 MB') end as file_size,
           case when s.slug is null then v.file_url_1 else concat('/second', s.slug) end as file_url_1
    from variant v left join catalog_stage s on v.item_id = s.slug and v.label = 'HD'""")
def _(tb):
    stage = tb["catalog_stage"].select(F.col("slug").alias("item_id"), F.lit("HD").alias("label"), "year")
    size = F.when(F.col("year") % 3 != 0, F.concat("year", F.lit(".50 MB"))).when(F.col("year").isNull(), ".50 MB")
    first = stage.select("item_id", "label", F.lit(1).alias("pos"), F.lit("x").alias("file_size"),
                         F.lit("/first").alias("file_url_1"))
    second = stage.select("item_id", "label", F.lit(2).alias("pos"), size.alias("file_size"),
                          F.concat(F.lit("/second"), "item_id").alias("file_url_1"))
    return pub.overwrite_variants(tb["variant"], first.unionByName(second)).select("id", "file_size", "file_url_1")


@query("m11_rebase_urls", ("catalog", "config"), """
    select slug, case when poster_ref like 'http%' then poster_ref
                      else (select rtrim(url, '/') from config where key = 'base_3') || poster_ref end as poster_url
    from catalog""")
def _(tb):
    return pub.rebase_urls(tb["catalog"], tb["config"], key="base_3").select("slug", "poster_url")


@query("p10_guarded_refresh", VF, """
    with fresh as (select item_id, bool_and(coalesce(file_url_1, '') = '' and coalesce(view_url_1, '') = '') as none
                   from variant_file group by 1),
    last as (select item_id, label, arg_max_null(file_url_1, pos) as f from variant_file group by 1, 2)
    select o.o_orderkey as item_id, x.label, case when not none and l.item_id is not null then l.f else '/old' end as file_url_1
    from orders o join (select 'AF' as label union all select 'NO') x on true
    left join fresh on fresh.item_id = o_orderkey
    left join last l on l.item_id = o_orderkey and l.label = x.label""")
def _(tb):
    label = F.explode(F.array(F.lit("AF"), F.lit("NO")))
    stored = tb["orders"].select(F.col("o_orderkey").alias("item_id"), label.alias("label"), F.lit("/old").alias("file_url_1"))
    fresh = tb["variant_file"].select("item_id", "label", "pos", "file_url_1", "view_url_1")
    wide = stored.withColumn("view_url_1", F.lit(None).cast("string"))
    return pub.overwrite_variants(wide, fresh, guard=True).select("item_id", "label", "file_url_1")
