"""A captured site made from the supplier table: listing, item, list, quality, file, server and player pages.

One item per supplier, so the number of pages grows with the table. The numbers decide what is missing:
k % 10 = 9 has no list, k % 13 = 0 no server links, k % 4 = 0 no second server, k % 7 = 0 no first final page,
k % 9 = 0 no captured first player page.
"""

from pyspark.sql import functions as F

from pagecat.operators.predicates import Noise
from pagecat.plans.extract import Labels
from pagecat.session import scratch
from pagecat.sources.html import parse_pages

ROOT = "https://site.example.com"
HOME = f"{ROOT}/"

# What this site calls things.
LABELS = Labels(*[{b: f"{kind}{b}" for b in (1, 2)} for kind in ("Server ", "File Server ", "View Server ")])
SERIES = "web-series"
NOISE = (Noise("web series", "any"),)
TITLES = {"title_end": " Full Download", "synopsis_label": "Synopsis:"}

ITEM_PAGES = f"""
    with item as (
      select s_suppkey as k, cast(s_suppkey as string) as s, s_name, s_nationkey, cast(1990 + s_suppkey % 35 as string) as y
      from supplier),
    variant as (select *, explode(sequence(1, int(1 + k % 3))) as i from item where k % 10 <> 9),
    branch as (select *, explode(array(1, 2)) as b from variant)
    select concat('{ROOT}/item/', s, '/') as url,
      concat('<html><head><title>', s_name, ' | Site</title></head><body>',
        case when k % 5 = 0 then '<h1> </h1>' else concat('<h1>', s_name, ' (', y, ') Full Download HD</h1>') end,
        '<picture>', case when k % 2 = 0 then concat('<source srcset="https://img.example.com/p/', s, '.webp 2x">') else '' end,
        '<img src="/p/', s, '.jpg?x=1"></picture>',
        '<ul class="info"><li><strong>Director:</strong> <span>First &amp; ', s, '</span>',
        '<li><strong>Starring:</strong> <span>A ', s, ', B|C &amp; D</span></li>',
        '<li><strong>Genres:</strong><span>G', cast(s_nationkey as string), ' ,  Drama</span></li>',
        '<li><strong>Movie Rating:</strong><span> ', cast(k % 10 as string), '.5/10</span></li>',
        '<li><strong>Language:</strong><span>L', cast(k % 4 as string), '</span></li>',
        '<li><strong>Run Time:</strong><span> ', cast(60 + k % 60 as string), ' min </span></li>',
        case when k % 6 = 0 then concat('<li><strong>DIRECTOR:</strong> <span>Second ', s, '</span></li>') else '' end,
        '</ul><div class="synopsis"><span>Synopsis:</span> About ', s, '.</div>',
        '<div class="entry"><img src="/i/info.svg"><a href="/about">About</a></div>',
        case when k % 10 <> 9 then concat('<div class="entry"><img src="/i/folder.svg"><a href="/list/', s, '/">All</a></div>')
             else '' end, '</body></html>') as html
    from item
    union all
    select concat('{ROOT}/list/', s, '/'),
      concat('<body>', array_join(transform(sequence(1, int(1 + k % 3)), i -> concat(
        '<div class="box entry"><img src="/i/folder.svg"><a href="/q/', s, '/', cast(i as string), '/">', s_name,
        ' (Q', cast(i as string), ')</a></div>')), ''),
        '<div class="entry"><img src="/i/folder.svg"><a href="/z/">No label</a></div>',
        '<div class="entry"><img src="/i/folder.svg"><a>(No link)</a></div></body>')
    from item where k % 10 <> 9
    union all
    select concat('{ROOT}/q/', s, '/', cast(i as string), '/'),
      concat('<div class="file"><ul><li><a href="/file/', s, '-', cast(i as string), '-1/">f1</a><li>File Size: ',
        cast(100 + k % 50 as string), ' MB<li>Format: Mp4</ul></div>',
        '<div class="file"><ul><li><a href="/other/">x</a> <a href="/file/', s, '-', cast(i as string), '-2/">f2</a></li>',
        '<li>File Size: ', case when (k + i) % 2 = 0 then '1.5 GB' else '90 MB' end, '</li></ul></div>',
        '<div class="file"><li>File Size: 9 GB</li></div>')
    from variant
    union all
    select concat('{ROOT}/file/', s, '-', cast(i as string), '-', cast(j as string), '/'),
      concat('<div class="details">Name<br>\nDuration: ', cast(i as string), 'h ', cast(k % 60 as string), 'm \nEnd</div>',
        case when k % 13 = 0 then '' else concat(
          '<div class="links"><a href="/s/', s, '-', cast(i as string), '-1/">Server 1</a>',
          case when k % 4 = 0 then '' else concat('<a href="../../s/', s, '-', cast(i as string), '-2/">Server 2</a>') end,
          '</div>') end)
    from (select *, explode(array(1, 2)) as j from variant)
    union all
    select concat('{ROOT}/s/', s, '-', cast(i as string), '-', cast(b as string), '/'),
      concat('<p class="links"><a href="/d/', s, '-', cast(i as string), '-', cast(b as string),
        '/"><b>File</b> Server ', cast(b as string), '</a></p>') from branch
    union all
    select concat('{ROOT}/d/', s, '-', cast(i as string), '-', cast(b as string), '/'),
      concat('<div class="links"><a href="https://cdn.example.com/', s, '.mp4?b=', cast(b as string), '&amp;q=', cast(i as string),
        '">File Server ', cast(b as string), '</a><a href="/w/', s, '-', cast(i as string), '-', cast(b as string),
        '/">View Server ', cast(b as string), '</a></div>')
    from branch where not (k % 7 = 0 and b = 1)
    union all
    select concat('{ROOT}/w/', s, '-', cast(i as string), '-', cast(b as string), '/'),
      concat('<video src="v', s, '.mp4">', case when k % 2 = 0 then concat('<source src="s', s, '-', cast(i as string), '.m3u8">') else '' end,
        '</video>') from branch where not (k % 9 = 0 and b = 1)"""

# 40 sections of the home page, 25 items a page, as many pages as the table needs.
LISTING_PAGES = f"""
    with item as (
      select s_suppkey as k, s_suppkey % 40 as sec, cast(floor(s_suppkey / 1000) as int) + 1 as page,
             s_name, s_suppkey from supplier),
    pages as (
      select sec, page, sort_array(collect_list(struct(k, s_name))) as items from item group by sec, page),
    home as (select explode(sequence(0, 39)) as n)
    select '{HOME}' as url, array_join(sort_array(collect_list(concat('<div class="entry"><img src="folder.svg"><a href="/section/',
      cast(n as string), '/1/"> Films of ', cast(1985 + n as string), '</a></div>'))), '') as html from home
    union all
    select concat('{ROOT}/section/', cast(sec as string), '/', cast(page as string), '/'),
      concat(array_join(transform(items, x -> concat('<div class="entry"><img src="/i/folder.svg"><a href="/item/', cast(x.k as string), '/">',
        x.s_name, case when x.k % 11 = 0 then ' Web Series' else '' end, '</a></div>')), ''),
        '<div class="entry"><img src="/i/folder.svg"><a href="/item/', cast(items[0].k as string), '/">Again</a></div>',
        '<div class="pager"><a href="#">Next</a><a href="../', cast(page + 1 as string), '/">next page</a></div>')
    from pages"""


def site(tb, listing=False):
    """(url, html) of the made-up site."""
    tb["supplier"].createOrReplaceTempView("supplier")
    return tb.spark.sql(LISTING_PAGES if listing else ITEM_PAGES)


def parsed_site(tb, listing=False):
    """The parsed pages as a stored table: each step then reads only the columns it needs."""
    path = scratch(tb.spark, "parsed")
    pages = site(tb, listing).repartition(tb.spark.sparkContext.defaultParallelism, "url")
    parse_pages(pages).write.parquet(path)
    return tb.spark.read.parquet(path)


def queue(tb):
    """Every supplier as a work item; k % 17 = 0 is a series, k % 19 = 0 was never captured."""
    k = F.col("s_suppkey")
    kind = F.when(k % 17 == 0, "/Web-Series/").when(k % 19 == 0, "/lost/").otherwise("/item/")
    return tb["supplier"].select(
        k.cast("string").alias("id"), F.concat(F.lit(ROOT), kind, k, F.lit("/")).alias("url"), k.alias("k")
    )
