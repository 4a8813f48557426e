"""First, last, latest and largest per key; sections and limits.

All per-key choices are min_by/max_by aggregates: each task reduces a key to one row before the
shuffle, so a key with a third of the rows costs no more than another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import is_next_link


def _pick(df: DataFrame, keys, order, cols, best) -> DataFrame:
    cols = [c for c in (cols or df.columns) if c not in keys]
    rank = F.struct(*[c if isinstance(c, Column) else F.col(c) for c in order])
    return df.groupBy(*keys).agg(best(F.struct(*cols), rank).alias("__row")).select(*keys, "__row.*")


def first_per_key(df: DataFrame, keys, order, cols=None) -> DataFrame:
    """The first row per key in ``order``; NULL keys form a group of their own."""
    return _pick(df, keys, order, cols, F.min_by)


def last_per_key(df: DataFrame, keys, order, cols=None) -> DataFrame:
    return _pick(df, keys, order, cols, F.max_by)


def dedup_first_seen(links: DataFrame, url: str = "url", order=("page_no", "pos")) -> DataFrame:
    """Keep each URL where it was seen first. Filter before calling: rejected links must not count."""
    return first_per_key(links, [url], list(order)).select(*links.columns)


def first_match_per_page(links: DataFrame, page: str, where: Column, order=("pos",)) -> DataFrame:
    return first_per_key(links.filter(where), [page], list(order)).select(*links.columns)


def last_match_per_page(links: DataFrame, page: str, where: Column, order=("pos",)) -> DataFrame:
    return last_per_key(links.filter(where), [page], list(order)).select(*links.columns)


def latest_per_key(df: DataFrame, keys, at: str, cols=None, tie=()) -> DataFrame:
    """The newest row per key. A missing time counts as newest, as in a descending database sort."""
    order = [F.col(at).isNull(), F.col(at), *tie]
    cols = list(cols) if cols else df.columns
    return last_per_key(df, keys, order, [*cols, *([at] if at not in cols else [])])


def latest_one(df: DataFrame, at: str, tie=()) -> DataFrame:
    return df.orderBy(F.col(at).desc_nulls_first(), *[F.col(t).desc() for t in tie]).limit(1)


def last_write_per_key(df: DataFrame, keys, arrival, given: dict[str, Column] | None = None) -> DataFrame:
    """What a row of writes leaves behind: per key and column the last value given, NULL included."""
    order = F.struct(*[F.col(a) for a in arrival])
    cols = [c for c in df.columns if c not in keys and c not in arrival]
    last = [
        F.max_by(F.struct(c), F.when((given or {}).get(c, F.lit(True)), order))[c].alias(c)
        for c in cols
    ]
    return df.groupBy(*keys).agg(*last)


def distinct_urls(links: DataFrame, url: str = "url") -> DataFrame:
    return links.select(url).distinct()


def union_pages(*pages: DataFrame) -> DataFrame:
    out = pages[0]
    for page in pages[1:]:
        out = out.unionByName(page)
    return out


def section_year(name) -> Column:
    return F.nullif(F.regexp_extract(name, r"\d{4}", 0), F.lit("")).cast("int")


def sort_sections(sections: DataFrame, name: str = "name", pos: str = "pos") -> DataFrame:
    """Newest year first; equal years keep page order."""
    return sections.orderBy(section_year(name).desc_nulls_last(), F.col(pos).asc())


def pick_section(sections: DataFrame, mode: str, year: str | None, current_year: str,
                 name: str = "name", pos: str = "pos") -> DataFrame:
    """One section. Custom mode with a year must find it; else the current year or the newest."""
    custom = mode == "custom" and bool(year)
    wanted = F.col(name).contains(year if custom else current_year)
    ranked = sections.withColumn("__hit", wanted).orderBy(
        F.col("__hit").desc(), section_year(name).desc_nulls_last(), F.col(pos).asc()
    ).limit(1)
    if not custom:
        return ranked.drop("__hit")
    # One row at most is left: an aggregate turns "none" into a row that can raise.
    found = ranked.filter("__hit").drop("__hit")
    row = found.agg(F.first(F.struct(*found.columns)).alias("row"))
    checked = F.when(F.col("row").isNotNull(), F.col("row")).otherwise(
        F.raise_error(F.lit(f"no section for {year}")).cast(row.schema["row"].dataType)
    )
    return row.select(checked.alias("row")).select("row.*")


def page_limit(rows: DataFrame, mode: str, depth: str = "depth") -> DataFrame:
    """Quick mode reads the first page only."""
    return rows.filter(F.col(depth) <= 1) if mode == "quick" else rows


def next_work(queue: DataFrame, n: int) -> DataFrame:
    """The next pending rows: lowest priority number first, none last, then by URL."""
    return (
        queue.filter(F.col("status") == "pending")
        .orderBy(F.col("priority").asc_nulls_last(), F.col("url").asc(), F.col("id").asc())
        .limit(n)
    )


def next_links(anchors: DataFrame) -> DataFrame:
    """Per page the first pager link onwards; a link to the page itself ends the walk."""
    hit = first_match_per_page(anchors, "page_url", is_next_link("link_text", "href"))
    return hit.filter(F.col("abs_url") != F.col("page_url")).select(
        "page_url", F.col("abs_url").alias("next_url")
    )
