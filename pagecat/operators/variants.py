"""Variants of an item: size choice, first duration, key/value pivots, ordered lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import duration_text, parse_size_mb

# Which label text feeds which field.
INFO_FIELDS = {
    "director": "director",
    "cast_members": "starring",
    "genres": "genres",
    "rating": "movie rating",
    "language": "language",
    "type": "quality",
    "last_updated": "last updated",
}


def largest_variant(files: DataFrame, key: str, size: str = "size_mb", pos: str = "pos",
                    href: str = "url") -> DataFrame:
    """Per key the largest file; the first of equals, size 0 counts, NaN and missing links never win."""
    x = F.col(size)
    fit = (F.coalesce(F.col(href), F.lit("")) != "") & ~F.isnan(x) & (x > -1)
    # The test sits inside the aggregate: as a filter it would compute the size a second time.
    best = F.max_by(F.struct(href, size, pos), F.when(fit, F.struct(x, -F.col(pos))))
    return files.groupBy(key).agg(best.alias("__v")).filter("__v IS NOT NULL").select(key, "__v.*")


def largest_in_page(files, label: str = "File Size:") -> Column:
    """The same choice over one page's array of files: struct(size_mb, href) or NULL."""
    sized = F.transform(
        F.col(files) if isinstance(files, str) else files,
        lambda f: F.struct(
            parse_size_mb(
                F.coalesce(
                    F.try_element_at(F.filter(f["lines"], lambda x: x.contains(label)), F.lit(-1)),
                    F.lit(""),
                ),
                label,
            ).alias("size_mb"),
            (-f["pos"]).alias("rank"),
            f["href"].alias("href"),
        ),
    )
    return F.array_max(
        F.filter(sized, lambda f: (F.coalesce(f["href"], F.lit("")) != "") & ~F.isnan(f["size_mb"]))
    )


def last_duration(probes, label: str = "Duration:") -> Column:
    """The last probed text that has a value."""
    found = F.transform(probes, lambda p: duration_text(p, label))
    return F.try_element_at(F.filter(found, lambda d: d.isNotNull()), F.lit(-1))


def first_non_null(rows: DataFrame, key: str, value: str, pos: str) -> DataFrame:
    """The first value that is neither NULL nor empty, in ``pos`` order; keys without one give NULL."""
    real = F.nullif(F.col(value), F.lit(""))
    return rows.groupBy(key).agg(F.min_by(real, F.when(real.isNotNull(), F.col(pos))).alias(value))


def pivot_last_wins(pairs: DataFrame, key: str, fields: dict[str, str] | None = None,
                    label: str = "k", value: str = "v", pos: str = "pos") -> DataFrame:
    """One row per key: for every field the value of its last matching label."""
    fields = fields or INFO_FIELDS
    return pairs.groupBy(key).agg(*[
        F.max_by(value, F.when(F.lower(label).contains(text), F.col(pos))).alias(name)
        for name, text in fields.items()
    ])


def pivot_in_page(info: str, fields: dict[str, str] | None = None) -> dict[str, Column]:
    """The same choice over one page's array of pairs."""
    return {
        name: F.try_element_at(
            F.filter(F.col(info), lambda p: F.lower(p["k"]).contains(text)), F.lit(-1)
        )["v"]
        for name, text in (fields or INFO_FIELDS).items()
    }


def collect_variants(rows: DataFrame, key: str, fields, pos: str = "pos", label: str = "label",
                     out: str = "payload") -> DataFrame:
    """All variants of each item as an ordered array of structs, repeated labels included.

    What one item's page lists becomes one row; the page bounds it.
    """
    entry = F.struct(F.col(pos).alias("pos"), F.col(label).alias("label"), *[F.col(f) for f in fields])
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("__all")).select(
        key,
        F.transform(
            "__all", lambda e: F.struct(e["label"].alias("label"), *[e[f].alias(f) for f in fields])
        ).alias(out),
    )
