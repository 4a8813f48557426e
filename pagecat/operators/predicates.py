"""Filters on links, pages and rows. Noise and skip rules are parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Noise:
    """A pattern (any case) that marks a link as no item, tested on its name, its url or either."""

    pattern: str
    on: str = "name"

    def hits(self, name: Column, url: Column) -> Column:
        test = f"(?iu){self.pattern}"
        by_name, by_url = name.rlike(test), url.rlike(test)
        return {"name": by_name, "url": by_url, "any": by_name | by_url}[self.on]



def is_section_link(name: str = "anchor_text", href: str = "href", icon: str = "has_icon") -> Column:
    """A linked block with the marker icon and a four-digit number in its text."""
    return (F.coalesce(F.col(href), F.lit("")) != "") & F.col(icon) & F.col(name).rlike(r"\d{4}")


def is_item_link(noise=(), name: str = "anchor_text", url: str = "abs_url",
                 href: str = "href", icon: str = "has_icon") -> Column:
    """A linked block with the marker icon that no noise rule hits."""
    keep = (F.coalesce(F.col(href), F.lit("")) != "") & F.col(icon)
    for rule in noise:
        hit = rule.hits(F.coalesce(F.col(name), F.lit("")), F.coalesce(F.col(url), F.lit("")))
        keep = keep & ~hit
    return keep


def skip_rule(url: str = "url", pattern: str | None = None) -> Column:
    """URLs that are skipped before any other work; without a pattern none is."""
    if pattern is None:
        return F.lit(False)
    return F.coalesce(F.col(url).rlike(f"(?i){pattern}"), F.lit(False))


def has_no_result(file_url: str = "file_url_1", view_url: str = "view_url_1") -> Column:
    """Neither primary address; the empty text counts as none, backup addresses do not count."""
    empty = F.lit("")
    return (F.coalesce(F.col(file_url), empty) == "") & (F.coalesce(F.col(view_url), empty) == "")


def group_has_no_result(df, key, file_url: str = "file_url_1", view_url: str = "view_url_1"):
    """(key, no_result): true where every variant of the item lacks both."""
    return df.groupBy(key).agg(F.bool_and(has_no_result(file_url, view_url)).alias("no_result"))


def status_in(col: str, values) -> Column:
    return F.col(col).isin(*values)


def since(col: str, cutoff) -> Column:
    """At or after the bound."""
    return F.col(col) >= cutoff


def is_full_ref(col: str) -> Column:
    """Starts with http; nothing more is tested."""
    return F.col(col).startswith("http")


def href_contains(fragment: str, col: str = "href") -> Column:
    return F.col(col).contains(fragment)
