"""Text functions as column expressions; they follow JavaScript's string rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The code points of the white space that JavaScript's trim() and \s know.
_SPACE_POINTS = (
    0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF,
)
JS_SPACE = "".join(map(chr, _SPACE_POINTS))
_S = (
    r"[\t\n\x0B\f\r \xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
)
_REST_OF_LINE = r"[^\n\r\x{2028}\x{2029}]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is read."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _found(c: Column, pattern: str, group: int) -> Column:
    """The group, or NULL where nothing matched (regexp_extract gives '')."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def js_trim(c) -> Column:
    return F.btrim(_col(c), F.lit(JS_SPACE))


def remove_first(c, pattern: str) -> Column:
    """Remove the first match only; Spark's own regexp_replace removes all."""
    return F.regexp_replace(_col(c), f"^((?s:.*?))(?:{pattern})", "$1")


def strip_suffix(c, start: str) -> Column:
    """Cut from the first match of ``start`` up to the end of the text, any case."""
    return F.regexp_replace(_col(c), f"(?i){start}{_REST_OF_LINE}*\\z", "")


def page_title(h1, title) -> Column:
    """The trimmed heading; where that is empty, the title before the first pipe."""
    head = js_trim(F.coalesce(_col(h1), F.lit("")))
    other = js_trim(F.split_part(F.coalesce(_col(title), F.lit("")), F.lit("|"), F.lit(1)))
    return F.when(head != "", head).otherwise(other)


def year_in_parens(c) -> Column:
    return _found(_col(c), r"\((\d{4})\)", 1).cast("int")


def label_in_parens(c) -> Column:
    return _found(_col(c), r"\(([^)]+)\)", 1)


def item_name(title, tail: str) -> Column:
    """The title without its first year in parentheses and without a trailing phrase."""
    bare = remove_first(title, rf"{_S}*\(\d{{4}}\)")
    return js_trim(remove_first(bare, f"(?i:{tail})"))


def parse_size_mb(c, label: str = "File Size:") -> Column:
    """Megabytes after the label. 0 without a match, NaN where the number does not start well."""
    size = F.regexp_extract(_col(c), f"(?i){label}{_S}*([0-9.]+{_S}*[MG]B)", 1)

    def value(m):
        number = _found(m, r"^([0-9]+\.?[0-9]*|\.[0-9]+)", 1).cast("double")
        factor = F.when(F.upper(m).endswith("GB"), 1024.0).otherwise(1.0)
        return F.when(F.coalesce(m, F.lit("")) == "", F.lit(0.0)).otherwise(
            F.coalesce(number, F.lit(float("nan"))) * factor
        )

    return let(size, value)


def to_fixed_2(x) -> Column:
    """Two decimals, rounded half up on the exact binary value (1.005 gives 1.00)."""
    value = _col(x).cast("double")
    whole = F.floor(value)
    # The fraction times 2**62 is a whole number for every fraction that can round to 0.01.
    units = ((value - whole) * F.lit(2.0**62)).cast("bigint").cast("decimal(20,0)")
    hundredths = F.call_function(
        "div", units * F.lit(100) + F.lit(2**61), F.lit(2**62).cast("decimal(20,0)")
    )
    total = whole * 100 + hundredths
    return F.concat(
        F.floor(total / 100).cast("bigint").cast("string"),
        F.lit("."),
        F.lpad(F.pmod(total, F.lit(100)).cast("string"), 2, "0"),
    )


def fmt_size(mb) -> Column:
    """``1515.52 MB``; NULL for sizes that are not above zero (Spark holds NaN above all)."""
    x = _col(mb)
    return F.when((x > 0) & ~F.isnan(x), F.concat(to_fixed_2(x), F.lit(" MB")))


def duration_text(c, label: str = "Duration:") -> Column:
    """The rest of the line after the label; NULL without the label or without a value."""
    text = _col(c)
    return F.when(
        text.contains(label),
        F.nullif(
            js_trim(F.regexp_extract(text, f"(?i){label}{_S}*({_REST_OF_LINE}+)", 1)),
            F.lit(""),
        ),
    )


def _split_trim(c, pattern: str) -> Column:
    return F.transform(F.split(_col(c), pattern), lambda x: js_trim(x))


def split_people(c) -> Column:
    """Split on comma, pipe and ampersand; empty parts stay."""
    return _split_trim(c, "[,|&]")


def split_genres(c) -> Column:
    return _split_trim(c, ",")


def singleton(c) -> Column:
    """A one-element array; NULL stays NULL."""
    return F.when(_col(c).isNotNull(), F.array(_col(c)))


def clean_rating(c) -> Column:
    return remove_first(c, "/10")


def rating_value(c) -> Column:
    """Typed view of a rating text; NULL where it is no number."""
    return js_trim(clean_rating(c)).try_cast("double")


def strip_label(c, label: str) -> Column:
    return F.nullif(js_trim(remove_first(c, f"(?i:{label})")), F.lit(""))


def contains_label(text, label, whole_word: bool = False) -> Column:
    """Case-sensitive; without ``whole_word`` the label ``Server 1`` also finds ``Server 10``."""
    if whole_word:
        return _col(text).rlike(rf"\Q{label}\E\b")
    return _col(text).contains(label)


def is_next_link(text, href) -> Column:
    word = js_trim(text)
    target = _col(href)
    return (
        (F.lower(word).contains("next") | (word == "»"))
        & target.isNotNull()
        & ~target.isin("", "#")
    )


def coalesce_src(source, video) -> Column:
    """The source's address unless empty, else the video's; empty counts as none."""
    return F.coalesce(F.nullif(_col(source), F.lit("")), F.nullif(_col(video), F.lit("")))


def payload_present(payload, kind: str = "value") -> Column:
    """Whether a stored payload is a result. NULL is none, an empty list is one.

    ``kind`` tells how it is stored: a typed ``value``, a ``variant``, or ``json`` text. Of the last two, what a script would take for
    nothing is no result: null, false, 0 and empty text; text that is no JSON is none either.
    """
    if kind == "value":
        return _col(payload).isNotNull()
    value = F.try_parse_json(_col(payload)) if kind == "json" else _col(payload)
    held = F.schema_of_variant(value)
    return F.coalesce(
        F.when(held == "VOID", False)
        .when(held == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(held == "STRING", F.try_variant_get(value, "$", "string") != "")
        .when(held.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(value, "$", "double") != 0)
        .when(held.isNotNull(), True),
        F.lit(False),
    )


def payload_kind(df, payload: str) -> str:
    """How the column is stored, for ``payload_present``."""
    return {"string": "json", "variant": "variant"}.get(df.schema[payload].dataType.simpleString(), "value")


def minutes_ago(now, then) -> Column:
    return F.floor((F.unix_micros(now) - F.unix_micros(then)) / F.lit(60_000_000))


def run_label(mode, year, trigger) -> Column:
    """``custom-<year>`` for a custom run with a year, else who triggered it."""
    return F.when(
        (_col(mode) == "custom") & (F.coalesce(_col(year), F.lit("")) != ""),
        F.concat(F.lit("custom-"), _col(year)),
    ).otherwise(_col(trigger))


def cutoff(as_of, minutes: int) -> Column:
    return _col(as_of) - F.expr(f"INTERVAL {int(minutes)} MINUTES")
