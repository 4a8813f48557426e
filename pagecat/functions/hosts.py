"""Host names of http-like addresses in normal form, as column expressions: names, numeric hosts, IPv6, Punycode.

They follow the web's URL rules, with these limits: a host with percent signs is none, letters outside ASCII are made small but not
composed (NFC), and full-width ASCII is the only compatibility form that is folded.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import let

# Fixed values of the Bootstring code for host names.
_BASE, _T_MIN, _T_MAX, _SKEW, _DAMP, _BIAS, _FIRST = 36, 1, 26, 38, 700, 72, 128
_DIGITS = "abcdefghijklmnopqrstuvwxyz0123456789"

_BYTE = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_DOTS = "。．｡"
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F) if c != 0xFF0E)
_NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F) if c != 0xFF0E)
_IGNORED = "­​⁠﻿"


def _long(value) -> Column:
    return F.lit(value).cast("bigint")


def _div(a: Column, b) -> Column:
    return F.floor(a / b)


def _number(part: Column) -> Column:
    """A decimal, octal (0…) or hexadecimal (0x…) number below 2^36; NULL for what is none."""
    return (
        F.when(part.rlike("^0x0*[0-9a-f]{0,8}$"), F.conv(F.concat(F.lit("0"), F.substring(part, 3, 1 << 20)), 16, 10))
        .when(part.rlike("^0+[1-7]?[0-7]{0,10}$"), F.conv(part, 8, 10))
        .when(part.rlike("^[1-9][0-9]{0,9}$"), part)
        .cast("bigint")
    )


def _ipv4(host: Column) -> Column:
    """A host whose last part is a number is an address of four bytes; the last number fills the bytes that are left."""
    places = F.array(*[_long(256**k) for k in (3, 2, 1, 0)])
    rooms = F.array(*[_long(256**k) for k in (4, 3, 2, 1)])

    def written(nums: Column) -> Column:
        n = F.size(nums)
        fits = F.forall(F.transform(nums, lambda x, i: x < F.when(i == n - 1, F.element_at(rooms, n)).otherwise(_long(256))), lambda ok: ok)
        value = F.aggregate(
            F.transform(nums, lambda x, i: F.when(i == n - 1, x).otherwise(x * F.element_at(places, i + 1))), _long(0), lambda a, x: a + x)
        dotted = let(value, lambda v: F.concat_ws(".", *[F.pmod(_div(v, 256**k), _long(256)).cast("string") for k in (3, 2, 1, 0)]))
        return F.when((n <= 4) & F.forall(nums, lambda x: x.isNotNull()), F.when(fits, dotted))

    return let(F.transform(F.split(host, r"\."), _number), written)


def _ipv6(host: Column) -> Column:
    """An address in brackets: eight groups, the first longest run of two or more zeros as ``::``; NULL for what is none."""
    inner = F.regexp_replace(host, r"^\[|\]$", "")
    tail = lambda s: F.split(F.substring_index(s, ":", -1), r"\.")
    pair = lambda b, i: F.lower(F.hex(b[i].cast("bigint") * 256 + b[i + 1].cast("bigint")))
    # Four bytes at the end stand for two groups.
    plain = let(inner, lambda s: F.when(
        s.rlike(rf":{_BYTE}(?:\.{_BYTE}){{3}}$"),
        let(tail(s), lambda b: F.concat(F.regexp_extract(s, r"^(.*:)[^:]*$", 1), pair(b, 0), F.lit(":"), pair(b, 2)))
    ).otherwise(s))

    def groups(half: Column) -> Column:
        return F.when(half == "", F.array().cast("array<string>")).otherwise(F.split(half, ":"))

    def filled(halves: Column) -> Column:
        left, right = groups(halves[0]), F.when(F.size(halves) == 2, groups(F.get(halves, F.lit(1)))).otherwise(F.array().cast("array<string>"))
        missing = 8 - F.size(left) - F.size(right)
        right_count = F.when(F.size(halves) == 2, missing > 0).otherwise(missing == 0)
        return F.when((F.size(halves) <= 2) & right_count, F.concat(left, F.array_repeat(F.lit("0"), missing), right))

    def shortened(text: Column) -> Column:
        out = F.lit(None).cast("string")
        for k in range(8, 1, -1):
            run = rf"^((?:[0-9a-f]+:)*?)0(?::0){{{k - 1}}}(?=:|$)(.*)$"
            before, after = F.regexp_extract(text, run, 1), F.regexp_extract(text, run, 2)
            short = F.concat(F.when(before == "", ":").otherwise(before), F.when(after == "", ":").otherwise(after))
            out = F.coalesce(out, F.when(text.rlike(run), short))
        return F.concat(F.lit("["), F.coalesce(out, text), F.lit("]"))

    def written(all_: Column) -> Column:
        good = F.forall(all_, lambda g: g.rlike("^[0-9a-f]{1,4}$"))
        return F.when(good, let(F.array_join(F.transform(all_, lambda g: F.regexp_replace(g, "^0+(?=.)", "")), ":"), shortened))

    return let(plain, lambda s: let(let(F.split(s, "::"), filled), written))


def _digits(delta: Column, bias: Column) -> Column:
    """A number as variable-length digits, the smallest place first."""
    def place(state, j):
        t = F.greatest(_long(_T_MIN), F.least(_long(_T_MAX), j * _BASE - bias))
        last = state["q"] < t
        digit = F.when(last, state["q"]).otherwise(t + F.pmod(state["q"] - t, _BASE - t))
        return F.when(state["done"], state).otherwise(F.struct(
            F.when(last, state["q"]).otherwise(_div(state["q"] - t, _BASE - t)).alias("q"),
            F.concat(state["out"], F.substring(F.lit(_DIGITS), digit.cast("int") + 1, F.lit(1))).alias("out"), last.alias("done")))

    start = F.struct(delta.alias("q"), F.lit("").alias("out"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(_long(1), _long(12)), start, place, lambda s: s["out"])


def _adapted(delta: Column, points: Column, first: Column) -> Column:
    """The bias for the next number."""
    begun = let(F.when(first, _div(delta, _DAMP)).otherwise(_div(delta, 2)), lambda d: d + _div(d, points))
    limit = (_BASE - _T_MIN) * _T_MAX // 2

    def halve(state, _):
        return F.when(state["d"] > limit, F.struct(_div(state["d"], _BASE - _T_MIN).alias("d"), (state["k"] + _BASE).alias("k"))).otherwise(state)

    end = lambda s: s["k"] + _div(s["d"] * (_BASE - _T_MIN + 1), s["d"] + _SKEW)
    return F.aggregate(F.sequence(_long(1), _long(8)), F.struct(begun.alias("d"), _long(0).alias("k")), halve, end)


def punycode(label: Column) -> Column:
    """One label in Bootstring, without the prefix.

    A decoder inserts the characters outside ASCII by code point, then place; so the distance between two insertions follows from
    their code points and their places among the characters that are there by then.
    """
    codes = F.transform(F.sequence(F.lit(1), F.char_length(label)), lambda i: F.ascii(F.substring(label, i, F.lit(1))).cast("bigint"))

    def spelled(cps: Column) -> Column:
        basic = F.filter(cps, lambda c: c < _FIRST)
        placed = F.array_sort(F.filter(F.transform(cps, lambda c, i: F.struct(c.alias("m"), i.alias("at"))), lambda s: s["m"] >= _FIRST))
        # The place of each among those with smaller or equal code points before it.
        ins = F.transform(placed, lambda s: F.struct(
            s["m"].alias("m"), F.size(F.filter(F.slice(cps, F.lit(1), s["at"]), lambda c: c <= s["m"])).cast("bigint").alias("i")))
        b = F.size(basic).cast("bigint")

        def deltas(all_: Column) -> Column:
            def one(s, k):
                before = F.get(all_, k - 1)
                n, i = F.coalesce(before["m"], _long(_FIRST)), F.coalesce(before["i"] + 1, _long(0))
                return F.struct(((s["m"] - n) * (b + k + 1) + s["i"] - i).alias("d"), k.cast("bigint").alias("k"))
            return F.transform(all_, one)

        def add(state, x):
            return F.struct(_adapted(x["d"], b + x["k"] + 1, x["k"] == 0).alias("bias"),
                            F.concat(state["out"], _digits(x["d"], state["bias"])).alias("out"))

        start = F.struct(_long(_BIAS).alias("bias"), F.lit("").alias("out"))
        plain = F.array_join(F.transform(basic, lambda c: F.char(c)), "")
        return F.concat(plain, F.when(b > 0, "-").otherwise(""), F.aggregate(let(ins, deltas), start, add, lambda s: s["out"]))

    return let(codes, spelled)


def normal_host(host: Column) -> Column:
    """The host of an http-like address as browsers write it; NULL for one that no address may have.

    Letters become small, labels with others than ASCII letters become Punycode, numeric hosts four bytes, IPv6 addresses their
    shortest form. Plain names pay two patterns.
    """
    # Capital sigma becomes the medial one wherever it stands; the three other full stops part labels.
    given = F.translate(host, _DOTS + _WIDE + "Σ" + _IGNORED, "..." + _NARROW + "σ")
    ascii_ = F.when(host.rlike(r"^[\x21-\x7e]*$"), F.lower(host)).otherwise(let(F.lower(given), lambda h: F.array_join(F.transform(
        F.split(h, r"\."), lambda x: F.when(x.rlike(r"^[\x21-\x7e]*$"), x).otherwise(F.concat(F.lit("xn--"), punycode(x)))), ".")))
    return let(ascii_, lambda h: (
        F.when(h.startswith("["), _ipv6(h))
        .when((h == "") | h.rlike(r"[\s#/<>?@\[\\\]^|%:\x00-\x20\x7f]"), F.lit(None).cast("string"))
        .when(h.rlike(r"(?:^|\.)(?:[0-9]+|0x[0-9a-f]*)\.?$"), _ipv4(F.regexp_replace(h, r"\.$", "")))
        .otherwise(h)
    ))
