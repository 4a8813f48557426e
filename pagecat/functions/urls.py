"""URL functions as column expressions: resolution, path, origin, relative references.

They follow the web's URL rules for http-like addresses (lower-case scheme and host, no default
port, dot segments removed, unsafe characters percent-encoded). Host names stay as written apart
from case: there is no punycode step.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .hosts import normal_host
from .text import _col, js_trim, let

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
_PARTS = (
    r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*)://(?:[^/?#@]*@)?(\[[0-9A-Fa-f:.]+\]|[^/?#:\s<>\\^|%\[\]]+)(?::([0-9]*))?"
    r"([^?#]*)(\?[^#]*)?(#.*)?\z"
)
_CUT = "\x01"

# Characters a path, a query and a fragment keep unescaped.
_KEEP_PATH = r"[!$%&'()*+,\-./0-9:;=@A-Z\[\\\]_a-z|~]"
_KEEP_QUERY = r"[!$%&()*+,\-./0-9:;=?@A-Z\[\\\]^_`a-z{|}~]"
_KEEP_FRAGMENT = r"[!#$%&'()*+,\-./0-9:;=?@A-Z\[\\\]^_a-z{|}~]"


def _escape(part: Column, keep: str) -> Column:
    """Percent-encode the UTF-8 bytes of every character outside ``keep``; most parts need none."""
    safe = part.rlike(f"(?s)^{keep}*\\z")
    spelled = F.transform(
        F.split(part, ""),
        lambda ch: F.when(ch.rlike(f"(?s)^{keep}*\\z"), ch).otherwise(
            F.regexp_replace(F.hex(F.encode(ch, "UTF-8")), "(..)", "%$1")
        ),
    )
    return F.when(safe, part).otherwise(F.array_join(spelled, ""))


def _no_dots(path: Column) -> Column:
    """Remove ``.`` and ``..`` segments. Only paths that have some pay for the fold."""
    folded = F.aggregate(
        F.slice(F.split(path, "/"), 2, F.length(path)),
        F.array().cast("array<string>"),
        lambda done, seg: F.when(seg == ".", done)
        .when(seg == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(seg))),
        lambda done: F.concat(
            F.lit("/"),
            F.array_join(done, "/"),
            F.when(path.rlike(r"/\.{1,2}\z") & (F.size(done) > 0), "/").otherwise(""),
        ),
    )
    return F.when(path.rlike(r"/\.{1,2}(/|\z)"), folded).otherwise(path)


def _clean(url) -> Column:
    """Strip outer white space and drop tabs and line breaks inside."""
    return F.translate(js_trim(url), "\t\n\r" + _CUT, "")


def _parts(url: Column) -> Column:
    """Scheme, host, port, path, query and fragment by one match; one element for what is no full address."""
    return F.split(F.regexp_replace(url, _PARTS, _CUT.join(f"${i}" for i in range(1, 7))), _CUT)


def _path(p: Column) -> Column:
    raw = F.translate(p[3], "\\", "/")
    return F.when(raw == "", F.lit("/")).otherwise(let(_no_dots(raw), lambda x: _escape(x, _KEEP_PATH)))


def _port(p: Column) -> Column:
    """The port with its colon, nothing for the scheme's own; NULL for one beyond 65535."""
    port = F.regexp_replace(p[2], "^0+(?=[0-9])", "")
    own = F.concat(F.lower(p[0]), port).isin("http80", "https443") | (port == "")
    fits = port.rlike("^[0-9]{1,5}$") & (port.try_cast("int") <= 65535)
    return F.when(own, F.lit("")).when(fits, F.concat(F.lit(":"), port))


def _origin(p: Column) -> Column:
    return F.concat(F.lower(p[0]), F.lit("://"), normal_host(p[1]), _port(p))


def _full(p: Column) -> Column:
    return F.size(p) == 6


def url_path(url) -> Column:
    """The path with its leading slash; NULL for an address that is none."""
    return let(_parts(_clean(url)), lambda p: F.when(_full(p) & _origin(p).isNotNull(), _path(p)))


def url_origin(url) -> Column:
    """Scheme, host and a port that is not the scheme's own; NULL for an address that is none."""
    return let(_parts(_clean(url)), lambda p: F.when(_full(p), _origin(p)))


def _joined(base: Column, ref: Column) -> Column:
    """The reference laid over its base, before the result is put in normal form."""
    no_fragment = F.substring_index(base, "#", 1)
    no_query = F.substring_index(no_fragment, "?", 1)
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(no_query, r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*://[^/]*/(?:.*/)?)", 1)
    return (
        F.when(ref.startswith("//"), F.concat(F.regexp_extract(base, _SCHEME, 0), ref))
        .when(ref.startswith("/"), F.concat(root, ref))
        .when(ref.rlike(_SCHEME), ref)
        .when(ref == "", no_fragment)
        .when(ref.startswith("?"), F.concat(no_query, ref))
        .when(ref.startswith("#"), F.concat(no_fragment, ref))
        .when(folder == "", F.concat(root, F.lit("/"), ref))
        .otherwise(F.concat(folder, ref))
    )


def _normal(url: Column) -> Column:
    def spelled(p):
        query = F.when(p[4] == "", F.lit("")).otherwise(_escape(p[4], _KEEP_QUERY))
        fragment = F.when(p[5] == "", F.lit("")).otherwise(_escape(p[5], _KEEP_FRAGMENT))
        # mailto: and the like have no host and stay as written
        other = F.when(p[0].rlike(_SCHEME) & ~p[0].rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), p[0])
        return F.when(_full(p), F.concat(_origin(p), _path(p), query, fragment)).otherwise(other)

    return let(_parts(url), spelled)


def url_resolve(base, ref) -> Column:
    """The full address of ``ref`` as seen from ``base``; NULL for a NULL and for what is no address."""
    return let(_clean(base), lambda b: let(_clean(ref), lambda r: _normal(_joined(b, r))))


@lru_cache(maxsize=32)
def _resolved(session: SparkSession, base: str, ref: str) -> Column:
    """Built once for a session: the expression is so large that writing it down takes a second."""
    return url_resolve(base, ref)


def with_resolved(df: DataFrame, base: str, ref: str, out: str = "abs_url") -> DataFrame:
    return df.withColumn(out, _resolved(df.sparkSession, base, ref))


def poster_ref(srcset, src) -> Column:
    """First image address up to a space; full addresses become paths, others stay as they are."""
    image = F.coalesce(
        F.nullif(_col(srcset), F.lit("")), F.nullif(_col(src), F.lit(""))
    )
    return let(
        F.substring_index(image, " ", 1),
        lambda x: F.when(x.startswith("http"), F.coalesce(url_path(x), x)).otherwise(x),
    )


def rebase(base, ref) -> Column:
    """A stored relative reference put on the current base address; full ones stay."""
    r = _col(ref)
    return F.when(r.startswith("http"), r).otherwise(
        F.concat(F.regexp_replace(_col(base), r"/+\z", ""), r)
    )
