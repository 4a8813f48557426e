"""Secret scans: a keyword automaton, anchored patterns near its hits, embedded checksums."""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Order of kinds at one start.
KINDS = ("assign", "access", "hex", "github", "npm")

# Published token prefixes, lengths and the alphabet of their checksums.
GITHUB = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")
NPM = ("npm_",)
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"(?:gh[pousr]_|npm_)([0-9A-Za-z]{36})(?![0-9A-Za-z])")
_LOWER = {c: c + 32 for c in range(65, 91)}


def checksum(body: str) -> str:
    """CRC-32 of the random part in base 62, six characters."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = BASE62[r] + out
    return out


@lru_cache(1)
def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for kind, words in (("assign", KEYWORDS), ("access", ("akia",)), ("github", GITHUB), ("npm", NPM)):
        for word in words:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def _lower(text: str) -> str:
    """A-Z only; no other letter may change its length or turn into one of a keyword."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


def scan(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) by start, then kind. Per kind leftmost and non-overlapping; also a match that fails its test uses its characters."""
    out = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    free = dict.fromkeys(KINDS, 0)
    # Hits come by their end; of one kind, a longer keyword that starts earlier must be tried first.
    hits = sorted((end + 1 - length, kind) for end, (kind, length) in _automaton().iter(_lower(text)))
    for start, kind in hits:
        if start < free[kind]:
            continue
        pattern = ASSIGN if kind == "assign" else ACCESS if kind == "access" else TOKEN
        m = pattern.match(text, start)
        if not m:
            continue
        free[kind] = m.end()
        if kind == "assign":
            good = len(m[2]) >= 6
        elif kind == "access":
            good = m.end() - start >= 20
        else:
            before = text[start - 1:start]
            good = not (before.isalnum() or before == "_") and checksum(m[1][:30]) == m[1][30:]
        if good:
            out.append((start, m.end(), kind))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All spans of secrets in each whole text: the id and an array of (kind, start, end) in code points, end exclusive.

    Kinds: ``assign`` (a value given to a key named like a secret), ``access`` (cloud access key ids), ``hex`` (long hexadecimal
    runs), ``github`` and ``npm`` (tokens whose embedded checksum holds). Null and empty texts have none. Rows that repeat an id,
    null ids and empty tables need no care; other columns are not read.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def find(batches):
        for batch in batches:
            spans = [
                [{"kind": k, "start": s, "end": e} for s, e, k in scan(text)] if text else []
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span))], names=[id_col, "spans"])

    kind = T.StructType([docs.schema[id_col], T.StructField("spans", T._parse_datatype_string("array<struct<kind:string,start:bigint,end:bigint>>"))])
    return docs.select(id_col, text_col).mapInArrow(find, kind)
