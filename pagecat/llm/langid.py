"""Language identification: one interpolated Kneser-Ney character model per language, in sorted hash arrays."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER = 4
PIECE = 1 << 20
UNKNOWN = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    """Code point to symbol: a letter is its lower case in 16 bits (1 beyond those), anything else 0."""
    out = np.zeros(0x110000, np.uint16)
    for c in range(0x110000):
        if (s := chr(c)).isalpha():
            low = ord(s.lower()[0])
            out[c] = low if 1 < low < 0x10000 else 1
    return out


@dataclass
class Grams:
    """The n-grams of some texts, one after another: packed symbols, which of them only lead in, where each text starts."""

    codes: np.ndarray
    lead: np.ndarray
    starts: np.ndarray
    rows: list[int]
    letters: np.ndarray


def grams(pieces: list[tuple[int, str, str, bool]]) -> Grams:
    """Of pieces (row, the three symbols before it, text, whether the text ends with it). Runs of other characters count as one
    space; a text is led in by three of them and closed by one."""
    joined = "".join(before + text + "\0" * last for _, before, text, last in pieces)
    symbols = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    ends = np.cumsum([len(text) + 3 + last for _, _, text, last in pieces])
    begins = np.concatenate(([0], ends[:-1]))
    lead = np.zeros(len(symbols), bool)
    for k in range(3):
        lead[begins + k] = True
    keep = (symbols != 0) | lead
    keep[1:] |= symbols[:-1] != 0
    letters = np.add.reduceat(((symbols != 0) & ~lead).astype(np.int64), begins)
    starts = np.concatenate(([0], np.cumsum(keep)[ends[:-1] - 1]))
    kept = symbols[keep].astype(np.uint64)
    codes = kept.copy()
    for k in range(1, ORDER):
        codes[k:] |= kept[:-k] << np.uint64(16 * k)
    return Grams(codes, lead[keep], starts, [p[0] for p in pieces], letters)


# A letter that stands for all beyond 16 bits.
_BEYOND = "\U00010428"


def _carried(before: str, text: str) -> str:
    """The last three symbols of a text after ``before``, as characters that have them."""
    symbols = _letters()[np.frombuffer((before + text).encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = symbols != 0
    keep[1:] |= symbols[:-1] != 0
    keep[:3] = True
    return "".join("\0" if s == 0 else _BEYOND if s == 1 else chr(s) for s in symbols[keep][-3:].tolist())


def grouped(texts: list[str | None], size: int = PIECE):
    """Groups of pieces of about ``size`` characters. A longer text is cut into pieces of that length, each with the three symbols
    before it, so that it is counted as if it were whole."""
    group, held = [], 0
    for row, text in enumerate(texts):
        before = "\0\0\0"
        for at in range(0, len(text or ""), size):
            piece, last = text[at:at + size], at + size >= len(text)
            group.append((row, before, piece, last))
            before = before if last else _carried(before, piece)
            held += min(size, len(text) - at)
            if held >= size:
                yield group
                group, held = [], 0
    if group:
        yield group


@dataclass
class Table:
    """Of one order: discounted share of each n-gram and weight left to the lower order of each context; keys sorted."""

    keys: np.ndarray
    share: np.ndarray
    contexts: np.ndarray
    rest: np.ndarray


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


def kneser_ney(codes: np.ndarray, counts: np.ndarray) -> list[Table]:
    """Tables of the orders 1 to ORDER from distinct n-grams of the highest order and their counts.

    Lower orders count in how many contexts a gram was seen; each order has its own discount n1 / (n1 + 2 n2).
    """
    out = []
    for order in range(ORDER, 0, -1):
        once, twice = int((counts == 1).sum()), int((counts == 2).sum())
        discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once and twice else 0.75
        contexts, of, kinds = np.unique(codes >> np.uint64(16), return_inverse=True, return_counts=True)
        whole = np.bincount(of, counts)
        out.append(Table(codes, (counts - discount) / whole[of], contexts, discount * kinds / whole))
        codes, counts = np.unique(codes & np.uint64((1 << 16 * (order - 1)) - 1), return_counts=True)
    return out[::-1]


@dataclass
class Model:
    """Languages with their tables; per language the mean and spread of cross-entropy on calibration texts."""

    langs: list[str]
    tables: list[list[Table]]
    symbols: int
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spread: np.ndarray = field(default_factory=lambda: np.zeros(0))
    char: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def costs(self, codes: np.ndarray) -> np.ndarray:
        """Nats of each n-gram's last symbol under each language."""
        out = np.empty((len(codes), len(self.langs)))
        for k, tables in enumerate(self.tables):
            p = np.full(len(codes), 1 / self.symbols)
            for order, t in enumerate(tables, 1):
                gram = codes if order == 4 else codes & np.uint64((1 << 16 * order) - 1)
                p = _find(t.keys, t.share, gram, 0.0) + _find(t.contexts, t.rest, gram >> np.uint64(16), 1.0) * p
            out[:, k] = -np.log(p)
        return out


class Scorer:
    """A model with the costs of the n-grams met so far (dropped beyond ``limit``; they are only computed again)."""

    def __init__(self, model: Model, limit: int = 1 << 20):
        self.model, self.limit = model, limit
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros((0, len(model.langs)))

    def of(self, codes: np.ndarray) -> np.ndarray:
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, codes), len(self.keys) - 1)
            new = np.sort(codes[self.keys[at] != codes])
        else:
            new = np.sort(codes)
        if len(new):
            if len(self.keys) + len(new) > self.limit:
                self.keys, self.values, new = np.zeros(0, np.uint64), self.values[:0], np.sort(codes)
            keys = np.concatenate([self.keys, new])
            order = np.argsort(keys, kind="stable")
            self.keys, self.values = keys[order], np.concatenate([self.values, self.model.costs(new)])[order]
        return self.values[np.searchsorted(self.keys, codes)]

    def sums(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: nats under each language, symbols scored, letters."""
        nats = np.zeros((len(texts), len(self.model.langs)))
        scored, letters = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for group in grouped(texts):
            g = grams(group)
            which, distinct = pd.factorize(g.codes)
            costs = np.vstack([self.of(distinct), np.zeros((1, nats.shape[1]))])
            which[g.lead] = len(distinct)
            for k in range(nats.shape[1]):
                np.add.at(nats[:, k], g.rows, np.add.reduceat(costs[which, k], g.starts))
            np.add.at(scored, g.rows, np.add.reduceat((~g.lead).astype(np.int64), g.starts))
            np.add.at(letters, g.rows, g.letters)
        return nats, scored, letters


def fit(
    docs: DataFrame, rows_per_lang: int = 3000, calibration: float = 0.25, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang",
) -> Model:
    """Learn from labelled rows. ``rows_per_lang`` bounds the sample: of a language with more rows a share by the hash of the id
    is taken, about that many whole texts. ``calibration`` of them is kept apart to learn which cross-entropy is usual."""
    spark = docs.sparkSession
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r["n"] for r in rows.groupBy(lang_col).agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], [], 1)
    uniform = lambda seed: F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1_000_003)) / 1_000_003
    wanted = F.lit(0.0)
    for lang, n in counts.items():
        wanted = F.when(F.col(lang_col) == lang, min(1.0, rows_per_lang / n)).otherwise(wanted)
    sample = rows.filter(uniform(1) < wanted).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
                                                     (uniform(2) < calibration).alias("calibrate"))

    def count(batches):
        for batch in batches:
            for lang in set(langs_of := batch.column(0).to_pylist()):
                texts = [t for t, at in zip(batch.column(1).to_pylist(), langs_of, strict=True) if at == lang]
                for group in grouped(texts):
                    g = grams(group)
                    codes, n = np.unique(g.codes[~g.lead], return_counts=True)
                    yield pa.RecordBatch.from_pydict({"lang": [lang] * len(codes), "code": codes.view(np.int64), "n": n})

    learn = sample.filter(~F.col("calibrate")).select("lang", "text")
    found = learn.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas()
    tables, langs = [], [x for x in langs if (found["lang"] == x).any()]
    for lang in langs:
        own = found[found["lang"] == lang]
        codes, n = own["code"].to_numpy(np.int64).view(np.uint64), own["n"].to_numpy(np.int64)
        order = np.argsort(codes)
        tables.append(kneser_ney(codes[order], n[order]))
    model = Model(langs, tables, 1 + len(np.unique(np.concatenate([t[0].keys for t in tables]))) if tables else 1)
    shared = spark.sparkContext.broadcast(model)

    def cross(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            nats, scored, letters = scorer.sums(batch.column(1).to_pylist())
            at = [shared.value.langs.index(x) if x in shared.value.langs else -1 for x in batch.column(0).to_pylist()]
            ok = (np.array(at) >= 0) & (letters > 0)
            rows = np.flatnonzero(ok)
            yield pa.RecordBatch.from_pydict({
                "lang": np.array(at)[rows].astype(np.int32), "mean": nats[rows, np.array(at)[rows]] / np.maximum(scored[rows], 1), "n": scored[rows],
            })

    seen = sample.filter("calibrate").select("lang", "text").mapInArrow(cross, "lang int, mean double, n long").toPandas()
    mean, spread, char = np.full(len(langs), np.inf), np.zeros(len(langs)), np.zeros(len(langs))
    for k in range(len(langs)):
        own = seen[seen["lang"] == k]
        if len(own) >= 10:
            m, n = own["mean"].to_numpy(), own["n"].to_numpy()
            mean[k] = np.average(m, weights=n)
            spread[k] = np.sqrt(np.average((m - mean[k]) ** 2, weights=n))
            # What is left is noise of short texts: a deviation per symbol that shrinks with the root of the length.
            char[k] = np.sqrt(np.mean((m - mean[k]) ** 2 * n))
    return Model(langs, tables, model.symbols, mean, spread, char)


def limits(model: Model, best: np.ndarray, scored: np.ndarray, margin: float) -> np.ndarray:
    """Highest usual cross-entropy of texts of these lengths in these languages (infinite where nothing could be calibrated)."""
    return model.mean[best] + margin + 6 * model.spread[best] + 6 * model.char[best] / np.sqrt(np.maximum(scored, 1))


def likely(model: Model, best: np.ndarray, scored: np.ndarray, lowest: np.ndarray, margin: float) -> np.ndarray:
    """1 for a usual cross-entropy, a half at the limit of what is accepted, towards 0 beyond."""
    usual = model.mean[best]
    room = limits(model, best, scored, margin) - usual
    with np.errstate(invalid="ignore"):
        over = np.where(np.isfinite(usual), np.maximum(lowest - usual, 0) / room, 0)
    return 1 / (1 + over ** 4)


def predict(docs: DataFrame, model: Model, margin: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language of each whole text: the lowest cross-entropy per symbol.

    Returns per row: the id, lang_pred (``und`` without text or letters, or if nothing was learned), score (0 to 1: the chosen
    language's share of the likelihood over 40 symbols at most, which falls as the cross-entropy leaves what is usual and is a half of
    it where texts begin to be rejected; 0 for ``und``), cross_entropy (null for ``und``) and
    rejected: ``und``, or a cross-entropy that calibration texts of the language and length do not reach. Ties go to the first
    language by name. Rows that repeat an id, null ids and empty tables need no care; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        scorer = Scorer(shared.value)
        names = np.array([*shared.value.langs, UNKNOWN], object)
        for batch in batches:
            nats, scored, letters = scorer.sums(batch.column(1).to_pylist())
            known = (letters > 0) & bool(shared.value.langs)
            cross = nats / np.maximum(scored, 1)[:, None] if shared.value.langs else np.zeros((len(scored), 1))
            best = cross.argmin(1)
            lowest = cross.min(1)
            share = 1 / np.exp((lowest[:, None] - cross) * np.minimum(scored, 40)[:, None]).sum(1)
            if shared.value.langs:
                share *= likely(shared.value, best, scored, lowest, margin)
            far = lowest > limits(shared.value, best, scored, margin) if shared.value.langs else ~known
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(names[np.where(known, best, len(names) - 1)], pa.string()), pa.array(np.where(known, share, 0.0)),
                pa.array(lowest, mask=~known), pa.array(~known | far),
            ], names=[id_col, "lang_pred", "score", "cross_entropy", "rejected"])

    kind = T.StructType([docs.schema[id_col], *T._parse_datatype_string(
        "lang_pred string, score double, cross_entropy double, rejected boolean").fields])
    return docs.select(id_col, text_col).mapInArrow(score, kind)


def accepted(docs: DataFrame, model: Model, margin: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text ``predict`` does not reject; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def choose(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            nats, scored, letters = scorer.sums(batch.column(at).to_pylist())
            keep = (letters > 0) & bool(shared.value.langs)
            if keep.any():
                cross = nats / np.maximum(scored, 1)[:, None]
                keep &= cross.min(1) <= limits(shared.value, cross.argmin(1), scored, margin)
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(choose, docs.schema)
