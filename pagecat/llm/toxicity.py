"""Toxicity: a weighted lexicon found by an Aho-Corasick automaton in folded text, normalised by length."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved

# Letters of other scripts and full-width forms that look like Latin ones, and digits and signs used for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ɡ": "g", "ӏ": "l", "ո": "n", "ս": "u", "ѵ": "v", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ⅼ": "l", "ｌ": "l",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
# In both text and lexicon l counts as i, as 1 stands for either.
MERGED = {"l": "i"}
# Uses of listed words that insult nobody, beside those that are learned; a hit inside one of them does not count.
EXCEPTIONS = (
    "trash can", "trash cans", "trash bin", "trash bag", "clown fish", "circus clown", "class clown", "pond scum", "soap scum",
    "scum line", "good loser", "not stupid", "not worthless", "not an idiot", "no idiot",
)
# Lengths of stems.
STEMS = (4, 5, 6, 7, 8)
WORD = re.compile(r"[^\W_]+")


def _table() -> dict[int, str]:
    pairs = {chr(c): chr(c + 32) for c in range(65, 91)}
    pairs |= {chr(0xFF41 + k): chr(97 + k) for k in range(26)} | {chr(0xFF21 + k): chr(97 + k) for k in range(26)}
    pairs |= HOMOGLYPHS | {g.upper(): x for g, x in HOMOGLYPHS.items() if len(g.upper()) == 1 and ord(g.upper()) > 127} | SUBSTITUTES
    return {ord(a): MERGED.get(b, b) for a, b in pairs.items()} | {ord(a): b for a, b in MERGED.items()} | {ord("L"): "i"}


FOLD = _table()


def fold(text: str) -> str:
    """One code point for each, so that places in the folded text are places in the text."""
    return text.translate(FOLD)


@dataclass
class Model:
    """Folded words with weights (a last ``*``: all words that start so), folded exceptions, and the logistic curve over
    (1, hits, density)."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: np.ndarray = field(default_factory=lambda: np.array([-3.0, 1.0, 1.0]))


class Matcher:
    def __init__(self, model: Model):
        self.automaton = ahocorasick.Automaton()
        entries: dict[str, list] = {}
        for word, weight in [*[(fold(p), None) for p in model.exceptions], *model.weights.items()]:
            entries.setdefault(word.rstrip("*"), []).append((word.endswith("*"), weight))
        for word, uses in entries.items():
            self.automaton.add_word(word, (len(word), uses))
        self.automaton.make_automaton()

    def score(self, text: str | None) -> tuple[float, int, int]:
        """Summed weights of the words hit outside exceptions, each by its heaviest entry, how many, and the words of the text."""
        if not text:
            return 0.0, 0, 0
        hits: dict[int, float] = {}
        spared = []
        for end, (length, uses) in self.automaton.iter(fold(text)) if len(self.automaton) else ():
            start = end + 1 - length
            # Words only: what stands beside a hit, as it is written, is no letter or digit; a stem may go on.
            if start and text[start - 1].isalnum():
                continue
            whole = end + 1 == len(text) or not text[end + 1].isalnum()
            for stem, weight in uses:
                if weight is None and whole:
                    spared.append((start, end))
                elif weight is not None and (stem or whole):
                    hits[start] = max(weight, hits.get(start, weight))
        if spared:
            hits = {at: w for at, w in hits.items() if not any(a <= at <= b for a, b in spared)}
        return float(sum(hits.values())), len(hits), len(text.split())


def features(weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hits by a logarithm, and their density: weight per hundred words, with ten words added to keep short texts in bounds."""
    return np.stack([np.ones(len(weight)), np.log1p(weight), np.log1p(100 * weight / (words + 10))], 1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method; the slopes stay at zero or above, as a hit never speaks for a clean text."""
    used = list(range(x.shape[1]))
    while True:
        w = np.zeros(len(used))
        own = x[:, used]
        penalty = ridge * np.array([0.0 if c == 0 else 1.0 for c in used]) + 1e-6
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(own @ w, -30, 30)))
            step = np.linalg.solve((own * (p * (1 - p))[:, None]).T @ own + np.diag(penalty), own.T @ (y - p) - penalty * w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        if (w[1:] >= 0).all():
            break
        used = [c for c, v in zip(used, w, strict=True) if c == 0 or v >= 0]
    out = np.zeros(x.shape[1])
    out[used] = w
    return out


def fit(
    docs: DataFrame, labels: DataFrame, rows: int = 30_000, min_support: int = 8, id_col: str = "doc_id",
    text_col: str = "text", label_col: str = "toxic", min_words: int = 3, min_clean: int = 3,
) -> Model:
    """Learn lexicon and curve from labelled rows. ``rows`` bounds the sample (about that many, by the hash of the id).

    A word's support is the number of toxic and of clean texts that have it, told apart by the words around its first
    occurrence, so that copies of one text add nothing. Words with ``min_support`` toxic texts, more toxic than clean ones and a
    log-odds ratio of three standard errors above 1 make the lexicon, weighted by that ratio. A stem has to earn its place beyond them:
    its support is that of the words that start so and are not in the lexicon themselves, and ``min_words`` of these must occur in toxic
    texts. The bounded sample bounds the lexicon: a word needs ``min_support`` rows of it.

    Exceptions are learned, too: a listed word with its neighbour on one side is spared if ``min_clean`` clean texts have the
    two, told apart by the neighbour on the other side, and at most a tenth of the texts with them is toxic.
    """
    spark = docs.sparkSession
    labelled = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("l_id")).agg(
        F.max(label_col).cast("int").alias("label"))
    n = labelled.count()
    if not n:
        return Model({})
    chosen = labelled.filter(F.pmod(F.xxhash64("l_id", F.lit(3)), F.lit(1_000_003)) < 1_000_003 * min(1.0, rows / n))
    # About ``rows`` ids and labels: small whatever the corpus.
    sample = docs.select(id_col, F.col(text_col).alias("text")).join(F.broadcast(chosen), F.col(id_col) == F.col("l_id")).select(
        "text", "label").filter(F.col("text").isNotNull())

    def neighbours(batches):
        for batch in batches:
            seen = set()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = WORD.findall(fold(text))
                first: dict[str, tuple[str, str]] = {}
                for word, before, after in zip(words, ["", *words[:-1]], [*words[1:], ""], strict=True):
                    first.setdefault(word, (before, after))
                seen.update((word, *around, label) for word, around in first.items())
            if seen:
                word, before, after, label = zip(*seen, strict=True)
                yield pa.RecordBatch.from_pydict({
                    "word": pa.array(word), "around": pa.array([f"{a} {b}" for a, b in zip(before, after, strict=True)]),
                    "label": pa.array(label, pa.int32()),
                })

    around = sample.mapInArrow(neighbours, "word string, around string, label int").select(
        "word", "label", F.xxhash64("around").alias("around")).distinct()
    support = around.groupBy("word").agg(F.sum(F.col("label") % 2).alias("bad"), F.count(F.lit(1)).alias("n"))
    totals = around.groupBy("label").count().collect()
    bad_all = sum(r["count"] for r in totals if r["label"] == 1) + 1.0
    good_all = sum(r["count"] for r in totals if r["label"] == 0) + 1.0
    bad, good = F.col("bad") + 0.5, F.col("n") - F.col("bad") + 0.5
    ratio = F.log(bad / bad_all) - F.log(good / good_all)
    support = saved(support, "support")

    def strong(words: DataFrame) -> DataFrame:
        return (
            words.filter((F.col("bad") >= min_support) & (2 * F.col("bad") > F.col("n")) & (F.length("word") > 1))
            .withColumn("weight", ratio).filter(F.col("weight") - 3 * F.sqrt(1 / bad + 1 / good) > 1).select("word", "weight")
        )

    stem = F.transform(F.array(*[F.lit(n) for n in STEMS]), lambda n: F.when(F.length("word") >= n, F.concat(F.substr("word", F.lit(1), n), F.lit("*"))))
    stems = (
        support.join(strong(support), "word", "left_anti").select(F.explode(F.array_compact(stem)).alias("word"), "bad", "n")
        .groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"), F.count_if(F.col("bad") > 0).alias("words"))
        .filter(F.col("words") >= min_words)
    )
    words = strong(support).unionByName(strong(stems)).orderBy(F.desc("weight"), "word").collect()
    model = Model({r["word"]: r["weight"] for r in words})
    listed_of = spark.sparkContext.broadcast(frozenset(model.weights))

    def contexts(batches):
        listed = listed_of.value
        for batch in batches:
            seen = set()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = ["", *WORD.findall(fold(text)), ""]
                for k, word in enumerate(words):
                    if word in listed:
                        seen.update({(f"{words[k - 1]} {word}", words[k + 1], label), (f"{word} {words[k + 1]}", words[k - 1], label)})
            if seen:
                phrase, other, label = zip(*seen, strict=True)
                yield pa.RecordBatch.from_pydict({"phrase": pa.array(phrase), "other": pa.array(other), "label": pa.array(label, pa.int32())})

    spared = (
        sample.mapInArrow(contexts, "phrase string, other string, label int").distinct()
        .groupBy("phrase").agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") - F.col("bad") >= min_clean) & (10 * F.col("bad") <= F.col("n")) & (F.trim("phrase") == F.col("phrase")))
        .orderBy("phrase").collect()
    )
    model.exceptions = (*EXCEPTIONS, *[r["phrase"] for r in spared])
    matcher_of = spark.sparkContext.broadcast(model)

    def measure(batches):
        matcher = Matcher(matcher_of.value)
        for batch in batches:
            found = [matcher.score(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"weight": [f[0] for f in found], "words": [f[2] for f in found], "label": batch.column(1)})

    seen = sample.mapInArrow(measure, "weight double, words long, label int").toPandas()
    if seen["label"].nunique() == 2:
        model.curve = _logistic(features(seen["weight"].to_numpy(), seen["words"].to_numpy()), seen["label"].to_numpy(float))
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text from 0 to 1: the id, score, hits, weight, words.

    Null and empty texts have no hits and get the score of a clean text. Rows that repeat an id, null ids and empty tables need
    no care; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        matcher = Matcher(shared.value)
        for batch in batches:
            found = [matcher.score(t) for t in batch.column(1).to_pylist()]
            weight, hits, words = (np.array([f[k] for f in found], kind) for k, kind in enumerate((float, np.int64, np.int64)))
            value = 1 / (1 + np.exp(-features(weight, words) @ shared.value.curve))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(value), pa.array(hits), pa.array(weight), pa.array(words)],
                names=[id_col, "score", "hits", "weight", "words"])

    kind = T.StructType([docs.schema[id_col], *T._parse_datatype_string("score double, hits long, weight double, words long").fields])
    return docs.select(id_col, text_col).mapInArrow(score, kind)
