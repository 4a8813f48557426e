"""SpotSigs fingerprints with Spark expressions only: chains of content words that follow common words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import running, saved

# Frequent function words of English, German, French and Spanish.
COMMON = tuple((
    "a an the and or of to in on at by for from with as is are was were be been it its this that these those he she they we you i not "
    "der die das den dem ein eine einer und oder von zu im am auf mit für ist sind war nicht sie er es wir ich auch als bei "
    "le la les un une des du de et ou à au aux en dans par pour sur avec est sont que qui ne pas il elle ce se "
    "el los las uno y o del al con por para es son su sus lo no se más como mi"
).split())


def spots(text: Column, chain: int = 2, reach: int = 10, common: tuple[str, ...] = COMMON) -> tuple[Column, callable]:
    """The words of a text, and the function that makes its signatures from them. Two steps, as the second one reads the words often."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")

    def signatures(words: Column, text: Column) -> Column:
        anchors = F.filter(F.transform(words, lambda w, i: F.when(w.isin(*common), i)), lambda i: i.isNotNull())
        chains = F.transform(anchors, lambda i: F.concat(
            F.slice(words, i + 1, 1), F.slice(F.filter(F.slice(words, i + 2, reach), lambda w: ~w.isin(*common)), 1, chain)))
        found = F.array_distinct(F.transform(F.filter(chains, lambda c: F.size(c) == chain + 1), lambda c: F.hash(c)))
        # A text without any chain is told by its words, one without words by itself.
        plain = F.when(F.size(words) > 0, F.array_distinct(F.transform(words, lambda w: F.hash(w)))).otherwise(F.array(F.hash(text)))
        return F.sort_array(F.when(F.size(found) > 0, found).otherwise(plain))

    return words, signatures


def with_signatures(df: DataFrame, text: Column, out: str, **how) -> DataFrame:
    """Add the sorted distinct signatures (32-bit hashes) of ``text`` as column ``out``."""
    words, signatures = spots(text, **how)
    kept = [F.col(c) for c in df.columns]
    made = df.withColumn("__words", words).withColumn("__found", signatures(F.col("__words"), text))
    return made.select(*kept, F.col("__found").alias(out))


def fingerprint(signatures: Column) -> Column:
    """Eight hexadecimal digits for each signature, in their order."""
    return F.array_join(F.transform(signatures, lambda s: F.lpad(F.hex(s.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0")), "")


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard of two signature sets. It can't exceed the ratio of their sizes: where that is below ``at_least`` it counts as 0, unread."""
    common = F.size(F.array_intersect(a, b))
    exact = common / (F.size(a) + F.size(b) - common)
    return F.when(F.least(F.size(a), F.size(b)) < at_least * F.greatest(F.size(a), F.size(b)), 0.0).otherwise(exact) if at_least else exact


def successors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Each document with an edited version of itself and with the next document, as signatures.

    The edited text has the last quarter of its code points (rounded down) replaced by as many from the start of the next text, or
    all of it if that is shorter; next is by id, after the last comes the first. Returns per id: n_chars, signatures, edited (text),
    edited_signatures, next_signatures. Null text counts as empty. Of rows that repeat an id the shortest counts; rows without an
    id have no place in the order and are left out; an empty table gives no rows; other columns are not read. Eager in part.

    Text is shuffled once, by id, together with its signatures; what goes to the document before is a prefix of a quarter of that
    document's length and the signatures.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), text.alias("text"))
    sizes = rows.groupBy("id").agg(F.min(F.length("text")).alias("n_chars"))
    placed = saved(running(saved(sizes, "sizes"), ["id"]), "placed")
    n = placed.count()
    before = placed.select(F.col("id").alias("prev_id"), F.floor(F.col("n_chars") / 4).cast("int").alias("k"),
                           ((F.col("index") + 1) % F.lit(max(n, 1))).alias("next_index"))
    links = saved(before.join(placed.select("id", "index"), F.col("next_index") == F.col("index")).select(
        F.col("id").alias("link_id"), "prev_id", "k"), "links")
    one = Window.partitionBy("id").orderBy(F.length("text"), "text")
    printed = with_signatures(rows, F.col("text"), "signatures", **how).withColumn("nth", F.row_number().over(one)).filter("nth = 1")
    heads = printed.join(links, F.col("id") == F.col("link_id")).select(
        "prev_id", F.substring("text", F.lit(1), F.col("k")).alias("head"), F.col("signatures").alias("next_signatures"))
    n_chars = F.length("text")
    both = printed.join(heads, F.col("id") == F.col("prev_id")).select(
        "id", n_chars.alias("n_chars"), "signatures", "next_signatures",
        F.concat(F.substring("text", F.lit(1), n_chars - F.floor(n_chars / 4).cast("int")), F.col("head")).alias("edited"))
    return with_signatures(both, F.col("edited"), "edited_signatures", **how).withColumnRenamed("id", id_col)


def matches(prints: DataFrame, at_least: float = 0.75, id_col: str = "doc_id", sig_col: str = "signatures") -> tuple[DataFrame, DataFrame]:
    """All pairs of different signature sets that are alike: (members, pairs).

    members: id and class_id, the smallest id with an equal set. pairs: id_a < id_b of such representatives and their likeness,
    ``at_least`` or more. Classes are partitioned by set length so that only a set's own partition and the next one can hold a
    partner; there, two sets must share one of their rarest signatures (so many that any partner holds one), and what these find
    is compared in full. Sets with nothing rare meet in no bucket larger than the number of sets that truly share it. Eager.
    """
    rows = prints.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(sig_col).alias("s"))
    key = F.sha2(F.array_join("s", ",").cast("binary"), 256)
    keyed = saved(rows.withColumn("key", key), "prints")
    least = keyed.groupBy("key").agg(F.min("id").alias("class_id"))
    members = keyed.join(least, "key").select(F.col("id").alias(id_col), "class_id")
    classes = keyed.join(least, "key").filter(F.col("id") == F.col("class_id")).dropDuplicates(["id"]).select("id", "s", F.size("s").alias("n"))
    classes = saved(classes.withColumn("part", F.floor(F.log("n") / F.log(F.lit(1 / at_least)))), "classes")
    each = classes.select("id", "n", "part", F.explode("s").alias("sig"))
    spread = each.groupBy("sig").agg(F.count(F.lit(1)).alias("df"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("df", "sig"))
    rare = saved(each.join(spread, "sig").withColumn("rank", rank).filter(
        F.col("rank") <= F.col("n") - F.ceil(F.col("n") * at_least - 1e-9) + 1).select("id", "n", "part", "sig"), "rare")
    other = rare.select(F.col("id").alias("o_id"), F.col("n").alias("o_n"), F.col("part").alias("o_part"), "sig")
    near = rare.withColumn("o_part", F.explode(F.array(F.col("part"), F.col("part") + 1))).join(other, ["sig", "o_part"]).filter(
        ((F.col("part") < F.col("o_part")) | (F.col("id") < F.col("o_id")))
        & (F.least("n", "o_n") >= F.greatest("n", "o_n") * at_least - 1e-9)).select("id", "o_id").distinct()
    sets = classes.select(F.col("id").alias("x"), "s")
    found = near.join(sets, F.col("id") == F.col("x")).select("id", "o_id", F.col("s").alias("a")).join(
        sets, F.col("o_id") == F.col("x")).withColumn("likeness", likeness(F.col("a"), F.col("s"), at_least))
    return members, found.filter(F.col("likeness") >= at_least).select(
        F.least("id", "o_id").alias("id_a"), F.greatest("id", "o_id").alias("id_b"), "likeness")
