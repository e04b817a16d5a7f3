"""Mix sources to target weights by weighted sampling without replacement, in built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.sinks.staging import Staging
from llm.rows import as_rows, from_rows

WORDS = r"[^ \t-\r]+"
SYMBOLS = "#*$%&|<>"
SOURCE_WEIGHTS = (5.0, 2.0, 1.0)
BUDGET_SHARE = 1.5
MOST_EPOCHS = 2.0
# Documents of a source that one bucket of the key order holds on average.
BUCKET_DOCUMENTS = 4000
LEAST_WEIGHT = 0.2
SEED = 7


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """Between LEAST_WEIGHT and 1: falls with the symbols a text has to its words."""
    symbols = F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))
    return F.coalesce(F.greatest(F.lit(LEAST_WEIGHT), 1 - 2 * symbols / F.when(size > 0, size)), F.lit(LEAST_WEIGHT))


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the parts alone: 52 bits of their digest."""
    digest = F.md5(F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def sampling_key(doc_id: Column, text: Column, size: Column, seed: int) -> Column:
    """-ln(u) / weight; u depends on the text too, so rows without id, or of one id, are sampled apart."""
    own = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    return -F.log(uniform(doc_id, F.lit(seed), own)) / quality_weight(text, size)


def source_targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = SOURCE_WEIGHTS,
    share: float = BUDGET_SHARE,
    most_epochs: float = MOST_EPOCHS,
) -> DataFrame:
    """(source, number, source_size, documents, target): each source's share of ``share`` times all words.

    ``sizes`` has one row a source: source, source_size, documents. Sources by code
    point, null last, take the weights in turn. A target stops at ``most_epochs`` times
    its source; the excess goes to the others by weight. The level at which that ends
    is found in one pass over the sources, in the order in which they reach their cap.
    The windows run over one row a source.
    """
    number = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("number", number).withColumn("weight", weight).withColumn("cap", most_epochs * F.col("source_size"))
    ranked = ranked.withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.asc_nulls_last("source"))
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    total = share * F.sum("source_size").over(whole)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    ranked = ranked.withColumn("level", level).withColumn("place", F.row_number().over(order))
    # The first source that stays below its cap fixes the level; without one, all reach it.
    open_level = F.when(F.col("ratio") >= F.col("level"), F.struct("place", "level"))
    level = F.min(open_level).over(whole)["level"]
    target = F.coalesce(F.least(F.col("cap"), F.col("weight") * level), F.col("cap"))
    return ranked.select("source", "number", "source_size", "documents", target.alias("target"))


def mixture(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = SOURCE_WEIGHTS,
    share: float = BUDGET_SHARE,
    most_epochs: float = MOST_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): words of every row the mix takes.

    Efraimidis-Spirakis: a document's key is -ln(u) / weight with u from a digest of id,
    seed and text and a weight that falls with symbols in the text. A source's target is cut
    into complete epochs, which take every document, and a fraction: documents by
    ascending key until their sizes fill it; the last gives its first words only, so
    the source meets its target to the word.

    A source is never ordered in one task: keys fall into buckets of some thousand
    documents, bucket totals are prefix-summed per source, and rows are ordered within
    their bucket. Reruns give the same rows. A null or empty text has size 0 and gives
    nothing; a text of any length is counted whole. Ids may be null or repeat: rows of
    one id and text in one source tie, and it does not matter which of them is taken. Null sources are one source, the last. Other columns
    do not matter; an empty table gives an empty result.
    """
    stage = Staging(docs.sparkSession)
    own = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.col(text_col).cast("string").alias("text"),
    ).withColumn("size", word_count(F.col("text")))
    key = sampling_key(F.col("doc_id"), F.col("text"), F.col("size"), seed)
    sized = stage(own.select("doc_id", "source", "size", key.alias("key")), "sized")
    return planned(sized, stage, weights, share, most_epochs)


def planned(
    sized: DataFrame,
    stage: Staging,
    weights: tuple[float, ...] = SOURCE_WEIGHTS,
    share: float = BUDGET_SHARE,
    most_epochs: float = MOST_EPOCHS,
    whole: bool = False,
) -> DataFrame:
    """``sized`` (source, size, key and more) with source_size, target and taken; ``whole`` parts no document."""
    kept = [c for c in sized.columns if c != "key"]
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    targets = stage(source_targets(sources, weights, share, most_epochs), "targets")
    targets = targets.select(F.col("source").alias("of"), "number", "source_size", "documents", "target")
    rows = sized.join(targets, F.col("source").eqNullSafe(F.col("of")))
    # Monotone, so buckets keep the order; near uniform for all weights, so none is large.
    spread = 1 - (F.exp(-F.col("key")) + F.exp(-LEAST_WEIGHT * F.col("key"))) / 2
    buckets = F.ceil(F.col("documents") / BUCKET_DOCUMENTS)
    rows = rows.withColumn("bucket", F.floor(spread * buckets))

    groups = rows.groupBy("number", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(
        "number", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("earlier")
    )
    # Ordered first: the join then finds the rows dealt and sorted by its own keys.
    within = Window.partitionBy("number", "bucket").orderBy("key", "doc_id", "size")
    inside = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("inside", F.coalesce(inside, F.lit(0))).join(groups, ["number", "bucket"])
    before = F.col("earlier") + F.col("inside")
    epochs = F.floor(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size")))
    epochs = F.coalesce(epochs, F.lit(0))
    rest = F.floor(F.col("target")) - epochs * F.col("source_size")
    part = F.least(F.col("size"), F.greatest(rest - before, F.lit(0)))
    if whole:
        # The nearer end of the document the target falls into; a source is not left without any.
        ends = (2 * part >= F.col("size")) | ((epochs == 0) & (before == 0))
        part = F.when((part > 0) & ends, F.col("size")).otherwise(F.lit(0))
    return rows.select(*kept, "source_size", "target", (epochs * F.col("size") + part).cast("long").alias("taken"))


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    size_col: str | None = "n_chars",
    weights: tuple[float, ...] = SOURCE_WEIGHTS,
    share: float = BUDGET_SHARE,
    most_epochs: float = MOST_EPOCHS,
    seed: int = SEED,
    whole: bool = False,
) -> DataFrame:
    """The rows of the mix with all columns of ``docs``: once for each epoch that takes them.

    As :func:`mixture`, whose decisions these are. The one document of a source that
    gives only its first words has them joined by spaces; ``size_col``, where given, is
    then the code points of that text. With ``whole`` that document is taken or left as it
    is, whichever lands nearer to the target, and taken where the source has no other.
    """
    stage = Staging(docs.sparkSession)
    rows = as_rows(docs, doc_id=id_col, source=source_col)
    # A field of the row, so that the text is in the shuffle once.
    text = F.col(f"row.c{docs.columns.index(text_col)}").cast("string")
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("size", word_count(text))
    key = sampling_key(F.col("doc_id"), text, F.col("size"), seed)
    mix = planned(rows.withColumn("key", key), stage, weights, share, most_epochs, whole).where("taken > 0")
    copies = F.concat(
        F.array_repeat(F.col("size"), (F.col("taken") / F.col("size")).cast("int")),
        F.filter(F.array(F.col("taken") % F.col("size")), lambda n: n > 0),
    )
    mix = mix.select("row", "size", F.explode(copies).alias("words"))
    first_words = F.slice(F.regexp_extract_all(text, F.lit(f"({WORDS})"), F.lit(1)), 1, F.col("words").cast("int"))
    cut = F.col("words") < F.col("size")
    mix = mix.withColumn("cut", cut).withColumn("text", F.when(cut, F.array_join(first_words, " ")).otherwise(text))
    if size_col is None:
        return from_rows(mix, docs, **{text_col: "text"})
    old = F.col(f"row.c{docs.columns.index(size_col)}")
    mix = mix.withColumn("n", F.when(F.col("cut"), F.char_length("text").cast("long")).otherwise(old))
    return from_rows(mix, docs, **{text_col: "text", size_col: "n"})
