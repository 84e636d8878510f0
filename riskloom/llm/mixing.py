"""Mixing sources to target weights, with DataFrame functions only.

Each document gets a hash-random key; within a source, documents stand in key order.  The order is cut
into ``2**bucket_bits`` equal ranges of the key (random keys, so equal ranges hold equal shares even of a
hot source).  Token counts per (source, range) are summed with partial aggregation, a running sum over
those few rows says which ranges lie before a source's budget, and only the one range that holds the cut
is sorted row by row.  A budget above the source's size repeats it in whole epochs first; the document at
the cut gives as many words as are left, so every source meets its budget to the word.

Targets: sources sorted by code point (null last) weigh 5, 2, 1, repeating.  They share all tokens by
weight, but no target exceeds ``max_epochs`` times its source's size; what is above is shared again among
the others by weight, until none is above.  This is the level of a water filling, found with running sums
over the sources (one row per source).

Defined cases: null text has size 0; a source of size 0 gets target 0; null sources form one group, last;
repeated rows and ids are rows of their own; empty input gives no rows.  Input columns are kept, and
working columns live in one struct so that no name clashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, join_hot, materialise, read_table

WEIGHTS = (5, 2, 1)


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """(source, source_size) -> the same with ``target``; one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    # Sources fill up in the order of cap / weight; before the j-th fills, the level is
    # (total - caps of those before) / (weights of j and those after).
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    upto, rest, everything = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    s = s.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))) / F.sum("weight").over(rest))
    # From the first source that does not fill up on, levels fall: theirs is the largest that keeps below its cap.
    s = s.withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(everything))
    return s.select("source", "source_size", F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = 3, seed: int = 17, bucket_bits: int = 12) -> DataFrame:
    """(row, mix): input rows (doc_id, text, source, ...) as structs with size, source_size, target, taken."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source"), F.col("text"))
    bucket = F.shiftrightunsigned("key", 64 - bucket_bits).cast("int")  # equal ranges of the key's unsigned order
    d = docs.select(F.struct(*names).alias("row"), *_source_key(F.col("source")), word_count().alias("size"), key.alias("key")).withColumn("bucket", bucket)
    plan = _source_plan(d.groupBy("src", "no_src", "bucket").agg(F.sum("size").alias("bucket_size")), weights, max_epochs)
    d = join_hot(d, plan, ["src", "no_src"], F.col("key"), how="inner")
    # Only the range that holds the cut is sorted; rows of other ranges are taken whole or not at all.
    at_cut = F.col("bucket") == F.col("cut_bucket")
    whole = d.where(~at_cut).withColumn("extra", F.when(F.col("bucket") < F.col("cut_bucket"), F.col("size")).otherwise(F.lit(0)))
    run = Window.partitionBy("src", "no_src").orderBy(F.shiftrightunsigned("key", 1), "key", "row.doc_id").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("before") + F.coalesce(F.sum("size").over(run), F.lit(0))
    cut = d.where(at_cut).withColumn("extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("part") - ahead)))
    taken = (F.col("epochs") * F.col("size") + F.col("extra")).cast("long").alias("taken")
    return whole.unionByName(cut).select("row", F.struct("size", "source_size", "target", taken).alias("mix"))


def mix_sources(docs: DataFrame, into: str = "mix", **options) -> DataFrame:
    """``docs`` plus the mix as a struct named ``into``, a name that ``docs`` does not have."""
    return mixed_rows(docs, **options).select("row.*", F.col("mix").alias(into))


def _source_key(source: Column) -> list[Column]:
    """A source as two columns that are never null, for plain equality joins."""
    return [F.coalesce(source, F.lit("")).alias("src"), source.isNull().alias("no_src")]


def _source_plan(bucket_sizes: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """One row per source: target, whole epochs, the part of the last epoch, the range that holds the cut, tokens before it."""
    buckets = materialise(bucket_sizes, "mix-buckets")
    sources = buckets.groupBy("src", "no_src").agg(F.sum("bucket_size").alias("source_size"))
    targets = source_targets(sources.withColumn("source", F.when(~F.col("no_src"), F.col("src"))), weights, max_epochs).select(*_source_key(F.col("source")), "source_size", "target")
    budget = F.round("target").cast("long")
    targets = targets.withColumn("epochs", F.floor(budget / F.greatest(F.col("source_size"), F.lit(1)))).withColumn("part", budget - F.col("epochs") * F.col("source_size"))
    run = Window.partitionBy("src", "no_src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = buckets.withColumn("before", F.coalesce(F.sum("bucket_size").over(run), F.lit(0)))
    # The last range that begins before the part ends; none if there is no part.
    at_cut = F.max(F.when(F.col("before") < F.col("part"), F.struct("bucket", "before"))).alias("cut")
    cut = before.join(targets, ["src", "no_src"]).groupBy("src", "no_src", "source_size", "target", "epochs", "part").agg(at_cut)
    return materialise(cut.select("src", "no_src", "source_size", "target", "epochs", "part", F.coalesce("cut.bucket", F.lit(-1)).alias("cut_bucket"), F.coalesce("cut.before", F.lit(0).cast("long")).alias("before")), "mix-plan")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: whole epochs repeat a row, the document at the cut is shortened to its first words.

    Columns are those of ``docs``; ``n_chars`` follows a shortened text if it is there.
    """
    out = [F.col(f"d.`{c}`") for c in docs.columns]
    keep = mixed_rows(docs, **options).where("mix.taken > 0").select(F.col("row").alias("d"), F.col("mix.size").alias("size"), F.col("mix.taken").alias("taken"))
    copies = F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))).alias("copy")
    left = F.least(F.col("size"), F.col("taken") - (F.col("copy") - 1) * F.col("size")).alias("words")
    rows = keep.select("d", "size", "taken", copies).select("d", "size", left)
    # The first ``words`` words with the white space before each; only the document at the cut needs it.
    first = F.array_join(F.slice(F.regexp_extract_all(F.col("d.text"), F.lit(rf"[\x20\x09-\x0D]*{WORD_PATTERN}"), 0), F.lit(1), F.col("words").cast("int")), "")
    rows = rows.withColumn("cut_text", F.when(F.col("words") < F.col("size"), first).otherwise(F.col("d.text")))
    fixed = {"text": F.col("cut_text").alias("text"), "n_chars": F.char_length("cut_text").cast("long").alias("n_chars")}
    return rows.select(*[fixed.get(c, o.alias(c)) for c, o in zip(docs.columns, out)])


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mix_sources(docs)
    return mixed.select("doc_id", F.col("mix.size").alias("size"), F.col("mix.source_size").alias("source_size"), F.col("mix.target").alias("target"), F.col("mix.taken").alias("taken"))
