"""Near-duplicate groups: MinHash with tensored banding, links confirmed on full shingle sets.

A document's set holds its distinct five-word shingles.  Two collections of ``tables`` half-keys are made
from ``rows`` minhashes each; a hash table is keyed by a pair of half-keys, one from either collection.
``tables**2`` tables thus cost ``2 * tables * rows`` minhashes instead of ``2 * tables**2 * rows``.  A pair with
similarity s shares a table unless it shares no half-key of one collection, with probability at most
``2 * (1 - s**rows)**tables`` (4e-6 at s = 0.75 as set).  Pairs of half-keys are formed only where
the first half-key is shared by two documents or more, so documents without near copies stop early.

1. Equal sets form classes (grouping by a 128-bit fingerprint); only the smallest doc_id of a class, its
   representative, goes on.
2. The 16 tables on the diagonal (i-th half-key of either collection) come first: all members of a key are
   compared with its *leader*, the smallest: linear in the members.  Pairs whose sizes or 64-byte sketches
   cannot reach the threshold are dropped (a sketch only prunes: pairs at the threshold fail it with
   probability under 1e-6), the others are compared on full sets made from their texts.
3. All other tables: a half-key or table key whose members are in one component by then can add nothing and is left
   out, so only what is still open is crossed.  Keys of few members compare those of different components; members
   of larger keys meet by the prefix filter: with shingles in one order, rarest first, two sets at the threshold
   share one of the first ``n - least + 1`` of either, and not too late in them.  No link is lost, and members
   just below the threshold of a large group are not compared with all of it.
4. Components of the links, by label propagation with joins.

Defined cases: null and empty texts and those without words have an empty set, are linked with nothing and
are kept; a null doc_id takes no part, has no component and is kept; rows that share a doc_id are one
document and linked to each other; below five words the whole sequence is the one shingle; empty input
gives no rows.  Other input columns are not read, so their names don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordHashes, byte_texts, in_slices, join_hot, materialise, mix, process_cache, read_table
from .graph import components

SHINGLE = 5
SKETCH = 64
_ODD = mix(np.arange(1, 64, dtype=np.uint64)) | np.uint64(1)


def shingles(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a document's lower-case words."""
    if not words:
        return np.zeros(0, np.uint64)
    h = hashes.of(words).view(np.uint64)
    width = min(SHINGLE, len(words))
    total = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        total += mix(h[k : len(words) - width + 1 + k] ^ _ODD[10 + k]) * _ODD[k]
    return np.unique(mix(total))


def _word_hashes() -> WordHashes:
    # Workers outlive their stage, so what they remember is kept small.
    return process_cache("word hashes", lambda: WordHashes(100_000))


def _minhashes(sets: list[np.ndarray], count: int) -> np.ndarray:
    """count x documents; every set has a shingle."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    seeds = mix(np.arange(1000, 1000 + 2 * count, dtype=np.uint64))
    out = np.empty((count, len(sets)), np.uint64)
    for f in range(count):
        out[f] = np.minimum.reduceat((flat ^ seeds[2 * f]) * (seeds[2 * f + 1] | np.uint64(1)), starts)
    return out


def signatures(docs: DataFrame, tables: int = 16, rows: int = 2) -> DataFrame:
    """doc_id, n, fp_a, fp_b (fingerprint of the set), u and v (half-keys), sketch; the last three null for empty sets."""
    import pyspark.sql.types as T

    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type)] + T._parse_datatype_string("n long, fp_a long, fp_b long, u array<long>, v array<long>, sketch binary").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _word_hashes()
        for batch in in_slices(batches):
            sets = [shingles((t or b"").lower().split(), hashes) for t in byte_texts(batch.column(1))]
            full = [i for i, s in enumerate(sets) if len(s)]
            fp = np.zeros((2, len(sets)), np.uint64)
            halves: list = [[None] * len(sets), [None] * len(sets)]
            sketch: list = [None] * len(sets)
            if full:
                some = [sets[i] for i in full]
                low = mix(_minhashes(some, 2 * tables * rows))
                for i, s in zip(full, some):
                    fp[0, i], fp[1, i] = mix(s ^ _ODD[40]).sum(dtype=np.uint64), mix(s ^ _ODD[41]).sum(dtype=np.uint64)
                keys = np.zeros((2 * tables, len(full)), np.uint64)
                for r in range(rows):
                    keys = mix(keys * _ODD[20] + low[r :: rows] + np.arange(2 * tables, dtype=np.uint64)[:, None])
                picks = np.resize(np.arange(len(low)), SKETCH)
                bytes_ = np.ascontiguousarray((low[picks] >> np.uint64(17)).astype(np.uint8).T)
                keys = np.ascontiguousarray(keys.T).view(np.int64)
                for k, i in enumerate(full):
                    halves[0][i], halves[1][i], sketch[i] = keys[k, :tables], keys[k, tables:], bytes_[k].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(f.view(np.int64)) for f in fp), *(pa.array(h, pa.list_(pa.int64())) for h in halves), pa.array(sketch, pa.binary())],
                names=schema.names,
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _marks(ids: DataFrame, bits: int) -> DataFrame:
    """(bucket, bits): a bitmap of 2**bits slots, set where a hash of an id falls, in rows of 4 KB; of fixed size, however many ids."""
    slot = F.pmod(F.xxhash64("id"), F.lit(1 << bits)) + 1
    parts = ids.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit"))
    return materialise(parts.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")), "marks")


def wanted_texts(docs: DataFrame, marks: DataFrame, bits: int) -> DataFrame:
    """(id, text) of the documents whose slot is set in ``marks``; a few others may be among them."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << bits)) + 1
    placed = docs.where("doc_id is not null").select(F.col("doc_id").alias("id"), "text", F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit"))
    # 2**bits bits in all, so 2 MB as set; texts never leave the JVM for it.
    is_set = F.expr("(shiftright(CAST(conv(hex(substring(bits, CAST(bit DIV 8 AS INT) + 1, 1)), 16, 10) AS INT), CAST(bit % 8 AS INT)) & 1) = 1")
    return placed.join(F.broadcast(marks), "bucket").where(is_set).select("id", "text")


def _set_of(text: bytes | None) -> np.ndarray:
    return shingles((text or b"").lower().split(), _word_hashes())


def _same_bytes():
    """Equal bytes of the sketches sa and sb, as a count."""
    return F.expr(f"aggregate(sequence(1, {SKETCH}), 0, (s, i) -> s + if(substring(sa, i, 1) = substring(sb, i, 1), 1, 0))")


def verify(pairs: DataFrame, docs: DataFrame, sig: DataFrame, percent: int, bits: int = 24) -> DataFrame:
    """The pairs (a, b) whose full sets have a similarity of ``percent`` or more."""
    side = lambda x: sig.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    least = percent / 100
    near = pairs.join(side("a"), "a").join(side("b"), "b").where(F.least("na", "nb") * 100 >= F.lit(percent) * F.greatest("na", "nb"))
    # A pair at the threshold has SKETCH * least equal bytes on average; five standard deviations below are kept.
    near = materialise(near.where(_same_bytes() >= SKETCH * least - 5 * (SKETCH * least * (1 - least)) ** 0.5).select("a", "b").distinct(), "near-pairs")
    wanted = _marks(near.select(F.col("a").alias("id")).union(near.select(F.col("b").alias("id"))), bits)
    # Texts are moved, not sets: shuffles compress words, but not hashes.
    texts = wanted_texts(docs, wanted, bits)
    met = near.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            linked = []
            for ta, tb in zip(byte_texts(batch.column(2)), byte_texts(batch.column(3))):
                x, y = _set_of(ta), _set_of(tb)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    return materialise(met.select("a", "b", "ta", "tb").mapInArrow(run, near.schema), "links")


def diagonal_pairs(reps: DataFrame) -> DataFrame:
    """(a, b): the members of each key of the diagonal tables with its leader."""
    at = F.explode(F.zip_with("u", "v", lambda x, y: F.xxhash64(x, y)))
    keyed = reps.select(F.col("doc_id").alias("id"), at.alias("key"))
    leaders = keyed.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("members")).where("members > 1").select("key", "a")
    return keyed.join(leaders, "key").where("id <> a").select("a", F.col("id").alias("b")).distinct()


def _open_halves(labelled: DataFrame, name: str) -> DataFrame:
    """(id, component, halves): of each representative the half-keys that are shared by several components."""
    rows = labelled.select("id", "component", F.explode(name).alias("half"))
    open_ = rows.groupBy("half").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("half")
    return rows.join(open_, "half").groupBy("id").agg(F.first("component").alias("component"), F.collect_list("half").alias(name))


def open_members(labelled: DataFrame) -> DataFrame:
    """(key, id, component, members) of the table keys with several components; of keys with the same members one stays."""
    crossed = _open_halves(labelled, "u").join(_open_halves(labelled, "v").drop("component"), "id").select("id", "component", F.explode("u").alias("half"), "v")
    keyed = materialise(crossed.select("id", "component", F.explode(F.transform("v", lambda x: F.xxhash64("half", x))).alias("key")), "table-keys")
    stats = keyed.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("id").alias("first"), F.count("*").alias("members"), F.bit_xor(F.xxhash64("id")).alias("print")
    )
    one = stats.where("lo <> hi").groupBy("first", "members", "print").agg(F.min("key").alias("key")).select("key", "members")
    return materialise(keyed.join(one, "key"), "open-members")


def prefix_pairs(members: DataFrame, docs: DataFrame, percent: int, bits: int = 24, slots: int = 1 << 20) -> DataFrame:
    """(a, b) of different components: all pairs of ``members`` (id, component) that may reach ``percent``."""
    import pyspark.sql.types as T

    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("set", T.ArrayType(T.LongType()))])

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            sets = [_set_of(t).view(np.int64) for t in byte_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=schema.names)

    members = materialise(members.distinct(), "large-keys")
    found = wanted_texts(docs, _marks(members, bits), bits)
    sets = materialise(found.join(members.select("id"), "id", "left_semi").select("id", "text").mapInArrow(to_sets, schema), "large-sets")
    # How often a shingle occurs is counted in a table of fixed size; any one order is right, rarest first is fast.
    counts = sets.select(F.explode("set").alias("x")).select(F.pmod("x", F.lit(slots)).alias("slot"))
    often = counts.groupBy("slot").count().where("count > 1").toPandas()
    level = np.zeros(slots, np.uint8)
    level[often["slot"].to_numpy(np.int64)] = np.log2(often["count"].to_numpy(np.float64)).astype(np.uint8)
    shapes = T.StructType([T.StructField("id", id_type)] + T._parse_datatype_string("token long, at long, n long").fields)

    def to_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 128):
            row, token, at, n = [], [], [], []
            for i, s in enumerate(batch.column(1)):
                s = s.values.to_numpy()
                first = len(s) - -(-percent * len(s) // 100) + 1
                s = s[np.lexsort((s, level[s % slots]))][:first]
                row.append(np.full(len(s), i))
                token.append(s)
                at.append(np.arange(len(s)))
                n.append(np.full(len(s), len(batch.column(1)[i])))
            columns = [batch.column(0).take(pa.array(np.concatenate(row))), *(pa.array(np.concatenate(c), pa.int64()) for c in (token, at, n))]
            yield pa.RecordBatch.from_arrays(columns, names=shapes.names)

    rows = materialise(sets.mapInArrow(to_prefixes, shapes).join(members, "id"), "prefixes")
    met = rows.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("token")
    rows = materialise(rows.join(met, "token"), "met-prefixes")
    x, y = (rows.select("token", *(F.col(c).alias(c + i) for c in ("id", "component", "at", "n"))) for i in "ab")
    size = f"100 * least(na, nb) >= {percent} * greatest(na, nb) and {100 + percent} * least(na - ata, nb - atb) >= {percent} * (na + nb)"
    pairs = x.join(y, "token").where(f"ida < idb and componenta <> componentb and {size}")
    return pairs.select(F.col("ida").alias("a"), F.col("idb").alias("b")).distinct()


def links(reps: DataFrame, docs: DataFrame, percent: int = 75, small: int = 8) -> DataFrame:
    """Links (a, b) that join all representatives of similarity ``percent`` or more into the right components."""
    sig = reps.select("doc_id", "n", "sketch")
    found = verify(diagonal_pairs(reps), docs, sig, percent)
    label = components(found).select(F.col("node").alias("id"), "component")
    labelled = reps.select(F.col("doc_id").alias("id"), "u", "v").join(label, "id", "left").withColumn("component", F.coalesce("component", "id"))
    members = open_members(materialise(labelled, "labelled"))
    x, y = (members.where(F.col("members") <= small).select("key", F.col("id").alias(i), F.col("component").alias(f"c{i}")) for i in "ab")
    pairs = x.join(y, "key").where("a < b and ca <> cb").select("a", "b").distinct()
    large = members.where(F.col("members") > small).select("id", "component")
    if not large.isEmpty():
        pairs = pairs.union(prefix_pairs(large, docs, percent)).distinct()
    return materialise(found.union(verify(pairs, docs, sig, percent)), "links")


def near_duplicates(docs: DataFrame, percent: int = 75, tables: int = 16, rows: int = 2) -> DataFrame:
    """doc_id, n_shingles, class_id (smallest doc_id with the same set), component_id, kept; one row per input row."""
    docs = docs.select("doc_id", "text")
    sig = materialise(signatures(docs, tables, rows), "signatures")
    full = sig.where("n > 0 and doc_id is not null")
    sets = ["fp_a", "fp_b", "n"]
    classes = materialise(full.groupBy(*sets).agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies")), "classes")
    reps = materialise(full.join(classes, sets).where("doc_id = class_id").dropDuplicates(sets).select("doc_id", "n", "u", "v", "sketch"), "representatives")
    many = classes.where("copies > 1").select(*sets, "class_id")
    named = join_hot(sig, many, sets, F.col("doc_id")).select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("class_id", "doc_id")).otherwise(F.col("doc_id")).alias("class_id"))
    named = materialise(named, "named-classes")
    # Rows that share a doc_id but not a text join their classes.
    shared = named.where("doc_id is not null").groupBy("doc_id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("b")).where("a <> b").select("a", "b")
    found = links(reps, docs, percent).unionByName(shared)
    label = components(found).select(F.col("node").alias("class_id"), "component")
    out = join_hot(named, label, ["class_id"], F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class_id"))
    return out.select("doc_id", "n_shingles", "class_id", component.alias("component_id"), (F.col("doc_id").isNull() | (component == F.col("doc_id"))).alias("kept"))


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One document of each group stays; of rows with one doc_id, one."""
    groups = near_duplicates(docs, **options).where("not kept and doc_id is not null").select("doc_id").distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"))
    rest = whole.join(groups.select(F.col("doc_id").alias("id")), "id", "left_anti")
    repeated = whole.where("id is not null").groupBy("id").count().where("count > 1").select("id")
    once = rest.join(repeated, "id", "left_semi").groupBy("id").agg(F.min("row").alias("row"))
    return rest.join(repeated, "id", "left_anti").select("row.*").unionByName(once.select("row.*"))


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")
