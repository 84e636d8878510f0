"""Ranked lexical search: an index in segments, Block-Max MaxScore in each, and their heaps merged.

``build_index`` cuts each input partition into segments of bounded size.  A segment numbers its documents by ascending
doc_id and holds a row per term: the term's postings (document, impact) in blocks of 128, compressed each by
itself, with the last document and the greatest impact of each block beside them, and the greatest impact of all.
An impact is what one occurrence list adds to a score but for the term's weight, so it is exact, not a
bound, and a list's bound is weight times greatest impact.  A segment's first row has no term and lists its documents.

``search`` joins the index with the asked terms, brings each segment's lists together and, for each item:

* global bounds: lists stand by ascending bound; as many of the first as cannot reach the threshold together are
  non-essential, and only documents of the others are candidates;
* block maxima: for each non-essential list the greatest impact of the one block a candidate can be in bounds what
  the list may add; candidates that cannot reach the threshold so are rejected before any of those blocks is
  decompressed; the lists that are left are read from the greatest bound down, only in blocks that still have candidates,
  rejecting after each;
* the threshold is the k-th best score so far; documents go in windows of doubling width, so it rises early.

Candidates that only tie with the threshold stay, because the smaller doc_id wins.  Segments give their k best, and
Spark's row_number keeps the k best per item, before the shuffle in each task and after it.

Items are taken in blocks of about ``block_bytes`` of text, so what is broadcast does not grow with their number.

Defined cases: null or term-less texts of documents count nowhere; items without terms, or whose terms no document
has, have no rows; repeated rows of documents rank each; repeated rows of items are answered each; null doc_ids come
last among equal scores; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_slices, materialise, read_table

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of a term stay (A-Z as a-z), all others become spaces; bytes of 128 and above are parts of term characters.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
BLOCK = 128
SCALE = 1_000_000_000


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def encode_varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the values, seven bits each with the high bit set but in a value's last; and where each ends."""
    size = np.ones(len(values), np.int8)
    for k in range(1, 5):
        size += values >= 1 << 7 * k
    ends = np.cumsum(size, dtype=np.int64)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(size.max()) if len(size) else 0):
        at = np.flatnonzero(size > k)
        own = size[at]
        out[ends[at] - own + k] = ((values[at] >> 7 * k) & 127) | np.where(own > k + 1, 128, 0)
    return out, ends


def decode_varints(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    stops = np.flatnonzero(raw < 128)
    starts = np.r_[0, stops[:-1] + 1]
    size = stops - starts + 1
    out = (raw[starts] & 127).astype(np.int64)
    for k in range(1, int(size.max()) if len(size) else 0):
        at = size > k
        out[at] |= (raw[starts[at] + k] & 127).astype(np.int64) << 7 * k
    return out


def impacts(tf: np.ndarray, length: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a term adds to a document's score, but for its weight."""
    m = 100 - 50 + (50 * length * documents) // total
    return (SCALE * tf) // (1000 * tf + 20 * m)


class _Vocabulary(dict):
    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self)
        return n


def _binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(ends) + 1, np.int32)
    offsets[1:] = ends
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


class _Segment:
    """Documents of a segment in the making."""

    def __init__(self) -> None:
        self.ids: list = []
        self.vocabulary, self.terms, self.bytes = _Vocabulary(), [], 0

    def add(self, doc_id, text: bytes) -> None:
        terms = terms_of(text)
        if terms:
            self.ids.append(doc_id)
            self.terms.append(np.fromiter(map(self.vocabulary.__getitem__, terms), np.int32, len(terms)))
            self.bytes += len(text)

    def rows(self, segment: int, documents: int, total: int, id_type: pa.DataType, names: list[str]) -> Iterator[pa.RecordBatch]:
        n = len(self.ids)
        order = sorted(range(n), key=lambda i: (self.ids[i] is None, self.ids[i]))
        local = np.empty(n, np.int64)
        local[order] = np.arange(n)
        length = np.fromiter(map(len, self.terms), np.int64, n)
        key = np.concatenate(self.terms).astype(np.int64) * n + np.repeat(local, length)
        self.terms = []
        key.sort()
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        tf = np.diff(np.r_[begin, len(key)])
        term, doc = (x.astype(np.int32) for x in np.divmod(key[begin], n))
        del key, begin
        impact = impacts(tf, length[order][doc], documents, total).astype(np.int32)
        del tf
        first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        df = np.diff(np.r_[first, len(doc)])
        begins = (np.arange(len(doc), dtype=np.int32) - np.repeat(first.astype(np.int32), df)) % BLOCK == 0
        blocks = np.flatnonzero(begins)
        pairs = np.empty(2 * len(doc), np.int32)
        pairs[0] = doc[0]
        pairs[2::2] = np.where(begins[1:], doc[1:], doc[1:] - doc[:-1])
        pairs[1::2] = impact
        data, ends = encode_varints(pairs)
        del pairs, begins
        stop = np.r_[blocks[1:], len(doc)] - 1  # the last posting of each block
        block_end = ends[2 * stop + 1]
        term_end = ends[2 * (first + df - 1) + 1]
        term_begin = np.r_[0, term_end[:-1]]
        number = -(-df // BLOCK)
        heads = np.column_stack([doc[stop], np.maximum.reduceat(impact, blocks), block_end - np.repeat(term_begin, number)]).astype("<i4")
        heads = heads[np.repeat(number > 1, number)]  # a list of one block needs no head
        head_end = np.cumsum(np.where(number > 1, number, 0)) * 12
        top = np.maximum.reduceat(impact, first)

        def batch(k: int, *columns: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(k, segment)), *columns], names=names)

        i4 = pa.int32()
        listed = pa.array([[self.ids[i] for i in order]], pa.list_(id_type))
        yield batch(1, pa.nulls(1, pa.string()), pa.array([n], i4), pa.array([0], i4), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), listed)
        names_of = pa.array(list(self.vocabulary), pa.binary()).cast(pa.string())
        yield batch(len(df), names_of, pa.array(df, i4), pa.array(top, i4), _binaries(heads.view(np.uint8).ravel(), head_end), _binaries(data, term_end), pa.nulls(len(df), pa.list_(id_type)))


def corpus_totals(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and terms in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = total = 0
        for batch in in_slices(batches, 256):
            for text in batch.column(0).cast(pa.binary()):
                n = len(terms_of(text.as_py() or b""))
                documents, total = documents + (n > 0), total + n
        yield pa.RecordBatch.from_arrays([pa.array([documents]), pa.array([total])], names=["documents", "total"])

    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("documents", "total")]
    row = docs.select("text").mapInArrow(run, "documents long, total long").agg(*sums).first()
    return row["documents"], row["total"]


def build_index(docs: DataFrame, segment_docs: int = 16384, segment_bytes: int = 16 << 20) -> tuple[DataFrame, int]:
    """The index of ``docs`` (doc_id, text) as a written table (segment, term, df, top, heads, postings, doc_ids), and the number of documents in it."""
    documents, total = corpus_totals(docs)
    id_field = docs.schema["doc_id"].dataType
    schema = T.StructType([*T._parse_datatype_string("segment long, term string, df int, top int, heads binary, postings binary").fields, T.StructField("doc_ids", T.ArrayType(id_field))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, segment, id_type = TaskContext.get().partitionId() << 24, _Segment(), None
        for batch in in_slices(batches, 256):
            id_type = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                segment.add(doc_id, text.as_py() or b"")
                if len(segment.ids) >= segment_docs or segment.bytes >= segment_bytes:
                    yield from segment.rows(number, documents, total, id_type, schema.names)
                    number, segment = number + 1, _Segment()
        if segment.ids:
            yield from segment.rows(number, documents, total, id_type, schema.names)

    return materialise(docs.select("doc_id", "text").mapInArrow(run, schema), "index"), documents


class Postings:
    """A term's list in one segment; blocks are decompressed when first asked for."""

    def __init__(self, weight: int, df: int, top: int, heads: bytes, data: bytes):
        if heads:
            table = np.frombuffer(heads, "<i4").reshape(-1, 3).astype(np.int64)
            self.last, peaks, self.ends = table[:, 0], table[:, 1], np.r_[0, table[:, 2]]
        else:
            self.last, peaks, self.ends = np.array([np.iinfo(np.int64).max]), np.array([top]), np.array([0, len(data)])
        self.data, self.df, self.bound = data, df, weight * top
        self.weight, self.peaks = weight, np.r_[peaks * weight, 0]  # past the last block nothing is added
        self.docs, self.scores = np.empty(df, np.int64), np.empty(df, np.int64)
        self.have = np.zeros(len(self.last), bool)

    def read(self, wanted: np.ndarray) -> None:
        """Decompress the blocks ``wanted`` that have not been yet; runs of neighbours at once."""
        missing = wanted[~self.have[wanted]]
        if not len(missing):
            return
        cut = np.flatnonzero(np.diff(missing) > 1) + 1
        for run in np.split(missing, cut):
            a, b = int(run[0]), int(run[-1]) + 1
            values = decode_varints(self.data[self.ends[a] : self.ends[b]]).reshape(-1, 2)
            n = len(values)
            gaps = np.zeros((b - a) * BLOCK, np.int64)
            gaps[:n] = values[:, 0]
            at = slice(a * BLOCK, a * BLOCK + n)
            self.docs[at] = np.cumsum(gaps.reshape(-1, BLOCK), axis=1).ravel()[:n]
            self.scores[at] = values[:, 1] * self.weight
            self.have[a:b] = True

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the window [low, high)."""
        a, b = np.searchsorted(self.last, [low, high - 1])
        b = min(int(b) + 1, len(self.last))
        if a >= b:
            return self.docs[:0], self.scores[:0]
        self.read(np.arange(a, b))
        docs = self.docs[a * BLOCK : b * BLOCK]
        x, y = np.searchsorted(docs, [low, high])
        return docs[x:y], self.scores[a * BLOCK + x : a * BLOCK + y]

    def add(self, docs: np.ndarray, block: np.ndarray, scores: np.ndarray) -> None:
        """Add this list's part to the ``scores`` of ``docs``, which lie in ``block`` if at all."""
        inside = np.flatnonzero(block < len(self.last))
        if not len(inside):
            return
        wanted = np.unique(block[inside])
        self.read(wanted)
        # The read blocks' postings one after another are ascending.
        at = (wanted[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        at = at[at < self.df]
        known = self.docs[at]
        place = np.minimum(np.searchsorted(known, docs[inside]), len(known) - 1)
        hit = known[place] == docs[inside]
        scores[inside[hit]] += self.scores[at[place[hit]]]


def best_in_segment(lists: list[Postings], documents: int, k: int, window: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Documents and scores of the ``k`` best of a segment, best first, ties to the smaller number; scores are above 0."""
    lists = sorted((x for x in lists if x.bound > 0), key=lambda x: x.bound)
    reach = np.cumsum([x.bound for x in lists])
    docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    threshold, low = 1, 0
    while low < documents:
        first = int(np.searchsorted(reach, threshold))  # lists before it reach less than the threshold together
        if first == len(lists):
            break
        high = min(documents, low + window)
        sums = np.zeros(high - low, np.int64)
        for x in lists[first:]:
            d, s = x.between(low, high)
            sums[d - low] += s  # a list names a document once
        candidates = np.flatnonzero(sums) + low
        own = sums[candidates - low]
        low, window = high, 2 * window
        if first:
            near = candidates[own + reach[first - 1] >= threshold]
            own = own[np.searchsorted(candidates, near)]
            candidates = near
            blocks = [np.searchsorted(x.last, candidates) for x in lists[:first]]
            rest = [x.peaks[b] for x, b in zip(lists, blocks)]
            open_ = np.sum(rest, axis=0)
            alive = np.flatnonzero(own + open_ >= threshold)
            for j in range(first - 1, -1, -1):
                if not len(alive):
                    break
                part = own[alive]
                lists[j].add(candidates[alive], blocks[j][alive], part)
                own[alive] = part
                open_ = open_ - rest[j]
                alive = alive[part + open_[alive] >= threshold]
            candidates, own = candidates[alive], own[alive]
        docs, scores = np.r_[docs, candidates], np.r_[scores, own]
        best = np.lexsort((docs, -scores))[:k]
        docs, scores = docs[best], scores[best]
        if len(docs) == k:
            threshold = max(1, int(scores[-1]))
    return docs, scores


def item_terms(items: DataFrame) -> DataFrame:
    """``items`` with ``terms``, their distinct terms."""
    lower = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    return items.withColumn("terms", F.array_distinct(F.regexp_extract_all(lower, F.lit(TERM + "+"), F.lit(0))))


def _search_block(index: DataFrame, documents: int, asked: list, k: int) -> DataFrame:
    """(key, doc_id, score) of the k best of each segment for each of ``asked`` (key, terms)."""
    spark = index.sparkSession
    words = sorted({t for row in asked for t in row["terms"]})
    queries = [(row["key"], list(row["terms"])) for row in asked]
    id_type = index.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("doc_id", id_type), T.StructField("score", T.LongType())])
    # At most the terms of one block of items.
    wanted = F.broadcast(spark.createDataFrame([(w,) for w in words], "term string"))
    hits = index.where(F.col("term").isNotNull()).join(wanted, "term")
    weight = F.floor(1000 * F.log((2.0 * documents + 2) / (2 * F.col("n") + 1)))
    weights = hits.groupBy("term").agg(F.sum(F.col("df").cast("long")).alias("n")).select("term", weight.cast("long").alias("weight"))
    hits = hits.join(F.broadcast(weights), "term")
    heads = index.where(F.col("term").isNull()).withColumn("weight", F.lit(0).cast("long"))

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        at = {t: i for i, t in enumerate(rows["term"])}
        ids, lists, out = rows["doc_ids"][at[None]], {}, ([], [], [])
        for key, terms in queries:
            own = []
            for t in terms:
                if t not in lists and t in at:
                    i = at[t]
                    lists[t] = Postings(rows["weight"][i], rows["df"][i], rows["top"][i], rows["heads"][i], rows["postings"][i])
                if t in lists:
                    own.append(lists[t])
            docs, scores = best_in_segment(own, len(ids), k)
            out[0].extend([key] * len(docs))
            out[1].extend(ids[d] for d in docs.tolist())
            out[2].extend(scores.tolist())
        types = (pa.int64(), table.schema.field("doc_ids").type.value_type, pa.int64())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=schema.names)

    columns = ["segment", "term", "df", "top", "heads", "postings", "doc_ids", "weight"]
    return hits.select(*columns).unionByName(heads.select(*columns)).groupBy("segment").applyInArrow(run, schema)


def search(index: DataFrame, documents: int, items: DataFrame, k: int = 50, block_bytes: int = 8 << 20) -> DataFrame:
    """The ``k`` best documents of each of ``items`` (item_id, text): item_id, rank, doc_id, score."""
    keyed = materialise(item_terms(items.select("item_id", "text")).select("item_id", "terms", F.octet_length("text").alias("bytes"), F.monotonically_increasing_id().alias("key")).where(F.size("terms") > 0), "items")
    blocks = math.ceil((keyed.agg(F.sum("bytes")).first()[0] or 0) / block_bytes)
    found = None
    for b in range(blocks):
        asked = keyed.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b).select("key", "terms").collect()
        if asked:
            part = materialise(_search_block(index, documents, asked, k), "found")
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = index.where("false").select(F.col("segment").alias("key"), F.col("doc_ids")[0].alias("doc_id"), F.col("segment").alias("score"))
    order = Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(keyed.select("key", "item_id"), "key").select("item_id", "rank", "doc_id", "score")


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index holds all documents and all their terms; the items of ``benchmark`` are searched in it."""
    index, documents = build_index(read_table(spark, sf_dir, "documents"))
    return search(index, documents, read_table(spark, sf_dir, "benchmark"))


#: DuckDB SQL: exhaustive scoring.
ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, terms, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0),
s AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM l),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
p AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM l) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
x AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))) AS score FROM p JOIN w USING (term), s),
r AS (SELECT item_id, doc_id, sum(score)::BIGINT AS score FROM q JOIN x USING (term) GROUP BY item_id, doc_id),
o AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM o WHERE rank <= 50
"""
