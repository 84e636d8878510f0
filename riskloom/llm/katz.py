"""Katz backoff over word pairs, with Good-Turing discounts and exactly normalised backoff weights.

Counts r up to ``K`` are discounted by Good-Turing ratios from the counts of counts (by half a count
each where those give no ratio between 0 and 1); larger counts give up ``SPARE`` of a count, so every
context keeps some mass.  Evaluation recurses from pairs to words to the one unknown word:

    p(w | h) = d(r) r / c(h)        if the pair (h, w) was seen r times
               alpha(h) p(w)        if not, alpha(h) = (1 - sum of seen p(. | h)) / (1 - sum of their p(.))
               p(w)                 if h is no context of the training texts
    p(w)     = d(c) c / N           if the word was seen c times, else the mass that is left

Words are 64-bit hashes.  Word counts are one table.  Words seen most often, up to ``head_words`` of them
(a bound), are broadcast with their counts; all others, the *tail*, meet their counts in joins.  Tokens
are dealt once, in compressed blocks, to buckets of their context; contexts that would fill much of a bucket
are spread further by the word.  Within a bucket pair counts are complete, so a bucket returns, in tables
partitioned by kind: its pair counts (the model), counts of counts, for each document how many of its
tokens met pairs of each count, the tokens that back off, and for their contexts the sums that alpha
needs.  Discounts are applied to these afterwards, so one pass over the texts does for counting and scoring.

Defined cases: null and empty texts are the end alone; a null doc_id counts as the empty string for the
split; repeated rows are texts of their own; with no training text every word is unknown and every
probability one; empty input gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordHashes, byte_texts, in_slices, materialise, mix, process_cache, read_table, scratch_path, word_hash

K, SPARE = 5, 0.1
END, START = word_hash(b"\n"), word_hash(b"\n\n")  # white space: never words
TAIL = np.uint32(1 << 31)


def discounted(n_r: list[float]) -> list[float]:
    """Counts 1..K after discounting; n_r[i] is the number of types seen i + 1 times, for i up to K."""
    n = [0.0, *n_r]
    try:
        cut = (K + 1) * n[K + 1] / n[1]
        out = [((r + 1) * n[r + 1] / n[r] - r * cut) / (1 - cut) for r in range(1, K + 1)]
    except ZeroDivisionError:
        out = []
    if len(out) == K and all(0 < x < r for r, x in enumerate(out, 1)):
        return out
    return [r - 0.5 for r in range(1, K + 1)]


def left_of(count, low: list[float]):
    """The discounted count as a column."""
    out = count - F.lit(SPARE)
    for r in range(K, 0, -1):
        out = F.when(count == r, F.lit(low[r - 1])).otherwise(out)
    return out


def _words(batch: pa.RecordBatch, at: int) -> Iterator[np.ndarray]:
    hashes = process_cache("word hashes", WordHashes)
    for text in byte_texts(batch.column(at)):
        yield hashes.of((text or b"").lower().split())


def word_counts(texts: DataFrame, flush: int = 1 << 21) -> DataFrame:
    """(w, c) over the training texts, the end included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            w, c = np.unique(np.concatenate(waiting), return_counts=True)
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array(w), pa.array(c.astype(np.int64))], names=["w", "c"])

        held = 0
        for batch in in_slices(batches):
            own = [np.append(w, END) for w in _words(batch, 0)]
            waiting += own
            held += sum(map(len, own))
            if held > flush:
                yield counted()
                held = 0
        if waiting:
            yield counted()

    return texts.where("not held").select("text").mapInArrow(run, "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))


def _pack(*arrays: np.ndarray) -> bytes:
    import zstandard

    body = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(np.array([len(a) for a in arrays], "<i8").tobytes() + body)


def _unpack(blob: bytes, *types: str) -> list[np.ndarray]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(blob)
    at, out = 8 * len(types), []
    for n, t in zip(np.frombuffer(data, "<i8", len(types)).tolist(), types):
        out.append(np.frombuffer(data, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


class Head:
    """Frequent words, sorted by hash, with their counts; what every task gets (12 bytes a word and a bound on words)."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, spread_from: float):
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        self.hot = self.words[self.counts > spread_from]

    def find(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among the head's words, and which of w are there."""
        if not len(self.words):
            return np.zeros(len(w), np.int64), np.zeros(len(w), bool)
        at = np.minimum(np.searchsorted(self.words, w), len(self.words) - 1)
        return at, self.words[at] == w


def token_blocks(texts: DataFrame, head: Head, buckets: int, flush: int = 1 << 21) -> DataFrame:
    """(bucket, first, block): tokens with their contexts and documents, packed by bucket; keys are first + place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        words: list[np.ndarray] = []
        flags: list[np.ndarray] = []

        def blocks() -> pa.RecordBatch:
            sizes = np.array([len(w) + 1 for w in words])
            n = int(sizes.sum())
            ends = np.cumsum(sizes)
            h, w = np.empty(n, np.int64), np.empty(n, np.int64)
            w[:] = END
            inner = np.ones(n, bool)
            inner[ends - 1] = False
            w[inner] = np.concatenate(words)
            h[1:], h[0] = w[:-1], START
            h[ends[:-1]] = START
            doc = np.repeat(np.arange(len(words)), sizes)
            key, held = np.diff(np.concatenate(keys), prepend=0), np.packbits(np.concatenate(flags))  # keys mostly rise by one
            slot = mix(h.view(np.uint64))
            if len(head.hot):
                hot = np.isin(h, head.hot)
                slot[hot] ^= mix(w[hot].view(np.uint64) + np.uint64(1))
            slot = (slot % np.uint64(buckets)).astype(np.int64)
            # By bucket, then by context (the leading bits of its hash: runs of two contexts that share them are only shorter).
            order = np.argsort((slot.astype(np.uint64) << np.uint64(40)) | (mix(h.view(np.uint64)) >> np.uint64(24)), kind="stable")
            slot, h, w, doc = slot[order], h[order], w[order], doc[order]
            cuts = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1], [True]]))
            out = []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                runs = np.flatnonzero(np.concatenate([[True], h[a + 1 : b] != h[a : b - 1]]))
                at, there = head.find(w[a:b])
                code = at.astype(np.uint32)
                tail, place = np.unique(w[a:b][~there], return_inverse=True)
                code[~there] = place.astype(np.uint32) | TAIL
                step = np.diff(doc[a:b], prepend=0).astype("<i4")
                out.append((int(slot[a]), _pack(h[a:b][runs], np.diff(np.append(runs, b - a)).astype("<u4"), tail, code, step, key, held)))
            keys.clear(), words.clear(), flags.clear()
            return pa.RecordBatch.from_arrays([pa.array([s for s, _ in out]), pa.array([x for _, x in out], pa.binary())], names=["bucket", "block"])

        waiting = 0
        for batch in in_slices(batches):
            keys.append(batch.column(0).to_numpy())
            flags.append(batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint8))
            own = list(_words(batch, 2))
            words += own
            waiting += sum(map(len, own)) + 64 * len(own)
            if waiting > flush:
                yield blocks()
                waiting = 0
        if words:
            yield blocks()

    return texts.select("key", "held", "text").mapInArrow(run, "bucket long, block binary")


OUT = "kind int, key long, h long, w long, n long, x array<double>, block binary"


def _bucket_counts(head: Head, p_head: np.ndarray, train_docs: int):
    """One bucket's blocks -> rows of ``OUT``; kinds: 0 counts of counts, 1 documents, 2 contexts, 3 tail pairs, 4 backoffs, 5 the model."""

    def run(table: pa.Table) -> pa.Table:
        hs, ws, docs, keys, flags, base = [], [], [], [], [], 0
        for blob in table.column("block").to_pylist():
            h, runs, tail, code, step, key, held = _unpack(blob, "<i8", "<u4", "<i8", "<u4", "<i4", "<i8", "u1")
            hs.append(np.repeat(h, runs))
            far = code >= TAIL
            w = np.empty(len(code), np.int64)
            w[far], w[~far] = tail[(code[far] ^ TAIL).astype(np.int64)], head.words[code[~far].astype(np.int64)]
            ws.append(w)
            docs.append(np.cumsum(step.astype(np.int64)) + base)
            keys.append(np.cumsum(key)), flags.append(np.unpackbits(held, count=len(key)).astype(bool))
            base += len(key)
        h, w, doc, key, held_doc = map(np.concatenate, (hs, ws, docs, keys, flags))
        held = held_doc[doc]
        contexts, hi = np.unique(h, return_inverse=True)
        pair = mix(h.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + w.view(np.uint64))
        _, first, pi = np.unique(pair, return_index=True, return_inverse=True)
        r_of = np.bincount(pi, weights=~held, minlength=len(first)).astype(np.int64)
        c_of = np.bincount(hi, weights=~held, minlength=len(contexts)).astype(np.int64)
        at, there = head.find(contexts)
        hot = np.isin(contexts, head.hot)
        c_of[hot] = head.counts[at[hot]]
        rows: list[dict] = [{"kind": 0, "x": np.bincount(np.minimum(r_of, K + 2), minlength=K + 3)[1 : K + 2].astype(float).tolist()}]
        r, c = r_of[pi], c_of[hi]
        seen = r > 0
        # Documents: tokens by pair count up to K, and the logarithms that need no discount.
        log = np.where(r > K, np.log10(np.maximum(r - SPARE, 1e-9)), 0.0) - np.log10(np.maximum(c, 1))
        met, di = np.unique(doc[seen], return_inverse=True)
        by_r = [np.bincount(di, weights=r[seen] == k, minlength=len(met)).astype("<u4") for k in range(1, K + 1)]
        logs = np.bincount(di, weights=log[seen], minlength=len(met))
        part = key[met] >> 12  # documents near each other meet again in one group
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.concatenate([[True], part[order][1:] != part[order][:-1], [True]])) if len(met) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            o = order[a:b]
            rows.append({"kind": 1, "key": int(part[o[0]]), "block": _pack((key[met[o]] & 4095).astype("<u2"), *[x[o] for x in by_r], logs[o])})
        # Tokens that back off, and what their contexts' weights need; spread contexts always tell their part.
        off = ~seen
        need = hot & (c_of > 0)
        need[hi[off & (c > 0)]] = True
        ph, pw = hi[first], w[first]
        pick = need[ph] & (r_of > 0)
        wa, wt = head.find(pw)
        known = np.bincount(ph[pick & wt], weights=p_head[wa[pick & wt]] if len(p_head) else None, minlength=len(contexts))
        by_h = [np.bincount(ph[pick & (r_of == k)], minlength=len(contexts)) for k in range(1, K + 1)]
        big = pick & (r_of > K)
        rest = np.bincount(ph[big], weights=r_of[big] - SPARE, minlength=len(contexts))
        for i in np.flatnonzero(need).tolist():
            rows.append({"kind": 2, "h": int(contexts[i]), "n": int(c_of[i]), "x": [*(float(b[i]) for b in by_h), float(rest[i]), float(known[i])]})
        have = np.flatnonzero(r_of > 0)
        have = have[np.argsort(ph[have], kind="stable")]
        rows.append({"kind": 5, "block": _pack(contexts[ph[have]], pw[have], r_of[have].astype("<u4")) if len(have) else b""})
        tail = np.flatnonzero(pick & ~wt)
        columns = [
            pa.Table.from_pylist(rows, schema=_OUT_ARROW),
            _plain(3, h=contexts[ph[tail]], w=pw[tail]),
            _plain(4, key=key[doc[off]], h=h[off], w=w[off], n=(c[off] > 0).astype(np.int64)),
        ]
        return pa.concat_tables(columns)

    return run


_OUT_ARROW = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("h", pa.int64()), ("w", pa.int64()), ("n", pa.int64()), ("x", pa.list_(pa.float64())), ("block", pa.binary())])


def _plain(kind: int, **columns: np.ndarray) -> pa.Table:
    n = len(next(iter(columns.values())))
    return pa.table({f.name: pa.array(columns[f.name]) if f.name in columns else pa.array(np.full(n, kind, np.int32)) if f.name == "kind" else pa.nulls(n, f.type) for f in _OUT_ARROW}, schema=_OUT_ARROW)


def _sum_documents(table: pa.Table) -> pa.Table:
    """Blocks of kind 1 of one group of documents -> a row for each document."""
    sums = np.zeros((K + 1, 4096))
    hit = np.zeros(4096, bool)
    for blob in table.column("block").to_pylist():
        at, *rest = _unpack(blob, "<u2", *["<u4"] * K, "<f8")
        hit[at] = True
        for i, x in enumerate(rest):
            sums[i, at] += x
    places = np.flatnonzero(hit)
    key = (np.int64(table.column("key")[0].as_py()) << 12) + places
    return pa.table([pa.array(key), *(pa.array(s[places]) for s in sums)], names=["key", *(f"m{k}" for k in range(1, K + 1)), "log"])


def plain_tokens(texts: DataFrame, head: Head, total: int, types: int) -> DataFrame:
    """A row (w null-free, n tokens, known, base) for each document's frequent words, and (w, n, known null) for each other word."""
    base_head = np.log10((head.counts + 0.1) / (total + 0.1 * (types + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            if not batch.num_rows:
                continue
            key, own = batch.column(0).to_numpy(), [np.append(w, END) for w in _words(batch, 1)]
            doc, words = np.repeat(np.arange(len(own)), [len(w) for w in own]), np.concatenate(own)
            at, there = head.find(words)
            known = np.bincount(doc[there], minlength=len(own))
            base = np.bincount(doc[there], weights=base_head[at[there]] if len(base_head) else None, minlength=len(own))
            d, w = doc[~there], words[~there]
            order = np.lexsort((w, d))
            d, w = d[order], w[order]
            first = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (w[1:] != w[:-1])])) if len(d) else np.zeros(0, np.int64)
            d, w, n = d[first], w[first], np.diff(np.append(first, len(d)))
            zero = np.zeros(len(d))
            columns = [np.append(key, key[d]), np.append(key ^ 0x5BD1E995, w), np.append(known, n), np.append(np.ones(len(key), bool), zero.astype(bool)), np.append(base.astype(float), zero)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "w", "n", "whole", "base"])

    return texts.select("key", "text").mapInArrow(run, "key long, w long, n long, whole boolean, base double")


def katz_scores(docs: DataFrame, held_out, head_words: int = 200_000, bucket_tokens: int = 1 << 19, written: bool = False) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: log10 probabilities of whole texts.

    Rows are numbered, and several passes must number them alike.  Only the scan of a written table does so by itself, so other
    input is written first; ``written`` says that ``docs`` is such a scan.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", held_out.alias("held"))
    texts = (docs if written else materialise(docs, "texts")).withColumn("key", F.monotonically_increasing_id())
    counts = materialise(word_counts(texts), "word-counts")
    train_docs = texts.where("not held").count()
    # Counts above 2**17 are one class here, so that this stays small.
    classes = {r["c"]: (r["types"], r["tokens"]) for r in counts.groupBy(F.least("c", F.lit(1 << 17)).alias("c")).agg(F.count("*").alias("types"), F.sum("c").alias("tokens")).collect()}
    types, total = sum(n for n, _ in classes.values()), sum(t for _, t in classes.values())
    low = discounted([float(classes.get(r, (0, 0))[0]) for r in range(1, K + 2)])
    spent = sum(n * low[c - 1] if c <= K else t - SPARE * n for c, (n, t) in classes.items())
    unknown = 1 - spent / total if total else 1.0
    least, taken = 1 << 62, 0
    for c in sorted(classes, reverse=True):
        taken += classes[c][0]
        if taken > head_words:
            break
        least = c
    top = counts.where(F.col("c") >= least).toPandas()
    buckets = max(1, -(-total // bucket_tokens))
    head = Head(np.append(top["w"].to_numpy(np.int64), START), np.append(top["c"].to_numpy(np.int64), train_docs), bucket_tokens / 8)
    is_start = head.words == START
    c = head.counts
    p_head = np.where(is_start, 0.0, np.where(c > K, c - SPARE, np.array([0.0, *low])[np.minimum(c, K)]) / max(total, 1))

    out = token_blocks(texts, head, buckets).groupBy("bucket").applyInArrow(_bucket_counts(head, p_head, train_docs), OUT)
    path = scratch_path(spark, "katz")
    out.write.partitionBy("kind").parquet(path)
    kind = lambda k: spark.read.schema(OUT.replace("kind int, ", "") + ", kind int").parquet(path).where(F.col("kind") == k)
    n_r = kind(0).agg(*[F.sum(F.element_at("x", r)).alias(f"n{r}") for r in range(1, K + 2)]).first()
    low2 = discounted([float(x or 0) for x in n_r])

    tokens = plain_tokens(texts, head, total, types).alias("t").join(counts.select("w", F.lit(False).alias("whole"), "c"), ["w", "whole"], "left")
    unseen = F.log10((F.coalesce("c", F.lit(0)) + 0.1) / F.lit(total + 0.1 * (types + 1)))
    base = tokens.groupBy("key").agg(
        F.sum("n").alias("n_tokens"), F.sum(F.when(F.col("whole") | F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.when(F.col("whole"), F.col("base")).otherwise(F.col("n") * unseen)).alias("base_score"),
    )
    p = left_of(F.col("c"), low) / F.lit(float(max(total, 1)))
    tail = kind(3).select("h", "w").join(counts, "w").groupBy("h").agg(F.sum(p).alias("tail"))
    x = [F.sum(F.element_at("x", i)).alias(f"x{i}") for i in range(1, K + 3)]
    used = sum((F.col(f"x{r}") * F.lit(low2[r - 1]) for r in range(1, K + 1)), F.col(f"x{K + 1}"))
    alpha = kind(2).groupBy("h").agg(F.max("n").alias("c_h"), *x).join(tail, "h", "left")
    alpha = materialise(alpha.select("h", ((1 - used / F.col("c_h")) / (1 - F.col(f"x{K + 2}") - F.coalesce("tail", F.lit(0.0)))).alias("alpha")), "alpha")
    back = kind(4).select("key", "h", "w", "n").join(alpha, "h", "left").join(counts, "w", "left")
    back = back.select("key", (F.log10(F.coalesce(p, F.lit(unknown))) + F.when(F.col("n") == 1, F.log10("alpha")).otherwise(F.lit(0.0))).alias("log"))
    back = back.groupBy("key").agg(F.sum("log").alias("backed"))
    doc_schema = "key long, " + ", ".join(f"m{k} double" for k in range(1, K + 1)) + ", log double"
    direct = kind(1).select("key", "block").groupBy("key").applyInArrow(_sum_documents, doc_schema)
    logs = sum((F.col(f"m{r}") * F.log10(F.lit(low2[r - 1])) for r in range(1, K + 1)), F.col("log"))
    scored = base.join(direct.select("key", logs.alias("direct")), "key", "left").join(back, "key", "left")
    zero = F.lit(0.0)
    scored = scored.select("key", "n_tokens", "n_known", "base_score", (F.coalesce("direct", zero) + F.coalesce("backed", zero)).alias("score"))
    return texts.select("doc_id", "held", "key").join(scored, "key").select("doc_id", F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def op3_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    return katz_scores(docs, held, written=True)
