"""Best-fit packing, the prefix trie and ranked search against brute force, with the defined cases."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import best_fit, lexical, prefix_trie

SMALL = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t ", "word", "É́ ß 漢字 \U0001f600", "x" * 30_000, "a b  c\n\n\n d e\tf  \n g h. " * 900, "a b c d e f g h. " * 900, "<|endoftext|> a\n\n <|endoftext|>", "\x00 nul \x85 next line"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "k", 1, "s") for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[6], (None, "one two", None, None, None)], "doc_id long, text string, key string, length int, term string").repartition(3).cache()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(best_fit.default_tokenizer()["path"])


def test_best_fit_holds_every_token_once(spark, odd, docs, tokenizer):
    for df, options, over in ((odd, {}, 0), (docs, {}, 1), (docs, {"block_items": 40, "children": 60}, 4)):
        want = collections.Counter()
        for r in df.select("doc_id", "text").collect():
            ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
            first = len(ids) % 1024 or 1024
            edges = [0, *range(first, len(ids) + 1, 1024)]
            for k, (a, b) in enumerate(itertools.pairwise(edges)):
                want[r.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
        rows = best_fit.pack_best_fit(df, digest=True, **options).collect()
        assert collections.Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in rows) == want
        bins = collections.defaultdict(list)
        for p in rows:
            bins[p.sequence_id].append((p.offset, p.length))
        for b in bins.values():
            at = 0
            for offset, length in sorted(b):
                assert offset == at
                at += length
            assert at <= 1024
        short = [p.length for p in rows if p.length < 1024]
        assert len(bins) - (len(rows) - len(short)) <= best_fit.lower_bound(short, 1024) + over
        full = best_fit.pack_best_fit(df, **options).collect()
        assert collections.Counter((p.doc_id, p.piece, zlib.crc32(p.input_ids)) for p in full) == collections.Counter((d, k, c) for d, k, _, _, c in want.elements())
    assert best_fit.pack_best_fit(odd.where("doc_id = -1")).count() == 0


def test_best_fit_encoders_agree_on_code_points(tokenizer):
    encoder = best_fit.Encoder(**best_fit.default_tokenizer())
    points = [c for c in range(0, 0x110000, 97) if not 0xD800 <= c < 0xE000] + list(range(0x300)) + list(range(0x2000, 0x2070)) + [0x1680, 0x3000, 0xFEFF]
    texts = [f"a{chr(c)}1{chr(c)}.{chr(c)} {chr(c)}a {chr(c)}1 {chr(c)}.\n{chr(c)}" for c in points]
    texts += ["".join(x) for x in itertools.product(" \n\ta1.'", repeat=4)]
    assert all(encoder.encode(t) == tokenizer.encode(t, add_special_tokens=False).ids for t in texts)


def test_best_fit_children_are_packings_and_the_fittest_improves():
    rng, own = np.random.default_rng(3), random.Random(3)
    sizes = sorted(rng.integers(200, 600, 400).tolist(), reverse=True)
    population = best_fit.first_packings(sizes, 1024, 6, own, True)
    start = len(population[0].fills)
    for _ in range(60):
        child = best_fit.cross(*own.sample(population, 2), sizes, 1024, own, 20)
        assert sorted(i for m in child.members for i in m) == list(range(400))
        assert all(0 < f <= 1024 and f == sum(sizes[i] for i in m) for f, m in zip(child.fills, child.members))
        assert all(i in child.members[slot] for i, slot in enumerate(child.where))
    found = best_fit.evolve(population, sizes, 1024, own, 1500, 20)
    assert best_fit.lower_bound(sizes, 1024) <= len(found[0].fills) < start
    assert best_fit.lower_bound([600] * 10, 1024) == 10 and best_fit.lower_bound([1024, 1024, 1], 1024) == 3


def test_best_fit_uses_migrants(spark):
    items = spark.range(600).select(F.col("id").alias("key"), (200 + F.pmod(F.xxhash64("id"), F.lit(400))).cast("int").alias("length"))
    found = {islands: best_fit.pack_items(items, 1024, block_items=1000, islands=islands, epochs=3, children=200).agg(F.countDistinct("sequence_id")).first()[0] for islands in (1, 3)}
    state = best_fit.evolved_blocks(items, 1, 1024, 4, 3, 2, 50, 6)
    assert state.count() == 600 and found[3] <= found[1]


def brute_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            d = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append((turn is not None, turn or 0, d, role, text))
    rebuilt = {}
    turns = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = turns.get(c - int(math.fmod(c, 5)), [])[:h] + turns[c][h:]
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:d])].append(c)
        ends[tuple(rebuilt[c])].append(c)
    kids = collections.Counter(n[:-1] for n in members if n)
    leaves, saved = collections.Counter(), collections.Counter()
    for n, m in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += kids[n] == 0
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1].encode()) if n else 0
    return sorted(
        (m[0], len(n), members[n[:-1]][0] if n else -1, len(m), kids[n], leaves[n], saved[n], hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest()) for n, m in members.items()
    )


@pytest.mark.parametrize("height", [1, 2, 3, 8])
def test_trie_matches_brute_force(spark, height):
    rng = random.Random(height)
    rows = []
    for c in [*range(40), -3, -7, 10**12, 10**12 + 3, 83]:
        n = 120 if c == 11 else rng.randrange(1, 14)
        for t in range(n):
            rows.append((c, None if rng.random() < 0.1 else t, rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "é", None, "", "same"])))
    rows += [(None, 0, "user", "lost"), rows[0], rows[0]]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, pos string, depth int").repartition(3)
    got = sorted(tuple(-1 if v is None else v for v in r) for r in prefix_trie.prefix_trie(df, least_height=height).collect())
    assert got == brute_trie(rows)
    assert prefix_trie.prefix_trie(df.where("conv_id = 5000")).count() == 0


def test_trie_hashes_are_the_same_in_small_chunks(spark):
    ends = spark.range(500).select(F.unhex(F.md5((F.col("id") % 3 > 0).cast("string"))).alias("id"), F.col("id").alias("conv_id"))
    got = {bytes(r.id): r.sha256 for r in prefix_trie.ordered_hash(ends, chunk=20).collect()}
    for flag, name in ((True, "true"), (False, "false")):
        ids = ",".join(str(i) for i in range(500) if (i % 3 > 0) == flag)
        assert got[hashlib.md5(name.encode()).digest()] == hashlib.sha256(ids.encode()).hexdigest()


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(lexical.UPPER, lexical.LOWER)


def brute_search(docs, items, k):
    terms = [(d, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    terms = [(d, c) for d, c in terms if c]
    n, total = len(terms), sum(sum(c.values()) for _, c in terms)
    df = collections.Counter(t for _, c in terms for t in c)
    out = []
    for item, text in items:
        asked = set(TERM.findall((text or "").translate(LOWER))) & set(df)
        scores = []
        for d, c in terms:
            m = 50 + 50 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2.0 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in asked)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, r + 1, None if x[1] else x[2], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("segment,block_bytes", [(16384, 8 << 20), (37, 300)])
def test_search_matches_brute_force(spark, odd, docs, segment, block_bytes):
    items = spark.createDataFrame([(1, "Word one É́ zzz"), (2, None), (3, ""), (4, "nowhere"), (1, "a b C"), (None, "x1 漢字 h")], "item_id long, text string")
    for df, asked in ((odd, items), (docs, spark.read.parquet(f"{SMALL}/benchmark.parquet").unionByName(items))):
        index, n = lexical.build_index(df, segment_docs=segment)
        got = [tuple(r) for r in lexical.search(index, n, asked, 50, block_bytes).collect()]
        want = brute_search([tuple(r) for r in df.select("doc_id", "text").collect()], [tuple(r) for r in asked.select("item_id", "text").collect()], 50)
        assert sorted(got, key=str) == want
    index, n = lexical.build_index(odd.where("doc_id = -1"))
    assert lexical.search(index, n, items).count() == 0 and lexical.search(index, n, items.limit(0)).count() == 0


def test_search_prunes_without_loss_and_leaves_blocks_compressed():
    rng = np.random.default_rng(5)
    documents, read, held = 9000, 0, 0
    for _ in range(6):
        lists, scores = [], np.zeros(documents, np.int64)
        for share in (0.9, 0.7, 0.6, 0.4, 0.05, 0.02, 0.004, 0.001):
            docs = np.flatnonzero(rng.random(documents) < share)
            impact, weight = rng.integers(1, 900_000, len(docs)), int(700 * -math.log(share)) + 1
            pairs, heads, at = [], [], 0
            for b in range(0, len(docs), 128):
                block = docs[b : b + 128]
                data, _ = lexical.encode_varints(np.column_stack([np.diff(np.r_[0, block]), impact[b : b + 128]]).ravel())
                at += len(data)
                pairs.append(data.tobytes())
                heads.append((block[-1], impact[b : b + 128].max(), at))
            head = np.array(heads, "<i4").tobytes() if len(heads) > 1 else b""
            lists.append(lexical.Postings(weight, len(docs), int(impact.max()), head, b"".join(pairs)))
            scores[docs] += weight * impact
        got = lexical.best_in_segment(lists, documents, 50)
        want = np.lexsort((np.arange(documents), -scores))[:50]
        assert got[0].tolist() == want.tolist() and got[1].tolist() == scores[want].tolist()
        read += sum(int(x.have.sum()) for x in lists)
        held += sum(len(x.have) for x in lists)
    assert read < held
    values = np.array([0, 1, 127, 128, 16383, 16384, (1 << 21) - 1, 1 << 21, 1 << 30], np.int64)
    assert lexical.decode_varints(lexical.encode_varints(values)[0].tobytes()).tolist() == values.tolist()


def test_queries_run(spark):
    from riskloom.llm.registry import QUERIES

    pieces = QUERIES["op11_best_fit"](spark, SMALL)
    assert pieces.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and pieces.count() >= 200
    assert QUERIES["op12_prefix_trie"](spark, SMALL).where("depth = 0").count() == 1
    ranked = QUERIES["op13_lexical"](spark, SMALL)
    assert ranked.columns == ["item_id", "rank", "doc_id", "score"] and ranked.count() > 0


def test_latin_words_get_the_tokenizers_ids():
    """Each entry of the vocabulary is encoded as itself by its merges, and words of all kinds get the tokenizer's ids."""
    import json

    from tokenizers import Tokenizer

    from riskloom.llm.packing import LatinWords, WordEncoder, default_tokenizer

    path = default_tokenizer()
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    rank = {tuple(pair): k for k, pair in enumerate(model["merges"])}
    assert len({a + b for a, b in rank}) == len(rank)
    for (a, b), k in rank.items():
        assert model["vocab"][a + b] == 512 + k  # ranks follow the order of the merges
        body, end = ((a + b)[:-4], "</w>") if b.endswith("</w>") else (a + b, "")
        parts = [*body[:-1], body[-1] + end]
        while len(parts) > 1:
            least = min(range(len(parts) - 1), key=lambda i: rank.get((parts[i], parts[i + 1]), len(rank)))
            assert (parts[least], parts[least + 1]) in rank
            parts[least : least + 2] = [parts[least] + parts[least + 1]]
    tokenizer, latin = Tokenizer.from_file(path), LatinWords.of(path)
    odd = ["don't", "I'LL", "'Ve's", "x²", "a½b", "İx", "ſs", "Ÿ", "ŉ", "<|endoftext|>", "a<|startoftext|>b", "<|x", "a\x01b", "\0", "a\0", "éa", "ΑΣ", "x\x1cy", "日本", "¿qué", "×÷", "!!!'s...", "a" * 500, "''s'", "_a_1", "１２", "\x85"]
    chars = [chr(c) for c in [*range(0x21, 0x7F), *range(0xC0, 0x180)] if c != 0x130]
    words = [a + b + c for a in chars[::3] for b in "sD'é9-" for c in ("", "a", ".")] + chars
    assert all(map(latin.takes, words)) and not latin.takes("İx") and not latin.takes("a<|startoftext|>b")
    mixed = [w for pair in zip(words, odd * (len(words) // len(odd) + 1)) for w in pair]
    encoder = WordEncoder(path, limit=400)  # words are forgotten and met again
    for some in (mixed, mixed[::-1], odd):
        for i in range(0, len(some), 300):
            for word, (ids, _) in zip(some[i : i + 300], encoder.encode([[w.encode()] for w in some[i : i + 300]])):
                assert ids.tolist() == tokenizer.encode(word, add_special_tokens=False).ids, word
