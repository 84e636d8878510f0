"""Small fixtures for the training-data operators: brute force, round trips and defined cases."""

import base64
import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import ann, chat, graph, katz, mixing, near_dup, packing, pii, quality, toxicity, warc

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, row string, mix string, quality string, pii string, key long"
ODD = [None, "", " \n\t ", "word", "É́ ß 漢字 \U0001f600", "x" * 30_000, "a b c d e f g h. " * 2_000, "a b c d e f g h. " * 2_000]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, null ids and columns with clashing names."""
    rows = [(i, t, None if i % 3 == 0 else f"s{i % 2}", "r", "m", "q", "p", i) for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[6], (None, "one two", None, None, None, None, None, None)], SCHEMA).repartition(2).cache()


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("doc_id = -1")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def words(text):
    return (text or "").encode().split()


def test_packing_holds_every_token_once(spark, odd, none, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    for df in (odd, docs):
        ids = collections.defaultdict(list)
        for r in df.select("doc_id", "text").collect():
            ids[r.doc_id].append(np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4"))
        pieces = packing.packed_digest(df).collect()
        assert sum(p.length for p in pieces) == sum(len(a) for x in ids.values() for a in x)
        for p in pieces:
            a = ids[p.doc_id][0]
            assert p.doc_tokens == len(a) and p.ids_crc32 == zlib.crc32(a[p.start : p.start + p.length].tobytes())
        sequences = collections.defaultdict(list)
        for p in pieces:
            sequences[p.sequence_id].append((p.offset, p.length))
        for s in sequences.values():
            at = 0
            for offset, length in sorted(s):
                assert offset == at
                at += length
            assert at <= 4096
    assert packing.packed_digest(none).count() == 0


def test_packing_cuts_cost_as_little_as_any():
    rng = np.random.default_rng(1)
    for _ in range(30):
        pos = np.concatenate([[0], np.cumsum(rng.integers(1, 6, 12))])
        cost = np.concatenate([[0.0], rng.integers(0, 4, 12)])
        best = [0.0] + [math.inf] * 12
        for i in range(1, 13):
            best[i] = min(best[j] + 8 - (pos[i] - pos[j]) + cost[i] for j in range(i) if pos[i] - pos[j] <= 8)
        cuts = packing.best_cuts(pos, cost, 8)
        got = sum(8 - (pos[b] - pos[a]) + cost[b] for a, b in zip([0, *cuts], cuts))
        assert got == best[12] and cuts[-1] == 12


def brute_quality(text):
    w = (text or "").encode().split()
    triples = collections.Counter(zip(w, w[1:], w[2:]))
    hit = {i + k for i in range(len(w) - 2) if triples[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return len(w), sum(len(x.decode()) for x in w), sum(map((text or "").count, "#*$%&|<>")), len(lines) - len(set(lines)), len(hit)


def test_quality_counts_and_verdicts(spark, odd, none, docs):
    for df in (odd, docs):
        for r in quality.clean_lines(df, into="verdict").collect():
            q = r.verdict
            assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == brute_quality(r.text)
            assert q.base_failed == (q.n_words < 50 or 2 * q.n_repeat_words > q.n_words)
            assert not (q.kept and q.base_failed)
    out = quality.clean_lines(docs.join(spark.read.parquet(f"{SMALL}/labels.parquet").selectExpr("doc_id", "quality AS label"), "doc_id")).collect()
    assert all(r.quality.kept == (r.label == 1) for r in out if not r.quality.base_failed)
    assert quality.kept_documents(odd).columns == odd.columns and quality.kept_documents(none).count() == 0
    prose = [" ".join(f"{x}{i}{k}" for k, x in enumerate("the river runs past old mills and on to sea".split())) + "." for i in range(6)]
    text = "\n".join([*prose, "Home | About | Contact", "All rights reserved."])
    kept = quality.kept_documents(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().text
    assert "Home" not in kept and "rights" not in kept and kept == "\n".join(prose)


def test_quality_sees_shouting_anywhere_in_a_line():
    numbers = " ".join(f"{i:08d}" for i in range(600))
    loud, soft = [" ".join(w + chr(65 + i) for i in range(20)) for w in ("LOUD", "soft")]
    for line, fails in ((f"{numbers} {loud} quiet.", True), (f"1999 2024 31337 AB CD EF GH ij {numbers[:80]}.", True), (f"{numbers} {loud} {soft} quiet.", False)):
        own = line.encode().split()
        assert quality.line_fails(line, len(own), own, 3) == fails


@pytest.mark.parametrize("head,bucket", [(200_000, 1 << 21), (30, 500)])
def test_katz_matches_brute_force(spark, odd, none, docs, head, bucket):
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    for df in (docs, odd):
        texts = [(r.doc_id, [*(r.text or "").encode().lower().split(), "end"]) for r in df.select("doc_id", "text").collect()]
        is_held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0
        uni, pairs, ctx = collections.Counter(), collections.Counter(), collections.Counter()
        for i, w in texts:
            if not is_held(i):
                uni.update(w), pairs.update(zip(["start", *w], w)), ctx.update(["start", *w[:-1]])
        n, v = sum(uni.values()), len(uni)
        low = [katz.discounted([float(sum(c == r for c in x.values())) for r in range(1, 7)]) for x in (uni, pairs)]
        left = lambda c, t: t[c - 1] if c <= katz.K else c - katz.SPARE
        unknown = 1 - sum(left(c, low[0]) for c in uni.values()) / n
        p1 = lambda w: left(uni[w], low[0]) / n if w in uni else unknown
        seen = collections.defaultdict(list)
        for h, w in pairs:
            seen[h].append(w)
        alpha = {h: (1 - sum(left(pairs[h, w], low[1]) for w in ws) / ctx[h]) / (1 - sum(map(p1, ws))) for h, ws in seen.items()}
        for h in list(alpha)[:20]:  # exactly normalised
            rest = sum(p1(w) for w in uni if (h, w) not in pairs) + unknown
            assert sum(left(pairs[h, w], low[1]) for w in seen[h]) / ctx[h] + alpha[h] * rest == pytest.approx(1)
        want = collections.defaultdict(set)
        for i, w in texts:
            score = sum(math.log10(left(pairs[h, x], low[1]) / ctx[h]) if (h, x) in pairs else math.log10(alpha.get(h, 1.0) * p1(x)) for h, x in zip(["start", *w], w))
            base = sum(math.log10((uni[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
            want[i].add((is_held(i), len(w), sum(x in uni for x in w), n, round(base, 6), round(score, 6)))
        out = katz.katz_scores(df.select("doc_id", "text"), held, head, bucket).collect()
        assert len(out) == len(texts)
        for r in out:
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) in want[r.doc_id]
    assert katz.katz_scores(none.select("doc_id", "text"), held).count() == 0


def test_warc_round_trip(spark, tmp_path):
    html = ["<p>a</p>", None, "", "<p>a</p>", "é\r\n\r\nWARC/1.0\r\n", "z" * 200_000, "<p>a</p>"]
    rows = [(i, None if i == 2 else f"http://x/{i}\r\nEvil: 1", h, "x") for i, h in enumerate(html)] + [(0, "u", "<p>a</p>", "x"), (None, "u", "<p>a</p>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    path = str(tmp_path / "w")
    warc.write_warc(pages, path)
    got = warc.read_warc(spark, path).collect()
    assert len(got) == len(rows)
    first = {"<p>a</p>": 0, "": 1}
    for r in got:
        i = re.match(r"<urn:page:(\d*)>", r.record_id)[1]
        body = (html[int(i)] if i else "<p>a</p>") or ""
        revisit = bool(i) and body in first and first[body] != int(i)
        assert r.warc_type == ("revisit" if revisit else "response") and r.payload_bytes == len(body.encode())
        assert r.refers_to == (f"<urn:page:{first[body]}>" if revisit else None)
        assert r.payload_digest == "sha1:" + base64.b32encode(hashlib.sha1(body.encode()).digest()).decode()
        assert r.payload is None if revisit else bytes(r.payload) == body.encode()
    heads = warc.read_warc(spark, path, "record_id string, warc_type string").where("warc_type = 'revisit'")
    assert heads.count() == 3
    reader = warc.WarcReader(path, ["record_id"], None, 1 << 20)
    from pyspark.sql.datasource import EqualTo, IsNotNull

    assert list(reader.pushFilters([EqualTo(("warc_type",), "revisit"), IsNotNull(("warc_type",)), EqualTo(("offset",), 3)])) == [EqualTo(("offset",), 3)]
    big = str(tmp_path / "m")
    warc.write_warc(pages, big, min_bytes=100)
    assert warc.read_warc(spark, big).where("warc_type = 'revisit'").count() == 0
    empty = str(tmp_path / "e")
    warc.write_warc(pages.where("page_id = -1"), empty)
    assert warc.read_warc(spark, empty).count() == 0


def brute_components(rows):
    sets = collections.defaultdict(list)
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i].append(set() if not w else {tuple(w)} if len(w) < 5 else set(zip(w, w[1:], w[2:], w[3:], w[4:])))
    at = {i: i for i in sets if i is not None}

    def root(x):
        while at[x] != x:
            x = at[x]
        return x

    ids = sorted(at)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = sorted((root(a), root(b)))
                at[q] = p
    return {i: root(i) for i in ids}


def test_near_duplicates_match_brute_force(spark, odd, none, docs):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(400)]
    base = list(rng.choice(vocabulary, 80))
    made = []
    for i in range(60):  # a large group of near copies, each changed in up to six places
        w = list(base)
        for p in rng.integers(0, 80, rng.integers(0, 7)):
            w[p] = str(rng.choice(vocabulary))
        made.append((1000 + i, " ".join(w)))
    # a chain: each text shares four fifths with the next
    long = [f"c{i}" for i in range(200)]
    made += [(2000 + i, " ".join(long[5 * i : 5 * i + 60])) for i in range(12)] + [(3000, "a b"), (3001, "A\tB"), (3002, "a b c")]
    made = spark.createDataFrame(made + [(1005, "another text under an id that is taken")], "doc_id long, text string")
    for df in (made, odd.select("doc_id", "text"), docs.select("doc_id", "text")):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        want = brute_components(rows)
        out = near_dup.near_duplicates(df).collect()
        assert len(out) == len(rows)
        for r in out:
            assert r.component_id == want.get(r.doc_id) and r.kept == (r.doc_id is None or r.component_id == r.doc_id)
    kept = near_dup.without_near_duplicates(odd)
    assert kept.columns == odd.columns and kept.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").count() == 0
    assert near_dup.near_duplicates(none).count() == 0 and near_dup.without_near_duplicates(none).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 501)], "a long, b long")
    out = {r.node: r.component for r in graph.components(edges).collect()}
    assert all(out[i] == 0 for i in range(101)) and out[501] == 500


def test_ordinal_model_finds_toxic_documents(spark, none):
    rng = np.random.default_rng(5)
    plain, bad = [f"w{i}" for i in range(300)], ["vile", "scum", "filth"]
    rows, labels = [], []
    for i in range(600):
        w = list(rng.choice(plain, 40))
        toxic = i % 3 == 0
        for p in rng.integers(0, 40, 1 + i % 5 if toxic else 0):
            w[p] = str(rng.choice(bad)).title() + "!"
        rows.append((i, " ".join(w))), labels.append((i, int(toxic)))
    rows += [(601, None), (602, ""), (603, "vile " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*labels, (None, 1), (9999, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert (np.diff(model.thetas) > 0).all()
    out = {r.doc_id: r for r in toxicity.grade_documents(docs, model).collect()}
    assert sum(out[i].toxic == (i % 3 == 0) for i in range(600)) >= 590
    assert not out[601].toxic and not out[602].toxic and out[603].toxic and out[603].expected_severity > 2
    assert out[12].expected_severity > out[0].expected_severity  # three such words against one
    nothing = toxicity.fit(docs, labels.where("toxic = 0"))
    assert nothing is None and toxicity.grade_documents(docs, None).agg(F.max("grade")).first()[0] == 0
    assert toxicity.grade_documents(none.select("doc_id", "text"), model).count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    d = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 13 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
    return 9 <= len(d) <= 15 if kind == "phone" else True


def test_pii_base_spans_and_redaction(spark, odd, none, docs):
    hard = ["é a.b@c.d@e.f.g x", "1.2.3.4.5 300.1.1.1 1.2.3.0255", "4111 1111-1111 1111 4111111111111112", "+1 (555) 010-9999, +12", "1 " * 20_000, "a@" * 3000 + "b.c", "\U0001f600 ada@x.org +49 30 1234567", "00000.0.0.0"]
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(hard)], "doc_id long, text string")
    model = pii.SpanModel(None, {})
    for df in (texts, odd, docs):
        for r in pii.find_spans(df, model, into="found").collect():
            for kind, pattern in PATTERNS.items():
                want = [(m.start(), m.end(), m.group(0)) for m in re.finditer(pattern, r.text or "") if passes(kind, m.group(0))]
                assert [(s.start, s.end, s.found) for s in r.found[kind] or []] == want
    clean = [r.text for r in pii.redact(texts, model).orderBy("doc_id").collect()]
    assert clean[6] == "\U0001f600 [EMAIL] [PHONE]" and pii.redact(odd, model).columns == odd.columns
    assert pii.fit_spans(none).score is None and pii.redact(none, model).count() == 0


def test_pii_model_adds_credentials_and_leaves_prose(spark):
    rows = [(i, f"some words token = \"{hashlib.sha1(str(i).encode()).hexdigest()}\" end" if i % 2 else f"abc{i} the-very-long-word-of-{i}-parts in prose {i}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit_spans(df)
    assert set(model.thresholds) == {"token"}
    for r in pii.find_spans(df, model).collect():
        assert [s.kind for s in r.pii.added] == (["secret"] if r.doc_id % 2 else [])


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_pii_adds_every_credential(spark, size):
    df = spark.read.parquet(f"/root/testdata/{size}/documents.parquet").select("doc_id", "text")
    token = re.compile(r"(?i)token = \"([0-9a-f]{40})\"")
    want = {(r.doc_id, m.start(1), m.end(1)) for r in df.collect() for m in token.finditer(r.text or "")}
    got = {(r.doc_id, s.start, s.end) for r in pii.find_spans(df, pii.fit_spans(df)).collect() for s in r.pii.added or [] if s.kind == "secret"}
    assert want and want <= got


def test_pii_learns_from_every_candidate(spark):
    """More candidates of a family than the 6,666 that were once taken: each one counts, with its label."""
    n = 9000
    hashes = [h for h in (hashlib.sha1(str(i).encode()).hexdigest() for i in range(10_000)) if not re.search("[0-9]{13}", h)][:n]  # no card numbers
    lines = [f'token = "{h}"' if i % 3 == 0 else f"commit {h}" for i, h in enumerate(hashes)]
    df = spark.createDataFrame([(i, "\n".join(lines[i : i + 30])) for i in range(0, n, 30)] + [(n, None), (n + 1, "+1 (555) 010-9999")], "doc_id long, text string")
    rows = pii.training_rows(df).collect()
    assert sum(r.n for r in rows) == n and sum(r.n for r in rows if r.label == 1) == n // 3
    assert {r.family for r in rows} == {1.0} and 0 < sum(r.n for r in rows if r._held) < n
    assert pii.fit_spans(df).score is not None


def test_pii_credentials_beside_equal_hashes(spark):
    hashes = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(300)]
    df = spark.createDataFrame([(i, f'token = "{h}" end' if i % 3 == 0 else f"commit {h} end") for i, h in enumerate(hashes)], "doc_id long, text string")
    for r in pii.find_spans(df, pii.fit_spans(df)).collect():
        assert [s.kind for s in r.pii.added] == (["secret"] if r.doc_id % 3 == 0 else [])


def test_pii_adds_phone_numbers_without_plus(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        a, b, c = rng.integers(200, 999), rng.integers(200, 999), rng.integers(1000, 9999)
        # A phone number, one that only its word and its format tell, a card number with a wrong check digit, a date, a base phone number.
        card = next(x for x in (f"4{a}{b}{c}{c}{d}" for d in range(10)) if not passes("card", x))
        rows.append((i, (f"ring ({a}) {b}-{c} soon", f"phone: {b}/{a}.{b}.{c}, now", f"order {card} came", f"on 2024-0{i % 9 + 1}-1{i % 10} it", f"ring +1 ({a}) {b}-{c} soon")[i % 5]))
    rows += [(600, "ring (555) 123-4567 soon"), (601, "write to ada@m\u00fcnchen.de, please"), (602, "phone: 1 555 0123 4567")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit_spans(df)
    assert "number" in model.thresholds
    for r in pii.find_spans(df, model).collect():
        found = [(s.kind, r.text[s.start : s.end]) for s in r.pii.added]
        if r.doc_id == 601:
            assert found == [("contact", "ada@m\u00fcnchen.de,")]
        elif r.doc_id in (600, 602):
            assert [k for k, _ in found] == ["account"]
        elif r.doc_id % 5 == 0:
            assert found == [("account", r.text[5:-5])]
        elif r.doc_id % 5 > 1:
            assert not found, r.text


def test_chat_turns_are_recovered_and_rendered(spark, none):
    turns = spark.read.parquet(f"{SMALL}/conversations.parquet")
    more = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    made = chat.transcripts(turns)
    model = chat.train(chat.transcripts(more))
    assert np.allclose(np.exp(model.moves).sum(1), 1)
    got = collections.defaultdict(list)
    for r in chat.parse_transcripts(made.select("conv_id", "transcript"), model).orderBy("conv_id", "turn_no").collect():
        got[r.conv_id].append(r.role)
        assert r.rendered.startswith(f"<|{r.role}|>\n")
    want = collections.defaultdict(list)
    for r in turns.orderBy("conv_id", "turn").collect():
        want[r.conv_id].append(r.role)
    assert sum(got[c] == want[c] for c in want) >= 0.8 * len(want)
    # Viterbi against all paths of a short transcript
    import itertools

    _, feats = chat.lines_of("User: hi there\n\nhello. yes\nmore?")
    shown = sum(e[:, feats[:, i]] for i, e in enumerate(model.emits)).T
    best = max(itertools.product(range(chat.STATES), repeat=3), key=lambda p: model.start[p[0]] + shown[0, p[0]] + sum(model.moves[a, b] + shown[t, b] for t, (a, b) in enumerate(zip(p, p[1:]), 1)))
    assert tuple(model.viterbi(feats)) == best
    odd = spark.createDataFrame([(None, 1, "user", "x"), (None, 1, "user", "x"), (7, None, None, None), (7, 1, "robot", ""), (8, 700, "user", "q? " * 9000), (8, 1, "user", "é")], "conv_id long, turn long, role string, text string")
    made = chat.transcripts(odd)
    assert made.count() == 6 and chat.parse_transcripts(made.select("conv_id", "transcript"), model).count() >= 6
    blank = spark.createDataFrame([(1, None), (2, ""), (3, "\n \n")], "conv_id long, transcript string")
    assert chat.parse_transcripts(blank, model).count() == 0 and chat.transcripts(odd.where("turn = -1")).count() == 0


def test_nearest_neighbours_recall_and_odd_vectors(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(1500, 16)).astype("float32")
    x[700:1000] = x[700]  # one vector held by many
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(2000, None), (2100, []), (2200, [0.0] * 16), (2300, [float("nan")] + [1.0] * 15), (2400, [None] + [1.0] * 15), (2500, [1.0] * 3), (None, x[3].tolist()), (5, x[5].tolist())]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    out = collections.defaultdict(list)
    for r in ann.nearest(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.score, r.vec_id))
    hits = 0
    assert sorted(out) == list(range(0, 1500, 100))
    for q, found in out.items():
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        want = sorted((s, i) for i, s in enumerate(d.tolist()) if i != q)[:10]
        assert found == sorted(found) and all(s == pytest.approx(d[i], rel=1e-12) for s, i in found)
        hits += len({i for _, i in want} & {i for _, i in found})
    assert hits >= 0.9 * 10 * len(out)
    assert out[700][:2] == [(0.0, 701), (0.0, 702)]
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 3.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in ann.nearest(two, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 1.0)]
    assert ann.nearest(two.where("vec_id = 0"), F.lit(True)).count() == 0 and ann.nearest(two.where("vec_id = 9"), F.lit(True)).count() == 0


def test_neighbour_graph_beside_one_long_vector(spark):
    x = np.random.default_rng(9).normal(size=(1200, 12))
    x[17] *= 1e6
    graph = collections.defaultdict(set)
    for r in ann.build_graph(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, vec array<double>"), block=128).collect():
        graph[r.node].add(r.nbr)
    hits = [len(graph[i] & set(np.argsort(((x - x[i]) ** 2).sum(1))[1:11].tolist())) for i in range(len(x))]
    assert np.mean(hits) > 9 and hits[17] >= 8


def water_fill(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 3 * sizes[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= full
    return target


def test_mix_meets_its_targets(spark, odd, none, docs):
    rng = np.random.default_rng(9)
    skewed = spark.createDataFrame([(i, "w " * int(rng.integers(0, 30)), f"s{min(int(rng.geometric(0.3)), 9)}") for i in range(3000)], "doc_id long, text string, source string")
    for df in (skewed, odd, docs):
        sizes = collections.Counter()
        for r in df.select("source", "text").collect():
            sizes[r.source] += len(words(r.text))
        want = water_fill(sizes)
        taken = collections.Counter()
        out = mixing.mix_sources(df, into="m").select("doc_id", "source", "m.*").collect()
        assert len(out) == df.count()
        for r in out:
            taken[r.source] += r.taken
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 3 * r.size
        assert all(abs(taken[s] - want[s]) <= 0.5 for s in want if sizes[s])
        again = mixing.mix_sources(df.repartition(3), into="m").select("doc_id", "m.taken").collect()
        assert sorted(map(str, again)) == sorted(map(str, [r for r in mixing.mix_sources(df, into="m").select("doc_id", "m.taken").collect()]))
    made = mixing.mixed_documents(odd)
    assert made.columns == odd.columns
    assert sum(len(words(r.text)) for r in made.collect()) == sum(r.taken for r in mixing.mix_sources(odd, into="m").select("m.taken").collect())
    assert mixing.mix_sources(none, into="m").count() == 0


def test_pipeline_stages_on_small_documents(spark, docs, none):
    import corpus_pipeline

    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SMALL).cache()
        assert frame.columns == docs.columns, name
    left = {r.doc_id for r in quality.kept_documents(docs).collect()}
    assert {r.doc_id for r in frame.collect()} <= left
    pieces = corpus_pipeline.packing(spark, frame, SMALL)
    assert pieces.agg(F.sum("length")).first()[0] > 0 and pieces.select("doc_id").distinct().count() == frame.select("doc_id").distinct().count()
    assert not frame.where("text like '%@mail%.example.com%'").count()


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
