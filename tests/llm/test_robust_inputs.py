"""Inputs that once went wrong: shuffled and coalesced rows, long runs of characters, rejected rows."""

import re
import time

import pytest
from pyspark.sql import functions as F

from riskloom.llm import chat, katz, packing, pii, quality

SMALL = "/root/testdata/sf0.001"


def test_katz_rows_keep_their_numbers_on_shuffled_input(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    want = {tuple(r) for r in katz.katz_scores(docs, held, written=True).select("doc_id", "n_tokens", "n_known", F.round("score", 6)).collect()}
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
        mixed = docs.groupBy("doc_id").agg(F.max("text").alias("text"))
        got = {tuple(r) for r in katz.katz_scores(mixed, held).select("doc_id", "n_tokens", "n_known", F.round("score", 6)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == want


def test_pii_patterns_take_linear_time(spark):
    long = ["x" * 1_000_000 + "@", "x" * 400_000 + "@y " + "z" * 400_000, "a@b" * 50_000, "a.b@" * 50_000]
    short = ["a@b.c_d@e.f", "a@b.c.d@e.f x@y", "%@%.a@b.c", "a@b@c.d", "..@a.b..@c.d", "me@here.org,you@there.org", "é@ü.de x", "@@a@@b.c@"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(long + short)], "doc_id long, text string")
    start = time.time()
    rows = df.select("doc_id", pii.base_spans(F.col("text"), "email").alias("email"), F.transform(pii.candidates(F.col("text"), "contact"), lambda c: F.struct(c["start"], c["end"])).alias("contact")).collect()
    assert time.time() - start < 60
    plain = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), "contact": re.compile(r"[^\x20\x09-\x0D@]+@[^\x20\x09-\x0D@]+")}
    for r in rows:
        if r.doc_id >= len(long):
            text = short[r.doc_id - len(long)]
            assert [(s.start, s.end) for s in r.email] == [m.span() for m in plain["email"].finditer(text)]
            assert [tuple(s) for s in r.contact] == [m.span() for m in plain["contact"].finditer(text)]


@pytest.mark.parametrize("rows", [0, 3])
def test_kept_documents_are_those_with_a_kept_verdict(spark, rows):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("row", F.lit(1))
    docs = docs.where("doc_id < 0") if rows == 0 else docs
    judged = quality.clean_lines(docs, into="verdict").where("verdict.kept").select("doc_id", F.col("verdict.clean_text").alias("text")).collect()
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.select("doc_id", "text").collect()) == sorted(tuple(r) for r in judged)
    assert kept.where("n_chars <> char_length(text)").count() == 0


def test_packing_remembers_few_words_whoever_stops_asking():
    path = packing.default_tokenizer()
    encoder, plain = packing.WordEncoder(path, 40), packing.WordEncoder(path, 1 << 30)
    texts = [[b"the", b"of", *(f"w{i * 31 % 997}x{k}.".encode() for k in range(9)), packing.LINE] for i in range(300)]
    for start in range(0, len(texts), 7):
        part = texts[start : start + 7]
        for words, (ids, ends) in zip(part, encoder.encode(part)):
            [(want, stops)] = plain.encode([words])
            assert ids.tolist() == want.tolist() == encoder.tokenizer.encode(b" ".join(words[:-1]).decode(), add_special_tokens=False).ids
            assert ends.tolist() == stops.tolist()
        assert len(encoder.codes) <= 40
        assert packing.LINE in encoder.codes and len(encoder.flat) < 1 << 14
    assert {b"the", b"of"} <= set(encoder.codes)


def test_chat_input_columns_with_clashing_names_come_in_a_struct(spark):
    turns = spark.createDataFrame([(1, t, r, f"words {t} of {r}.") for t, r in enumerate(["user", "assistant"] * 4)], "conv_id long, turn long, role string, text string")
    model = chat.train(chat.transcripts(turns))
    texts = spark.createDataFrame([(1, "User: hello\nAssistant: good day", "mine", 7)], "conv_id long, transcript string, role string, turn_no int")
    out = chat.parse_transcripts(texts, model)
    assert out.columns == ["conv_id", "input", "turn_no", "role", "rendered", "n_lines"]
    rows = out.orderBy("turn_no").collect()
    assert rows and all(r["input"].asDict() == {"role": "mine", "turn_no": 7} for r in rows) and [r["turn_no"] for r in rows] == list(range(len(rows)))
    plain = chat.parse_transcripts(texts.select("conv_id", "transcript"), model).orderBy("turn_no")
    assert [r["rendered"] for r in rows] == [r["rendered"] for r in plain.collect()]
    with pytest.raises(ValueError):
        chat.parse_transcripts(texts.withColumnRenamed("conv_id", "input"), model)
