"""Line-first cleaning: rules judge each line, failing lines go, then documents that lost too much go.

Line rules (a line with a word fails on the first that holds; lines without one are neutral):

* ``symbols``      -- over 0.3 symbols of ``#*$%&|<>`` per word;
* ``punctuation``  -- over 30 % of its words (five at least) end in repeated ``!`` or ``?``;
* ``shouting``     -- five words or more, over 70 % of those with letters all upper case;
* ``navigation``   -- two separators or more (``|``, ``»``, ``›``, ``•``, ``::``) with under four words between
  two, or up to ``short_line`` words without any closing punctuation;
* ``boilerplate``  -- up to 30 words with a phrase of ``BOILERPLATE``;
* ``duplicate``    -- equal to an earlier line of the document;
* ``repetition``   -- eight words or more, half of them in word triples found twice or more in the line.

A document is kept if it passes the base checks (``min_words`` words, at most half of them in repeated word
triples) and its failing lines hold at most ``max_lost`` of its words.

Defined cases: null and empty texts have no words and fail; white space only likewise; repeated rows are
judged each for themselves; empty input gives no rows; other input columns pass through whatever their
names; the operator's own are in one struct, whose name can be chosen.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_slices, read_table

SYMBOLS = "#*$%&|<>"
SEPARATORS = re.compile(r"[|»›•]|::")
CLOSING = re.compile(r"[.!?…:;。！？][\"'»”’)\]]*$")
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service", "click here", "read more",
    "sign up", "log in", "javascript is", "licensed under", "released under", "is licensed", "lorem ipsum",
)

VERDICT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, words_lost long, base_failed boolean, kept boolean, clean_text string"


def repeated_words(words: list) -> int:
    """Words that lie in a window of three found twice or more (the first window included)."""
    n = len(words) - 2
    if n < 2:
        return 0
    codes: dict = {}
    w = np.fromiter((codes.setdefault(x, len(codes)) for x in words), dtype=np.int64, count=len(words))
    # Pairs first, then pairs with the third word: codes stay below the square of the text's length.
    pairs = w[:-1] * len(codes) + w[1:]
    if len(codes) < 1 << 20:
        triples = pairs[:-1] * len(codes) + w[2:]
    else:
        triples = np.unique(pairs[:-1], return_inverse=True)[1].astype(np.int64) * len(codes) + w[2:]
    _, inverse, counts = np.unique(triples, return_inverse=True, return_counts=True)
    hit = counts[inverse] >= 2
    if not hit.any():
        return 0
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[k : k + n] |= hit
    return int(covered.sum())


def line_fails(line: str, n_words: int, words: list[bytes], short_line: int) -> bool:
    if sum(map(line.count, SYMBOLS)) > 0.3 * n_words:
        return True
    if n_words >= 5:
        if "!!" in line or "??" in line:
            if sum(w.rstrip(b".,")[-2:] in (b"!!", b"??", b"!?", b"?!") for w in words) > 0.3 * n_words:
                return True
        if line.upper() == line and line.lower() != line:
            return True
        if line.lower() != line:  # without a capital no word shouts
            words_here = line.split()
            loud = sum(w == w.upper() and len(w) > 1 and w.lower() != w for w in words_here)
            if loud and loud > 0.7 * sum(w.lower() != w.upper() for w in words_here):
                return True
    closed = CLOSING.search(line[-8:].rstrip())
    if n_words <= short_line and not closed:
        return True
    separators = len(SEPARATORS.findall(line))
    if separators >= 2 and n_words < 5 * (separators + 1):
        return True
    if n_words <= 30:
        low = line.lower()
        if any(p in low for p in BOILERPLATE):
            return True
    return n_words >= 8 and repeated_words(words) > 0.5 * n_words


def judge(text: str | None, min_words: int = 50, max_lost: float = 0.5, short_line: int = 3) -> tuple:
    """The verdict on one text, in the order of ``VERDICT``."""
    if not text:
        return 0, 0, 0, 0, 0, 0, True, False, text
    data = text.encode()
    words = data.split()
    n = len(words)
    spaces = sum(map(text.count, " \t\n\r\x0b\x0c"))
    symbols = sum(map(text.count, SYMBOLS))
    repeats = repeated_words(words)
    seen: set[str] = set()
    duplicates = lost = 0
    kept_lines = []
    for line in text.split("\n"):
        own = line.encode().split()
        if own:
            if line in seen:
                duplicates += 1
                lost += len(own)
                continue
            seen.add(line)
            if line_fails(line, len(own), own, short_line):
                lost += len(own)
                continue
        kept_lines.append(line)
    base_failed = n < min_words or 100 * repeats > 50 * n
    kept = not base_failed and lost <= max_lost * n
    return n, len(text) - spaces, symbols, duplicates, repeats, lost, base_failed, kept, "\n".join(kept_lines)


def judged_rows(docs: DataFrame, text_col: str = "text", with_text: bool = True, only_kept: bool = False, **rules) -> DataFrame:
    """(row, quality): input rows as structs with their verdicts (see ``VERDICT``); ``clean_text`` is null without ``with_text``.

    With ``only_kept``, rejected rows stay out, and ``clean_text`` is null where the text stays as it is.
    """
    import pyspark.sql.types as T

    verdict = T._parse_datatype_string(VERDICT)
    names = [f.name for f in verdict.fields]
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("quality", verdict)])
    text_at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.string()]
        for batch in in_slices(batches):
            row = batch.column(0)
            texts = row.flatten()[text_at].to_pylist()
            verdicts = [judge(t, **rules) for t in texts]
            if only_kept:
                row = row.filter(pa.array([v[-2] for v in verdicts], pa.bool_()))
                verdicts = [(*v[:-1], None if v[-1] == t else v[-1]) for v, t in zip(verdicts, texts) if v[-2]]
            columns = list(zip(*verdicts)) or [[]] * len(names)
            if not with_text:
                columns[-1] = [None] * len(verdicts)
            quality = pa.StructArray.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)
            yield pa.RecordBatch.from_arrays([row, quality], names=["row", "quality"])

    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return packed.mapInArrow(run, schema)


def clean_lines(docs: DataFrame, into: str = "quality", **options) -> DataFrame:
    """``docs`` plus the verdict as a struct named ``into``, a name that ``docs`` does not have."""
    return judged_rows(docs, **options).select("row.*", F.col("quality").alias(into))


def kept_documents(docs: DataFrame, **rules) -> DataFrame:
    """Documents that pass, with their failing lines removed; columns are those of ``docs``."""
    judged = judged_rows(docs, only_kept=True, **rules)
    text = F.coalesce("quality.clean_text", "row.text")
    fixed = {"text": text.alias("text"), "n_chars": F.char_length(text).cast("long").alias("n_chars")}
    return judged.select(*[fixed.get(c, F.col(f"row.`{c}`")) for c in docs.columns])


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = clean_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False)
    q = [F.col(f"quality.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "words_lost")]
    return judged.select("doc_id", *q)
