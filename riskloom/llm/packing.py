"""Order-preserving packing: windows over the token stream, cut where padding plus truncation costs least.

Documents keep their order within an input partition.  A dynamic programme runs over the possible cuts
(document ends, sentence and line ends, and forced cuts inside long stretches without any): a window
between two cuts costs its padding up to ``seq_len`` plus a penalty for the kind of cut at its end.  The
cost of the best packing up to cut i is ``min_j cost[j] + seq_len - (pos[i] - pos[j]) + penalty[i]`` over
cuts at most ``seq_len`` back, so the minimum of ``cost[j] + pos[j]`` over a sliding window is all that is
needed: a monotone queue gives it in constant time per cut.

The stream is solved in blocks of about ``block_tokens``; all windows but the last of a block are final, and
the rest joins the next block, so memory does not grow with the partition.  No shuffle is needed.  What is
left at a partition's end may be split into windows whose lengths are powers of two, which need no padding,
where that costs less than padding it.

Tokens of a text are those of its words: the tokenizer drops white space and no rule of it looks across
ASCII white space, so distinct words are encoded once and remembered.  Words of printable ASCII and Latin letters are
encoded by ``tiktoken`` from the same file's merges (``LatinWords``), all others by ``tokenizers``.

Defined cases: null and empty texts are the end id alone; repeated rows are packed each; a document may
span any number of windows; empty input gives no rows; only the id and text columns are read.
"""

from __future__ import annotations

import json
import os
import re
from collections import deque
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_texts, in_slices, process_cache, read_table

LINE = b"\xff"  # stands for a line's end among a text's words; never part of UTF-8
ENDS = (b".", b"!", b"?")


# The rules of a tokenizer whose words LatinWords can encode.
WORD_RULES = {
    "normalizer": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    "end_of_word_suffix": "</w>",
}


class LatinWords:
    """Token ids of words of printable ASCII and the letters U+00C0 to U+017F, without the tokenizer's general machinery.

    Composition changes nothing in that range, and lower case stays in it but for U+0130, which is left out.  A part's
    end is a NUL character: the vocabulary's word ends become ranks with a NUL, and each byte's end precedes all
    merges, as there.  Ranks tell merges apart by their result only; that gives the tokenizer's ids if every entry
    of the vocabulary is encoded as itself, since then no two other neighbours that make it up are ever left
    side by side (tested).  The character U+0001 stands between words.
    """

    fits = re.compile(r"[!-~\u00c0-\u012f\u0131-\u017f]+").fullmatch
    parts = re.compile(r"('s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[^\sa-z\u00df-\u00f6\u00f8-\u017f0-9]+)")

    def __init__(self, rules: dict):
        import tiktoken

        vocab, suffix = rules["model"]["vocab"], rules["model"]["end_of_word_suffix"]
        self.added = [t["content"] for t in rules["added_tokens"]]
        ranks = {piece: i for token, i in vocab.items() if token not in self.added for piece in [piece_bytes(token, suffix)]}
        self.separator = ranks[b"\x01"]
        self.encoding = tiktoken.Encoding("words", pat_str=r"[^\x00\x01]+\x00|\x01", mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, path: str) -> LatinWords | None:
        """For the tokenizer file ``path``, or None if its rules are others."""
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        steps = (rules["normalizer"] or {}).get("normalizers"), (rules["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        split = steps[1][0]
        same = (
            steps[0] == WORD_RULES["normalizer"]
            and [s.get("type") for s in steps[1]] == ["Split", "ByteLevel"]
            and (split["pattern"], split["behavior"], split["invert"]) == ({"Regex": WORD_RULES["pattern"]}, "Removed", True)
            and (steps[1][1]["add_prefix_space"], steps[1][1]["use_regex"]) == (False, False)
            and rules["model"]["type"] == "BPE"
            and rules["model"]["end_of_word_suffix"] == WORD_RULES["end_of_word_suffix"]
            and not any(rules["model"].get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges"))
        )
        return cls(rules) if same else None

    def takes(self, word: str) -> bool:
        return self.fits(word) is not None and not ("<" in word and any(token in word for token in self.added))

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has."""
        text = self.parts.sub("\\1\0", "\n".join(words).lower()).replace("\n", "\1") + "\1"
        found = np.array(self.encoding.encode_ordinary(text), np.int64)
        between = np.flatnonzero(found == self.separator)
        return np.delete(found, between), np.diff(between, prepend=-1) - 1


def piece_bytes(token: str, suffix: str) -> bytes:
    """The bytes that a token of a byte-level vocabulary stands for; its word end becomes a NUL."""
    ends = token.endswith(suffix)
    body = token[: -len(suffix)] if ends else token
    # Byte-level vocabularies show printable Latin-1 bytes as themselves and the others, in order, from U+0100 on.
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    place = {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
    return bytes(place[c] for c in body) + b"\0" * ends


class WordCodes(dict):
    """word -> its number from 0; a word met for the first time gets the next one and is noted as ``new``."""

    def __init__(self, words: list[bytes]):
        super().__init__(zip(words, range(len(words))))
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        self.new.append(word)
        return code


class WordEncoder:
    """Token ids of texts by way of their distinct words, at most ``limit`` of which stay remembered after a call.

    Beyond the limit, the half of it that most texts had stays; what is forgotten is encoded again when it is met.
    """

    def __init__(self, path: str, limit: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"

        self.path, self.limit, self.latin = path, limit, LatinWords.of(path)
        self.codes = WordCodes([LINE])
        self.start, self.size, self.ends = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(1024, bool)
        self.ends[0] = True
        self.met = np.zeros(1024, np.int64)
        self.flat, self.used, self.known = np.zeros(4096, np.uint32), 0, 1

    @cached_property
    def tokenizer(self):
        """The whole tokenizer, read when first needed."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _add(self, words: list[bytes], at_once: int = 4096) -> None:
        """Encode new words, whose codes are the last ones, few at a time: what the tokenizer tells of a token takes far more than its id."""
        for i in range(0, len(words), at_once):
            some = words[i : i + at_once]
            texts = [w.decode() for w in some]
            whole = [k for k, w in enumerate(texts) if self.latin is None or not self.latin.takes(w)]
            if not whole:
                self._remember(some, *self.latin.encode(texts))
            elif len(whole) == len(texts):
                self._remember(some, *self._encode_any(texts))
            else:
                fit = np.setdiff1d(np.arange(len(texts)), whole).tolist()
                parts = self.latin.encode([texts[k] for k in fit]), self._encode_any([texts[k] for k in whole])
                order = np.argsort(fit + whole)
                found, sizes = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                start = np.cumsum(sizes) - sizes
                start, sizes = start[order], sizes[order]
                upto = np.cumsum(sizes)
                self._remember(some, found[np.repeat(start - (upto - sizes), sizes) + np.arange(len(found))], sizes)

    def _encode_any(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has, by the tokenizer itself."""
        # Words are encoded 64 at a time, joined by spaces; offsets tell whose each id is.
        groups = [words[i : i + 64] for i in range(0, len(words), 64)]
        found, sizes = [], np.zeros(len(words), np.int64)
        for i, (group, e) in enumerate(zip(groups, self.tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False))):
            begin = np.cumsum([0] + [len(x) + 1 for x in group])
            at = np.fromiter((o[0] for o in e.offsets), np.int64, len(e.ids))
            sizes[64 * i : 64 * i + len(group)] = np.diff(np.searchsorted(at, begin))
            found += e.ids
        return np.array(found, np.int64), sizes

    def _remember(self, words: list[bytes], found: np.ndarray, sizes: np.ndarray) -> None:
        n, total = self.known, len(found)
        while n + len(words) > len(self.start):
            self.start, self.size, self.ends, self.met = (np.concatenate([a, np.zeros_like(a)]) for a in (self.start, self.size, self.ends, self.met))
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + total] = found
        self.size[n : n + len(words)] = sizes
        self.start[n : n + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.ends[n : n + len(words)] = [w.endswith(ENDS) for w in words]
        self.used, self.known = self.used + total, n + len(words)

    def _forget(self, left: int) -> None:
        """Keep ``left`` words, those that most texts had, and the line's end; older meetings count half from now on."""
        words = list(self.codes)  # in the order of their codes
        met = self.met[: len(words)]
        keep = np.union1d([0], np.argpartition(-met, min(left, len(words) - 1))[:left])
        sizes = self.size[keep]
        upto = np.cumsum(sizes)
        self.flat = self.flat[np.repeat(self.start[keep] - (upto - sizes), sizes) + np.arange(int(upto[-1]))]
        self.used = len(self.flat)
        self.start, self.size, self.ends, self.met = upto - sizes, sizes, self.ends[keep], met[keep] // 2
        self.codes, self.known = WordCodes([words[k] for k in keep.tolist()]), len(keep)
        # An empty array would not grow by doubling.
        self.flat = np.append(self.flat, np.zeros(4096, np.uint32))

    def encode(self, texts: list[list[bytes]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text, as words: its ids, and the places (ids before them) where a sentence or line ends.

        A list, no generator: what is done after the last text must be done even if nobody asks for more.
        """
        places = [np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words)) for words in texts]
        if self.codes.new:
            self._add(self.codes.new)
            self.codes.new = []
        out = []
        for at in places:
            self.met[at] += 1
            sizes = self.size[at]
            upto = np.cumsum(sizes)
            total = int(upto[-1]) if len(at) else 0
            ids = self.flat[np.repeat(self.start[at] - (upto - sizes), sizes) + np.arange(total)]
            out.append((ids, upto[self.ends[at]]))
        if len(self.codes) > self.limit:
            self._forget(self.limit // 2)
        return out


def best_cuts(pos: np.ndarray, penalty: np.ndarray, seq_len: int) -> list[int]:
    """Indices of the cuts that end windows, the last one always among them; pos[0] = 0 begins the first."""
    places, costs = pos.tolist(), penalty.tolist()
    best, back = [0.0] * len(places), [0] * len(places)
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for i in range(1, len(places)):
        p = places[i]
        while places[queue[0][1]] < p - seq_len:
            queue.popleft()
        value, j = queue[0]
        best[i], back[i] = value + seq_len - p + costs[i], j
        value = best[i] + p
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, i))
    cuts, i = [], len(places) - 1
    while i > 0:
        cuts.append(i)
        i = back[i]
    return cuts[::-1]


def tail_lengths(n: int, seq_len: int, forced: float) -> list[int]:
    """Lengths of the last windows of a partition: one, or powers of two where that costs less."""
    powers = [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]
    return powers if (len(powers) - 1) * forced < seq_len - n else [n]


class Packer:
    """Takes documents in order and yields windows of one partition as pieces."""

    def __init__(self, seq_len: int, block_tokens: int, sentence: float, forced: float, max_gap: int, first_id: int):
        self.seq_len, self.block, self.sentence, self.forced, self.max_gap = seq_len, block_tokens, sentence, forced, max_gap
        self.docs: list[tuple] = []  # doc_id, ids, cuts, ids already packed
        self.waiting, self.next_id = 0, first_id

    def add(self, doc_id, ids: np.ndarray, ends: np.ndarray) -> list[tuple]:
        self.docs.append((doc_id, ids, ends, 0))
        self.waiting += len(ids)
        return self.solve(False) if self.waiting >= self.block else []

    def _cuts(self) -> tuple[np.ndarray, np.ndarray]:
        pos, cost, at = [np.zeros(1, np.int64)], [np.zeros(1)], 0
        for _, ids, ends, done in self.docs:
            own = np.unique(ends[(ends > done) & (ends < len(ids) - 1)]) - done
            gaps = np.diff(np.concatenate([[0], own, [len(ids) - done]]))
            price = np.full(len(own), self.sentence)
            if len(long := np.flatnonzero(gaps > self.max_gap)):
                edges = np.concatenate([[0], own])
                extra = np.concatenate([np.arange(edges[g] + self.max_gap, edges[g] + gaps[g], self.max_gap) for g in long])
                own, price = np.concatenate([own, extra]), np.concatenate([price, np.full(len(extra), self.forced)])
                order = np.argsort(own, kind="stable")
                own, price = own[order], price[order]
            pos += [own + at, np.array([at + len(ids) - done])]
            cost += [price, np.zeros(1)]
            at += len(ids) - done
        return np.concatenate(pos), np.concatenate(cost)

    def solve(self, last: bool) -> list[tuple]:
        if not self.docs:
            return []
        pos, cost = self._cuts()
        windows = np.diff(np.concatenate([[0], pos[best_cuts(pos, cost, self.seq_len)]])).tolist()
        rest = windows.pop()
        if last:
            windows += tail_lengths(rest, self.seq_len, self.forced)
        pieces, docs, i, done = [], self.docs, 0, self.docs[0][3]
        for length in windows:
            offset = 0
            while offset < length:
                doc_id, ids, _, _ = docs[i]
                take = min(length - offset, len(ids) - done)
                pieces.append((doc_id, done, take, ids[done : done + take].tobytes(), len(ids), self.next_id, offset))
                offset, done = offset + take, done + take
                if done == len(ids):
                    i, done = i + 1, docs[i + 1][3] if i + 1 < len(docs) else 0
            self.next_id += 1
        self.docs = docs[i:]
        if self.docs:
            self.docs[0] = (*self.docs[0][:3], done)
        self.waiting = 0 if last else rest
        return pieces


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int = 2, seq_len: int = 4096, block_tokens: int = 1 << 19,
    sentence_penalty: float = 4.0, forced_penalty: float = 48.0, max_gap: int = 64, cached_words: int = 300_000,
) -> DataFrame:
    """Pieces of documents in sequences: doc_id, start, length, input_ids (unsigned little-endian 32-bit), doc_tokens, sequence_id, offset."""
    import pyspark.sql.types as T

    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", id_type)] + T._parse_datatype_string("start long, length long, input_ids binary, doc_tokens long, sequence_id long, offset long").fields)
    end = np.array([end_id], dtype="<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = process_cache(f"words of {tokenizer_path} {cached_words}", lambda: WordEncoder(tokenizer_path, cached_words))
        packer = Packer(seq_len, block_tokens, sentence_penalty, forced_penalty, max_gap, TaskContext.get().partitionId() << 40)
        types: list = []

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*pieces), types)], names=schema.names)

        for batch in in_slices(batches, 64):
            types = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            texts = [(t or b"").replace(b"\n", b" \xff ").split() for t in byte_texts(batch.column(1))]
            for doc_id, (ids, ends) in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                if pieces := packer.add(doc_id, np.concatenate([ids.astype("<u4"), end]), ends):
                    yield rows(pieces)
        if pieces := packer.solve(True):
            yield rows(pieces)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def packed_digest(docs: DataFrame, **options) -> DataFrame:
    pieces = pack_documents(docs, default_tokenizer(), **options)
    return pieces.select("doc_id", "start", "length", F.crc32("input_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digest(read_table(spark, sf_dir, "documents"))
