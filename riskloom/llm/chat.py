"""Transcript parsing: a hidden Markov model over line features recovers roles, then turns are rendered alike.

A transcript is text in lines.  Its hidden states are (role, first line of a turn or a later one); what a
line shows is its speaker marker (of a user, of an assistant, of a system, another name, none), whether a blank
line stands before it, its length class, its ending and how it begins.  Transitions and emissions are counted over
labelled transcripts (add-one smoothing); counts are summed by Spark, so any number of transcripts may
train.  Viterbi finds the most probable states; a turn begins wherever a first-line state stands or the role
changes, its marker is taken off, and it is rendered as ``<|role|>`` and its lines.

Transcripts are decoded row by row.  ``transcripts`` makes them from a table of turns, in segments of at most
``segment`` turn numbers, so that a conversation of any length meets in one task only by segments.

Defined cases: a null or empty transcript has no turns; a transcript of blank lines likewise; null texts
of turns are empty; rows without conv_id or turn are transcripts of their own; equal turn numbers stand in
the order of their texts; unknown roles are left out of training; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_slices, materialise, read_table

ROLES = ("system", "user", "assistant")
MARKERS = {"user": ("user", "human", "question", "q", "customer"), "assistant": ("assistant", "ai", "bot", "answer", "a", "agent"), "system": ("system", "instructions")}
_CLASS = {name: 1 + i for i, role in enumerate(("user", "assistant", "system")) for name in MARKERS[role]}
_MARKER = re.compile(r"^\W{0,4}([A-Za-z]{1,14})\W{0,3}:\s*")
#: Values of each feature: marker, blank before, length class, ending, beginning.
SIZES = (5, 2, 6, 3, 3)
STATES = 2 * len(ROLES)  # role * 2 + (0: first line, 1: later line)


def lines_of(text: str) -> tuple[list[str], np.ndarray]:
    """Lines that are not blank, and their features."""
    lines, feats, blank = [], [], True
    for line in text.split("\n"):
        bare = line.strip()
        if not bare:
            blank = True
            continue
        found = _MARKER.match(bare)
        marker = 0 if not found else _CLASS.get(found[1].lower(), 4)
        rest = bare[found.end() :] if found else bare
        n = len(rest.split())
        ending = 1 if rest.endswith("?") else 2 if not rest.endswith((".", "!")) else 0
        begin = 1 if rest[:1].islower() else 2 if not rest[:1].isalpha() else 0
        lines.append(line)
        feats.append((marker, int(blank), min(5, n.bit_length() - 1 if n else 0), ending, begin))
        blank = False
    return lines, np.array(feats, np.int64).reshape(-1, len(SIZES))


class Hmm:
    """Logarithms of start, transition and emission probabilities."""

    def __init__(self, counts: np.ndarray):
        start, moves, *emits = np.split(counts + 1.0, np.cumsum([STATES, STATES * STATES] + [STATES * s for s in SIZES])[:-1])
        self.start = np.log(start / start.sum())
        moves = moves.reshape(STATES, STATES)
        self.moves = np.log(moves / moves.sum(1, keepdims=True))
        self.emits = [np.log(e.reshape(STATES, -1) / e.reshape(STATES, -1).sum(1, keepdims=True)) for e in emits]

    def viterbi(self, feats: np.ndarray) -> list[int]:
        if not len(feats):
            return []
        shown = sum(e[:, feats[:, i]] for i, e in enumerate(self.emits)).T
        best, back = self.start + shown[0], np.zeros((len(feats), STATES), np.int8)
        for t in range(1, len(feats)):
            reach = best[:, None] + self.moves
            back[t] = reach.argmax(0)
            best = reach.max(0) + shown[t]
        path = [int(best.argmax())]
        for t in range(len(feats) - 1, 0, -1):
            path.append(int(back[t, path[-1]]))
        return path[::-1]


def _count(text: str, states: list[int], out: np.ndarray) -> None:
    _, feats = lines_of(text)
    s = np.asarray(states, np.int64)
    if len(s) == 0 or len(s) != len(feats):
        return
    out[s[0]] += 1
    np.add.at(out, STATES + s[:-1] * STATES + s[1:], 1)
    at = STATES + STATES * STATES
    for i, size in enumerate(SIZES):
        np.add.at(out, at + s * size + feats[:, i], 1)
        at += STATES * size


def train(labelled: DataFrame) -> Hmm:
    """(transcript, states: a state for each line that is not blank) -> model."""
    size = STATES + STATES * STATES + STATES * sum(SIZES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size, np.int64)
        for batch in in_slices(batches):
            for text, states in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                _count(text or "", states or [], out)
        at = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out[at])], names=["at", "n"])

    rows = labelled.select("transcript", "states").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(size)
    for r in rows:
        counts[r["at"]] = r["n"]
    return Hmm(counts)


def turns_of(text: str | None, model: Hmm) -> list[tuple[str, str, int]]:
    """(role, canonical text, lines) of each turn."""
    lines, feats = lines_of(text or "")
    turns: list[tuple[str, list[str]]] = []
    for line, marker, state in zip(lines, feats[:, 0].tolist() if len(feats) else [], model.viterbi(feats)):
        role, later = ROLES[state // 2], state % 2
        bare = _MARKER.sub("", line.strip(), count=1) if 0 < marker < 4 and not later else line.strip()
        if turns and later and turns[-1][0] == role:
            turns[-1][1].append(bare)
        else:
            turns.append((role, [bare]))
    return [(role, f"<|{role}|>\n" + "\n".join(body), len(body)) for role, body in turns]


def parse_transcripts(texts: DataFrame, model: Hmm, clashing: str = "input") -> DataFrame:
    """``texts`` (transcript, ...) -> a row for each turn: the other columns, turn_no, role, rendered, n_lines.

    Input columns that have one of these four names come as a struct named ``clashing``, a name ``texts`` does not have.
    """
    import pyspark.sql.types as T

    others = [c for c in texts.columns if c != "transcript"]
    inner = T.StructType([T.StructField("row", texts.select(*[F.col(f"`{c}`") for c in others]).schema)] + T._parse_datatype_string("turn_no int, role string, rendered string, n_lines int").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            at, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for k, turn in enumerate(turns_of(text, model)):
                    at.append(i)
                    rows.append((k, *turn))
            columns = list(zip(*rows)) or [[], [], [], []]
            types = (pa.int32(), pa.string(), pa.string(), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, types))], names=inner.names)

    packed = texts.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), "transcript")
    turn = ["turn_no", "role", "rendered", "n_lines"]
    plain = [F.col(f"row.`{c}`").alias(c) for c in others if c not in turn]
    taken = [F.col(f"row.`{c}`").alias(c) for c in others if c in turn]
    if taken and clashing in [*others, *turn]:
        raise ValueError(f"{clashing!r} is a column already; choose another name for the struct of clashing columns")
    return packed.mapInArrow(run, inner).select(*plain, *([F.struct(*taken).alias(clashing)] if taken else []), *turn)


def transcripts(turns: DataFrame, segment: int = 256, marked: int = 75, spaced: int = 80) -> DataFrame:
    """(conv_id, segment, transcript, states) from a table of turns (conv_id, turn, role, text).

    As in collected logs, only ``marked`` percent of the turns carry a marker and ``spaced`` percent a blank line
    before them; which, and the marker's word, follows from a hash of the turn.  ``states`` is null where a role is
    unknown.
    """
    alone = F.when(F.col("conv_id").isNull() | F.col("turn").isNull(), F.monotonically_increasing_id())
    rows = turns.select("conv_id", F.floor(F.col("turn") / segment).cast("long").alias("segment"), alone.alias("alone"), F.struct(F.col("turn"), F.coalesce("text", F.lit("")).alias("text"), F.col("role"), F.xxhash64("conv_id", "turn", "text").alias("h")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            texts, states = [], []
            for group in batch.column(2).to_pylist():
                out, own, known = [], [], True
                for t in sorted(group, key=lambda t: (t["turn"] is None, t["turn"], t["text"])):
                    role, h = t["role"], t["h"]
                    body = [x for x in t["text"].split("\n") if x.strip()] or ["..."]
                    if h % 100 < spaced and out:
                        out.append("")
                    if role in ROLES:
                        own += [ROLES.index(role) * 2] + [ROLES.index(role) * 2 + 1] * (len(body) - 1)
                        if (h >> 8) % 100 < marked:
                            names = MARKERS[role]
                            body[0] = f"{names[(h >> 16) % len(names)].title()}: {body[0]}"
                    else:
                        known = False
                    out += body
                texts.append("\n".join(out))
                states.append(own if known else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(states, pa.list_(pa.int32()))], names=["conv_id", "segment", "transcript", "states"])

    id_type = turns.schema["conv_id"].dataType.simpleString()
    grouped = rows.groupBy("conv_id", "segment", "alone").agg(F.collect_list("t").alias("ts"))
    return grouped.select("conv_id", "segment", "ts").mapInArrow(run, f"conv_id {id_type}, segment long, transcript string, states array<int>")


def op8_chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine tenths of the conversations (by a hash of conv_id) train; all are parsed, from their transcripts alone.

    The transcripts are written once, so the turns are shuffled once for both.
    """
    made = materialise(transcripts(read_table(spark, sf_dir, "conversations")), "transcripts")
    model = train(made.where(F.pmod(F.xxhash64("conv_id"), F.lit(10)) != 0))
    return parse_transcripts(made.select("conv_id", "segment", "transcript"), model)
