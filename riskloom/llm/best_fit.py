"""Best-fit packing by a grouping genetic algorithm, run as islands with elite migration.

Documents are tokenized and, only where longer than ``seq_len``, cut into pieces of ``seq_len`` tokens of which
the first may be shorter.  A whole piece is a sequence by itself; the others are the items to pack.

Items are dealt by a hash of their row into blocks of about ``block_items``, so no group grows with the data and
no key can be hot.  Each block is evolved on ``islands`` islands, one Spark group each.  An individual is a packing,
its genes are whole bins.  A child takes over its first parent's bins and gets some well-filled bins of the second
injected; the bins that hold a duplicate of an injected item, and some of the emptiest, are dissolved, and
the displaced items go, longest first, where they fit best.  Fewer bins are fitter, then bins of more unequal
fill.  After each epoch every island keeps its population and sends its elite to the next island of its block; the
fittest packing of a block's islands wins.  An island stops early at the lower bound of its lengths.

Blocks leave a few loose bins each.  The emptiest bins that hold at most a quarter of the items are dealt anew into as
many blocks as they need, level by level, until one block is left or all bins that have room are too many.

Two public libraries encode the same vocabulary: ``tiktoken`` four times as fast as ``tokenizers``, whose ids are
asked for.  They agree on every code point (tests), but only the latter sees added tokens in a text, so texts that hold
the text of one go there.

Defined cases: null and empty texts are the end id alone; repeated rows are packed each; texts of any length are
encoded whole; empty input gives no rows; only the id and text columns are read, so others may have any name.
"""

from __future__ import annotations

import json
import math
import os
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_slices, materialise, process_cache, read_table


class Encoder:
    """Ids of texts without special tokens, as ``tokenizers`` gives them for ``path``."""

    def __init__(self, path: str, ranks_path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.added = [t["content"] for t in json.load(f)["added_tokens"]]
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if any(token in text for token in self.added):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def cut_documents(docs: DataFrame, tokenizer: dict[str, str], end_id: int = 2, seq_len: int = 1024, digest: bool = False) -> DataFrame:
    """key, doc_id, piece, start, length and input_ids (unsigned little-endian 32-bit), or their ids_crc32 if ``digest``.

    Keys are unique, but another run may give others: write the result before using it twice.
    """
    import zlib

    body, body_type = (T.StructField("ids_crc32", T.LongType()), pa.int64()) if digest else (T.StructField("input_ids", T.BinaryType()), pa.binary())
    head = T._parse_datatype_string("piece int, start long, length int").fields
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("doc_id", docs.schema["doc_id"].dataType), *head, body])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = process_cache(f"encoder {tokenizer['path']}", lambda: Encoder(**tokenizer))
        key = TaskContext.get().partitionId() << 40
        for batch in in_slices(batches, 64):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encoder.encode(text.as_py() or ""), end_id], dtype="<u4")
                edges = [0, *range(len(ids) % seq_len or seq_len, len(ids) + 1, seq_len)]
                for piece, (start, stop) in enumerate(zip(edges, edges[1:])):
                    part = ids[start:stop].tobytes()
                    rows.append((key, doc_id, piece, start, stop - start, zlib.crc32(part) if digest else part))
                    key += 1
            types = (pa.int64(), batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int32(), body_type)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


class Packing:
    """An individual: ``members`` and ``fills`` of its bins, and ``where`` each item is."""

    __slots__ = ("members", "fills", "where")

    def __init__(self, members: list[list[int]], fills: list[int], where: list[int]):
        self.members, self.fills, self.where = members, fills, where

    def fitness(self) -> tuple[int, int]:
        """The smaller the better: bins, then minus the sum of their squared fills."""
        return len(self.fills), -sum(f * f for f in self.fills)

    @staticmethod
    def of(where: np.ndarray, sizes: list[int]) -> Packing:
        members: list[list[int]] = [[] for _ in range(int(where.max()) + 1)]
        for i, slot in enumerate(where.tolist()):
            members[slot].append(i)
        return Packing(members, [sum(sizes[i] for i in m) for m in members], where.tolist())


def best_fit(packing: Packing, items: list[int], sizes: list[int], capacity: int, free: list[int]) -> None:
    """Place ``items`` in the given order where they leave the least room; ``free`` slots are used before new ones."""
    members, fills, where = packing.members, packing.fills, packing.where
    rooms: dict[int, list[int]] = {}
    mask, skip = 0, set(free)  # bit r of the mask: some bin has room for r more tokens
    for slot, fill in enumerate(fills):
        if fill < capacity and slot not in skip:
            rooms.setdefault(capacity - fill, []).append(slot)
            mask |= 1 << (capacity - fill)
    for i in items:
        size = sizes[i]
        if fitting := mask >> size:
            room = size + (fitting & -fitting).bit_length() - 1
            stack = rooms[room]
            slot = stack.pop()
            if not stack:
                mask ^= 1 << room
        else:
            room = capacity
            if free:
                slot = free.pop()
            else:
                slot = len(fills)
                members.append([])
                fills.append(0)
            members[slot] = []
            fills[slot] = 0
        members[slot] = [*members[slot], i]  # lists may be shared with a parent
        fills[slot] += size
        where[i] = slot
        if left := room - size:
            rooms.setdefault(left, []).append(slot)
            mask |= 1 << left
    for slot in sorted(free, reverse=True):  # unused slots: the last bin moves there
        last_members, last_fill = members.pop(), fills.pop()
        if slot < len(fills):
            members[slot], fills[slot] = last_members, last_fill
            for i in last_members:
                where[i] = slot


def lower_bound(sizes: list[int], capacity: int) -> int:
    """Bins that any packing needs: total length, and for each t the items too long to share a bin with one of length t."""
    counts = np.bincount(np.asarray(sizes, np.int64), minlength=capacity + 1)
    number, total = np.cumsum(counts), np.cumsum(counts * np.arange(capacity + 1))
    best = -(-int(total[-1]) // capacity)
    for t in [0, *np.flatnonzero(counts[: capacity // 2 + 1]).tolist()]:
        alone = int(number[-1] - number[capacity - t])
        large = int(number[capacity - t] - number[capacity // 2])
        room = large * capacity - int(total[capacity - t] - total[capacity // 2])
        small = int(total[capacity // 2] - (total[t - 1] if t else 0))
        best = max(best, alone + large + max(0, -(-(small - room) // capacity)))
    return best


def cross(first: Packing, second: Packing, sizes: list[int], capacity: int, rng: random.Random, inject: int) -> Packing:
    """A child: ``first`` with up to ``inject`` well-filled bins of ``second`` in place of the bins they overlap."""
    child = Packing(first.members.copy(), first.fills.copy(), first.where.copy())
    members, fills, where = child.members, child.fills, child.where
    # Well-filled: the fullest of three drawn, ``inject`` times; bins that both parents share change nothing.
    drawn = {max((rng.randrange(len(second.fills)) for _ in range(3)), key=second.fills.__getitem__) for _ in range(rng.randint(1, inject))}
    donors = [second.members[s] for s in drawn if sorted(members[where[second.members[s][0]]]) != sorted(second.members[s])]
    injected = {i for m in donors for i in m}
    gone = {where[i] for i in injected}
    gone |= {min((rng.randrange(len(fills)) for _ in range(8)), key=fills.__getitem__) for _ in range(rng.randint(1, 3))}
    displaced = sorted((i for s in gone for i in members[s] if i not in injected), key=lambda i: -sizes[i])
    free = list(gone)
    for m in donors:
        slot = free.pop() if free else len(fills)
        if slot == len(fills):
            members.append([])
            fills.append(0)
        members[slot], fills[slot] = m, sum(sizes[i] for i in m)
        for i in m:
            where[i] = slot
    best_fit(child, displaced, sizes, capacity, free)
    return child


def evolve(population: list[Packing], sizes: list[int], capacity: int, rng: random.Random, children: int, inject: int) -> list[Packing]:
    """The population after ``children`` children, fittest first; a child that is fitter than the worst takes its place."""
    ranked = sorted(((p.fitness(), k, p) for k, p in enumerate(population)), key=lambda x: x[:2])
    least, count = lower_bound(sizes, capacity), len(ranked)
    for _ in range(children if len(sizes) > 2 and len(ranked) > 1 else 0):
        if ranked[0][0][0] <= least:
            break
        a, b = rng.sample(range(len(ranked)), 2)
        child = cross(ranked[min(a, b)][2], ranked[max(a, b)][2], sizes, capacity, rng, inject)
        fitness = child.fitness()
        if fitness < ranked[-1][0] and all(fitness != f for f, _, _ in ranked):
            ranked[-1] = (fitness, count, child)
            count += 1
            ranked.sort(key=lambda x: x[:2])
    return [p for _, _, p in ranked]


def first_packings(sizes: list[int], capacity: int, number: int, rng: random.Random, whole: bool) -> list[Packing]:
    """Best-fit packings of the items: longest first if ``whole``, the others in orders disturbed ever more."""
    out = []
    for k in range(number):
        noise = 0 if whole and k == 0 else capacity * 0.02 * (k + 1)
        order = sorted(range(len(sizes)), key=lambda i: -sizes[i] + (rng.uniform(-noise, noise) if noise else 0))
        p = Packing([], [], [0] * len(sizes))
        best_fit(p, order, sizes, capacity, [])
        out.append(p)
    return out


_POPULATION = "block long, island int, home int, bins int, cost long, keys binary, sizes binary, slots binary"


def _rows(block: int, island: int, islands: int, keys: np.ndarray, sizes: list[int], population: list[Packing]) -> pa.RecordBatch:
    """An island's population, fittest first, and its elite once more for the next island."""
    rows = []
    for k, p in enumerate(population):
        bins, cost = p.fitness()
        row = (bins, cost, keys.tobytes() if k == 0 else None, np.array(sizes, "<i4").tobytes() if k == 0 else None, np.array(p.where, "<i4").tobytes())
        rows.append((block, island, island, *row))
        if k == 0 and islands > 1:
            rows.append((block, (island + 1) % islands, island, bins, cost, None, None, row[-1]))
    types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    names = [part.split()[0] for part in _POPULATION.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def evolved_blocks(items: DataFrame, blocks: int, capacity: int, population: int, islands: int, epochs: int, children: int, inject: int) -> DataFrame:
    """Items (key, length) -> (key, block, slot, fill): the fittest packing of each block."""

    def settle(table: pa.Table) -> pa.Table:
        block, island = table.column("block")[0].as_py(), table.column("island")[0].as_py()
        keys, sizes = table.column("key").to_numpy(), table.column("length").to_numpy()
        order = np.lexsort((keys, -sizes))
        rng = random.Random(f"{block} {island}")
        own = sizes[order].tolist()
        found = evolve(first_packings(own, capacity, population, rng, True), own, capacity, rng, children, inject)
        return pa.Table.from_batches([_rows(block, island, islands, keys[order], own, found)])

    def step(epoch: int):
        def run(table: pa.Table) -> pa.Table:
            rows = sorted(table.to_pylist(), key=lambda r: (r["home"] != r["island"], r["bins"], r["cost"], r["slots"]))
            block, island = rows[0]["block"], rows[0]["island"]
            owner = next(r for r in rows if r["keys"] is not None)
            keys, sizes = np.frombuffer(owner["keys"], np.int64), np.frombuffer(owner["sizes"], "<i4").tolist()
            packings = [Packing.of(np.frombuffer(r["slots"], "<i4"), sizes) for r in rows]
            own = [p for r, p in zip(rows, packings) if r["home"] == island]
            came = [p for r, p in zip(rows, packings) if r["home"] != island]
            rng = random.Random(f"{block} {island} {epoch}")
            # An immigrant takes the place of the least fit.
            found = evolve([*own[: max(1, population - len(came))], *came], sizes, capacity, rng, children, inject)
            return pa.Table.from_batches([_rows(block, island, islands, keys, sizes, found)])

        return run

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 16):
            for r in batch.to_pylist():
                keys, sizes, slots = np.frombuffer(r["keys"], np.int64), np.frombuffer(r["sizes"], "<i4"), np.frombuffer(r["slots"], "<i4")
                fills = np.bincount(slots, weights=sizes).astype(np.int32)
                order = np.lexsort((keys, slots))
                s, ends = slots[order], np.cumsum(sizes[order])
                begins = ends - sizes[order]
                first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
                offset = begins - np.repeat(begins[first], np.diff(np.r_[first, len(s)]))
                columns = [keys[order], sizes[order], np.full(len(s), r["block"]), s, fills[s], offset]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64()))], names=["key", "length", "block", "slot", "fill", "offset"])

    dealt = items.select("key", "length", F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"))
    state = dealt.groupBy("block", "island").applyInArrow(settle, _POPULATION)
    for epoch in range(1, epochs):
        state = state.groupBy("block", "island").applyInArrow(step(epoch), _POPULATION)
    elite = state.where(F.col("keys").isNotNull()).groupBy("block").agg(F.min_by(F.struct("keys", "sizes", "slots"), F.struct("bins", "cost", "island")).alias("e"))
    return elite.select("block", "e.*").mapInArrow(unfold, "key long, length int, block long, slot int, fill int, offset long")


def pack_items(items: DataFrame, capacity: int, block_items: int = 4096, population: int = 6, islands: int = 2, epochs: int = 3, children: int = 300, inject: int = 20) -> DataFrame:
    """Items (unique key, length of at most ``capacity``) -> (key, sequence_id, offset)."""
    items = materialise(items.select("key", "length"), "items")
    number, level, done = items.count(), 0, []
    while number:
        blocks = math.ceil(number / block_items)
        packed = materialise(evolved_blocks(items, blocks, capacity, population, islands, epochs, children, inject), "packed")
        # Loose bins: the emptiest that hold at most a quarter of the items, and no full one.
        left, bar = 0, 0
        for fill, held in sorted(packed.where(F.col("fill") < capacity).groupBy("fill").count().collect()):
            if blocks == 1 or 4 * (left + held) > number:
                break
            left, bar = left + held, fill + 1
        sequence = F.lit(level << 56) + F.shiftleft("block", 24) + F.col("slot")
        done.append(packed.where(F.col("fill") >= bar).select("key", sequence.alias("sequence_id"), "offset"))
        items, number, level = packed.where(F.col("fill") < bar).select("key", "length"), left, level + 1
    out = items.select("key", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")) if not done else done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack_best_fit(docs: DataFrame, tokenizer: dict[str, str] | None = None, end_id: int = 2, seq_len: int = 1024, digest: bool = False, **options) -> DataFrame:
    """Pieces of documents in sequences: doc_id, piece, start, length, input_ids (or ids_crc32 if ``digest``), sequence_id, offset.

    ``options`` are those of ``pack_items``.
    """
    pieces = materialise(cut_documents(docs, tokenizer or default_tokenizer(), end_id, seq_len, digest), "pieces")
    short = pieces.where(F.col("length") < seq_len)
    places = pack_items(short, seq_len, **options)
    # Whole pieces have even sequence numbers, packed ones odd.
    packed = short.join(places.select("key", (F.shiftleft("sequence_id", 1) + 1).alias("sequence_id"), "offset"), "key")
    whole = pieces.where(F.col("length") == seq_len).withColumn("sequence_id", F.shiftleft("key", 1)).withColumn("offset", F.lit(0).cast("long"))
    out = whole.unionByName(packed)
    return out.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), pieces.columns[-1], "sequence_id", "offset")


def default_tokenizer() -> dict[str, str]:
    import public_tokenizers

    return {"path": public_tokenizers.path("byte_bpe_50k.json"), "ranks_path": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_best_fit(read_table(spark, sf_dir, "documents"), digest=True)
