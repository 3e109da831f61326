"""Operator 13: documents packed into sequences of a fixed length, balanced by the cost of attention.

A piece of n tokens costs n times a linear weight and n * n times a quadratic one: tokens attend within their piece. In
a block of pieces that holds as many tokens as its sequences have room for, pieces go in descending order to the sequence
of the lowest cost among those with room for the whole piece. Where none has room, the piece is cut to the largest room
that is left, and the rest goes back among the pieces. So every sequence of a block is filled.

The tasks that read and encode the documents also pack them, block by block, with what is left of a block (less than one
sequence) going on to the next; the ids never move between executors. Only what is left of each task, less than one
sequence again, is brought together, the leftovers of a bounded number of tasks at a time, until one is left. Its tokens
fill one sequence for each power of two in their number, so nothing is padded.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import SLICE_BYTES, codec
from .common import byte_groups, need, staged, table

#: Bytes of a token's id.
WIDE = 4


@dataclass(frozen=True)
class Packing:
    """capacity: tokens of a sequence, a power of two. linear, quadratic: cost of a piece by its tokens and their square.

    block: sequences that are packed together; fan: tasks whose leftovers are packed together. end: the id after each document.
    """

    capacity: int = 1024
    linear: float = 1.0
    quadratic: float = 1 / 1024
    block: int = 1024
    fan: int = 256
    end: int = 0

    def cost(self, n: int) -> float:
        return self.linear * n + self.quadratic * n * n


def assigned(lengths: list[int], rooms: list[int], packing: Packing) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int, int]]]:
    """Pieces of the given lengths laid into sequences with the given room, by descending length to the lowest cost.

    Gives (piece, tokens of it before, tokens, sequence) in the order of assignment, which is that of their offsets, and
    (piece, tokens before, tokens) of what found no room. Equal pieces go by their order, sequences of equal cost too.
    """
    widest = max(rooms, default=0)
    # Sequences by the room that they have, those of each room in a heap by cost; least holds the top cost for each room.
    by_room: list[list[tuple[float, int]]] = [[] for _ in range(widest + 1)]
    least = np.full(widest + 1, np.inf)
    for s, room in enumerate(rooms):
        by_room[room].append((0.0, s))
        least[room] = 0.0
    queue = [(-n, k, 0) for k, n in enumerate(lengths) if n]
    heapq.heapify(queue)
    out, left, most = [], [], widest
    while queue:
        n, k, before = heapq.heappop(queue)
        n = -n
        while most and not by_room[most]:
            most -= 1
        if not most:
            left.append((k, before, n))
            continue
        if n > most:
            heapq.heappush(queue, (most - n, k, before + most))
            n = most
        room = n + int(np.argmin(least[n : most + 1]))
        # Rooms of equal least cost: the first sequence.
        ties = np.flatnonzero(least[n : most + 1] == least[room])
        if len(ties) > 1:
            room = n + int(min(ties, key=lambda r: by_room[n + r][0][1]))
        cost, s = heapq.heappop(by_room[room])
        least[room] = by_room[room][0][0] if by_room[room] else np.inf
        out.append((k, before, n, s))
        rest = room - n
        heapq.heappush(by_room[rest], (cost + packing.cost(n), s))
        least[rest] = by_room[rest][0][0]
    return out, left


#: A piece on its way: the document's key, its tokens, tokens before the piece, and the piece's ids.
Piece = tuple[object, int, int, bytes]


def laid(pieces: list[Piece], rooms: list[int], packing: Packing) -> tuple[list[tuple], list[Piece]]:
    """(key, tokens of the document, start, ids, sequence, offset) of what is laid, and the pieces that are left."""
    placed, left = assigned([len(p[3]) // WIDE for p in pieces], rooms, packing)
    held, out = [0] * len(rooms), []
    cut = lambda k, before, n: pieces[k][3][before * WIDE : (before + n) * WIDE]
    for k, before, n, s in placed:
        out.append((pieces[k][0], pieces[k][1], pieces[k][2] + before, cut(k, before, n), s, held[s]))
        held[s] += n
    return out, [(pieces[k][0], pieces[k][1], pieces[k][2] + before, cut(k, before, n)) for k, before, n in left]


def _schema(id_type: T.DataType) -> T.StructType:
    kinds = (("id", id_type), ("doc_tokens", T.LongType()), ("start", T.LongType()), ("ids", T.BinaryType()), ("part", T.LongType()), ("seq", T.LongType()), ("offset", T.LongType()))
    return T.StructType([T.StructField(*x) for x in kinds])


class Packer:
    """Packs pieces as they come. Rows are (id, doc_tokens, start, ids, part, seq, offset); seq counts the sequences of the part, null for leftovers."""

    def __init__(self, packing: Packing, part: int):
        self.packing, self.part, self.made = packing, part, 0
        self.held: list[Piece] = []
        self.tokens = 0

    def add(self, piece: Piece) -> Iterator[list[tuple]]:
        """The rows of a block as soon as it is full. A long document fills several; what is beyond a block waits for the next."""
        key, total, start, ids = piece
        full, at, size = self.packing.block * self.packing.capacity, 0, len(ids) // WIDE
        while self.tokens + size - at >= full:
            n = full - self.tokens
            self.held.append((key, total, start + at, ids[at * WIDE : (at + n) * WIDE]))
            self.tokens, at = full, at + n
            yield self.pack()
        if at < size:
            self.held.append((key, total, start + at, ids[at * WIDE :]))
            self.tokens += size - at

    def pack(self) -> list[tuple]:
        """Fills as many sequences as the held pieces can; what is left stays held."""
        n = self.tokens // self.packing.capacity
        placed, self.held = laid(self.held, [self.packing.capacity] * n, self.packing)
        self.tokens -= n * self.packing.capacity
        self.made += n
        return [(k, t, start, ids, self.part, self.made - n + s, at) for k, t, start, ids, s, at in placed]

    def rest(self) -> list[tuple]:
        return [(k, t, start, ids, self.part, None, None) for k, t, start, ids in self.held]

    def close(self) -> list[tuple]:
        """The last leftover, in one sequence for each power of two of its tokens."""
        rooms = [1 << b for b in range(self.tokens.bit_length())[::-1] if self.tokens >> b & 1]
        placed, _ = laid(self.held, rooms, self.packing)
        return [(k, t, start, ids, self.part, self.made + s, at) for k, t, start, ids, s, at in placed]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows) if rows else [()] * len(schema), schema)], schema=schema)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", packing: Packing = Packing()) -> DataFrame:
    """Per piece: id, doc_tokens, start, ids binary (little-endian unsigned 32-bit), sequence_id, offset; all of it is written.

    A document's tokens are its text's and `end`; a null text counts as empty, so it is one token. Each token lies in one
    piece, and a document of more tokens than a sequence holds is cut into several. Every sequence is full, but for the
    last ones, one for each power of two that is left of the corpus. Rows of equal id are documents of their own; null
    ids are carried; other columns are left out, so their names can't clash. An empty table gives an empty one. A text is
    encoded whole; beyond that a task holds a block. Which documents share a sequence follows from how the scan is split
    into tasks; a task that is run again gives the same rows.
    """
    from pyspark import TaskContext
    from pyspark.sql.pandas.types import to_arrow_schema

    need(docs, [id_col, text_col])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    schema = _schema(rows.schema["id"].dataType)
    arrow = to_arrow_schema(schema)
    end = int(packing.end).to_bytes(WIDE, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, packer = codec(tokenizer_path), Packer(packing, TaskContext.get().partitionId())
        for batch in batches:
            texts = [x or b"" for x in batch.column(1).to_pylist()]
            keys = batch.column(0).to_pylist()
            for lo, hi in byte_groups(map(len, texts), SLICE_BYTES):
                for key, ids in zip(keys[lo:hi], own.encode_batch(texts[lo:hi])):
                    ids += end
                    for full in packer.add((key, len(ids) // WIDE, 0, ids)):
                        yield _batch(full, arrow)
        yield _batch(packer.pack(), arrow)
        yield _batch(packer.rest(), arrow)

    def rest_packer(last: bool):
        def again(pieces: pa.Table) -> pa.Table:
            """What is left of up to `fan` packers, each less than one sequence."""
            held = sorted(pieces.to_pylist(), key=lambda r: (r["part"], r["at"]))
            packer, done = Packer(packing, held[0]["group"]), []
            for r in held:
                for full in packer.add((r["id"], r["doc_tokens"], r["start"], r["ids"])):
                    done += full
            done += packer.pack() + (packer.close() if last else packer.rest())
            return pa.Table.from_batches([_batch(done, arrow)])

        return again

    made = staged(rows.mapInArrow(encode, schema), "packed")
    # What a sequence is known by: the packer, counted over all rounds, in the upper bits, and its count there.
    named = lambda base: ((F.col("part") + F.lit(base)) * F.lit(1 << 32) + F.col("seq")).alias("sequence_id")
    out = made.filter("seq IS NOT NULL").select("id", "doc_tokens", "start", "ids", named(0), "offset")
    base, parts = 0, 1 + (made.agg(F.max("part")).first()[0] or 0)
    while True:
        base, parts = base + parts, -(-parts // packing.fan)

        left = made.filter("seq IS NULL").withColumn("at", F.monotonically_increasing_id()).withColumn("group", F.floor(F.col("part") / packing.fan))
        made = staged(left.groupBy("group").applyInArrow(rest_packer(parts == 1), schema), "packed-rest")
        out = out.unionByName(made.filter("seq IS NOT NULL").select("id", "doc_tokens", "start", "ids", named(base), "offset"))
        if parts == 1:
            return out.withColumnRenamed("id", id_col)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents; a null text counts as empty and is one token, repeated rows are packed each, an empty table gives an empty one."""
    import public_tokenizers

    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    length = (F.octet_length("ids") / WIDE).cast("long").alias("length")
    return pieces.select("doc_id", "start", length, F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
