"""Operator 13: every token once, full sequences, and the rule of lowest cost against a plain loop."""

import random
import zlib
from collections import defaultdict
from itertools import accumulate

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparksift.llm import packing
from sparksift.llm.packing import Packing

from ..conftest import SF_DIR

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plainly(lengths, rooms, p):
    """Descending pieces to the lowest cost with room, one after the other; cut to the largest room where none has it."""
    todo, room, cost, out, left = [(n, k, 0) for k, n in enumerate(lengths) if n], list(rooms), [0.0] * len(rooms), [], []
    while todo:
        n, k, before = todo.pop(min(range(len(todo)), key=lambda i: (-todo[i][0], todo[i][1], todo[i][2])))
        most = max(room, default=0)
        if not most:
            left.append((k, before, n))
            continue
        if n > most:
            todo.append((n - most, k, before + most))
            n = most
        s = min((s for s in range(len(room)) if room[s] >= n), key=lambda s: (cost[s], s))
        out.append((k, before, n, s))
        room[s] -= n
        cost[s] += p.cost(n)
    return out, left


@pytest.mark.parametrize("seed", range(12))
def test_assignment_equals_a_plain_loop(seed):
    r, p = random.Random(seed), Packing(capacity=64)
    lengths = [r.choice((0, 1, 2, 3, 5, 8, 20, 63, 64, 65, 200, r.randrange(300))) for _ in range(60)]
    rooms = [64] * (sum(lengths) // 64) if seed % 2 else [64, 64, 32, 8, 1]
    assert packing.assigned(lengths, rooms, p) == plainly(lengths, rooms, p)
    assert packing.assigned(lengths, [], p)[0] == [] and packing.assigned([], rooms, p) == ([], [])


def test_costs_are_balanced():
    r, p = random.Random(1), Packing(capacity=1024)
    lengths = [r.randrange(1, 400) for _ in range(2000)]
    n = sum(lengths) // 1024
    spread = lambda placed: (lambda c: max(c) - min(c))([sum(p.cost(x[2]) for x in placed if x[3] == s) for s in range(n)])
    in_turn, at = [], 0
    for k, x in enumerate(lengths):  # one after the other, cut at the ends of sequences
        before = 0
        while x and at < n * 1024:
            m = min(x, 1024 - at % 1024)
            in_turn.append((k, before, m, at // 1024))
            at, x, before = at + m, x - m, before + m
    assert spread(packing.assigned(lengths, [1024] * n, p)[0]) < 0.6 * spread(in_turn)


def held(rows, texts, capacity, key):
    """Checks the pieces of one table; texts: by a number that key(row) gives."""
    own = Tokenizer.from_file(PATH)
    own.no_truncation()
    own.no_padding()
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[key(r)].append(r)
        seqs[r["sequence_id"]].append(r)
    assert set(docs) == set(texts)
    for k, pieces in docs.items():
        pieces.sort(key=lambda r: r["start"])
        ids = own.encode(texts[k] or "", add_special_tokens=False).ids + [0]
        assert b"".join(bytes(r["ids"]) for r in pieces) == b"".join(i.to_bytes(4, "little") for i in ids)
        assert all(r["doc_tokens"] == len(ids) for r in pieces)
        assert [r["start"] for r in pieces] == [0, *accumulate(len(r["ids"]) // 4 for r in pieces)][:-1]
    short = []
    for pieces in seqs.values():
        pieces.sort(key=lambda r: r["offset"])
        sizes = [len(r["ids"]) // 4 for r in pieces]
        assert min(sizes) > 0 and [r["offset"] for r in pieces] == [0, *accumulate(sizes)][:-1]
        short += [sum(sizes)] if sum(sizes) != capacity else []
    total = sum(len(r["ids"]) // 4 for r in rows)
    assert sorted(short) == [1 << b for b in range(capacity.bit_length() - 1) if total >> b & 1]


@pytest.mark.parametrize("parts, p", [(1, Packing()), (7, Packing(capacity=64, block=4, fan=2)), (3, Packing(capacity=16, block=1, fan=256)), (9, Packing(capacity=1024, block=64, fan=3))])
def test_pieces_of_odd_texts(spark, documents, edge_rows, parts, p):
    rows = [(k, t) for k, (_, t) in enumerate(edge_rows)] + [(100 + k, "again and again") for k in range(50)]
    got = packing.pack(documents(rows).repartition(parts), PATH, packing=p)
    assert got.columns == ["doc_id", "doc_tokens", "start", "ids", "sequence_id", "offset"]
    held(got.collect(), dict(rows), p.capacity, lambda r: r["doc_id"])


def test_null_and_repeated_ids_and_empty_tables(spark, documents):
    rows = packing.pack(documents([(None, "a b"), (1, None), (1, None), (1, "a b")]), PATH).collect()
    assert sorted((r["doc_id"] or 0, r["doc_tokens"], len(r["ids"]) // 4) for r in rows) == [(0, 3, 3), (1, 1, 1), (1, 1, 1), (1, 3, 3)]
    assert packing.pack(documents([]), PATH).count() == 0


def test_whole_table(spark):
    rows = packing.op13_packing(spark, SF_DIR).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    own = Tokenizer.from_file(PATH)
    own.no_truncation()
    own.no_padding()
    ids = {k: own.encode(t or "", add_special_tokens=False).ids + [0] for k, t in texts.items()}
    for r in rows:
        assert zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[r["doc_id"]][r["start"] : r["start"] + r["length"]])) == r["ids_crc32"]
    assert sum(r["length"] for r in rows) == sum(map(len, ids.values()))
