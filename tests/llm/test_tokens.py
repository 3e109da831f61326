import hashlib
import itertools
import random
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparksift.llm.bpe import ForcedBoundaryCodec, byte_alphabet, digests, encode_decode
from sparksift.llm.common import table
from sparksift.llm.token_counts import LengthCounter, safe_parts, token_counts

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = [" ", "  ", "\n", "\n\n", "\t", "\u00a0", "\u3000", "\x1c", "\x85", "à", "é", "a", "b", "bq", "vq", "'s", "'ll", "'", "!", "...", "12", "٣", "中", "e\u0301", "<|endoftext|>", "<|startoftext|>", "<|", "😀", "\u200d", "İ", "Σ", "ß", "\ufeff", "\u200b", "\r\n", "×", "qz" * 200, "Word,", "foo.bar"]


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(3)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]


def test_encoding_equals_the_library(texts):
    own, lib = ForcedBoundaryCodec(BYTES, 500), Tokenizer.from_file(BYTES)
    assert own.ranked
    for lo in range(0, len(texts), 100):
        part = texts[lo : lo + 100]
        want = [e.ids for e in lib.encode_batch(part, add_special_tokens=False)]
        got = own.encode_batch([t.encode() for t in part])
        assert [array("I", x).tolist() for x in got] == want
        assert [own.decode(x) for x in got] == [lib.decode(x, skip_special_tokens=False) for x in want] == part


def test_cuts_are_forced(texts):
    """Every cut parts a byte pair that no token holds, and the fragments are the text."""
    own, lib = ForcedBoundaryCodec(BYTES), Tokenizer.from_file(BYTES)
    back = byte_alphabet()
    tokens = [bytes(back[c] for c in t) for t, i in lib.get_vocab(with_added_tokens=False).items()]
    inside = {t[k : k + 2] for t in tokens for k in range(len(t) - 1)}
    assert b"\xa0 " in inside and b"vq" not in inside and b"th" in inside
    n = 0
    for t in [*texts, "vq" * 400, "12vq!?'s it's", "à b\u00a0 c"]:
        raw = t.encode()
        cut, at = own.fragments([raw])
        assert b"".join(cut) == raw and at == [0, len(cut)]
        ends = list(itertools.accumulate(map(len, cut)))[:-1]
        assert all(raw[e - 1 : e + 1] not in inside for e in ends)
        n += len(ends)
    assert n > len(texts) and len(own.fragments([b"vq" * 400])[0]) > 300
    assert own.fragments([b"", b"a b", b""]) == ([b"a", b" b"], [0, 0, 2, 2])


def test_random_bytes_of_latin_text(texts):
    """Characters drawn freely, so that all classes stand side by side."""
    own, lib, rnd = ForcedBoundaryCodec(BYTES), Tokenizer.from_file(BYTES), random.Random(11)
    signs = [*map(chr, range(256)), "'s", "'re", "\u3000", "\u2028", "\u200b", "中", "e\u0301", "<|endoftext|>"]
    held = ["".join(rnd.choices(signs, k=rnd.randint(1, 60))) for _ in range(3000)] + ["".join(rnd.choices("ab' !?1 \n'sté", k=30)) for _ in range(5000)]
    got = own.encode_batch([t.encode() for t in held])
    assert [array("I", x).tolist() for x in got] == [e.ids for e in lib.encode_batch(held, add_special_tokens=False)]


def test_counts_equal_the_library(texts):
    lib = Tokenizer.from_file(WORDS)
    got = LengthCounter(WORDS, 500).counts([t.encode() for t in texts], 300)
    assert got == [len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]


def test_safe_parts():
    raw = b"aa bbb " * 100
    assert b"".join(safe_parts(raw, 16)) == raw and max(map(len, safe_parts(raw, 16))) <= 16
    assert safe_parts(b"x" * 50, 16) == [b"x" * 50] and safe_parts(b"", 16) == []


def test_edges(spark, documents, edge_rows):
    lib, words = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
    docs = documents(edge_rows)
    got = sorted(tuple(r) for r in digests(encode_decode(docs, BYTES)).na.fill(-1).collect())
    want = []
    for i, t in edge_rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((-1 if i is None else i, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    counts = sorted(tuple(r) for r in token_counts(docs, WORDS).na.fill(-1, ["doc_id"]).collect())
    assert counts == sorted((-1 if i is None else i, len((t or "").encode()), len(words.encode(t or "", add_special_tokens=False).ids)) for i, t in edge_rows)
    assert encode_decode(docs.limit(0), BYTES).count() == token_counts(docs.limit(0), WORDS).count() == 0


def test_whole_table(spark):
    from sparksift.llm.queries import QUERIES

    lib, words = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
    texts = {r["doc_id"]: r["text"] for r in table(spark, "/root/testdata/sf0.001", "documents").collect()}
    for r in QUERIES["op4_bpe_encoding"](spark, "/root/testdata/sf0.001").collect():
        ids = lib.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest())
    for r in QUERIES["op5_token_counts"](spark, "/root/testdata/sf0.001").collect():
        n = len(words.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 2048)
