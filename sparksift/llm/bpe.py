"""Operator 4: BPE encoding and decoding by forced boundaries.

A byte pair that occurs inside no vocabulary token can never be merged over, so a text is cut between the two bytes of
every such pair. The table of pairs is made from the vocabulary's bytes, and every cut is looked up in it, whatever the
bytes are. The pre-tokeniser only guards: a cut stands where the classes of the two characters say that it can't change
the pre-tokeniser's pieces, or only shortens a run of one class (there the pairs tell that nothing merges over it).
Fragments are encoded independently (each distinct one once while the memo holds it) and their ids are concatenated.
"""

from __future__ import annotations

import functools
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_groups, need, table

OTHER, SPACE, LETTER, DIGIT, SIGN, QUOTE = range(6)
#: Classes on the left of a cut, and those that may stand on the right of it. White space belongs to what follows, so nothing
#: is cut after it; an apostrophe may begin a contraction unless it follows other signs, so those stay together. Characters
#: beyond ASCII are no letters to rely on, but for those of Latin-1; next to OTHER nothing is cut.
MAY_CUT = {
    LETTER: (SPACE, LETTER, DIGIT, SIGN, QUOTE),
    DIGIT: (SPACE, LETTER, DIGIT, SIGN, QUOTE),
    SIGN: (SPACE, LETTER, DIGIT, SIGN),
    QUOTE: (SPACE,),
}
#: Characters whose class is the same in every Unicode version: their fragments may take the rank-ordered encoder.
SETTLED = re.compile(r"[\t-\r -~\xc0-\xff]+")
MEMO_ENTRIES = 250_000
#: Longer fragments are not kept in the memo.
MEMO_BYTES = 64
SLICE_BYTES = 2 << 20


def byte_classes() -> np.ndarray:
    out = np.full(256, OTHER, np.uint8)
    out[0x21:0x7F] = SIGN
    out[[0x20, *range(0x09, 0x0E)]] = SPACE
    out[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
    out[0x30:0x3A] = DIGIT
    out[0x27] = QUOTE
    return out


def guard() -> np.ndarray:
    """By class on the left times six, and class on the right."""
    out = np.zeros(36, bool)
    for left, rights in MAY_CUT.items():
        out[[left * 6 + r for r in rights]] = True
    return out


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if printable, else the next free code from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    odd = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(odd)}


class ForcedBoundaryCodec:
    """Encodes as the tokenizers library does, by fragments; decodes ids by the vocabulary's bytes."""

    def __init__(self, path: str, memo_entries: int = MEMO_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo: dict[bytes, bytes] = {}
        self.memo_entries = memo_entries
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = byte_alphabet()
        added = {x["id"]: x["content"] for x in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        self.pieces = [b""] * (1 + max([*vocab.values(), *added]))
        self.inside = bytearray(1 << 16)
        for token, i in vocab.items():
            raw = bytes(back[c] for c in token)
            self.pieces[i] = raw
            for a, b in zip(raw, raw[1:]):
                self.inside[a << 8 | b] = 1
        for i, content in added.items():
            self.pieces[i] = content.encode()
        self.specials = [x.encode() for x in added.values()]
        self.forced = np.frombuffer(self.inside, np.uint8) == 0
        self.classes, self.guard = byte_classes(), guard()
        self.ranked = self._ranked(spec["model"])

    def _ranked(self, model: dict):
        """A rank-ordered encoder of the same merges, if merge order and id order agree; else None."""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in merges]
        if made != sorted(made) or len(set(made)) != len(made) or made and made[0] < 256:
            return None
        import public_tokenizers
        import tiktoken

        ranks = {self.pieces[i]: i for i in model["vocab"].values()}
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def cuts(self, blob: bytes) -> np.ndarray:
        """Whether to cut before each byte but the first: the pair with the byte before is forced, and the guard lets it stand."""
        raw = np.frombuffer(blob, np.uint8)
        kind = self.classes[raw]
        lead = np.flatnonzero(raw[:-1] == 0xC3)
        # U+00C0 to U+00FF: letters, but for the signs of multiplication and division.
        lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]
        kind[lead] = kind[lead + 1] = LETTER
        out = self.forced[raw[:-1].astype(np.uint16) << 8 | raw[1:]]
        out &= self.guard[kind[:-1] * 6 + kind[1:]]
        out &= raw[1:] & 0xC0 != 0x80  # never inside a character
        for special in self.specials:
            at = blob.find(special)
            while at >= 0:
                out[at : at + len(special) - 1] = False
                at = blob.find(special, at + len(special))
        return out

    def fragments(self, texts: list[bytes]) -> tuple[list[bytes], list[int]]:
        """The fragments of all texts one after the other, and where each text's begin (one more than texts)."""
        blob = b"".join(texts)
        starts = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        if not blob:
            return [], [0] * len(starts)
        cut = np.concatenate(([True], self.cuts(blob), [True]))
        cut[starts] = True
        edges = np.flatnonzero(cut)
        held = edges.tolist()
        return [blob[a:b] for a, b in zip(held, held[1:])], np.searchsorted(edges, starts).tolist()

    def encode_batch(self, texts: list[bytes]) -> list[bytes]:
        """Of each text (UTF-8) the ids as little-endian unsigned 32-bit integers."""
        if len(self.memo) > self.memo_entries:
            self.memo.clear()
        memo, plain = self.memo, self.ranked
        cut, at = self.fragments(texts)
        fresh: dict[bytes, bytes] = {}
        rest = []
        for f in set(cut):
            if f in memo:
                continue
            text = f.decode()
            if plain and SETTLED.fullmatch(text) and not any(x in f for x in self.specials):
                fresh[f] = array("I", plain(text)).tobytes()
            else:
                rest.append((f, text))
        for lo, hi in byte_groups((len(f) for f, _ in rest), 1 << 20):
            part = rest[lo:hi]
            for (f, _), e in zip(part, self.tokenizer.encode_batch([t for _, t in part], add_special_tokens=False)):
                fresh[f] = array("I", e.ids).tobytes()
        memo.update((f, ids) for f, ids in fresh.items() if len(f) <= MEMO_BYTES)
        ids = [memo[f] if f in memo else fresh[f] for f in cut]
        return [b"".join(ids[a:b]) for a, b in zip(at, at[1:])]

    def decode(self, ids: bytes) -> str:
        pieces, held = self.pieces, array("I", ids)
        return b"".join([pieces[i] for i in held]).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def codec(path: str) -> ForcedBoundaryCodec:
    return ForcedBoundaryCodec(path)


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens long, ids binary (little-endian unsigned 32-bit), decoded string.

    A null text counts as empty: no tokens, empty ids, empty decoded text. Repeated rows each give a row; null
    ids are carried; other columns are left out, so their names can't clash. An empty table gives an empty one.
    Long texts are taken whole: memory follows the longest text and SLICE_BYTES, not the partition.
    """
    need(docs, [id_col, text_col])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    out = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer_path)
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for lo, hi in byte_groups(sizes, SLICE_BYTES):
                ids = own.encode_batch([t or b"" for t in texts.slice(lo, hi - lo).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array([own.decode(x) for x in ids], pa.string())], ["id", "n_tokens", "ids", "decoded"])

    return rows.mapInArrow(run, out).withColumnRenamed("id", id_col)


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and decoded text of each row that encode_decode gives; empty texts have the digests of nothing."""
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op4_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents; null counts as empty, repeated rows each give a row, an empty table gives an empty one."""
    import public_tokenizers

    return digests(encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))
