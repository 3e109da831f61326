"""Operator 5: token counts by batch encoding in Arrow functions that return lengths only.

Texts are packed into batches of about equal bytes. A text over the batch size is split at ASCII white space,
where this vocabulary's normaliser and pre-tokeniser always end a piece (no canonical composition reaches over
a space, runs of white space become one, and white space is dropped). Inside a batch the pieces between white
space (and up to punctuation that follows a letter) are encoded once each while the memo holds them; only their
lengths are kept. A-Z are lower-cased first, as the normaliser does, except in texts with a special token's mark.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import byte_alphabet
from .common import byte_groups, need, table

BATCH_BYTES = 1 << 20
MEMO_ENTRIES = 400_000
SPACES = b" \t\n\v\f\r"
#: Pieces between white space, cut also between a letter and ASCII punctuation other than the apostrophe.
PIECE = re.compile(rb"[a-z]+(?=[!-&(-/:-@\[-`{-~])|[^ \t-\r]+")


def safe_parts(raw: bytes, limit: int) -> list[bytes]:
    """Cuts raw before white space so that parts hold at most limit bytes, or one piece without white space."""
    out, start = [], 0
    while len(raw) - start > limit:
        cut = max(raw.rfind(s, start + 1, start + limit + 1) for s in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))
        if cut < 0:
            cut = min((c for s in SPACES if (c := raw.find(s, start + limit)) >= 0), default=len(raw))
        out.append(raw[start:cut])
        start = cut
    if start < len(raw):
        out.append(raw[start:])
    return out


#: Lower-case words of ASCII and Latin-1 letters: the rank-ordered encoder takes these.
WORD = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
#: A word's last byte stands apart from the same byte inside: a-z as A-Z, 0x80-0xBF as 0x00-0x3F.
AT_END = bytes(b - 0x20 if 0x61 <= b <= 0x7A else b - 0x80 if 0x80 <= b <= 0xBF else b for b in range(256))
END = "</w>"


def word_encoder(path: str):
    """An encoder of a WORD's bytes (last one through AT_END) by merge rank, or None if the file isn't of that kind."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    if model.get("end_of_word_suffix") != END:
        return None
    back, ranks = byte_alphabet(), {}
    for n, m in enumerate(model["merges"]):
        a, b = m.split(" ") if isinstance(m, str) else m
        joined = a + b
        inner = joined.removesuffix(END)
        raw = bytes(back[c] for c in inner)
        if inner != joined:
            raw = raw[:-1] + raw[-1:].translate(AT_END)
        if not WORD.fullmatch(bytes(back[c] for c in inner)) and not all(0x61 <= x <= 0x7A or x >= 0x80 for x in bytes(back[c] for c in inner)):
            continue  # holds signs or digits, which no WORD has
        ranks.setdefault(raw, 256 + n)
    ranks |= {bytes([b]): b for b in range(256)}
    core = tiktoken.Encoding("own", pat_str=r"(?s:.)+", mergeable_ranks=ranks, special_tokens={})._core_bpe
    return core.encode_single_piece


class LengthCounter:
    def __init__(self, path: str, memo_entries: int = MEMO_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.ranked = word_encoder(path)
        self.memo: dict[bytes, int] = {}
        self.memo_entries = memo_entries

    def lengths(self, parts: list[bytes]) -> list[int]:
        """Tokens of each part; one batch."""
        memo = self.memo
        if len(memo) > self.memo_entries:
            memo.clear()
        cut = [p.split() if b"<|" in p else PIECE.findall(p.lower()) for p in parts]
        new, ranked = [], self.ranked
        for w in {w for words in cut for w in words if w not in memo}:
            if ranked and WORD.fullmatch(w):
                memo[w] = len(ranked(w[:-1] + w[-1:].translate(AT_END)))
            else:
                new.append(w)
        for lo, hi in byte_groups(map(len, new), BATCH_BYTES):
            part = new[lo:hi]
            for w, e in zip(part, self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)):
                memo[w] = len(e)
        return [sum([memo[w] for w in words]) for words in cut]

    def counts(self, texts: list[bytes], batch_bytes: int = BATCH_BYTES) -> list[int]:
        owner, parts = [], []
        for k, raw in enumerate(texts):
            for p in safe_parts(raw, batch_bytes):
                owner.append(k)
                parts.append(p)
        out = [0] * len(texts)
        for lo, hi in byte_groups(map(len, parts), batch_bytes):
            for k, n in zip(owner[lo:hi], self.lengths(parts[lo:hi])):
                out[k] += n
        return out


@functools.lru_cache(maxsize=2)
def counter(path: str) -> LengthCounter:
    return LengthCounter(path)


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes long, n_tokens long.

    A null or empty text has 0 bytes and 0 tokens. Repeated rows and null ids are carried; other columns are left
    out, so their names can't clash. An empty table gives an empty one.
    """
    need(docs, [id_col, text_col])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("raw"))
    out = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer_path)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0)
            counts = []
            for lo, hi in byte_groups(sizes.to_pylist(), 4 * BATCH_BYTES):
                counts += own.counts([x or b"" for x in batch.column(1).slice(lo, hi - lo).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes.cast(pa.int64()), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])

    return rows.mapInArrow(run, out).withColumnRenamed("id", id_col)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents; null counts as empty. Repeated rows each give a row, an empty table gives an empty one."""
    import public_tokenizers

    counted = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)
