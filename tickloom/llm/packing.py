"""Packing by power-of-two decomposition.

A document's token ids are cut into pieces whose lengths are powers of two: as
many full ``max_len`` pieces as fit, then the binary digits of the rest, longest
first. Every piece is a sequence of its own, so nothing is padded and no
sequence crosses documents; sequences of one length form a bucket, from which
batches of one shape are drawn.

Defined results: a special token's string in a text is that token; a null or empty text is the end token alone, one piece of
length 1; rows that repeat a doc_id are packed one by one; an empty table gives
an empty result; only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LEN = 2048
END = 1
#: Characters of text encoded before rows are handed back.
BATCH_CHARS = 1_000_000
SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint"


def vocabulary() -> str:
    """Path of the default vocabulary, looked up where it is used."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Code points of the byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts that hold a longer run of blanks go to ``tokenizers``, since the fast encoder's pattern recurses over such runs.
BLANKS = 100_000


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """Byte strings by merge rank where the file is a plain byte-level BPE; None where it holds anything else."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
    level = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    added = spec.get("added_tokens", [])
    exact = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added)
    if not (plain and level and exact) or spec.get("normalizer"):
        return None
    byte_of = {chr(b): b for b in _SHOWN} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
    special = {t["content"] for t in added}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [model["vocab"].get(a + b) for a, b in merges]
    return ranks if made == sorted(made) and len(made) + 256 == len(ranks) and min(made, default=256) >= 256 else None


@lru_cache(maxsize=4)
def encoder(path: str) -> Callable[[str], list[int]]:
    """Text to the ids that ``tokenizers`` gives for the file with add_special_tokens=False; a special token's string is that token.

    In a plain byte-level BPE the vocabulary in merge order is what tiktoken calls ranks. Its
    encoder gives the same ids several times faster. Any other file is left to ``tokenizers``.
    """
    import json

    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    slow = lambda text: whole.encode(text, add_special_tokens=False).ids
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    ranks = _ranks(spec)
    if ranks is None:
        return slow
    import re

    import tiktoken

    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    quick = tiktoken.Encoding("byte_bpe", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special)
    wide = re.compile(rf"\s{{{BLANKS}}}")
    marked = re.compile("|".join(map(re.escape, special))) if special else None

    def encode(text: str) -> list[int]:
        if len(text) > BLANKS and wide.search(text):
            return slow(text)
        if marked and marked.search(text):
            return quick.encode(text, allowed_special="all")
        return quick.encode_ordinary(text)

    return encode


def piece_lengths(n: int, max_len: int = MAX_LEN) -> list[int]:
    """Full pieces, then the set bits of the rest from the highest down."""
    rest = n % max_len
    return [max_len] * (n // max_len) + [1 << b for b in reversed(range(max_len.bit_length())) if rest >> b & 1]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str | None = None, max_len: int = MAX_LEN, end_id: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian uint32), doc_tokens, bucket (log2 of length), sequence_id, offset.

    One pass without a shuffle. ``sequence_id`` numbers rows within input
    partitions, so it is unique and the same whenever a lost task runs again.
    """
    if max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    path = vocab or vocabulary()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            rows, chars = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*encode(text or ""), end_id], dtype="<u4")
                at = 0
                for n in piece_lengths(len(ids), max_len):
                    rows.append((doc, at, n, ids[at : at + n].tobytes(), len(ids)))
                    at += n
                chars += len(text or "")
                if chars >= BATCH_CHARS:
                    yield _batch(rows)
                    rows, chars = [], 0
            if rows:
                yield _batch(rows)

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = plain.mapInArrow(pieces, SCHEMA)
    return out.withColumns({"bucket": F.log2("length").cast("int"), "sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
    names = ["doc_id", "start", "length", "ids", "doc_tokens"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write packed sequences in one folder per length."""
    packed.write.mode("overwrite").partitionBy("bucket").parquet(path)
