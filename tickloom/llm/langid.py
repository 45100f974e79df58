"""Language identification by segmentation-marginalised unigrams.

The vocabulary is a fixed public SentencePiece file. Each language has a
probability for every piece, counted on a bounded sample of labelled documents.
A word's probability under a language is the sum over all its segmentations
into pieces, which a forward pass over its bytes gives; a text's is the product
over its words. The forward pass runs over many words and all languages at
once, and each distinct word of a batch is scored once.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
an empty table, or one without labels, gives ``und`` for every row; rows that
repeat a doc_id are judged one by one; a null doc_id is not held out and teaches
nothing; a word of any length, as all of a text without blanks, is summed over all its
segmentations; every label that a taught row has is learned. A worker holds one number
for each piece and language, and otherwise arrays of bounded size. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled documents that teach a language, at most about so many of each.
SAMPLE_PER_LANG = 1500
#: Share of the all-language distribution mixed into each language's.
SMOOTH = 0.02
#: Numbers in each array of a forward pass, words in one pass, and languages scored at once; together they bound a worker's memory.
CELLS, PASS, LANGS = 4_000_000, 8192, 64
#: Words above LONG bytes are scored one by one where fewer than ALONE of them would share a pass, SLICE bytes at a time.
LONG, ALONE, SLICE = 64, 128, 1 << 16
#: Scores kept for words met again, and characters of text whose words are scored together at most (for up to 16 languages).
CACHE, BATCH_CHARS = 1_000_000, 1_000_000
_B = 0x9E3779B97F4A7C15


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class Pieces:
    """The vocabulary's byte strings (word start as a blank) in a chained hash table over their 64-bit hashes."""

    SLOTS = 20

    def __init__(self, path: str):
        sp = _processor(path)
        size = sp.get_piece_size()
        found: dict[bytes, int] = {}
        for i in range(size):
            if sp.is_byte(i):
                found.setdefault(bytes([int(sp.id_to_piece(i)[3:-1], 16)]), i)
        for i in range(size):
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                found[sp.id_to_piece(i).replace("▁", " ").encode()] = i
        self.lengths = sorted({len(k) for k in found})
        self.keys = np.zeros(len(found) + 1, dtype=np.uint64)
        self.keys[1:] = [_hash(k) for k in found]
        self.ids = np.array([0, *found.values()])
        slot = self._slot(self.keys)
        self.table = np.zeros(1 << self.SLOTS, dtype=np.int32)
        self.chain = np.zeros(len(self.keys), dtype=np.int32)
        for k in range(1, len(self.keys)):
            self.chain[k], self.table[slot[k]] = self.table[slot[k]], k

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - self.SLOTS)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``h`` that hold a piece's hash, and the pieces' ids."""
        at = self.table[self._slot(h)]
        todo = np.flatnonzero(at)
        at, hits, got = at[todo], [], []
        while len(todo):
            same = self.keys[at] == h[todo]
            hits.append(todo[same])
            got.append(self.ids[at[same]])
            at = self.chain[at]
            more = ~same & (at > 0)
            todo, at = todo[more], at[more]
        return (np.concatenate(hits), np.concatenate(got)) if hits else (np.zeros(0, np.int64), np.zeros(0, np.int64))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse."""
    up, down = np.full(n, _B, dtype=np.uint64), np.full(n, pow(_B, -1, 2**64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


@lru_cache(maxsize=2)
def _pieces(path: str) -> Pieces:
    return Pieces(path)


def _hash(data: bytes) -> int:
    h = 0
    for b in data:
        h = (h * _B + b + 1) % 2**64
    return h


def remainder(id_col: str) -> Column:
    """crc32 of the id's text, modulo 4."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def has_letter(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def learn(labelled: DataFrame, vocab: str | None = None, sample_per_lang: int = SAMPLE_PER_LANG) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log priors and piece probabilities from columns doc_id, text, lang.

    The sample is chosen by a hash of doc_id at a rate that the full label counts
    set, so its expected size per language is bounded whatever the input's. What
    reaches the driver is one count per language and piece.
    """
    path = vocab or vocabulary()
    usable = labelled.filter(F.col("lang").isNotNull() & has_letter("text"))
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    total = {r["lang"]: r["n"] for r in counts.collect()}
    langs = sorted(total)
    size = _processor(path).get_piece_size()
    if not langs:
        return [], np.zeros(0), np.zeros((size, 0))
    spot = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    rates = labelled.sparkSession.createDataFrame([(k, min(1.0, sample_per_lang / total[k])) for k in langs], "_lang string, rate double")
    sample = usable.select("text", "lang", spot.alias("spot")).join(F.broadcast(rates), F.col("lang") == F.col("_lang")).filter("spot < rate").select("text", "lang")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sp = _processor(path)
        for pdf in batches:
            for lang, part in pdf.groupby("lang"):
                words = [w for t in part["text"] for w in t.split()]
                ids = [i for got in sp.encode(words, num_threads=1) for i in got]
                pieces, n = np.unique(np.array(ids, dtype=np.int64), return_counts=True)
                yield pd.DataFrame({"lang": lang, "piece": pieces, "n": n})

    table = sample.mapInPandas(count, "lang string, piece bigint, n bigint").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
    c = np.zeros((size, len(langs)))
    for k, lang in enumerate(langs):
        mine = table[table["lang"] == lang]
        c[mine["piece"].to_numpy(dtype=np.int64), k] = mine["n"]
    share = (c + 1e-3) / (c + 1e-3).sum(0)
    probs = (1 - SMOOTH) * share + SMOOTH * share.mean(1, keepdims=True)
    prior = np.log(np.array([total[k] for k in langs], dtype=float) / sum(total.values()))
    return langs, prior, probs


def word_scores(words: list[bytes], path: str, probs: np.ndarray) -> np.ndarray:
    """Log of the summed probability of all segmentations, words by languages. A word starts with its blank and has any length."""
    out = np.empty((len(words), probs.shape[1]))
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    order = np.argsort(sizes, kind="stable")
    keep = _pieces(path).lengths[-1] + 1
    for lo in range(0, probs.shape[1], LANGS):
        part = np.ascontiguousarray(probs[:, lo : lo + LANGS])
        at = 0
        while at < len(order):
            most = max(1, min(PASS, CELLS // (keep * part.shape[1])))
            rows = order[at : at + most]
            rows = rows[: max(1, np.searchsorted(np.arange(1, len(rows) + 1) * sizes[rows], CELLS))]
            if sizes[rows[-1]] > LONG and len(rows) < ALONE:
                for r in rows:
                    out[r, lo : lo + LANGS] = _one_score(words[r], path, part)
            else:
                out[rows, lo : lo + LANGS] = _pass_scores([words[r] for r in rows], path, part)
            at += len(rows)
    return out


def _pass_scores(words: list[bytes], path: str, probs: np.ndarray) -> np.ndarray:
    """Scores of words in order of length, all of them one byte further at a time.

    ``alpha`` holds the prefixes that a piece can still start from, as many as the longest piece has bytes.
    """
    pieces = _pieces(path)
    lengths = pieces.lengths
    width, ring = len(words[-1]), lengths[-1] + 1
    n = np.array([len(w) for w in words])
    flat = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8)
    text = flat.reshape(len(words), width).T
    prefix = np.zeros((width + 1, len(words)), dtype=np.uint64)
    powers = np.ones(ring + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            prefix[i + 1] = prefix[i] * np.uint64(_B) + text[i] + np.uint64(1)
        for i in range(ring):
            powers[i + 1] = powers[i] * np.uint64(_B)
    alpha = np.zeros((ring, len(words), probs.shape[1]))
    alpha[0] = 1.0
    shift = np.zeros((len(words), probs.shape[1]))
    final = np.zeros((len(words), probs.shape[1]))
    for end in range(1, width + 1):
        here = alpha[end % ring]
        here[:] = 0.0
        for size in lengths:
            if size > end:
                break
            with np.errstate(over="ignore"):
                h = prefix[end] - prefix[end - size] * powers[size]
            hit, piece = pieces.find(h)
            if len(hit):
                here[hit] += alpha[(end - size) % ring, hit] * probs[piece]
        done = n == end
        final[done] = np.log(np.maximum(here[done], 1e-300)) + shift[done]
        if end % 16 == 0:
            scale = np.maximum(here, 1e-300)
            alpha /= scale
            shift += np.log(scale)
    return final


def _one_score(word: bytes, path: str, probs: np.ndarray) -> np.ndarray:
    """The same for one long word: its pieces are found at all places at once, then summed byte by byte."""
    pieces = _pieces(path)
    ring = pieces.lengths[-1] + 1
    data = np.frombuffer(word, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    alpha = np.zeros((ring, probs.shape[1]))
    alpha[0], shift = 1.0, np.zeros(probs.shape[1])
    for a in range(0, len(data), SLICE):
        # places a + 1 .. b end in this slice; pieces may start before it
        b, back = min(a + SLICE, len(data)), min(a, ring - 1)
        part = data[a - back : b]
        up, down = _powers(SLICE + ring)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * down[: len(part)], out=sums[1:])
        ends, sizes, found = [], [], []
        for size in pieces.lengths:
            if size > len(part):
                break
            first = max(0, back + 1 - size)
            h = (sums[first + size :] - sums[first : len(sums) - size]) * up[first + size - 1 : len(part)]
            hit, piece = pieces.find(h)
            ends.append(hit + first + size)
            sizes.append(np.full(len(hit), size))
            found.append(piece)
        end, size, piece = (np.concatenate(x) for x in (ends, sizes, found))
        order = np.argsort(end, kind="stable")
        end, size, piece = end[order], size[order], piece[order]
        lo = np.searchsorted(end, np.arange(back + 1, len(part) + 2))
        for k in range(len(part) - back):
            at, x = a + k + 1, slice(lo[k], lo[k + 1])
            here = (alpha[(at - size[x]) % ring] * probs[piece[x]]).sum(0)
            alpha[at % ring] = here
            if at % 16 == 0:
                scale = np.maximum(here, 1e-300)
                alpha /= scale
                shift += np.log(scale)
    return np.log(np.maximum(alpha[len(data) % ring], 1e-300)) + shift


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], text_col: str = "text", vocab: str | None = None, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns with lang_pred and score (posterior of that language) of every row, in one pass without a shuffle."""
    path = vocab or vocabulary()
    langs, prior, probs = model
    if not langs:
        return docs.select(*carry, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    plain = docs.select(*carry, F.when(has_letter(text_col), F.col(text_col)).alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(probs)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_of: dict[str, int] = {}
        cache, most = max(1, CACHE // len(langs)), max(1, min(BATCH_CHARS, 16 * BATCH_CHARS // len(langs)))
        known = np.zeros((cache, len(langs)))
        for batch in batches:
            column, at = batch.column(batch.num_columns - 1), 0
            while at < len(column):
                texts, chars = [], 0
                while at + len(texts) < len(column) and chars < most:
                    texts.append(column[at + len(texts)].as_py())
                    chars += len(texts[-1] or "")
                split = [t.split() if t is not None else [] for t in texts]
                fresh = list({w for ws in split for w in ws} - row_of.keys())
                if len(row_of) + len(fresh) > len(known):
                    row_of = {}
                    fresh = list({w for ws in split for w in ws})
                    known = np.zeros((max(cache, len(fresh)), len(langs)))
                if fresh:
                    known[len(row_of) : len(row_of) + len(fresh)] = word_scores([b" " + w.encode("utf-8", "surrogatepass") for w in fresh], path, shared.value)
                    row_of.update(zip(fresh, range(len(row_of), len(row_of) + len(fresh)), strict=True))
                best, score = [], []
                for ws in split:
                    if not ws:
                        best.append("und")
                        score.append(0.0)
                        continue
                    total = known[np.fromiter((row_of[w] for w in ws), dtype=np.int64, count=len(ws))].sum(0) + prior
                    k = int(total.argmax())
                    best.append(langs[k])
                    score.append(float(1.0 / np.exp(total - total[k]).sum()))
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(best), pa.array(score)], [*part.schema.names[:-1], "lang_pred", "score"])
                at += len(texts)

    schema = T.StructType([*plain.schema.fields[:-1], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return plain.mapInArrow(predict, schema)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", vocab: str | None = None, sample_per_lang: int = SAMPLE_PER_LANG) -> DataFrame:
    """Learn from the rows that are not held out, predict every row: doc_id, held_out, lang_pred, score."""
    rest = remainder(id_col)
    taught = docs.filter(rest != 2).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    out = identify(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), learn(taught, vocab, sample_per_lang), "text", vocab)
    return out.select("doc_id", F.coalesce(remainder("doc_id") == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
