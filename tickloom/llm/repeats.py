"""Removal of long repeated byte strings, keeping the first copy, by longest previous factors.

The longest previous factor of a position is the longest string that starts there and also starts earlier. In suffix
order it is found beside the position: it is the larger of the common prefixes with the previous smaller and the next
smaller position. Bytes covered by a factor of at least ``WIDTH`` go, so suffixes are cut to WIDTH bytes
and only positions that can have such a factor are ordered:

1. Documents stand in blocks of consecutive doc_id, cut by bytes from a range-partitioned table. Each window of WIDTH
   bytes is assigned its leftmost minimal k-gram; consecutive windows with the same one form a segment. Equal windows have
   equal k-grams, so the suffixes of one k-gram are a candidate set, and only there can a factor reach WIDTH.
2. Each block sends one entry per k-gram, with the segment's fingerprint. Where all segments of a k-gram are equal the
   first stays and later ones are covered whole; k-grams that occur once need nothing.
3. Where a k-gram has different segments, their bytes go to its bucket. There the cut suffixes of all blocks are sorted, neighbours
   give common prefixes, pointer jumping gives previous and next smaller positions, and both give the longest previous
   factors. A k-gram of more than ``HOT`` segments is spread: its blocks order its suffixes by themselves
   and send those without an earlier copy one by one, dealt out by their own hash.

Defined results: a null text counts as empty; rows that repeat a doc_id are separate documents in an order that their texts'
hashes set; null doc_ids come first; both are spread over blocks like any others; texts shorter than WIDTH lose nothing; an
empty table gives an empty result; only the named columns are read. Texts of any length are worked on in slices.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.scratch import cut, sweep
from tickloom.llm.shingles import _powers, mix

WIDTH = 100
GRAM = 48
#: Bytes of text in a block, and bytes of text whose entries make a bucket, about.
BLOCK_BYTES, BUCKET_BYTES = 8_000_000, 24_000_000
#: Segments of a k-gram above which its suffixes are dealt out by their own hash.
HOT = 50_000
#: Windows ordered at once, which bounds a worker's arrays.
SORTED = 400_000
SLICE = 1 << 19
COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "rest"]
#: Ids travel as text, which pandas keeps exact beside nulls.
OUT = "doc_id string, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, rest string"


class Block:
    """Documents of a block in order, as one buffer with a zero byte after each. Places in it have 32 bits."""

    def __init__(self, payload: bytes):
        table = pa.ipc.open_stream(payload).read_all().to_pydict()
        self.ids = [None if i is None else str(i) for i in table["doc_id"]]
        self.rest = [r or "" for r in table["rest"]]
        data = [(t or "").encode("utf-8", "surrogatepass") for t in table["text"]]
        self.sizes = np.array([len(d) for d in data], dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes + 1)))
        self.raw = b"\0".join(data) + b"\0"
        self.buf = np.frombuffer(self.raw, dtype=np.uint8)

    def _hashed(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Prefix sums for windows a..b-1 and the inverse powers they go with."""
        part = self.buf[a : b + WIDTH - 1]
        up, down = _powers(1 << 20)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
        return sums, down

    def _grams(self, sums: np.ndarray, down: np.ndarray) -> np.ndarray:
        return mix((sums[GRAM:] - sums[:-GRAM]) * down[: len(sums) - GRAM])

    def segments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, windows, gram hash, content hash) of each segment, in text order."""
        found = [[], [], [], []]
        total = len(self.buf) - WIDTH + 1
        ends = self.starts[1:] - 1  # places of the zero bytes
        for a in range(0, total, SLICE):
            b = min(a + SLICE, total)
            m = b - a
            sums, down = self._hashed(a, b)
            least = grams = self._grams(sums, down)
            at = np.zeros(len(grams), dtype=np.uint8)
            span = 1
            want = WIDTH - GRAM + 1
            while span < want:
                d = min(span, want - span)
                take = least[d:] < least[:-d]
                least, at = np.where(take, least[d:], least[:-d]), np.where(take, at[d:] + np.uint8(d), at[:-d])
                span += d
            place = np.arange(m) + at
            near = ends[np.searchsorted(ends, a) : np.searchsorted(ends, b + WIDTH - 1)] - a
            bad = np.zeros(m + 1, dtype=np.int32)
            np.add.at(bad, np.clip(near - WIDTH + 1, 0, m), 1)
            np.add.at(bad, np.clip(near + 1, 0, m), -1)
            valid = np.cumsum(bad[:m]) == 0
            turn = np.concatenate(([True], place[1:] != place[:-1], [True]))
            first = np.flatnonzero(valid & (turn[:m] | ~np.concatenate(([False], valid[:-1]))))
            last = np.flatnonzero(valid & (turn[1:] | ~np.concatenate((valid[1:], [False]))))
            found[0].append(first + a)
            found[1].append(last - first + 1)
            found[2].append(grams[place[first]])
            found[3].append(mix((sums[last + WIDTH] - sums[first]) * down[first] + (last - first).astype(np.uint64)) | np.uint64(1))
        if not found[0]:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        return tuple(np.concatenate(x) for x in found)

    def cut(self, start: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The bytes that the windows of the given segments span, one segment after the other."""
        size = count + WIDTH - 1
        at = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
        return self.buf[at]


def longest_previous(pos: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Longest previous factors of positions ``pos`` in suffix order; ``lcp[i]`` is the common prefix of the suffixes i - 1 and i.

    Links start at the neighbour and jump over larger positions to where those link, taking the least common prefix
    on the way, until they stand on the previous (then the next) smaller position.
    """
    n, best = len(pos), np.zeros(len(pos), dtype=lcp.dtype)
    for turn in (1, -1):
        p = pos[::turn]
        link = np.arange(n) - 1
        common = lcp.copy() if turn == 1 else np.append(lcp.dtype.type(0), lcp[:0:-1])[:n]
        todo = np.flatnonzero(link >= 0)
        todo = todo[p[link[todo]] > p[todo]]
        while len(todo):
            over = link[todo]
            common[todo], link[todo] = np.minimum(common[todo], common[over]), link[over]
            todo = todo[link[todo] >= 0]
            todo = todo[p[link[todo]] > p[todo]]
        common[link < 0] = 0
        best = np.maximum(best, common[::turn])
    return best


def _orders(windows: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Whether each window (a row of WIDTH bytes, the suffix cut there) has a longest previous factor of WIDTH."""
    order = np.argsort(np.ascontiguousarray(windows).view(f"S{WIDTH}").ravel(), kind="stable")
    rows = windows[order]
    lcp = np.zeros(len(order), dtype=np.uint8)
    if len(order) > 1:
        differ = rows[1:] != rows[:-1]
        lcp[1:] = np.where(differ.any(1), differ.argmax(1), WIDTH)
    covered = np.zeros(len(order), dtype=bool)
    covered[order] = longest_previous(pos[order], lcp) >= WIDTH
    return covered


def covered_windows(text: np.ndarray, start: np.ndarray, count: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Whether each window of the segments (``count`` windows from ``start`` in ``text``) has an earlier copy, in the order of ``pos``.

    Windows are ordered in parts that a hash of their ends sets: equal ones stand in one part.
    """
    at = np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())
    out = np.zeros(len(at), dtype=bool)
    if not len(at):
        return out
    word = np.lib.stride_tricks.sliding_window_view(text, 8)
    ends = np.ascontiguousarray(word[at]).view(np.uint64).ravel() * np.uint64(0x9E3779B97F4A7C15) + np.ascontiguousarray(word[at + WIDTH - 8]).view(np.uint64).ravel()
    part = mix(ends) % np.uint64(-(-len(at) // SORTED))
    view = np.lib.stride_tricks.sliding_window_view(text, WIDTH)
    by = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[by], np.arange(int(part.max()) + 2, dtype=np.uint64))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        mine = by[a:b]
        out[mine] = _orders(view[at[mine]], pos[mine])
    return out


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


def _by_gram(h: np.ndarray, c: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
    """Entries of a block in order of bucket and k-gram: (bucket, h, c or 0 where contents differ, different segments), then per segment its entry and whether an equal segment stands before it."""
    order = np.lexsort((np.arange(len(h)), c, h))
    hs, cs = h[order], c[order]
    new_h = np.concatenate(([True], hs[1:] != hs[:-1])) if len(hs) else np.zeros(0, bool)
    repeat = np.concatenate(([False], (hs[1:] == hs[:-1]) & (cs[1:] == cs[:-1]))) if len(hs) else np.zeros(0, bool)
    entry = np.cumsum(new_h) - 1
    heads = np.flatnonzero(new_h)
    kinds = np.add.reduceat((~repeat).astype(np.int64), heads) if len(heads) else np.zeros(0, np.int64)
    eh, ec = hs[heads], np.where(kinds > 1, np.uint64(0), cs[heads])
    bucket = _bucket(eh, buckets)
    rank = np.argsort(bucket, kind="stable")
    place = np.empty(len(rank), dtype=np.int64)
    place[rank] = np.arange(len(rank))
    seg_entry, seg_repeat = np.empty(len(h), np.int64), np.empty(len(h), bool)
    seg_entry[order], seg_repeat[order] = place[entry], repeat
    return bucket[rank], eh[rank], ec[rank], kinds[rank], seg_entry, seg_repeat


def _cuts(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    if len(bucket):
        heads = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        for a, b in zip(heads, np.append(heads[1:], len(bucket)), strict=True):
            yield int(bucket[a]), int(a), int(b)


def _blobs(pdf: pd.DataFrame, kinds: tuple[str, ...]) -> tuple[list[np.ndarray], np.ndarray, pd.DataFrame]:
    """Rows in order of block, the columns of their blobs joined, and the row that each entry is from."""
    pdf = pdf.sort_values("block", kind="stable").reset_index(drop=True)
    parts = [_columns(x, kinds) for x in pdf["blob"]]
    return [np.concatenate(c) for c in zip(*parts, strict=True)], np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts]), pdf


def _columns(blob: bytes, kinds: tuple[str, ...]) -> list[np.ndarray]:
    n, out, at = len(blob) // sum(int(k[1:]) for k in kinds), [], 0
    for k in kinds:
        out.append(np.frombuffer(blob, dtype=k, count=n, offset=at))
        at += n * int(k[1:])
    return out


def _blob(kinds: tuple[str, ...], *columns: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(c).astype(k).tobytes() for k, c in zip(kinds, columns, strict=True))


def _union(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of spans that overlap or touch."""
    if not len(lo):
        return lo, hi
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.flatnonzero(np.concatenate(([True], lo[1:] > hi[:-1])))
    return lo[new], hi[np.append(new[1:], len(hi)) - 1]


#: k-gram (its bucket holds further bits), content and different segments; place and windows of a segment; span.
ENTRY, SEGMENT, SPAN = ("u4", "u8", "u4"), ("u4", "u4"), ("u4", "u4")
#: What a bucket says of an entry: nothing repeats; an equal segment stands in an earlier block; segments differ; they do, and are many.
ONCE, WHOLE, DIFFER, MANY = range(4)


def _send(buckets: int):
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for key, payload in zip(pdf["block"], pdf["payload"], strict=True):
                _, _, h, c = Block(payload).segments()
                bucket, eh, ec, kinds, _, _ = _by_gram(h, c, buckets)
                rows = [(p, key, _blob(ENTRY, eh[a:b] >> np.uint64(32), ec[a:b], kinds[a:b])) for p, a, b in _cuts(bucket)]
                yield pd.DataFrame(rows, columns=["bucket", "block", "blob"])

    return send


def _judge(hot: int):
    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        (h, c, kinds), row, pdf = _blobs(pdf, ENTRY)
        order = np.lexsort((np.arange(len(h)), h))
        hs, cs = h[order], c[order]
        new = np.concatenate(([True], hs[1:] != hs[:-1]))
        heads, group = np.flatnonzero(new), np.cumsum(new) - 1
        differ = (np.minimum.reduceat(cs, heads) != np.maximum.reduceat(cs, heads)) | (np.minimum.reduceat(cs, heads) == 0)
        many = np.add.reduceat(kinds[order].astype(np.int64), heads) > hot
        code = np.zeros(len(h), dtype=np.uint8)
        code[order] = np.where(differ[group], np.where(many[group], MANY, DIFFER), np.where(new, ONCE, WHOLE))
        ends = np.cumsum(np.bincount(row, minlength=len(pdf)))
        return pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"], "codes": [code[a:b].tobytes() for a, b in zip(np.concatenate(([0], ends[:-1])), ends, strict=True)]})

    return judge


def _resolve(buckets: int):
    """A block's covered spans (kind 0, key is the block) and the segments that other blocks may share windows with (kind 1, key is the bucket)."""

    def resolve(key: tuple, pdf: pd.DataFrame, codes: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf) or not len(codes):
            return pd.DataFrame({"kind": [], "key": [], "block": [], "blob": [], "text": []})
        block = Block(pdf["payload"].iat[0])
        start, count, h, c = block.segments()
        *_, entry, repeat = _by_gram(h, c, buckets)
        code = np.frombuffer(b"".join(codes.sort_values("bucket")["codes"]), dtype=np.uint8)[entry]
        whole = repeat | (code == WHOLE)
        spans = [np.stack((start[whole], start[whole] + count[whole] + WIDTH - 1))]
        open_ = (code == DIFFER) & ~repeat
        place, size, home = start[open_], count[open_], _bucket(h[open_], buckets)
        many = (code == MANY) & ~repeat
        if many.any():
            at = np.repeat(start[many] - np.cumsum(count[many]) + count[many], count[many]) + np.arange(count[many].sum())
            again = covered_windows(block.buf, start[many], count[many], at)
            spans.append(np.stack((at[again], at[again] + WIDTH)))
            one = at[~again]
            ends = np.lib.stride_tricks.sliding_window_view(block.buf, WIDTH)[one]
            own = mix(np.frombuffer(ends.tobytes(), dtype=np.uint32).reshape(len(one), WIDTH // 4).astype(np.uint64) @ _ODD)
            place, size, home = np.concatenate((place, one)), np.concatenate((size, np.ones(len(one), np.int64))), np.concatenate((home, _bucket(own, buckets)))
        rank = np.argsort(home, kind="stable")
        place, size = place[rank], size[rank]
        rows = [(0, key[0], key[0], _blob(SPAN, *_union(*np.concatenate(spans, axis=1))), b"")]
        rows += [(1, p, key[0], _blob(SEGMENT, place[x:y], size[x:y]), block.cut(place[x:y], size[x:y]).tobytes()) for p, x, y in _cuts(home[rank])]
        return pd.DataFrame(rows, columns=["kind", "key", "block", "blob", "text"])

    return resolve


#: Odd multipliers of a window's 25 words of four bytes.
_ODD = mix(np.arange(1, WIDTH // 4 + 1, dtype=np.uint64)) | np.uint64(1)


def _meet(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Spans of windows whose longest previous factor reaches WIDTH. Spans of kind 0 pass."""
    if key[0] == 0:
        return pdf[["block", "blob"]]
    (place, size), row, pdf = _blobs(pdf, SEGMENT)
    size = size.astype(np.int64)
    text = np.frombuffer(b"".join(pdf["text"]), dtype=np.uint8)
    length = size + WIDTH - 1
    first = np.cumsum(length) - length
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    at = np.repeat(place.astype(np.int64), size) + inside
    home = np.repeat(row, size)
    covered = covered_windows(text, first, size, home << np.int64(32) | at)
    rows = []
    for r in np.unique(home[covered]):
        mine = at[covered & (home == r)]
        rows.append((pdf["block"].iat[r], _blob(SPAN, *_union(mine, mine + WIDTH))))
    return pd.DataFrame(rows, columns=["block", "blob"])


def _remove(key: tuple, pdf: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
    if not len(pdf):
        return pd.DataFrame(columns=COLUMNS)
    block = Block(pdf["payload"].iat[0])
    parts = [_columns(x, SPAN) for x in spans["blob"]] or [[np.zeros(0, np.uint32)] * 2]
    lo, hi = _union(*(np.concatenate(c).astype(np.int64) for c in zip(*parts, strict=True)))
    first = np.searchsorted(lo, block.starts[:-1])
    upto = np.searchsorted(lo, block.starts[1:])
    rows = []
    for k, doc in enumerate(block.ids):
        at, end, out, gone = int(block.starts[k]), int(block.starts[k] + block.sizes[k]), [], 0
        for s, e in zip(lo[first[k] : upto[k]].tolist(), hi[first[k] : upto[k]].tolist(), strict=True):
            out.append(block.raw[at:s])
            gone += e - s
            at = e
        out.append(block.raw[at:end])
        rows.append((doc, int(block.sizes[k]), gone, int(upto[k] - first[k]), b"".join(out), block.rest[k]))
    return pd.DataFrame(rows, columns=COLUMNS)


def _hashed(key: tuple, pdf: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
    out = _remove(key, pdf, spans)
    return out.drop(columns=["kept", "rest"]).assign(kept_sha256=[hashlib.sha256(x).hexdigest() for x in out["kept"]])


def _texted(key: tuple, pdf: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
    out = _remove(key, pdf, spans)
    return out.assign(kept=[x.decode("utf-8", "ignore") for x in out["kept"]]).rename(columns={"kept": "text"})


def in_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row (block, payload) per block, from (doc_id, text, rest), stored.

    Rows are range-partitioned and sorted by doc_id and the hash of the text, so rows without an id or of one id spread like
    others, and each partition is cut into blocks of about ``block_bytes``; blocks are numbered in order. A payload is
    an Arrow stream, compressed, since texts cross the network once for each pass.
    """
    keyed = docs.withColumn("mark", F.xxhash64("text"))
    dealt = keyed.repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark").select("doc_id", "text", "rest")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        options = pa.ipc.IpcWriteOptions(compression="zstd")
        block, held, size = TaskContext.get().partitionId() << 32, [], 0

        def close() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema, options=options) as out:
                for part in held:
                    out.write_batch(part)
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "payload"])

        for batch in batches:
            ends = size + np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            at = 0
            while at < len(ends):
                upto = min(len(ends), int(np.searchsorted(ends, block_bytes)) + 1)
                held.append(batch.slice(at, upto - at))
                size = int(ends[upto - 1])
                if size >= block_bytes:
                    yield close()
                    block, held, ends, size = block + 1, [], ends - size, 0
                at = upto
        if held:
            yield close()

    return cut(dealt.mapInArrow(deal, "block bigint, payload binary"), "blocks")


def _spans(docs: DataFrame, block_bytes: int, hot: int) -> tuple[DataFrame, DataFrame]:
    """Blocks and their covered spans. One plan joins the blocks twice, so that their exchange is written once."""
    blocks = in_blocks(docs, block_bytes)
    sweep(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // max(BUCKET_BYTES, 3 * block_bytes)))
    sent = blocks.mapInPandas(_send(buckets), "bucket bigint, block bigint, blob binary")
    codes = sent.groupBy("bucket").applyInPandas(_judge(hot), "block bigint, bucket bigint, codes binary")
    found = blocks.groupBy("block").cogroup(codes.groupBy("block")).applyInPandas(_resolve(buckets), "kind int, key bigint, block bigint, blob binary, text binary")
    return blocks, found.groupBy("kind", "key").applyInPandas(_meet, "block bigint, blob binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, hot: int = HOT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept, the remaining bytes."""
    return _removed(docs, id_col, text_col, block_bytes, _remove, OUT, hot=hot).drop("rest")


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text and the ``carry`` columns; the text is what remains, without characters that a removed run cuts."""
    rest = F.to_json(F.struct(*carry)) if carry else None
    out = _removed(docs, id_col, text_col, block_bytes, _texted, OUT.replace("kept binary", "text string"), rest)
    if not carry:
        return out.select("doc_id", "text")
    return out.withColumn("rest", F.from_json("rest", docs.select(*carry).schema)).select("doc_id", "text", "rest.*")


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """As :func:`remove_repeats`, with the SHA-256 of the remaining bytes in their place."""
    return _removed(docs, id_col, text_col, block_bytes, _hashed, OUT.replace("kept binary, rest string", "kept_sha256 string"))


def _removed(docs: DataFrame, id_col: str, text_col: str, block_bytes: int, last, schema: str, rest=None, hot: int = HOT) -> DataFrame:
    rest = F.lit(None).cast("string") if rest is None else rest
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), rest.alias("rest"))
    blocks, spans = _spans(plain, block_bytes, hot)
    out = blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInPandas(last, schema)
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
