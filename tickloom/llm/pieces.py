"""SentencePiece encoding and decoding as a relational lattice.

A text is cut into units at places that no piece of the vocabulary spans: before
a run of blanks, and between letters and other characters. Each distinct unit is
encoded once. Its substrings of bounded length are exploded and equi-joined
to the piece table; the matches are the edges of its lattice. Edges are grouped
by unit and folded with ``aggregate``: a bit mask holds the unit's boundaries, and
each step takes out the boundary inside the best edge that spans exactly two
current symbols. That is how a BPE model with scores segments, so the ids are
the library's; a plain Viterbi sum of scores would give others for such a model.

The units that occur most, at most ``HOT_UNITS``, are joined by broadcast, which
spares most occurrences a shuffle; the others are written once and joined by shuffle. Units of
more than ``WIDE`` characters do not fit a mask and are merged by a queue in
Arrow batches.

Defined results: a null or empty text has no pieces; rows without doc_id have no
result; rows that repeat a doc_id are encoded each by its own text; characters outside the vocabulary
become byte pieces; the word-start mark itself counts as a blank; an empty table gives an empty result; only the named columns
are read.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.scratch import cut, sweep

HOT_UNITS = 200_000
#: Hot units are picked on one text in so many; that sets where a unit is looked up, not its ids.
SAMPLE = 16
WIDE = 60
#: Bits of an edge, from the highest: rank of the score, 63 less the start, the end, the mark of late pieces, the id. Better edges are larger numbers, and of equal ones the left one.
_RANK, _START, _END, _LATE_BIT, _ID = 33, 27, 21, 20, (1 << 20) - 1
#: Mark in a mask of boundaries that its unit needs the fold step by step.
ODD = 1 << 62
#: Distinct units whose lattices one task builds, so that sorting their edges stays in memory.
TASK_UNITS = 10_000
#: Largest vocabulary that is broadcast.
MAX_PIECES = 500_000
_UNITS = r" *+[a-zA-Z\p{L}\p{M}]++| *+[^a-zA-Z\p{L}\p{M} ]++| ++"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def late_pieces(pieces: dict[str, tuple[int, float]]) -> set[str]:
    """Pieces that are part of a piece at least as good: only merging one of these can make an edge mergeable that was passed over."""
    return {x for p, (_, score) in pieces.items() for k in range(1, len(p)) for x in (p[:k], p[k:]) if len(x) > 1 and x in pieces and pieces[x][1] <= score}


@lru_cache(maxsize=2)
def load(path: str) -> tuple[dict[str, tuple[int, float]], int, int]:
    """(piece with blanks for word starts -> (id, score), id of byte 0, longest piece). Checks what the operator relies on."""
    import unicodedata

    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, zero = {}, -1
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i):
            zero = i if sp.id_to_piece(i) == "<0x00>" else zero
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            pieces[sp.id_to_piece(i).replace("▁", " ")] = (i, sp.get_score(i))
    letter = lambda c: unicodedata.category(c)[0] in "LM"
    for p in pieces:
        body = p.lstrip(" ")
        if " " in body or len({letter(c) for c in body}) > 1:
            raise ValueError(f"piece {p!r} spans a unit boundary")
    if zero < 0 or len(pieces) > MAX_PIECES:
        raise ValueError("the vocabulary needs byte pieces and a bounded size")
    return pieces, zero, max(map(len, pieces))


def piece_table(spark: SparkSession, path: str) -> DataFrame:
    """(piece, code): what an edge of the piece says beyond its place, packed as rank by score, mark of late pieces, id."""
    pieces, _, _ = load(path)
    late = late_pieces(pieces)
    rank = {score: k for k, score in enumerate(sorted({s for _, s in pieces.values()}))}
    rows = pd.DataFrame([(p, rank[s] << _RANK | (p in late) << _LATE_BIT | i) for p, (i, s) in pieces.items()], columns=["piece", "code"])
    return spark.createDataFrame(rows, "piece string, code long")


def units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, pos, unit) in text order; ``mark`` is the text's xxhash64, which tells rows of one doc_id apart."""
    marked = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text"))
    spaced = F.when(F.length("text") > 0, F.concat(F.lit(" "), F.replace(F.col("text"), F.lit("▁"), F.lit(" "))))
    # inside the generator: a column of its own would be worked out again for the filters that Spark infers
    return marked.select("doc_id", "mark", F.posexplode(F.regexp_extract_all(spaced, F.lit(_UNITS), F.lit(0))).alias("pos", "unit"))


def _by_hash(rows: DataFrame, table: DataFrame, text: str, how: str) -> DataFrame:
    """``rows`` joined with a broadcast ``table`` on equal texts, through their 64-bit hashes, whose table is several times faster.

    Equality is spelt as two comparisons, which keeps the text itself from becoming a key.
    """
    named = table.withColumnRenamed(text, "_t").withColumn("_h", F.xxhash64("_t"))
    same = (F.xxhash64(text) == F.col("_h")) & (F.col(text) <= F.col("_t")) & (F.col(text) >= F.col("_t"))
    return rows.join(F.broadcast(named), same, how).drop("_h", "_t")


def lattice(vocab: DataFrame, path: str) -> DataFrame:
    """(unit, n, edges from the best down) from distinct units of up to WIDE characters, dealt by unit so that grouping needs no shuffle.

    Substrings are some fifty times the units, so the number of tasks follows a count of the units.
    """
    _, _, longest = load(path)
    tasks = vocab.count() // TASK_UNITS + 1
    sub = vocab.select("unit", F.length("unit").alias("n")).repartition(tasks, "unit")
    sub = sub.select("unit", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("s"))
    sub = sub.select("unit", "s", F.explode(F.sequence(F.col("s") + 1, F.least("n", F.col("s") + longest))).alias("e"))
    sub = sub.select("unit", "s", "e", F.substring("unit", F.col("s") + 1, F.col("e") - F.col("s")).alias("piece"))
    single = F.col("e") - F.col("s") == 1
    edges = _by_hash(sub, piece_table(vocab.sparkSession, path), "piece", "left").filter(F.col("code").isNotNull() | single)
    edge = F.col("code").bitwiseOR(F.shiftleft((63 - F.col("s")).cast("long"), _START)).bitwiseOR(F.shiftleft(F.col("e").cast("long"), _END))
    found = edges.groupBy("unit").agg(F.collect_list(edge).alias("packed"))
    unpacked = f"""transform(sort_array(packed, false), x -> transform(array(struct(63 - int(shiftright(x, {_START}) & 63L) AS s, int(shiftright(x, {_END}) & 63L) AS e)),
      y -> struct(y.s AS s, y.e AS e, int(x & {_ID}L) AS id, shiftright(x, {_RANK}) AS rank, shiftleft(1L, y.s) | shiftleft(1L, y.e) AS ends, shiftleft(1L, y.e) - shiftleft(1L, y.s + 1) AS inner, shiftright(x, {_LATE_BIT}) & 1L AS late))[0])"""
    return found.select("unit", F.expr(unpacked).alias("edges"), F.length("unit").alias("n"))


def _spans(x: str, m: str, symbols: int) -> str:
    """SQL: edge ``x`` spans so many current symbols of mask ``m``."""
    return f"({m} & {x}.ends) = {x}.ends AND bit_count({m} & {x}.inner) = {symbols - 1}"


_FULL = "(shiftleft(1L, n + 1) - 1L)"
#: The best mergeable edge again and again; as many steps as there can be merges.
_STEPS = f"""aggregate(sequence(2, n), {_FULL},
  (m, k) -> transform(array(get(filter(edges, x -> {_spans("x", "m", 2)}), 0)), x -> CASE WHEN x IS NULL THEN m ELSE m & ~x.inner END)[0])"""
_LATE = f"CASE WHEN x.late > 0L AND exists(edges, y -> y.inner > 0L AND y.rank >= x.rank AND {_spans('y', '(m & ~x.inner)', 2)}) THEN {ODD}L ELSE 0L END"
#: One pass over the edges from the best down. It is the same unless a merge makes a better edge mergeable, which marks the mask.
_PASS = f"aggregate(edges, {_FULL}, (m, x) -> CASE WHEN {_spans('x', 'm', 2)} THEN (m & ~x.inner) | {_LATE} ELSE m END)"
_FOLD = f"transform(array({_PASS}), r -> CASE WHEN (r & {ODD}L) > 0L THEN {_STEPS} ELSE r END)[0]"


def _ids(zero: int) -> str:
    """SQL from the final mask to ids in order: edges that span one symbol, and the bytes of characters without an edge."""
    bytes_ = f"transform(sequence(1, length(h) div 2), j -> int(conv(substring(h, 2 * j - 1, 2), 16, 10)) + {zero})"
    spelled = f"transform(array(hex(encode(substring(unit, b[k] + 1, b[k + 1] - b[k]), 'UTF-8'))), h -> {bytes_})[0]"
    each = f"flatten(transform(sequence(0, size(b) - 2), k -> transform(array(filter(f, x -> x.s = b[k])), g -> CASE WHEN size(g) > 0 THEN array(g[0].id) ELSE {spelled} END)[0]))"
    bounds = "filter(sequence(0, n), i -> (shiftright(mask, i) & 1L) = 1L)"
    plain = "transform(array_sort(transform(f, x -> struct(x.s AS s, x.id AS id))), x -> x.id)"
    covered = "aggregate(f, 0, (c, x) -> c + x.e - x.s) = n"
    final = f"filter(edges, x -> {_spans('x', 'mask', 1)})"
    return f"transform(array({final}), f -> CASE WHEN {covered} THEN {plain} ELSE transform(array({bounds}), b -> {each})[0] END)[0]"


def fold(edges: DataFrame, path: str) -> DataFrame:
    """(unit, ids) from lattices. Masks and lists are bound by lambdas, so that each is worked out once."""
    _, zero, _ = load(path)
    return edges.select("unit", F.expr(f"transform(array({_FOLD}), mask -> {_ids(zero)})[0]").alias("ids"))


def merge(unit: str, pieces: dict[str, tuple[int, float]], zero: int) -> list[int]:
    """Ids of one unit of any length, by a queue of mergeable neighbours."""
    text = list(unit)
    after, before = list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
    queue: list = []

    def offer(i: int) -> None:
        j = after[i] if i >= 0 else len(text)
        if 0 <= i and j < len(text) and (hit := pieces.get(text[i] + text[j])):
            heapq.heappush(queue, (-hit[1], i, text[i], text[j]))

    for i in range(len(text)):
        offer(i)
    while queue:
        _, i, a, b = heapq.heappop(queue)
        if text[i] != a or after[i] >= len(text) or text[after[i]] != b:
            continue
        j = after[i]
        text[i], text[j] = a + b, ""
        after[i] = after[j]
        if after[j] < len(text):
            before[after[j]] = i
        offer(i)
        offer(before[i])
    return [x for t in text if t for x in ([pieces[t][0]] if t in pieces else [c + zero for c in t.encode("utf-8", "surrogatepass")])]


def encode_units(vocab: DataFrame, path: str) -> DataFrame:
    """(unit, ids) of distinct units."""
    size = F.length("unit")
    short = vocab.filter(size <= WIDE)
    whole = fold(lattice(short, path), path)

    @F.pandas_udf("array<int>")
    def long_ids(found: pd.Series) -> pd.Series:
        pieces, zero, _ = load(path)
        return found.map(lambda u: merge(u, pieces, zero))

    return whole.unionByName(vocab.filter(size > WIDE).select("unit", long_ids("unit").alias("ids")))


def encode_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str | None = None, hot_units: int = HOT_UNITS) -> DataFrame:
    """The encoding as a relation: (doc_id, mark, pos, ids), one row per unit of each text."""
    path = vocab or vocabulary()
    rows = units(docs, id_col, text_col)
    some = units(docs.filter(F.pmod(F.xxhash64(F.lit("hot"), text_col), F.lit(SAMPLE)) == 0), id_col, text_col)
    counts = cut(some.groupBy("unit").agg(F.count(F.lit(1)).alias("n")), "units")
    hot = cut(encode_units(counts.filter(F.col("n") >= _least_count(counts, hot_units)).select("unit"), path), "hot")
    sweep(docs.sparkSession)
    common = _by_hash(rows, hot, "unit", "inner").select("doc_id", "mark", "pos", "ids")
    rare = cut(_by_hash(rows, hot.select("unit"), "unit", "left_anti"), "rare")
    sweep(docs.sparkSession)
    told = cut(encode_units(rare.select("unit").distinct(), path), "told")
    sweep(docs.sparkSession)
    return common.unionByName(rare.join(told, "unit").select("doc_id", "mark", "pos", "ids"))


def _least_count(counts: DataFrame, most: int) -> int:
    """Smallest count such that at most ``most`` units reach it, from a histogram over powers of sqrt 2."""
    step = F.ceil(2 * F.log2("n")).cast("int")
    total, level = 0, None
    for r in counts.groupBy(step.alias("k")).count().orderBy(F.desc("k")).collect():
        if total + r["count"] > most:
            break
        total, level = total + r["count"], r["k"]
    return 2**62 if level is None else int(2 ** ((level - 1) / 2)) + 1


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: str | None = None) -> DataFrame:
    """(doc_id, ids): the ids of every row with a doc_id, null and empty texts with none."""
    rows = encode_rows(docs, id_col, text_col, vocab).withColumnsRenamed({"doc_id": "_id", "mark": "_mark"})
    parts = F.array_sort(F.array_distinct(F.collect_list(F.struct("pos", "ids"))))
    whole = rows.groupBy("_id", "_mark").agg(F.flatten(F.transform(parts, lambda r: r["ids"])).alias("ids"))
    all_ = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("mark"))
    met = all_.join(whole, (F.col("doc_id") == F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
    return met.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocab: str | None = None) -> DataFrame:
    """(doc_id, text) of every row: pieces looked up by id and joined in order; the first blank is the one encoding put there."""
    path = vocab or vocabulary()
    pieces, zero, _ = load(path)
    known = [(i, p.encode()) for p, (i, _) in pieces.items()] + [(zero + b, bytes([b])) for b in range(256)]
    table = encoded.sparkSession.createDataFrame(pd.DataFrame(known, columns=["id", "bytes"]), "id int, bytes binary")
    named = encoded.select(F.col(id_col).alias("doc_id"), F.xxhash64(ids_col).alias("mark"), F.col(ids_col).alias("ids"))
    rows = named.select(F.xxhash64("doc_id", "mark").alias("_row"), F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.posexplode("ids").alias("pos", "id"))
    met = rows.join(F.broadcast(table), "id").groupBy("_row", "_id", "_mark").agg(F.array_sort(F.array_distinct(F.collect_list(F.struct("pos", "bytes")))).alias("p"))
    joined = F.expr("unhex(array_join(transform(p, x -> hex(x.bytes)), ''))")
    told = met.select("_id", "_mark", F.substring(F.decode(joined, "UTF-8"), 2, 2**31 - 1).alias("text"))
    back = named.join(told, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
    return back.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
