"""Line deduplication by a segment-partition edit join.

A line is removed when an equal line, or one within ``edits`` edits, stands earlier in
the corpus (smaller doc_id, or earlier in the same document). Each is judged
on the input, not on what is left. Lines with fewer than ``min_chars``
characters stay as they are.

Equal lines meet by fingerprint and only their first occurrence goes on. With a
threshold of k edits a line splits into k + 1 segments, and a line within k edits
holds one of them unchanged. The substring index has the segments of every line;
a line probes the index of its own length and of the next k shorter ones, with the
substrings whose place leaves enough edits on either side (26 for k = 3). A pair that
shares a key is verified with a banded bit-parallel automaton: one word holds, for
0 to k edits, which of the 2k + 1 diagonals a prefix can reach, and every character
moves all of them at once. Pairs whose slices already tell them apart are spared that.

A key that more than ``CROWD`` lines hold as a segment is crowded. Its lines meet the eldest of them, which settles
crowds of near copies. Lines that no one has removed by then, and those older than the youngest of them, are compared
with each other where they are at most ``PRODUCT``, by two parity words and by hashes of slices, which rule out most pairs before texts are read; only
pairs within the threshold leave that join. More go to another round among themselves, with more segments: any k + 1 segments of a line serve, so each indexes its k + 1 rarest,
which lie where it differs from the crowd. After the last of ``ROUNDS`` what is still crowded (lines alike in all but a few of
``ROUNDS[-1]`` segments) is compared line by line. All of that is exact.

Keys travel as two numbers, texts only for lines that share one. Joins deal both sides out by their key; hash tables hold
a partition of the narrow side (keys, ids or line numbers), so that no plan depends on a side that grows with
the data being small. All steps are DataFrame functions. Defined results: a null
text keeps null and has no lines; rows with a null doc_id pass unchanged; rows that
repeat a doc_id are documents of their own, in an order that their texts' hashes
set, and rows that repeat the text as well lose the same lines; a text may lose all
of its lines and is then empty; an empty table gives an empty result. Other columns
are carried along unread, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.scratch import cut, release, sweep

MIN_CHARS = 20
#: Edits that the operator allows by default, those that the registered query and the pipeline ask for, and the most that the verifier's word holds.
EDITS = 1
CORPUS_EDITS = 3
MAX_EDITS = 3
#: A key of more lines is crowded: its lines meet the eldest of them, and then, where that does not settle them, by rarer segments.
CROWD = 4
#: Segments in each round (at least edits + 1, and no shorter than FINEST characters); what is still crowded after the last is compared line by line.
ROUNDS, FINEST = (1, 16), 6
#: Crowds of up to so many lines are compared pair by pair, on two numbers a line first; larger ones go to the next round.
PRODUCT = 4096
#: Parity words of a line, which later rounds carry beside its keys.
MARKS = ("one", "two")
#: Slices, the fewest and the most, whose hashes tell most pairs of a crowd apart that the parity words let pass.
SLICES = (8, 64)


def _places(edits: int, segments: int) -> list[tuple[int, int, int]]:
    """(segment, excess, shift): where a line looks for a segment of a line ``excess`` characters shorter.

    A shift is kept when the edits left of the segment and those right of it can both be afforded. With no more segments than
    edits + 1 one can be found that has at most as many edits on its left as segments, and on its right likewise.
    """
    out = []
    for d in range(edits + 1):
        for i in range(max(segments, edits + 1)):
            left, right = (i, edits - i) if segments <= edits + 1 else (edits, edits)
            shifts = range(max(-left, d - right), min(left, d + right) + 1)
            out += [(i, d, s) for s in shifts if abs(s) + abs(d - s) <= edits]
    return out


def within(a: str, b: str, edits: int) -> str:
    """SQL: the strings ``a`` and ``b`` are at most ``edits`` edits apart, by a banded automaton in one 64-bit word.

    Lane e of the word holds diagonals -k to k: bit i of it says that the prefix of ``b`` that is i - k characters longer
    than what is read of ``a`` is within e edits of that. A character keeps the diagonals where it matches, and moves lane e
    to lane e + 1 for a substitution, an insertion (a diagonal down) or a deletion (a diagonal up, at once for several). What both
    strings begin and end with, found by halving, changes no distance and is left out.
    """
    if not 0 <= edits <= MAX_EDITS:
        raise ValueError(f"edits must lie between 0 and {MAX_EDITS}")
    k = edits
    lane, width = 3 * k + 1, 2 * k + 1
    all_ = sum(((1 << width) - 1) << (e * lane) for e in range(k + 1))
    start = sum(1 << (e * lane + k + d) for e in range(k + 1) for d in range(e + 1))
    every = sum(1 << (e * lane) for e in range(k + 1))
    same = " + ".join(f"if(get(z.b, j + {i - k}) = z.a[j], {1 << i}L, 0L)" for i in range(width))
    moved = f"(s & (({same}) * {every}L)) | (shiftleft(s, {lane}) & {all_}L) | (shiftleft(shiftright(s, 1), {lane}) & {all_}L)"
    step = lambda x, n: f"(shiftleft({x}, {n * (lane + 1)}) & {all_}L)"
    one = f"(x | {step('x', 1)})"
    closed = f"transform(array({moved}), x -> {one} | {step(one, 2)})[0]"
    last = f"aggregate(sequence(0, size(z.a) - 1), {start}L, (s, j) -> CASE WHEN s = 0L THEN s ELSE {closed} END)"
    end = f"shiftright({last}, {k * lane + k} + size(z.b) - size(z.a)) & 1L"
    shared = lambda x, y, side, most: f"aggregate(transform(sequence(int(log2({most} + 1)), 0), i -> shiftleft(1, i)), 0, (p, w) -> CASE WHEN p + w <= {most} AND {side}({x}, p + w) = {side}({y}, p + w) THEN p + w ELSE p END)"
    front = f"transform(array({shared(a, b, 'left', f'least(length({a}), length({b}))')}), p -> struct(substring({a}, p + 1, length({a})) AS a, substring({b}, p + 1, length({b})) AS b))[0]"
    back = f"transform(array({front}), y -> transform(array({shared('y.a', 'y.b', 'right', 'least(length(y.a), length(y.b))')}), q -> struct(left(y.a, length(y.a) - q) AS a, left(y.b, length(y.b) - q) AS b))[0])[0]"
    ends = f"CASE WHEN length(y.a) = 0 OR length(y.b) = 0 THEN 1L ELSE transform(array(struct(split(y.a, '') AS a, split(y.b, '') AS b)), z -> {end})[0] END"
    return f"(abs(length({a}) - length({b})) <= {k} AND transform(array({back}), y -> {ends})[0] = 1L)"


def maybe_within(a: str, b: str, edits: int) -> str:
    """SQL that is true of all pairs within ``edits``: an edit changes at most one of 2 (edits + 1) slices of ``a``, the others stand in ``b``."""
    n = 2 * (edits + 1)
    cut_ = lambda i: f"substring({a}, {i} * (length({a}) div {n}) + 1, length({a}) div {n})"
    return f"({' + '.join(f'int(contains({b}, {cut_(i)}))' for i in range(n))}) >= {n - edits}"


def distinct_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """From (doc_id, mark, text): one row per distinct line, with the first place ``at`` (doc_id, mark, line_no) it has."""
    lines = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "mark", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.filter(F.length("line") >= max(1, min_chars))
    marked = lines.select(F.struct("doc_id", "mark", "line_no").alias("at"), F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("again"), "line").alias("h2"), "line")
    return marked.groupBy("h1", "h2").agg(F.min("at").alias("at"), F.first("line").alias("line")).select("at", "line")


def _keys(items: DataFrame, places: list[tuple[int, int, int]], edits: int, segments: int) -> DataFrame:
    """(key, id, age): the substrings of each item's line at the places. Keys hold the indexed length and the segment.

    Lines of one byte a character are cut without counting characters.
    """
    at = F.explode(F.array(*[F.struct(*[F.lit(x).alias(c) for x, c in zip(p, "ids", strict=True)]) for p in places]))
    rows = items.withColumns({"size": F.length("line"), "bytes": F.col("line").cast("binary")}).withColumn("p", at)
    i, short = F.col("p.i"), F.col("size") - F.col("p.d")
    n = F.lit(edits + 1)
    if segments > edits + 1:
        n = F.greatest(n, F.least(F.lit(segments), F.floor(short / FINEST).cast("int")))
    base, more = F.floor(short / n).cast("int"), short % n
    width = base + (i >= n - more).cast("int")
    start = i * base + F.greatest(i - (n - more), F.lit(0)) + F.col("p.s")
    held = rows.filter((short >= 0) & (i < n) & (start >= 0) & (start + width <= F.col("size")))
    part = F.when(F.octet_length("bytes") == F.col("size"), F.substring("bytes", start + 1, width)).otherwise(F.substring("line", start + 1, width).cast("binary"))
    return held.select(F.xxhash64(i, short, part).alias("key"), "id", "age", *[c for c in MARKS if c in items.columns])


def _parities(lines: DataFrame) -> DataFrame:
    """Adds two words a line that tell most pairs apart: the parities of how often its characters (``one``) and its pairs of
    neighbouring characters (``two``) occur, in 64 classes each."""
    one = "aggregate(c, 0L, (s, x) -> s ^ shiftleft(1L, ascii(x) & 63))"
    two = "aggregate(sequence(0, size(c) - 1), 0L, (s, i) -> s ^ shiftleft(1L, int(pmod(hash(c[i], get(c, i + 1)), 64))))"
    marked = lines.withColumn("_m", F.expr(f"transform(array(split(line, '')), c -> struct({one} AS one, {two} AS two))[0]"))
    return marked.select("*", "_m.one", "_m.two").drop("_m")


def _alike(edits: int) -> str:
    """SQL that is true of all pairs (one, two), (o, t) within ``edits``: an edit changes at most two parities of the first and four of the second."""
    return f"bit_count(one ^ o) <= {2 * edits} AND bit_count(two ^ t) <= {4 * edits}"


def _sliced(lines: DataFrame, edits: int) -> DataFrame:
    """Adds the ``width`` of a line's slices (a power of two of them, about FINEST characters long), their hashes (``cuts``) and, slice by
    slice, the hashes of what lies up to ``edits`` beside them (``fits``)."""
    n = f"int(least({SLICES[1]}, greatest({SLICES[0]}, power(2, floor(log2(greatest(length(line), 1) / {FINEST}))))))"
    at = lambda i: f"smallint(pmod(hash(substring(line, int({i}) + 1, width)), 32768))"
    wide = lines.withColumn("_n", F.expr(n)).withColumn("width", F.expr("length(line) div _n"))
    cuts = f"transform(sequence(0, _n - 1), i -> {at('i * width')})"
    fits = f"transform(sequence(0, _n - 1), i -> transform(sequence({-edits}, {edits}), s -> CASE WHEN i * width + s >= 0 THEN {at('i * width + s')} END))"
    return wide.withColumns({"cuts": F.expr(cuts), "fits": F.expr(fits)}).drop("_n")


def _fitting(edits: int) -> str:
    """SQL that is true of all pairs (width, fits), (w, c) within ``edits``: an edit changes at most one slice, the others lie up to
    ``edits`` characters from their places. Lines whose slices differ in number or width are not told apart."""
    return f"(width <> w OR size(fits) <> size(c) OR size(filter(zip_with(fits, c, (f, x) -> array_contains(f, x)), y -> y)) >= size(c) - {edits})"


def _met(items: DataFrame, edits: int, segments: int) -> DataFrame:
    """(key, a, b, crowd, near): lines ``a`` that find the line ``b`` under a key; in a crowded key only its eldest line. ``near``: the pair is to be verified."""
    places = _places(edits, segments)
    marks = [c for c in MARKS if c in items.columns]
    index = _keys(items, [p for p in places if p[1:] == (0, 0)], edits, segments)
    if segments > edits + 1:
        counts = index.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        rarest = Window.partitionBy("id").orderBy("n", "key")
        index = index.join(counts, "key").withColumn("_r", F.row_number().over(rarest)).filter(F.col("_r") <= edits + 1).select("key", "id", "age", *marks)
    index = index.repartition("key")
    crowds = index.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("age").alias("first"), F.min_by("id", "age").alias("eldest")).filter(F.col("n") > CROWD)
    crowds = crowds.select(F.col("key").alias("_key"), "first", "eldest")
    # both sides read the same columns, so the index is dealt out once
    index = index.join(crowds.hint("shuffle_hash"), F.col("key") == F.col("_key"), "left").filter(F.col("eldest").isNull() | ((F.col("eldest") == F.col("id")) & (F.col("first") == F.col("age"))))
    index = index.select(F.col("key").alias("_key"), F.col("eldest").isNotNull().alias("crowd"), F.col("id").alias("b"), *[F.col(c).alias(c[0]) for c in marks])
    probes = _keys(items, places, edits, segments).select("key", F.col("id").alias("a"), *marks)
    near = F.col("a") != F.col("b")
    if marks:
        near = near & F.expr(_alike(edits))
    met = probes.join(index.hint("shuffle_hash"), (F.col("key") == F.col("_key")) & (F.col("crowd") | near))
    return met.select("key", "a", "b", "crowd", near.alias("near"))


def _verified(pairs: DataFrame, texts: DataFrame, gone: DataFrame | None, edits: int) -> DataFrame:
    """Ids of the younger lines of distinct ``pairs`` (x, y) within the threshold; lines that are ``gone`` already are not compared again."""
    at = lambda c: texts.select(F.col("id").alias(c), F.col("at").alias(f"at_{c}"))
    old = F.col("at_x") < F.col("at_y")
    aged = pairs.join(at("x"), "x").join(at("y"), "y").select(F.when(old, F.col("x")).otherwise(F.col("y")).alias("elder"), F.when(old, F.col("y")).otherwise(F.col("x")).alias("id"))
    if gone is not None:
        aged = aged.join(gone.hint("shuffle_hash"), "id", "left_anti")
    told = aged.join(texts.select("id", "line").hint("merge"), "id").join(texts.select(F.col("id").alias("elder"), F.col("line").alias("old")).hint("merge"), "elder")
    return told.filter(F.expr(maybe_within("old", "line", edits))).filter(F.expr(within("old", "line", edits))).select("id").distinct()


def _settle(met: DataFrame, texts: DataFrame, gone: DataFrame | None, edits: int) -> DataFrame:
    """Ids of lines that a line met under a key precedes within the threshold."""
    return _verified(met.filter("near").select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct(), texts, gone, edits)


def _open(crowds: DataFrame, texts: DataFrame, gone: DataFrame) -> DataFrame:
    """(key, id, at, left, n lines) of the lines of crowded keys up to the youngest that is ``left`` (that no one has removed);
    younger ones are nobody's elders there."""
    rows = crowds.select("key", F.col("a").alias("id")).distinct()
    places = texts.select("id", "at").join(gone.withColumn("_gone", F.lit(True)).hint("shuffle_hash"), "id", "left")
    told = cut(rows.join(places.hint("merge"), "id").select("key", "id", "at", F.col("_gone").isNull().alias("left")), "open")
    span = told.groupBy("key").agg(F.max(F.when(F.col("left"), F.col("at"))).alias("last"), F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).filter("first < last")
    return told.join(span, "key").filter(F.col("at") <= F.col("last")).drop("first", "last")


def _product(open_: DataFrame, texts: DataFrame, gone: DataFrame, edits: int) -> DataFrame:
    """Ids of the lines left in crowded keys that an elder of the key is close to: parities and slices tell most pairs apart, the automaton the others,
    all where the key's lines meet, so that only pairs within the threshold leave the join, and one of a line goes on.
    A pair of several keys is compared under one of them, another for each pair, which spreads a crowd over its keys."""
    keys = open_.groupBy("id").agg(F.collect_list("key").alias("keys"), F.first("at").alias("at"), F.first("left").alias("left"))
    marks = _sliced(_parities(texts.select("id", "line").join(keys, "id")), edits).select("id", "at", "left", "line", "keys", *MARKS, "width", "cuts", "fits")
    told = cut(marks, "marks").withColumn("key", F.explode("keys"))
    elder = told.select("key", F.col("at").alias("a"), F.col("id").alias("x"), F.col("line").alias("old"), F.col("one").alias("o"), F.col("two").alias("t"), F.col("width").alias("w"), F.col("cuts").alias("c"), F.col("keys").alias("k"))
    younger = told.filter("left").select("key", "at", F.col("id").alias("y"), "line", "keys", *MARKS, "width", "fits")
    once = "transform(array(array_intersect(keys, k)), z -> z[pmod(hash(x, y), size(z))])[0] = key"
    tests = [_alike(edits), once, _fitting(edits), maybe_within("old", "line", edits), within("old", "line", edits)]
    pairs = elder.hint("merge").join(younger, "key").filter(F.expr(" AND ".join(["a < at", *tests])))
    return _verified(pairs.groupBy("y").agg(F.min("x").alias("x")).select("x", "y"), texts, gone, edits)


def kept_lines(docs: DataFrame, min_chars: int = MIN_CHARS, edits: int = EDITS) -> DataFrame:
    """(doc_id, mark, keep): the numbers of the long lines that stay, from (doc_id, mark, text)."""
    spark = docs.sparkSession
    lines = cut(distinct_lines(docs, min_chars).withColumn("id", F.monotonically_increasing_id()), "lines")
    sweep(spark)
    items, gone, texts = lines.select("id", F.col("at.doc_id").alias("age"), "line"), None, None
    for k, segments in enumerate(ROUNDS):
        met = cut(_met(items, edits, segments), "met")
        sweep(spark)
        if texts is None:
            needed = met.select(F.explode(F.array("a", "b")).alias("id")).distinct()
            texts = cut(lines.join(needed.hint("shuffle_hash"), "id", "left_semi"), "texts")
        found = _settle(met, texts, gone, edits)
        gone = cut(found if gone is None else gone.unionByName(found).distinct(), "gone")
        open_ = cut(_open(met.filter("crowd"), texts, gone), "open")
        few = open_ if k + 1 == len(ROUNDS) else open_.filter(F.col("n") <= PRODUCT)
        gone = cut(gone.unionByName(_product(few, texts, gone, edits)).distinct(), "gone")
        pool = open_.filter(F.col("n") > PRODUCT).select("id").distinct()
        if k + 1 == len(ROUNDS) or pool.isEmpty():
            break
        items = cut(_parities(texts.join(pool, "id", "left_semi").select("id", F.col("at.doc_id").alias("age"), "line")), "pool")
        sweep(spark)
    stay = lines.select("id", "at").join(gone.hint("shuffle_hash"), "id", "left_anti")
    keep = cut(stay.groupBy("at.doc_id", "at.mark").agg(F.collect_list("at.line_no").alias("keep")), "keep")
    release(lines, texts, gone)
    sweep(spark)
    return keep


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, edits: int = EDITS) -> DataFrame:
    """``docs`` with later copies of lines taken out of the text, and the counts n_lines and n_removed in ``_lines``."""
    mark = F.xxhash64(F.col(text_col))
    keep = kept_lines(docs.select(F.col(id_col).cast("long").alias("doc_id"), mark.alias("mark"), F.col(text_col).alias("text")), min_chars, edits)
    names = {c: f"_c{k}" for k, c in enumerate(docs.columns)}
    held = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    key, text = names[id_col], names[text_col]
    same = (F.col(key).cast("long") == F.col("doc_id")) & (F.xxhash64(text) == F.col("mark"))
    joined = held.join(keep.hint("shuffle_hash"), same, "left")
    short = f"filter(transform(p, (l, i) -> CASE WHEN length(l) < {max(1, min_chars)} THEN i ELSE -1 END), i -> i >= 0)"
    stay = f"CASE WHEN {key} IS NULL THEN sequence(0, size(p) - 1) ELSE sort_array(array_union({short}, coalesce(keep, array()))) END"
    told = f"transform(array({stay}), s -> struct(size(p) AS n, size(s) AS k, array_join(transform(s, i -> p[i]), '\\n') AS text))[0]"
    out = joined.withColumn("_told", F.expr(f"transform(array(split({text}, '\\n')), p -> CASE WHEN p IS NOT NULL THEN {told} END)[0]"))
    n, k = F.coalesce(F.col("_told.n"), F.lit(0)), F.coalesce(F.col("_told.k"), F.lit(0))
    counts = F.struct(n.cast("long").alias("n_lines"), (n - k).cast("long").alias("n_removed"))
    return out.select(*[F.col("_told.text" if c == text_col else n_).alias(c) for c, n_ in names.items()], counts.alias("_lines"))


#: DuckDB counts edits in bytes, so letters with marks become one byte each there.
_ONE_BYTE = " || ".join(f"chr({i})" for i in (*range(1, 9), *range(11, 32)))

ORACLE = rf"""
WITH o AS (SELECT doc_id, i - 1 AS line_no, string_split(text, chr(10))[i] AS line FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)),
l AS (SELECT translate(line, 'àáâãäåæçèéêëìíîïñòóôõöøùúûüýß', {_ONE_BYTE}) AS line, length(line) AS size, min((doc_id, line_no)) AS pl FROM o WHERE length(line) >= {MIN_CHARS} GROUP BY ALL),
s AS (SELECT *, size // {CORPUS_EDITS + 1} AS w FROM l),
m AS (SELECT a.pl AS x, b.pl AS y, a.line AS la, b.line AS lb FROM s a JOIN (SELECT *, unnest(range(size - {CORPUS_EDITS}, size + 1)) AS fit FROM l) b ON a.size = b.fit
  WHERE a.pl <> b.pl AND ({" OR ".join(f"contains(b.line, substr(a.line, w * {i} + 1, w))" for i in range(CORPUS_EDITS + 1))})),
gone AS (SELECT DISTINCT greatest(x, y) AS pl FROM m WHERE levenshtein(la, lb) <= {CORPUS_EDITS}),
stay AS (SELECT pl FROM l WHERE pl NOT IN (SELECT pl FROM gone)),
r AS (SELECT doc_id, line_no, line, length(line) < {MIN_CHARS} OR (doc_id, line_no) IN (SELECT pl FROM stay) AS kept FROM o)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT kept) AS n_removed, sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (kept), '')) AS kept_sha256
FROM r GROUP BY doc_id
"""
