"""Quality rules whose cutoffs adapt to each language and source.

Every document gets word, symbol and repetition measures. Documents that pass a
small fixed base test feed mergeable quantile sketches, one per (language,
source) and measure. The sketch is a log-linear histogram: a value keeps its
seven leading bits, so a bucket is at most 1/64 of its value wide, buckets of two
sketches add up, and the outcome does not depend on partitioning. Groups too
small for stable quantiles use the merged sketch of their language, or of the
corpus. A document is kept when each measure lies inside its group's fences. They stand
``FENCE`` times the spread beyond the outer deciles, the spread being the distance from the decile to the
median (between far edges of their buckets); only word lengths are fenced below too, since no rate is bad for being low. So a tenth of a group's texts must show
a trait for it to count as the group's nature. Rates of duplicate lines and of repeats occur in few texts of any
group; their fence is the upper Tukey fence of the values above zero.

Defined results: a null or empty text has no words and fails the base test; null
language or source is a group of its own; rows that repeat a doc_id are judged
one by one; an empty table gives an empty result; only the named columns are
read, so extra columns never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.scratch import cut

WINDOW = 8
#: Leading bits that a sketch keeps of a value, and the buckets of each power of two.
LEAD, HALF = 7, 64
#: measure -> (slack added outside the fences, well below the measures' spread; whether low values are fenced too)
MEASURES = {"symbol_rate": (50, False), "word_length": (20, True), "dup_line_rate": (20, False), "repeat_rate": (20, False)}
#: Fences stand this many spreads from the outer deciles.
FENCE = 3
#: Groups of fewer base-passing documents use a merged sketch.
MIN_GROUP = 100
#: Rates that are zero in most texts of any group: their fence stands on the values above zero, where ``MIN_NONZERO`` of them are known.
SPARSE = ("dup_line_rate", "repeat_rate")
MIN_NONZERO = 30

_WORDS = r"filter(split(translate(t, '\t\n\u000b\u000c\r', '     '), ' '), w -> w <> '')"
_HASHES = f"transform(sequence(1, size(ws) - {WINDOW - 1}), i -> xxhash64(slice(ws, i, {WINDOW})))"
#: Positions of windows that another window of the text equals, in text order; then the words they cover.
_COVERED = f"""
transform(array(array_sort(transform(hs, (h, i) -> struct(h AS h, i AS i)))), s ->
  aggregate(
    array_sort(filter(
      transform(s, (p, j) -> CASE WHEN get(s, j - 1).h = p.h OR get(s, j + 1).h = p.h THEN p.i ELSE -1 END),
      i -> i >= 0)),
    named_struct('n', 0L, 'to', 0L),
    (a, i) -> named_struct('n', a.n + i + {WINDOW} - greatest(a.to, bigint(i)), 'to', bigint(i + {WINDOW})),
    a -> a.n))[0]
"""


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keys: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """One row per input row: ``doc_id``, the group keys and the counts."""
    base = docs.select(F.col(id_col).alias("doc_id"), *[F.col(k) for k in keys], F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    words = base.select(
        "doc_id",
        *keys,
        F.expr(_WORDS).alias("ws"),
        F.expr(r"length(translate(t, ' \t\n\u000b\u000c\r', ''))").cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.expr(r"transform(array(filter(split(t, '\n'), l -> length(translate(l, ' \t\u000b\u000c\r', '')) > 0)), l -> struct(size(l) AS n, size(array_distinct(l)) AS d))[0]").alias("ls"),
    )
    repeats = F.expr(f"CASE WHEN size(ws) < {WINDOW} THEN 0L ELSE transform(array({_HASHES}), hs -> CASE WHEN size(array_distinct(hs)) = size(hs) THEN 0L ELSE {_COVERED} END)[0] END")
    return words.select(
        "doc_id",
        *keys,
        F.size("ws").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.col("ls.n") - F.col("ls.d")).cast("long").alias("n_dup_lines"),
        repeats.alias("n_repeat_words"),
        F.col("ls.n").cast("long").alias("n_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _rates() -> list[Column]:
    ints = {
        "symbol_rate": "10000 * n_symbols div greatest(word_chars, 1)",
        "word_length": "100 * word_chars div greatest(n_words, 1)",
        "dup_line_rate": "1000 * n_dup_lines div greatest(n_lines, 1)",
        "repeat_rate": "1000 * n_repeat_words div greatest(n_words, 1)",
    }
    return [F.expr(ints[m]).alias(m) for m in MEASURES]


def bucket(value: str) -> str:
    """SQL for the log-linear bucket of a non-negative integer."""
    shift = f"greatest(length(bin({value})) - {LEAD}, 0)"
    return f"bigint({HALF} * {shift} + shiftright({value}, {shift}))"


def bucket_top(b: str) -> str:
    """SQL for the largest value in a bucket."""
    shift = f"greatest({b} div {HALF} - 1, 0)"
    return f"(shiftleft({b} - {HALF} * {shift} + 1, int({shift})) - 1)"


def bucket_bottom(b: str) -> str:
    """SQL for the smallest value in a bucket."""
    shift = f"greatest({b} div {HALF} - 1, 0)"
    return f"shiftleft({b} - {HALF} * {shift}, int({shift}))"


def sketches(rated: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Mergeable sketches: rows (keys, measure, bucket, n). Merging two is adding n by bucket."""
    stack = ", ".join(f"'{m}', {m}" for m in MEASURES)
    long = rated.select(*keys, F.expr(f"stack({len(MEASURES)}, {stack}) AS (measure, value)"))
    return long.groupBy(*keys, "measure", F.expr(bucket("value")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def quantiles(sketch: DataFrame, keys: tuple[str, ...], percents: tuple[int, ...]) -> DataFrame:
    """Per (keys, measure): n, and the bucket of each quantile by nearest rank as its top q<percent> and bottom b<percent>. A group has a few hundred buckets at most."""
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    ranked = merged.select("*", F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"), F.sum("n").over(group).alias("total"))
    at = lambda q, edge: F.min(F.when(100 * F.col("upto") >= q * F.col("total"), F.expr(edge("bucket"))))
    edges = (("q", bucket_top), ("b", bucket_bottom))
    return ranked.groupBy(*keys, "measure").agg(F.max("total").alias("n"), *[at(q, edge).alias(f"{c}{q}") for q in percents for c, edge in edges])


def _finest(groups: DataFrame, sketch: DataFrame, keys: tuple[str, ...], percents: tuple[int, ...], least: int, last: int) -> DataFrame:
    """Quantiles for each (keys, measure) of ``groups``: its own where it has ``least`` values, else its first key's, else those of all where ``last`` are known."""
    out = groups
    for k, by in enumerate((keys, keys[:1], ())):
        one = quantiles(sketch if by else sketch.withColumn("_all", F.lit(0)), by or ("_all",), percents)
        found = F.when(F.col("n") >= (least if by else last), F.struct(*[f"{c}{q}" for q in percents for c in "qb"])).alias(f"_q{k}")
        one = one.select(*[F.col(c).alias(f"_{k}{c}") for c in by], F.col("measure").alias(f"_m{k}"), found)
        same = F.col("measure") == F.col(f"_m{k}")
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_{k}{c}"))
        out = out.join(one, same, "left")
    return out.select(*keys, "measure", F.coalesce("_q0", "_q1", "_q2").alias("q")).select(*keys, "measure", "q.*")


def fences(sketch: DataFrame, keys: tuple[str, ...], min_group: int = MIN_GROUP) -> DataFrame:
    """One row per group with lo_<measure> (where low values are fenced) and hi_<measure>; null where too little is known."""
    groups = sketch.select(*keys).distinct()
    of = lambda names: groups.withColumn("measure", F.explode(F.array(*map(F.lit, names))))
    is_sparse = F.col("measure").isin(*SPARSE)
    dense = _finest(of([m for m in MEASURES if m not in SPARSE]), sketch.filter(~is_sparse), keys, (10, 50, 90), min_group, 1)
    dense = dense.select(*keys, "measure", (F.col("b10") - FENCE * (F.col("q50") - F.col("b10"))).alias("lo"), (F.col("q90") + FENCE * (F.col("q90") - F.col("b50"))).alias("hi"))
    rare = _finest(of(SPARSE), sketch.filter(is_sparse & (F.col("bucket") > 0)), keys, (25, 75), MIN_NONZERO, MIN_NONZERO)
    rare = rare.select(*keys, "measure", F.lit(None).cast("long").alias("lo"), (F.col("q75") + F.floor(1.5 * (F.col("q75") - F.col("b25")))).alias("hi"))
    out = []
    for m, (slack, low) in MEASURES.items():
        mine = F.col("measure") == m
        out.append(F.max(F.when(mine, F.col("hi") + slack)).alias(f"hi_{m}"))
        if low:
            out.append(F.max(F.when(mine, F.col("lo") - slack)).alias(f"lo_{m}"))
    return dense.unionByName(rare).groupBy(*keys).agg(*out)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keys: tuple[str, ...] = ("lang", "source"), min_group: int = MIN_GROUP) -> DataFrame:
    """Counts, base test and adaptive verdict (``kept``) of every row of ``docs``.

    The counts are written once; the sketches and the verdict both read them.
    The verdict joins on the group keys only, one row per group on the other side.
    """
    own = tuple(f"_g{i}" for i in range(len(keys)))
    counted = measures(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *[F.col(k).alias(o) for k, o in zip(keys, own, strict=True)]), "_id", "_text", own)
    rated = cut(counted.select("*", base_failed().alias("base_failed"), *_rates()), "quality")
    limits = fences(cut(sketches(rated.filter(~F.col("base_failed")), own), "sketch"), own, min_group)
    limits = limits.select(*[F.col(o).alias(f"l{o}") for o in own], *[c for c in limits.columns if c not in own])
    same = [F.col(o).eqNullSafe(F.col(f"l{o}")) for o in own]
    joined = rated.join(limits, same, "left")
    inside = F.lit(True)
    for m, (_, low) in MEASURES.items():
        inside = inside & F.coalesce(F.col(m) <= F.col(f"hi_{m}"), F.lit(True))
        if low:
            inside = inside & F.coalesce(F.col(m) >= F.col(f"lo_{m}"), F.lit(True))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.when(F.col("base_failed"), F.lit(False)).otherwise(F.coalesce(inside, F.lit(True))).alias("kept"))


def oracle_sql() -> str:
    """The same counts, sketches and verdicts in DuckDB SQL."""
    blank = r"[\x20\x09-\x0D]"
    shift = f"greatest(length(bin(v)) - {LEAD}, 0)"
    top = f"greatest(bucket // {HALF} - 1, 0)"

    def quantile(name: str, keys: str, source: str) -> str:
        by = f"{keys}, " if keys else ""
        at = ", ".join(f"min(CASE WHEN 100 * upto >= {q} * total THEN {edge} END) AS {c}{q}" for q in (10, 25, 50, 75, 90) for c, edge in (("q", "hi"), ("b", "lo")))
        return f"""{name} AS (SELECT {by}measure, max(total) AS n, {at}
  FROM (SELECT {by}measure, ((bucket - {HALF} * {top} + 1) << {top}::INT) - 1 AS hi, (bucket - {HALF} * {top}) << {top}::INT AS lo, sum(n) OVER (PARTITION BY {by}measure ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {by}measure) AS total
    FROM (SELECT {by}measure, bucket, sum(n) AS n FROM {source} GROUP BY ALL)) GROUP BY ALL)"""

    def pick(q: str) -> str:
        return f"CASE WHEN own.n >= least THEN own.{q} WHEN wide.n >= least THEN wide.{q} WHEN whole.n >= floor_ THEN whole.{q} END AS {q}"

    names = ", ".join(f"'{m}'" for m in MEASURES)
    limits = ", ".join(f"({slack}, '{m}', {str(low).lower()})" for m, (slack, low) in MEASURES.items())
    inside = " AND ".join(f"coalesce({m} <= hi['{m}'], true) AND coalesce({m} >= lo['{m}'], true)" for m in MEASURES)
    sparse = ", ".join(f"'{m}'" for m in SPARSE)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '{blank}+'), lambda x: x <> '') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS j FROM rep) GROUP BY 1),
m AS (SELECT w.rid, doc_id, lang, source, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '{blank}', '', 'g'))::BIGINT AS word_chars, (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines FROM w LEFT JOIN cov USING (rid)),
r AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, 10000 * n_symbols // greatest(word_chars, 1) AS symbol_rate, 100 * word_chars // greatest(n_words, 1) AS word_length,
  1000 * n_dup_lines // greatest(n_lines, 1) AS dup_line_rate, 1000 * n_repeat_words // greatest(n_words, 1) AS repeat_rate FROM m),
s AS (SELECT lang, source, measure, {HALF} * {shift} + (v >> {shift}::INT) AS bucket, count(*) AS n FROM (SELECT lang, source, unnest([{names}]) AS measure, unnest([{", ".join(MEASURES)}]) AS v FROM r WHERE NOT base_failed) GROUP BY ALL),
u AS (SELECT * FROM s WHERE measure NOT IN ({sparse}) OR bucket > 0),
{quantile("own", "lang, source", "u")},
{quantile("wide", "lang", "u")},
{quantile("whole", "", "u")},
g AS (SELECT * FROM (SELECT DISTINCT lang, source FROM s), (SELECT *, measure IN ({sparse}) AS rare, CASE WHEN measure IN ({sparse}) THEN {MIN_NONZERO} ELSE {MIN_GROUP} END AS least, CASE WHEN measure IN ({sparse}) THEN {MIN_NONZERO} ELSE 1 END AS floor_ FROM (VALUES {limits}) l(slack, measure, low))),
p AS (SELECT g.*, {", ".join(map(pick, ("b10", "b25", "b50", "q50", "q75", "q90")))} FROM g LEFT JOIN own ON own.measure = g.measure AND own.lang IS NOT DISTINCT FROM g.lang AND own.source IS NOT DISTINCT FROM g.source
  LEFT JOIN wide ON wide.measure = g.measure AND wide.lang IS NOT DISTINCT FROM g.lang LEFT JOIN whole ON whole.measure = g.measure),
f AS (SELECT lang, source, map_from_entries(list((measure, CASE WHEN low THEN b10 - {FENCE} * (q50 - b10) - slack END))) AS lo,
  map_from_entries(list((measure, CASE WHEN rare THEN q75 + floor(1.5::DOUBLE * (q75 - b25)) ELSE q90 + {FENCE} * (q90 - b50) END + slack))) AS hi FROM p GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce({inside}, true) AS kept
FROM r LEFT JOIN f ON r.lang IS NOT DISTINCT FROM f.lang AND r.source IS NOT DISTINCT FROM f.source
"""
