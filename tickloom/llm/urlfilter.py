"""URL filters: rules on host and path, and link-graph propagation for the rest.

A url that a rule fits takes the rule's verdict. Every other url is judged by
its host's place in the link graph: trust flows from hosts with allowed pages
along links, distrust flows from hosts with blocked pages against them, both as
personalised PageRank. Only what a host receives over links counts, so a rule
on one path does not condemn the rest of a host. A host is blocked when the
distrust it receives reaches ``THRESHOLD`` and exceeds the trust it receives.

Masses are integers (a seed holds ``SEED``), so sums do not depend on order and
SQL gives the same verdicts. Every step starts from what the teleport alone gives, so masses
only grow; after ``ITERATIONS`` of them all hosts together lack at most a thousandth of the
seeds' mass (the damping to that power), and a step that changes nothing ends the walk. Quotients are taken before
products, so no product leaves 64 bits while all seeds together hold less than 9e18. The out-links of a host are dealt out
in ``FAN`` at a time, so that a hub's are spread over tasks.

Defined results: a null url, or one without ``://``, has an empty host and path,
fits no rule and is allowed; null html has no links; repeated page_ids are judged
row by row; a table without links between hosts leaves rules only; only the
named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.scratch import cut

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
SEED = 10**9
DAMPING = 85
ITERATIONS = 43
FAN = 4096
THRESHOLD = SEED // 100
#: Rules up to so many are compared within each row; more are joined by host suffix.
INLINE_RULES = 256

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _fit_inline(pages: DataFrame, rules) -> DataFrame:
    table = F.array(*[F.struct(F.lit(len(h) + len(p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"), F.lit(h).alias("h"), F.lit(p).alias("p")) for v, h, p in rules])
    fits = F.filter(table, lambda r: ((F.col("host") == r["h"]) | F.endswith(F.col("host"), F.concat(F.lit("."), r["h"]))) & F.startswith(F.col("path"), r["p"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(r["size"].alias("size"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    return pages.withColumn("_best", best).withColumns({"rule": F.col("_best.rule"), "ruled": F.col("_best.verdict")}).drop("_best")


def _fit_joined(pages: DataFrame, rules) -> DataFrame:
    """Distinct (host, path) pairs meet the rules over the host's suffixes, one per label."""
    table = pages.sparkSession.createDataFrame([(h, p, v) for v, h, p in rules], "h string, p string, v string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    urls = pages.select("host", "path").distinct()
    met = urls.withColumn("h", F.explode(suffixes)).join(table, "h").filter(F.startswith("path", "p"))
    best = met.groupBy("host", "path").agg(F.max(F.struct((F.length("h") + F.length("p")).alias("size"), F.concat("h", "p").alias("rule"), "v")).alias("_best"))
    return pages.join(best, ["host", "path"], "left").withColumns({"rule": F.col("_best.rule"), "ruled": F.col("_best.v")}).drop("_best")


def host_links(pages: DataFrame) -> DataFrame:
    """Links between different hosts, (src, dst, n), summed before they are shuffled. Links without a host stay on theirs."""
    found = F.regexp_extract_all("html", F.lit(r"""(?i)href\s*=\s*["']?\s*((?:https?:)?//[^\s"'>]+)"""), 1)
    urls = pages.filter(F.col("host") != "").select(F.col("host").alias("src"), F.explode(found).alias("url"))
    target = F.regexp_replace("url", r"^(?:[a-zA-Z]+:)?//", "http://")
    links = urls.select("src", host_and_path(target)[0].alias("dst")).filter((F.col("dst") != "") & (F.col("src") != F.col("dst")))
    return links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def _part(mass: str, share: str, whole: int) -> str:
    """SQL: mass * share div whole, exactly and without a product above mass."""
    return f"({mass} div {whole} * {share} + {mass} % {whole} * {share} div {whole})"


def propagate(links: DataFrame, seeds: DataFrame, iterations: int | None = None) -> DataFrame:
    """Received trust and distrust per host. ``seeds``: (host, kind), kind ``t`` or ``d``, one row each.

    Both kinds travel in one join: trust over links, distrust over links turned
    round. Shares of an edge are fixed parts per million of its source's mass.
    """
    forward = links.select(F.lit("t").alias("kind"), F.col("src").alias("here"), F.col("dst").alias("there"), "n")
    backward = links.select(F.lit("d").alias("kind"), F.col("dst").alias("here"), F.col("src").alias("there"), "n")
    moves = forward.unionByName(backward)
    out_of = cut(moves.groupBy("kind", "here").agg(F.sum("n").alias("all"), F.ceil(F.count(F.lit(1)) / FAN).alias("fans")), "out")
    moves = moves.join(out_of, ["kind", "here"])
    moves = cut(moves.select("kind", "here", F.pmod(F.xxhash64("there"), "fans").alias("fan"), "there", F.expr("bigint(1000000 * n div all)").alias("ppm")), "moves")
    fans = out_of.select("kind", "here", F.explode(F.sequence(F.lit(0).cast("long"), F.col("fans") - 1)).alias("fan"))
    start = seeds.select("kind", F.col("host").alias("here"), F.lit((100 - DAMPING) * SEED // 100).cast("long").alias("mass"))
    state, received, before = start, None, None
    for step in range(iterations or ITERATIONS):
        sent = state.join(fans, ["kind", "here"]).join(moves, ["kind", "here", "fan"]).select("kind", F.col("there").alias("here"), F.expr(_part("mass", "ppm", 1_000_000)).alias("mass"))
        received = sent.groupBy("kind", "here").agg(F.sum("mass").alias("got"))
        if step % 4 == 3:
            received = cut(received, "ranks")
            total = received.agg(F.sum(F.col("got").cast("decimal(38,0)")), F.count(F.lit(1))).first()
            if total == before:
                break
            before = total
        damped = received.select("kind", "here", F.expr(_part("got", str(DAMPING), 100)).alias("mass"))
        state = damped.unionByName(start).groupBy("kind", "here").agg(F.sum("mass").alias("mass"))
    total = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("got"))), F.lit(0))
    return received.groupBy(F.col("here").alias("host")).agg(total("t").alias("trust"), total("d").alias("distrust"))


def url_filter(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES, threshold: int = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages``."""
    host, path = host_and_path(F.col(url_col))
    base = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    fit = _fit_inline if len(rules) <= INLINE_RULES else _fit_joined
    judged = fit(base.drop("html"), rules)
    links = cut(host_links(base), "links")
    if links.isEmpty():
        judged = judged.withColumn("condemned", F.lit(False))
    else:
        seeds = judged.filter(F.col("ruled").isNotNull()).select("host", F.when(F.col("ruled") == "allow", "t").otherwise("d").alias("kind")).distinct()
        ranks = propagate(links, seeds)
        bad = ranks.filter((F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))).select("host", F.lit(True).alias("condemned"))
        judged = judged.join(bad, "host", "left")
    method = F.when(F.col("condemned"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"))


def oracle_sql() -> str:
    """The same verdicts in DuckDB SQL; the iterations are unrolled."""
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    split = lambda u: (f"CASE WHEN strpos({u}, '://') > 0 THEN translate(regexp_extract(substr({u}, strpos({u}, '://') + 3), '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') ELSE '' END", f"CASE WHEN strpos({u}, '://') > 0 THEN regexp_extract(substr({u}, strpos({u}, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END")
    host, path = split("url")
    parts = [
        f"rules(verdict, h, p) AS (VALUES {rules})",
        f"base AS (SELECT row_number() OVER () AS rid, page_id, coalesce({host}, '') AS host, coalesce({path}, '') AS path, html FROM pages)",
        "fit AS (SELECT rid, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS ruled FROM base JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY rid)",
        "judged AS (SELECT base.*, rule, ruled FROM base LEFT JOIN fit USING (rid))",
        "urls AS (SELECT host AS src, regexp_replace(unnest(regexp_extract_all(html, '(?i)href\\s*=\\s*[\"'']?\\s*((?:https?:)?//[^\\s\"''>]+)', 1)), '^(?:[a-zA-Z]+:)?//', 'http://') AS u FROM base WHERE host <> '')",
        f"links AS (SELECT src, dst, count(*) AS n FROM (SELECT src, {split('u')[0]} AS dst FROM urls) WHERE dst <> '' AND src <> dst GROUP BY ALL)",
        "raw AS (SELECT 't' AS kind, src AS here, dst AS there, n FROM links UNION ALL SELECT 'd', dst, src, n FROM links)",
        "moves AS (SELECT kind, here, there, (1000000 * n // sum(n) OVER (PARTITION BY kind, here))::BIGINT AS ppm FROM raw)",
        f"seeds AS (SELECT DISTINCT host AS here, CASE ruled WHEN 'allow' THEN 't' ELSE 'd' END AS kind FROM judged WHERE ruled IS NOT NULL)",
        f"s0 AS (SELECT kind, here, {(100 - DAMPING) * SEED // 100}::BIGINT AS mass FROM seeds)",
    ]
    for i in range(ITERATIONS):
        parts.append(f"r{i} AS MATERIALIZED (SELECT kind, there AS here, sum(mass::HUGEINT * ppm // 1000000)::BIGINT AS got FROM s{i} JOIN moves USING (kind, here) GROUP BY ALL)")
        parts.append(f"s{i + 1} AS (SELECT kind, here, sum(mass)::BIGINT AS mass FROM (SELECT kind, here, {DAMPING} * got::HUGEINT // 100 AS mass FROM r{i} UNION ALL FROM s0) GROUP BY ALL)")
    last = f"r{ITERATIONS - 1}"
    parts.append(f"ranks AS (SELECT here AS host, coalesce(sum(got) FILTER (kind = 't'), 0) AS trust, coalesce(sum(got) FILTER (kind = 'd'), 0) AS distrust FROM {last} GROUP BY here)")
    parts.append(f"bad AS (SELECT host FROM ranks WHERE distrust >= {THRESHOLD} AND distrust > trust)")
    return "WITH " + ",\n".join(parts) + "\nSELECT page_id, judged.host, path, rule, coalesce(ruled, CASE WHEN bad.host IS NULL THEN 'allow' ELSE 'block' END) AS verdict FROM judged LEFT JOIN bad ON judged.host = bad.host"
