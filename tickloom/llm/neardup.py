"""MinHash near-duplicates by a chosen-path similarity join.

Documents with one shingle set are one class, with a number of its own. Each class has
``TREES`` minwise tokens for the roots and as many for branching, from other functions. In
tree t a node holds the classes that share root token t. A node of
up to ``NODE`` classes is compared exhaustively on full shingle sets. In a larger
one the most popular class (the one whose nodes are largest) leads. Where fewer
than half of the classes are alike to the leader, the node branches on the tree's next
two branching tokens, so that classes which only share a common passage part. Otherwise,
or after the last branching, it is a crowd, known by its leader in any tree. A crowd is compared in
blocks, first every class with the leader and its block, then, once components
are known, the classes outside the leader's component with all of the crowd.
Links exist only where full sets satisfy 100 * intersection >= 75 * union.

A pair of similarity 0.75 is missed by all trees with probability 0.25 ** 12, 6e-8, where its nodes are small. Where all
of its nodes branch once, the miss is 2e-6, and 1.5e-4 where all branch twice, since trees share branching tokens
(``tests/llm/test_neardup.py`` draws these figures).

Defined results: a null or empty text has no shingles and no link; fewer than
five words are one shingle; rows without doc_id are kept with no component; rows
that repeat a doc_id are judged each by its own text, and are linked with each other by
their texts only; an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.components import components
from tickloom.llm.scratch import cut, release, shuffled
from tickloom.llm.shingles import fingerprint, minwise, shingle_sets

TREES = 12
NODE = 64
#: Times a node of unlike classes may branch, and the share of equal root tokens that makes a class alike to its leader.
DEPTH, ALIKE = 3, 0.58
#: Branching tokens that a tree takes at each depth, counted from its own number; few trees share two of them.
BRANCHES = ((0, 5), (7, 2))
#: Classes of a crowd that are compared in one block.
BLOCK = 256
MIN_PERCENT = 75
#: Characters of text hashed at once, which bounds a worker's arrays.
_CHARS = 400_000


def _in_slices(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Runs of rows of bounded text."""
    ends = pdf["text"].str.len().fillna(0).cumsum() // _CHARS
    for _, part in pdf.groupby(ends.to_numpy(), sort=True):
        yield part


def signatures(docs: DataFrame, trees: int = TREES) -> DataFrame:
    """From (doc_id, text, mark): both others, n_shingles, the set's fingerprint (set_a, set_b) and its minwise tokens, roots before branches (null for empty sets)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch.column(1), 0
            while at < len(texts):
                part, chars = [], 0
                while at + len(part) < len(texts) and chars < _CHARS:
                    part.append(texts[at + len(part)].as_py())
                    chars += len(part[-1] or "")
                hashes, offsets = shingle_sets(part)
                n = np.diff(offsets)
                marks, tokens = np.zeros((2, len(n)), np.int64), [None] * len(n)
                full = np.flatnonzero(n)
                if len(full):
                    marks[:, full] = [x.view(np.int64) for x in fingerprint(hashes, offsets)]
                    for i, row in zip(full, minwise(hashes, offsets, 2 * trees).view(np.int64).tolist(), strict=True):
                        tokens[i] = row
                columns = [batch.column(0).slice(at, len(part)), batch.column(2).slice(at, len(part)), pa.array(n), *map(pa.array, marks), pa.array(tokens, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "n_shingles", "set_a", "set_b", "tokens"])
                at += len(part)

    return docs.mapInArrow(sign, "doc_id bigint, mark bigint, n_shingles bigint, set_a bigint, set_b bigint, tokens array<bigint>")


def _sized(keys: DataFrame) -> DataFrame:
    """Members of nodes with two classes or more, with the node's size; one row per node joins."""
    sizes = keys.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return keys.join(shuffled(sizes), "node")


def _split(big: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Large nodes by kind: rows (leader, fame, doc) of alike nodes, and the members of the others.

    A node is alike when at least half of its classes share ALIKE tokens with its leader. It stays whole.
    """
    leaders = big.groupBy("node").agg(F.max(F.struct("popular", (-F.col("doc")).alias("least"), "tokens")).alias("l"))
    trees = (F.size("tokens") / 2).cast("int")
    agree = F.aggregate(F.slice(F.zip_with("tokens", "l.tokens", lambda x, y: (x == y).cast("int")), F.lit(1), trees), F.lit(0), lambda n, x: n + x)
    led = big.join(leaders, "node").select("node", "doc", "tokens", "tree", "popular", (-F.col("l.least")).alias("leader"), F.col("l.popular").alias("fame"), (agree >= ALIKE * trees).alias("near"))
    led = cut(led, "led")
    alike = led.groupBy("node").agg((2 * F.count_if("near") >= F.count(F.lit(1))).alias("alike"))
    told = cut(led.join(alike, "node"), "large")
    release(led)
    return told.filter("alike").select("leader", "fame", "doc"), told.filter("NOT alike")


def _merged(crowds: DataFrame) -> DataFrame:
    """Rows (leader, doc) after each crowd has joined the most famous one that its leader is a member of, twice over.

    The nodes of different trees hold much the same crowd under several leaders; merged, it is compared once.
    """
    for _ in range(2):
        leaders = crowds.select(F.col("leader").alias("doc")).distinct()
        best = crowds.join(shuffled(leaders), "doc", "left_semi").groupBy(F.col("doc").alias("leader")).agg(F.max(F.struct("fame", (-F.col("leader")).alias("least"))).alias("b"))
        crowds = crowds.drop("fame").join(best, "leader").select((-F.col("b.least")).alias("leader"), F.col("b.fame").alias("fame"), "doc").distinct()
    return crowds.select("leader", "doc")


def _branch(members: DataFrame, depth: int) -> DataFrame:
    """Children of large nodes: the node's key with each of the two branching tokens that its tree has at this depth."""
    trees = (F.size("tokens") / 2).cast("int")
    at = lambda s: (trees + F.pmod(F.col("tree") + s, trees)).cast("int")
    child = F.explode(F.array(*[F.xxhash64("node", at(s), F.element_at("tokens", at(s) + 1)) for s in BRANCHES[depth - 1]]))
    return members.select("doc", "tokens", "popular", "tree", child.alias("node"))


def cells_of(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(small, crowds): rows (cell, doc) of nodes to compare whole, once for equal memberships, and rows (leader, doc) of crowds."""
    roots = F.slice("tokens", F.lit(1), (F.size("tokens") / 2).cast("int"))
    first = classes.select("doc", "tokens", F.posexplode(roots).alias("tree", "token"))
    one = cut(_sized(first.select("doc", "tokens", "tree", F.xxhash64("tree", "token").alias("node"))), "nodes")
    small = one.filter(F.col("size") <= NODE).select("node", "doc")
    big = one.filter(F.col("size") > NODE)
    crowds = None
    if not big.isEmpty():
        popular = one.groupBy("doc").agg(F.sum("size").alias("popular"))
        crowds, mixed = _split(big.join(shuffled(popular), "doc"))
        for depth in range(1, DEPTH):
            level = cut(_sized(_branch(mixed, depth)), "nodes")
            small = small.unionByName(level.filter(F.col("size") <= NODE).select("node", "doc"))
            alike, mixed = _split(level.filter(F.col("size") > NODE))
            crowds = crowds.unionByName(alike)
        crowds = _merged(cut(crowds.unionByName(mixed.select("leader", "fame", "doc")).distinct(), "crowds"))
    else:
        crowds = one.select(F.col("doc").alias("leader"), "doc").filter("false")
    mark = small.groupBy("node").agg(*[F.sum(F.pmod(F.xxhash64(F.lit(i), "doc"), F.lit(1 << 50))).alias(f"m{i}") for i in (1, 2)], F.count(F.lit(1)).alias("k"))
    once = mark.groupBy("m1", "m2", "k").agg(F.min("node").alias("node")).select("node")
    return small.join(shuffled(once), "node").select(F.col("node").alias("cell"), "doc"), crowds.distinct()


def _links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (i of left, j of right) of set indices that satisfy the similarity, from all shared hashes."""
    used = np.unique(np.concatenate((left, right)))
    flat = np.concatenate([sets[i] for i in used])
    owner = np.repeat(used, [len(sets[i]) for i in used])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1]))
    group = np.cumsum(new) - 1
    shared = np.bincount(group)[group] > 1
    group, owner = group[shared], owner[shared]
    group = np.cumsum(np.concatenate(([True], group[1:] != group[:-1]))) - 1 if len(group) else group
    size = np.array([len(s) for s in sets], dtype=np.int64)
    inter = np.zeros((len(left), len(right)), dtype=np.float64)
    row = {d: k for k, d in enumerate(left)}
    col = {d: k for k, d in enumerate(right)}
    l_of = np.array([row.get(i, -1) for i in range(len(sets))])
    r_of = np.array([col.get(i, -1) for i in range(len(sets))])
    width = int(group[-1]) + 1 if len(group) else 0
    for lo in range(0, width, 8192):
        a, b = np.searchsorted(group, (lo, lo + 8192))
        g, o = group[a:b] - lo, owner[a:b]
        x, y = np.zeros((len(left), 8192), np.float32), np.zeros((len(right), 8192), np.float32)
        for m, of in ((x, l_of), (y, r_of)):
            mine = of[o] >= 0
            m[of[o[mine]], g[mine]] = 1
        inter += x @ y.T
    union = size[left][:, None] + size[right][None, :] - inter
    hit = 100 * inter >= MIN_PERCENT * union
    return [(int(left[i]), int(right[j])) for i, j in zip(*np.nonzero(hit), strict=True) if left[i] != right[j]]


def _roots(n: int, pairs: list[tuple[int, int]], ids: np.ndarray) -> Iterator[tuple[int, int]]:
    """(id, smallest id of its group) for linked members: a spanning star of each group."""
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in pairs:
        a, b = find(i), find(j)
        if a != b:
            if ids[b] < ids[a]:
                a, b = b, a
            parent[b] = a
    for i in range(n):
        if (r := find(i)) != i:
            yield int(ids[i]), int(ids[r])


def compare(cells: DataFrame) -> DataFrame:
    """Edges (a, b) from rows (cell, doc, side, set_a, set_b, text).

    A cell's rows are compared with each other, or side 0 with side 1 where both occur; side 2 stands on both.
    Rows arrive sorted by cell, so one cell at a time is held.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, docs, sides, sets = None, [], [], []

        def close() -> list[tuple[int, int]]:
            side = np.array(sides)
            both = (side == 0).any() and (side == 1).any()
            left = np.flatnonzero(side != 1) if both else np.arange(len(docs))
            right = np.flatnonzero(side != 0) if both else left
            return list(_roots(len(docs), _links(sets, left, right), np.array(docs)))

        for pdf in batches:
            edges = []
            for part in _in_slices(pdf):
                hashes, offsets = shingle_sets(list(part["text"]))
                a = b = np.zeros(0, np.uint64)
                full = np.flatnonzero(np.diff(offsets))
                if len(full):
                    a, b = fingerprint(hashes, offsets)
                mark = np.zeros((2, len(part)), np.int64)
                mark[0, full], mark[1, full] = a.view(np.int64), b.view(np.int64)
                same = (mark[0] == part["set_a"].to_numpy()) & (mark[1] == part["set_b"].to_numpy())
                for k, (c, d, s) in enumerate(zip(part["cell"], part["doc"], part["side"], strict=True)):
                    if not same[k]:
                        continue
                    if c != cell:
                        if len(docs) > 1:
                            edges += close()
                        cell, docs, sides, sets = c, [], [], []
                    if docs and docs[-1] == d:
                        continue
                    docs.append(d)
                    sides.append(s)
                    sets.append(hashes[offsets[k] : offsets[k + 1]].copy())
            yield pd.DataFrame(edges, columns=["a", "b"], dtype=np.int64)
        if len(docs) > 1:
            yield pd.DataFrame(close(), columns=["a", "b"], dtype=np.int64)

    dealt = cells.repartition("cell").sortWithinPartitions("cell", "side", "doc")
    return dealt.mapInPandas(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trees: int = TREES, mark: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``; ``mark`` adds the text's xxhash64 as ``_mark``."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("mark"))
    signed = cut(signatures(plain, trees), "signed")
    own = ["set_a", "set_b", "n_shingles"]
    sets = signed.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()).groupBy(*own).agg(F.min("doc_id").alias("least"), F.min_by("mark", "doc_id").alias("mark"), F.first("tokens").alias("tokens"))
    classes = cut(sets.withColumn("doc", F.monotonically_increasing_id()), "classes")
    small, crowds = cells_of(classes.select("doc", "tokens"))
    small, crowds = cut(small, "small"), cut(crowds, "crowds")
    needed = small.select("doc").unionByName(crowds.select("doc")).distinct()
    marks = classes.select("doc", F.col("least").alias("doc_id"), "mark", "set_a", "set_b").join(shuffled(needed), "doc")
    texts = cut(plain.join(shuffled(marks), ["doc_id", "mark"]).select("doc", "text", "set_a", "set_b"), "texts")
    sizes = crowds.groupBy("leader").agg(F.count(F.lit(1)).alias("n"))
    spread = crowds.filter(F.col("leader") != F.col("doc")).join(sizes, "leader").withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    block = F.pmod(F.xxhash64("doc"), F.col("blocks"))
    in_block = spread.select(F.xxhash64(F.lit("crowd"), "leader", block).alias("cell"), "doc", F.lit(0).alias("side"))
    led = sizes.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / BLOCK) - 1)))
    led = led.select(F.xxhash64(F.lit("crowd"), "leader", "block").alias("cell"), F.col("leader").alias("doc"), F.lit(0).alias("side"))
    cells = small.select("cell", "doc", F.lit(0).alias("side")).unionByName(in_block).unionByName(led)
    edges = cut(compare(cells.join(shuffled(texts), "doc").select("cell", "doc", "side", "set_a", "set_b", "text")), "links")
    found = cut(components(edges), "components")
    rest = _outsiders(crowds, found)
    if rest is not None:
        more = compare(rest.join(shuffled(texts), "doc").select("cell", "doc", "side", "set_a", "set_b", "text"))
        found = _joined(found, cut(more.distinct(), "links"))
    of = classes.select(*own, "least", "doc").join(shuffled(found.withColumnRenamed("node", "doc")), "doc", "left").select(*own, "least", F.coalesce("component", "doc").alias("component"))
    eldest = of.groupBy("component").agg(F.min("least").alias("_component"))
    of_class = of.join(shuffled(eldest), "component").select(*own, "_component")
    out = signed.select("doc_id", "mark", *own).join(shuffled(of_class), own, "left")
    release(texts)
    component = F.when(F.col("n_shingles") > 0, F.col("_component")).otherwise(F.col("doc_id"))
    more = [F.col("mark").alias("_mark")] if mark else []
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"), *more)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))).select("doc_id", "n_shingles", "component_id", "kept", *(["_mark"] if mark else []))


def _joined(found: DataFrame, more: DataFrame) -> DataFrame:
    """Components after further links: only the components that those links join are settled anew."""
    if more.isEmpty():
        return found
    end = lambda c: shuffled(found.select(F.col("node").alias(c), F.col("component").alias(f"_{c}")))
    ends = more.join(end("a"), "a", "left").join(end("b"), "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    merged = cut(components(ends), "components").select(F.col("node").alias("component"), F.col("component").alias("_to"))
    fresh = more.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(shuffled(found), "node", "left_anti").withColumn("component", F.col("node"))
    return found.unionByName(fresh).join(shuffled(merged), "component", "left").select("node", F.coalesce("_to", "component").alias("component"))


def _outsiders(crowds: DataFrame, found: DataFrame) -> DataFrame | None:
    """Rows (cell, doc, side) that pair blocks of the classes outside their leader's component with blocks of the whole crowd."""
    own = found.select(F.col("node").alias("doc"), F.col("component").alias("mine"))
    lead = found.select(F.col("node").alias("leader"), F.col("component").alias("theirs")).join(crowds.select("leader").distinct(), "leader", "left_semi")
    all_ = crowds.join(shuffled(own), "doc", "left").join(lead, "leader", "left")
    all_ = cut(all_.select("leader", "doc", (F.coalesce("mine", "doc") != F.coalesce("theirs", "leader")).alias("outside")), "crowds")
    n = all_.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"), F.ceil(F.count_if("outside") / BLOCK).alias("outer")).filter("outer > 0")
    if n.isEmpty():
        return None
    sized = all_.join(n, "leader")
    all_of = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    whole = sized.select("leader", "doc", F.pmod(F.xxhash64("doc"), F.col("blocks")).alias("j"), all_of("outer").alias("i"), F.lit(1).alias("side"))
    outer = sized.filter("outside").select("leader", "doc", F.pmod(F.xxhash64(F.lit(7), "doc"), F.col("outer")).alias("i"), all_of("blocks").alias("j"), F.lit(0).alias("side"))
    rows = outer.select("leader", "i", "j", "doc", "side").unionByName(whole.select("leader", "i", "j", "doc", "side"))
    return rows.groupBy(F.xxhash64(F.lit("outside"), "leader", "i", "j").alias("cell"), "doc").agg(F.when(F.count(F.lit(1)) > 1, 2).otherwise(F.min("side")).alias("side"))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0),
sh AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN 's ' || array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS s FROM i),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY ALL),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least_of AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id, w.doc_id = least(w.doc_id, coalesce(m, w.doc_id)) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least_of ON least_of.a = w.doc_id
"""
