from __future__ import annotations

import random
import re
import sys

import pytest

from tickloom.llm import neardup
from tickloom.llm.components import components
from tickloom.llm.shingles import shingle_sets

components_module = sys.modules[components.__module__]


def brute(rows):
    sets = {}
    for i, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for c in "\t\n\x0b\x0c\r":
            w = w.replace(c, " ")
        w = [x for x in w.split(" ") if x]
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                comp[y] = x
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


def corpus(rng, n):
    words = [f"w{k}" for k in range(400)]
    common = [rng.choice(words) for _ in range(14)]
    base = [[rng.choice(words) for _ in range(rng.randint(30, 80))] for _ in range(6)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.5:
            b = list(rng.choice(base))
            for _ in range(rng.randint(0, 3)):
                b[rng.randrange(len(b))] = rng.choice(words)
        elif kind < 0.8:
            b = common + [rng.choice(words) for _ in range(rng.randint(0, 30))]
        else:
            b = [rng.choice(words) for _ in range(rng.randint(0, 9))]
        rows.append((i, " ".join(w.upper() if rng.random() < 0.1 else w for w in b)))
    return rows


@pytest.mark.parametrize("node", [64, 4])
def test_against_brute_force(spark, monkeypatch, node):
    """With small nodes every document passes through branching and crowds."""
    monkeypatch.setattr(neardup, "NODE", node)
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rows = corpus(random.Random(3), 160)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in neardup.near_duplicates(df).collect()) == brute(rows)


def test_tables_that_grow_with_the_corpus_are_not_broadcast(spark, monkeypatch):
    """Only tables with one row per large node or crowd may be built in the driver; the plans are those of small tables under Spark's own threshold."""
    keys, write = set(), components_module.cut

    def cut(df, label):
        keys.update(re.findall(r"Broadcast(?:Hash|NestedLoop)Join \[(\w+?)#", df._jdf.queryExecution().executedPlan().toString()))
        return write(df, label)

    monkeypatch.setattr(neardup, "NODE", 4)
    monkeypatch.setattr(neardup, "BLOCK", 16)
    for module in (neardup, components_module):
        monkeypatch.setattr(module, "cut", cut)
    rows = corpus(random.Random(3), 160)
    cut(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), "out")
    assert keys <= {"node", "leader"}


def test_rows_that_repeat_an_id_are_linked_by_their_own_texts(spark):
    text = lambda p: " ".join(f"{p}{i}" for i in range(40))
    near = lambda p: text(p) + f" {p}more"
    df = spark.createDataFrame([(1, text("a")), (2, text("q")), (2, near("a")), (3, near("q")), (2, near("a"))], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(df).collect())
    assert got == sorted([(1, 36, 1, True), (2, 36, 2, True), (2, 37, 1, False), (3, 37, 2, False), (2, 37, 1, False)])


def test_misses_of_branched_trees():
    """Draws which tokens of a pair at similarity 0.75 agree, and in how many draws no tree keeps it together in small nodes after 0, 1 and 2 branchings."""
    import numpy as np

    rng, n, t = np.random.default_rng(1), 400_000, neardup.TREES
    found, branch = rng.random((n, t)) < 0.75, rng.random((n, t)) < 0.75
    missed = [(~found.any(1)).mean()]
    for pair in neardup.BRANCHES:
        found = found & (branch[:, (np.arange(t) + pair[0]) % t] | branch[:, (np.arange(t) + pair[1]) % t])
        missed.append((~found.any(1)).mean())
    assert missed[0] < 1e-5 and missed[1] < 1e-5 and missed[2] < 2.5e-4


def test_odd_rows(odd, none):
    out = neardup.near_duplicates(odd).collect()
    assert len(out) == odd.count()
    empty = [r for r in out if r["n_shingles"] == 0]
    assert sorted(r["doc_id"] for r in empty) == [3, 4, 5] and all(r["kept"] and r["component_id"] == r["doc_id"] for r in empty)
    assert {r["component_id"] for r in out if r["doc_id"] == 1} == {1} and [r["kept"] for r in out if r["doc_id"] is None] == [True]
    assert neardup.near_duplicates(none).count() == 0


def test_shingles_ignore_blanks_and_case():
    a, o = shingle_sets(["A b\tc\nd  e f", "a B c d e f", "a b", "b a", None])
    sets = [a[o[i] : o[i + 1]].tolist() for i in range(5)]
    assert sets[0] == sets[1] and len(sets[0]) == 2 and sets[2] != sets[3] and sets[4] == []


def test_components(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 102), (102, 100)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(path, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 104), 100)}
