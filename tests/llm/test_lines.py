from __future__ import annotations

import random

import pytest

from tickloom.llm import linededup


def near(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[k + 1 :] == b[k + 1 :] or a[k + 1 :] == b[k:] or a[k:] == b[k + 1 :] or a == b


def brute(rows, least):
    places = [(i, n, line) for i, t in sorted(rows) for n, line in enumerate(t.split("\n"))]
    out = {i: [] for i, _ in rows}
    for k, (i, _, line) in enumerate(places):
        if len(line) < least or not any(len(x) >= least and near(x, line) for _, _, x in places[:k]):
            out[i].append(line)
    return {i: "\n".join(v) for i, v in out.items()}


@pytest.mark.parametrize("crowd", [64, 1])
def test_against_brute_force(spark, monkeypatch, crowd):
    """With CROWD at 1 every shared key goes through all rounds."""
    monkeypatch.setattr(linededup, "CROWD", crowd)
    monkeypatch.setattr(linededup, "PRODUCT", 3 if crowd == 1 else 4096)
    rng = random.Random(2)
    base = ["".join(rng.choice("abc") for _ in range(rng.randint(18, 26))) for _ in range(12)]

    def edit(s):
        k = rng.randrange(len(s))
        return rng.choice([s[:k] + s[k + 1 :], s[:k] + "z" + s[k:], s[:k] + rng.choice("abc") + s[k + 1 :]])

    lines = lambda: [edit(edit(x)) if rng.random() < 0.3 else edit(x) if rng.random() < 0.5 else x for x in rng.choices([*base, "short"], k=4)]
    rows = [(i, "\n".join(lines())) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(df).collect()}
    assert got == brute(rows, linededup.MIN_CHARS)


def test_odd_rows(odd, none):
    out = linededup.dedup_lines(odd)
    rows = out.collect()
    assert out.columns == [*odd.columns, "_lines"] and len(rows) == odd.count()
    by = {(r["doc_id"], r["_lines"]["n_lines"]): r["text"] for r in rows}
    assert by[(3, 0)] is None and by[(4, 1)] == ""
    assert {r["text"] for r in rows if r["doc_id"] is None} == {"a row without an id but with some words in it"}
    assert linededup.dedup_lines(none).count() == 0


def test_no_python_in_the_plan(odd):
    plan = linededup.dedup_lines(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
