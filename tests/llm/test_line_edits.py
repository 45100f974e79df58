"""Line deduplication beyond one edit, against the full edit-distance table."""

from __future__ import annotations

import random

import pytest

from tickloom.llm import linededup


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("edits,crowd", [(3, 64), (3, 1), (2, 64)])
def test_against_brute_force(spark, monkeypatch, edits, crowd):
    monkeypatch.setattr(linededup, "CROWD", crowd)
    monkeypatch.setattr(linededup, "PRODUCT", 3 if crowd == 1 else 4096)
    rng = random.Random(edits)
    base = ["".join(rng.choice("abcd") for _ in range(rng.randint(18, 30))) for _ in range(10)]

    def edit(s):
        k = rng.randrange(len(s))
        return rng.choice([s[:k] + s[k + 1 :], s[:k] + rng.choice("zab") + s[k:], s[:k] + rng.choice("abé") + s[k + 1 :]])

    places = []
    for i in range(50):
        for n in range(3):
            line = rng.choice(base)
            for _ in range(rng.randint(0, edits + 2)):
                line = edit(line)
            places.append((i, n, line))
    df = spark.createDataFrame([(i, "\n".join(x for j, _, x in places if j == i)) for i in range(50)], "doc_id long, text string")
    want = {i: [] for i in range(50)}
    for k, (i, _, line) in enumerate(places):
        if len(line) < linededup.MIN_CHARS or not any(len(x) >= linededup.MIN_CHARS and distance(x, line) <= edits for _, _, x in places[:k]):
            want[i].append(line)
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(df, edits=edits).collect()}
    assert got == {i: "\n".join(v) for i, v in want.items()} and 0 < sum(map(len, want.values())) < len(places)


def test_rows_that_repeat_an_id_are_documents_of_their_own(spark):
    """A line goes from the row that holds a later copy of it and from no other row of that id."""
    line, other = "the harbour wall was built from grey stone in spring", "nothing here resembles any line that stands elsewhere"
    rows = [(1, line), (2, line.replace("grey", "gray")), (2, other), (2, other)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["text"], r["_lines"]["n_removed"]) for r in linededup.dedup_lines(df, edits=3).collect())
    assert got == sorted([(1, line, 0), (2, "", 1), (2, other, 0), (2, other, 0)])


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_verifier_against_the_full_table(spark, edits):
    rng = random.Random(edits)
    pairs = []
    for _ in range(400):
        a = b = "".join(rng.choice("abé") for _ in range(rng.randint(1, 30)))
        for _ in range(rng.randint(0, 5)):
            k = rng.randrange(len(b) + 1)
            b = rng.choice([b[:k] + b[k + 1 :], b[:k] + "c" + b[k:], b[:k] + "a" + b[k + 1 :]])
        pairs.append((a, b or "x"))
    df = spark.createDataFrame(pairs, "a string, b string")
    told = df.selectExpr("a", "b", f"{linededup.within('a', 'b', edits)} AS ok").collect()
    assert all(r["ok"] == (distance(r["a"], r["b"]) <= edits) for r in told) and any(r["ok"] for r in told)


def test_a_document_of_very_many_lines(spark):
    rows = [(1, "\n".join(f"line number {i} of a very long document" for i in range(30_000)))]
    got = linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), edits=0).first()
    assert got["text"] == rows[0][1] and got["_lines"]["n_lines"] == 30_000


def test_the_pipeline_takes_out_a_line_three_edits_away(spark):
    import corpus_pipeline

    line = "The ferry leaves the northern quay at seven and returns before the evening tide"
    rows = [(1, line, "en", "s", len(line)), (2, line.replace("seven", "sevens").replace("quay", "bay") + "\nAnother line that nothing else resembles in any way", "en", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, df, "").collect()}
    assert distance(line, rows[1][1].split("\n")[0]) == 3
    assert got == {1: line, 2: "Another line that nothing else resembles in any way"}


@pytest.mark.parametrize("edits", [1, 3])
def test_slices_lose_no_pair_within_the_threshold(spark, edits):
    rng = random.Random(edits)
    pairs = []
    for _ in range(300):
        a = b = "".join(rng.choice("abé ") for _ in range(rng.randint(10, 500)))
        for _ in range(edits):
            k = rng.randrange(len(b))
            b = rng.choice([b[:k] + b[k + 1 :], b[:k] + "c" + b[k:], b[:k] + "é" + b[k + 1 :]])
        pairs.append((a, b))
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pairs)], "id long, x string, y string")
    elder = linededup._sliced(df.select("id", df.x.alias("line")), edits).selectExpr("id", "width AS w", "cuts AS c")
    met = elder.join(linededup._sliced(df.select("id", df.y.alias("line")), edits), "id")
    assert met.selectExpr(f"{linededup._fitting(edits)} AS ok").filter("NOT ok").count() == 0


def test_a_crowd_of_distant_copies_makes_few_pairs(spark, monkeypatch):
    """Copies with four letters put in at places of their own are eight edits apart; their texts are not read pair by pair."""
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(480))
    lines = [base[: 8 * i] + "".join(rng.choice("etaoin") for _ in range(4)) + base[8 * i :] for i in range(60)]
    asked, verify = [], linededup._verified
    monkeypatch.setattr(linededup, "_verified", lambda pairs, *rest: asked.append(pairs.count()) or verify(pairs, *rest))
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r["doc_id"] for r in linededup.dedup_lines(df, edits=3).collect() if r["text"]}
    want = {i for i, x in enumerate(lines) if not any(distance(y, x) <= 3 for y in lines[:i])}
    assert got == want and len(want) > 50 and len(asked) == 2 and asked[1] < 60 * 59 / 2 / 4, asked


def test_only_pairs_within_the_threshold_leave_a_crowd(spark, monkeypatch):
    """Copies with a word of their own are four to ten edits apart, too close for slices to tell; no such pair is written or sent on."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("etaoin") for _ in range(6))
    words = [word() for _ in range(60)]
    lines = [" ".join([*words[: 20 + i % 12], word()[: 4 + i % 3], *words[21 + i % 12 :]]) for i in range(60)]
    asked, verify = [], linededup._verified
    monkeypatch.setattr(linededup, "_verified", lambda pairs, *rest: asked.append(pairs.count()) or verify(pairs, *rest))
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r["doc_id"] for r in linededup.dedup_lines(df, edits=3).collect() if r["text"]}
    close = [[j for j in range(i) if distance(lines[j], lines[i]) <= 3] for i in range(60)]
    assert got == {i for i in range(60) if not close[i]}
    assert len(asked) == 2 and asked[1] <= sum(map(bool, close)), asked
