from __future__ import annotations

import hashlib
import random

import pytest

from tickloom.llm import repeats


def brute(spark, rows, width=repeats.WIDTH):
    """Every window by set lookup, documents in order of id (null first) and hash of the text."""
    seen, out = set(), []
    hashes = {r["text"]: r["h"] for r in spark.createDataFrame([(t,) for _, t in rows], "text string").selectExpr("text", "xxhash64(text) AS h").collect()}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]])):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            w = b[p : p + width]
            if w in seen:
                gone[p : p + width] = b"\1" * width
            seen.add(w)
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, block, hot):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = repeats.remove_repeats(df, block_bytes=block, hot=hot).collect()
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in out), key=str)


def test_longest_previous_factors():
    """Against the definition: the longest common prefix with any suffix that starts earlier."""
    import numpy as np

    rng = random.Random(11)
    for n in (0, 1, 2, 40, 200):
        t = "".join(rng.choice("ab") for _ in range(n))
        suffixes = sorted(range(n), key=lambda i: t[i:])
        common = lambda i, j: next((k for k, (x, y) in enumerate(zip(t[i:], t[j:], strict=False)) if x != y), min(n - i, n - j))
        lcp = np.array([0] * min(n, 1) + [common(a, b) for a, b in zip(suffixes, suffixes[1:], strict=False)], dtype=np.int64)
        got = repeats.longest_previous(np.array(suffixes, dtype=np.int64), lcp)
        assert dict(zip(suffixes, got.tolist(), strict=True)) == {i: max((common(i, j) for j in range(i)), default=0) for i in range(n)}


def test_windows_in_parts(monkeypatch):
    import numpy as np

    monkeypatch.setattr(repeats, "SORTED", 50)
    rng = random.Random(2)
    text = "".join(rng.choice("ab") for _ in range(150)) * 3 + "c" * 130
    buf = np.frombuffer(text.encode(), dtype=np.uint8)
    n = len(text) - repeats.WIDTH + 1
    got = repeats.covered_windows(buf, np.array([0, 200]), np.array([200, n - 200]), np.arange(n))
    assert got.tolist() == [text[i : i + 100] in {text[j : j + 100] for j in range(i)} for i in range(n)]


@pytest.mark.parametrize(("block", "hot"), [(3_000, repeats.HOT), (10**9, repeats.HOT), (3_000, 1), (500, 3)])
def test_against_brute_force(spark, odd, block, hot):
    rng = random.Random(5)
    say = lambda n: "".join(rng.choice("ab é") for _ in range(n))
    shared, line = say(300), say(99)
    rows = [(i, say(rng.randint(0, 200)) + rng.choice([shared, shared[40:220], line, ""]) + say(rng.randint(0, 150))) for i in range(60)]
    rows += [(100, "ab" * 400), (101, "a" * 500), (102, shared * 3), (103, shared), (104, shared)]
    rows += [(r["doc_id"], r["text"]) for r in odd.collect()]
    rows += [(7, say(120) + shared[:150]) for _ in range(30)] + [(None, shared[10:260] + say(40)) for _ in range(20)]
    assert run(spark, rows, block, hot) == brute(spark, rows)
    digests = repeats.repeat_digests(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=block)
    assert hot != repeats.HOT or sorted((tuple(r) for r in digests.collect()), key=str) == brute(spark, rows)


def test_texts_and_carried_columns(spark, odd, none):
    out = repeats.strip_repeats(odd, carry=("lang", "source", "kept"))
    assert out.columns == ["doc_id", "text", "lang", "source", "kept"] and out.count() == odd.count()
    assert {r["text"] for r in out.collect() if r["doc_id"] == 9} == {"short"}
    assert repeats.remove_repeats(none).count() == 0


def test_cut_characters_go(spark):
    t = "é" * 60
    out = repeats.strip_repeats(spark.createDataFrame([(1, t), (2, "x" + t + "yé")], "doc_id long, text string"))
    assert {r["doc_id"]: r["text"] for r in out.collect()}[2] == "xyé"
