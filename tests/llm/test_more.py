"""Language, neighbours, pieces, quality, urls, chats, and the pipeline."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import ann, chat, langid, pieces, quality, urlfilter

from ..conftest import DATA


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = langid.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = out.filter("held_out")
    assert held.count() > 20 and held.filter("lang_pred = lang").count() / held.count() > 0.97


def test_forward_sums_all_segmentations():
    path = langid.vocabulary()
    sp = langid._processor(path)
    probs = np.random.default_rng(1).random((sp.get_piece_size(), 2)) / 50
    found = {sp.id_to_piece(i).replace("▁", " ").encode(): i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i):
            found.setdefault(bytes([int(sp.id_to_piece(i)[3:-1], 16)]), i)

    def total(w, k):
        return 1.0 if not w else sum(probs[found[w[:n]], k] * total(w[n:], k) for n in range(1, len(w) + 1) if w[:n] in found)

    words = [b" the", b" ab\xc3\xa9", b" z", b"thing"]
    got = langid.word_scores(words, path, probs)
    assert np.allclose(got, np.log([[total(w, k) for k in range(2)] for w in words]))
    assert np.isfinite(langid.word_scores([b" " + b"ab" * 32], path, probs)).all()


def forward(word, pieces, probs):
    """Log of the sum over all segmentations, one byte after the other."""
    alpha, shift = [np.ones(probs.shape[1])], np.zeros(probs.shape[1])
    for end in range(1, len(word) + 1):
        here = np.zeros(probs.shape[1])
        for size in range(1, min(end, 60) + 1):
            if (i := pieces.get(word[end - size : end])) is not None:
                here = here + alpha[end - size] * probs[i]
        alpha.append(here)
        if end % 7 == 0:
            alpha = [*alpha[:-60], *(a / here for a in alpha[-60:])]
            shift = shift + np.log(here)
    return np.log(alpha[-1]) + shift


@pytest.mark.parametrize("cells,alone,langs", [(4_000_000, 128, 64), (4_000_000, 1, 64), (200, 10**9, 2)])
def test_whole_words_of_any_length(monkeypatch, cells, alone, langs):
    """In passes, one by one in slices, and a few languages at a time."""
    for name, value in (("CELLS", cells), ("ALONE", alone), ("LANGS", langs), ("SLICE", 100)):
        monkeypatch.setattr(langid, name, value)
    path = langid.vocabulary()
    sp = langid._processor(path)
    known = {}
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i):
            known.setdefault(bytes([int(sp.id_to_piece(i)[3:-1], 16)]), i)
    for i in range(sp.get_piece_size()):
        if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)):
            known[sp.id_to_piece(i).replace("▁", " ").encode()] = i
    rng = np.random.default_rng(4)
    probs = rng.random((sp.get_piece_size(), 5)) ** 8 + 1e-9
    words = ["a", "日本語の文章には空白がない" * 9, "internationalisation" * 4, "ü" * 33, "x" * 200, "東京都" * 60, "http://example.org/" + "path/" * 90]
    words = [b" " + w.encode() for w in words]
    want = np.array([forward(w, known, probs) for w in words])
    assert np.allclose(langid.word_scores(words, path, probs), want, rtol=1e-9)


def test_whole_query_against_brute_force(spark):
    """Learning, posterior and verdict of every row, with texts without blanks and rows that teach nothing."""
    import math
    import zlib

    rng = random.Random(5)
    said = {"en": "the house stands by the river and the boat waits there".split(), "de": "das haus steht am fluss und das boot wartet dort über nacht".split(), "ja": ["川のほとりに家が建ちそこで船が待っている", "夜になると誰もいない" * 9]}
    rows = []
    for i in range(90):
        lang = rng.choice(list(said))
        rows.append((i, " ".join(rng.choices(said[lang], k=rng.randint(1, 6))), lang if i % 5 else None))
    rows += [(900, None, "en"), (901, "123 456", "de"), (902, "", None), (903, "z" * 300, None), (None, "the river", "en"), (4, "das boot", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sp = langid._processor(langid.vocabulary())
    letters = lambda t: any(c.isalpha() for c in t or "")
    taught = [(t, k) for i, t, k in rows if i is not None and zlib.crc32(str(i).encode()) % 4 != 2 and k and letters(t)]
    langs = sorted({k for _, k in taught})
    counts = np.zeros((sp.get_piece_size(), len(langs)))
    for t, k in taught:
        for w in t.split():
            for p in sp.encode(w):
                counts[p, langs.index(k)] += 1
    share = (counts + 1e-3) / (counts + 1e-3).sum(0)
    probs = (1 - langid.SMOOTH) * share + langid.SMOOTH * share.mean(1, keepdims=True)
    prior = np.array([math.log(sum(k == x for _, k in taught) / len(taught)) for x in langs])
    known = {}
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i):
            known.setdefault(bytes([int(sp.id_to_piece(i)[3:-1], 16)]), i)
    for i in range(sp.get_piece_size()):
        if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)):
            known[sp.id_to_piece(i).replace("▁", " ").encode()] = i
    want = []
    for i, t, _ in rows:
        held = i is not None and zlib.crc32(str(i).encode()) % 4 == 2
        if not letters(t):
            want.append((i, held, "und", 0.0))
            continue
        total = prior + sum(forward(b" " + w.encode(), known, probs) for w in t.split())
        k = int(total.argmax())
        want.append((i, held, langs[k], 1 / np.exp(total - total[k]).sum()))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[3])
    got = sorted(map(tuple, langid.language_id(df).collect()), key=key)
    want.sort(key=key)
    assert [r[:3] for r in got] == [r[:3] for r in want] and np.allclose([r[3] for r in got], [r[3] for r in want])


def test_more_languages_than_any_table_has(spark):
    """Every label is learned, one that few rows have too."""
    rows = [(i, f"word{i % 300} special{i % 300}", f"l{i % 300}") for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, prior, probs = langid.learn(df)
    assert len(langs) == 300 == probs.shape[1] == len(prior)


def test_language_odd_rows(odd, none):
    out = langid.language_id(odd).collect()
    assert len(out) == odd.count() and sorted(r["doc_id"] for r in out if r["lang_pred"] == "und") == [3, 4, 5]
    assert langid.language_id(none).count() == 0
    nothing = langid.language_id(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}


def test_neighbours_recall_and_ties(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(20, 16))
    x = (centre[rng.integers(20, size=1500)] + 0.3 * rng.normal(size=(1500, 16))).astype(np.float32)
    x[100:400] = x[7]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(9001, None), (9002, [0.0] * 16), (9003, [float("nan")] * 16), (9004, [float("inf")] * 16), (9005, [1.0]), (9006, []), (None, x[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = ann.nearest(df, df.filter("vec_id % 20 = 0")).toPandas()
    d = x.astype(float)
    hit = n = 0
    for q, g in out.groupby("query_id"):
        g = g.sort_values("rank")
        s = d @ d[q]
        order = [i for i in np.lexsort((np.arange(len(d)), -np.round(s, 9))) if i != q][:20]
        hit += len(set(order) & set(g["vec_id"]))
        n += 20
        assert g["rank"].tolist() == list(range(1, 21)) and np.allclose(g["score"], s[g["vec_id"]])
        if 100 <= q < 400:
            same = g[np.isclose(g["score"], s[q])]["vec_id"].tolist()
            assert same == sorted(same)
    assert n == 75 * 20 and hit / n >= 0.9


def test_neighbours_of_few(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (5, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r["query_id"], r["vec_id"], r["rank"]) for r in ann.nearest(df, df).orderBy("query_id").collect()] == [(0, 5, 1), (5, 0, 1)]
    assert ann.nearest(df.filter("false"), df).count() == 0


def test_neighbours_with_odd_rows_and_columns(spark):
    """Ids that repeat count once, vectors that take no part stay out, and extra columns may have any names."""
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.9, 0.1]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, []), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("query_id", "rank", "score", "v", "leaf", "entry", "mark")})
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in ann.nearest(df, df.filter("vec_id = 0 OR vec_id = 3")).collect()}
    assert got == {(0, 1): (1, 0.5), (0, 2): (8, 0.0)}


def test_pieces_match_the_library(spark, odd, none):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.vocabulary())
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").limit(40)
    extra = odd.filter("doc_id > 2").select((-F.col("doc_id")).alias("doc_id"), "text")
    wide = [(-60 - n, "Umgangssprachlichkeitsbeauftragtenversammlungsprotokollführerin"[: n % 8 + 3] * 20) for n in range(8)]
    extra = extra.unionByName(odd.sparkSession.createDataFrame([(i, t[: 50 + -i % 21]) for i, t in wide], "doc_id long, text string"))
    docs = docs.unionByName(extra).unionByName(spark.createDataFrame([(-50, "  a  b "), (-51, "a▁b"), (-52, "ab1" * 90)], "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    coded = pieces.encode(docs).persist()
    assert {r["doc_id"]: r["ids"] for r in coded.collect()} == {i: sp.encode(t) for i, t in texts.items()}
    assert {r["doc_id"]: r["text"] for r in pieces.decode(coded).collect()} == {i: t.replace("▁", " ") for i, t in texts.items()}
    assert pieces.encode(none).count() == 0


def test_pieces_of_rows_that_repeat_an_id(spark):
    """Rows of one id keep their own pieces, equal rows come back as often, and a null id has no result."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.vocabulary())
    rows = [(1, "alpha beta gamma"), (1, "one two three"), (2, "the same text"), (2, "the same text"), (3, None), (None, "lost")]
    coded = pieces.encode(spark.createDataFrame(rows, "doc_id long, text string")).persist()
    want = sorted((i, sp.encode(t or "")) for i, t in rows if i is not None)
    assert sorted((r["doc_id"], r["ids"]) for r in coded.collect()) == want
    assert sorted((r["doc_id"], r["text"]) for r in pieces.decode(coded).collect()) == sorted((i, t or "") for i, t in rows if i is not None)


@pytest.mark.parametrize("wide", [60, 50])
def test_fold_and_queue_agree(spark, monkeypatch, wide):
    """Units of 50 to 60 characters by the fold and by the queue; the library gives the same ids."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.vocabulary())
    monkeypatch.setattr(pieces, "WIDE", wide)
    rng = random.Random(8)
    words = ["".join(rng.choice("thenarioucksde") for _ in range(rng.randint(50, 70))) for _ in range(60)] + ["ü" * 58 + "x", "th" * 28, "日本" * 27]
    rows = [(i, w) for i, w in enumerate(words)]
    coded = pieces.encode(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["ids"] for r in coded.collect()} == {i: sp.encode(w) for i, w in rows}


def brute_quality(text):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    marked = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if any(c not in " \t\x0b\x0c\r" for c in x)]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(marked)


def test_quality_counts_and_fences(spark, odd, none):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["a", "bb", "#c", "d|", "e\nf"]) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    rows += [(r["doc_id"], r["text"]) for r in odd.filter("doc_id <> 6").collect()]
    df = spark.createDataFrame([(i, t, "x", None) for i, t in rows], "doc_id long, text string, lang string, source string")
    got = sorted((tuple(r)[1:6] for r in quality.quality_rules(df).collect()))
    assert got == sorted(brute_quality(t) for _, t in rows)
    clean = [(i, " ".join(rng.choice(["some", "plain", "words", "here"]) + str(rng.random())[2:6] for _ in range(60)), "en", "s") for i in range(200)]
    junk = [(1000 + i, " ".join("$$##" + str(rng.random())[2:6] for _ in range(60)), "en", "s") for i in range(5)]
    out = quality.quality_rules(spark.createDataFrame(clean + junk, df.schema))
    assert out.filter("doc_id < 1000 AND NOT kept").count() == 0 and out.filter("doc_id >= 1000 AND kept").count() == 0
    assert quality.quality_rules(none).count() == 0 and quality.quality_rules(odd).count() == odd.count()


def test_sketches_merge(spark):
    d = spark.range(1000).select((F.col("id") % 3).alias("k"), *[(F.col("id") * 7 % 991).alias(m) for m in quality.MEASURES])
    whole = quality.quantiles(quality.sketches(d.withColumn("k", F.lit(0)), ("k",)), ("k",), (25, 75)).select("n", "q25", "q75")
    merged = quality.quantiles(quality.sketches(d, ("k",)).withColumn("k", F.lit(0)), ("k",), (25, 75)).select("n", "q25", "q75")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect()))
    exact = sorted(i * 7 % 991 for i in range(1000))
    r = whole.first()
    assert abs(r["q25"] - exact[249]) <= exact[249] / 64 + 1 and abs(r["q75"] - exact[749]) <= exact[749] / 64 + 1


def test_thresholds_differ_by_group(spark):
    """A source where symbols are usual keeps them; elsewhere the same texts go; a group's word lengths set its own fences."""
    rng = random.Random(9)
    plain = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(max(1, n + rng.randint(-1, 1)))) for _ in range(60))
    coded = lambda n: plain(n) + " " + "| $ " * 12
    rows = [(i, plain(5), "en", "prose") for i in range(200)] + [(1000 + i, coded(5), "en", "prose") for i in range(6)]
    rows += [(2000 + i, coded(5) if i % 2 else plain(5), "en", "code") for i in range(200)]
    rows += [(3000 + i, plain(9), "de", "prose") for i in range(200)] + [(4000 + i, plain(9), "en", "prose") for i in range(3)] + [(5000, plain(5), "de", "prose")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    gone = {r["doc_id"] for r in quality.quality_rules(df).filter("NOT kept").collect()}
    assert gone == {*range(1000, 1006), *range(4000, 4003), 5000}
    rated = quality.measures(df).select("*", *quality._rates())
    limits = {(r["lang"], r["source"]): r for r in quality.fences(quality.sketches(rated, ("lang", "source")), ("lang", "source")).collect()}
    assert limits["en", "prose"]["hi_symbol_rate"] < limits["en", "code"]["hi_symbol_rate"] and limits["en", "prose"]["hi_word_length"] < limits["de", "prose"]["hi_word_length"]


def test_url_rules_and_propagation(spark, monkeypatch):
    link = lambda *u: "".join(f"<a href='{x}'>x</a>" for x in u)
    rows = [
        (1, "http://A.Example.NET/en/x?q#f", None),
        (2, "https://spam.net/x", link("//mid.org/a")),
        (3, "http://mid.org/p", link("https://spam.net/", "/local")),
        (4, "http://friend.org/p", None),
        (5, "http://good.org/fr/a", link("http://friend.org/")),
        (6, None, None),
        (7, "no scheme", None),
        (8, "http://example.com/de/x", None),
        (9, "http://example.com/en", None),
        (10, "http://x.net", None),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    monkeypatch.setattr(urlfilter, "ITERATIONS", 9)

    def run():
        return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.url_filter(df).collect()}

    got = run()
    assert got[1] == ("a.example.net", "/en/x", "example.net/en/", "allow") and got[2][2:] == ("net/", "block")
    assert got[3][2:] == (None, "block") and got[4][2:] == (None, "allow") and got[5][2:] == ("org/fr/", "allow")
    assert got[6] == got[7] == ("", "", None, "allow") and got[8][3] == "block" and got[9][2:] == (None, "allow") and got[10][1:3] == ("", None)
    monkeypatch.setattr(urlfilter, "INLINE_RULES", 0)
    assert run() == got
    import duckdb

    pages = df.toPandas()  # noqa: F841
    sql = duckdb.sql(urlfilter.oracle_sql()).fetchall()
    assert {r[0]: (r[1], r[2], r[3], r[4]) for r in sql} == got
    assert urlfilter.url_filter(df.filter("false")).count() == 0


def test_a_hub_of_blocked_hosts(spark, monkeypatch):
    """Masses of many seeds meet in one host, its links are dealt out, and SQL agrees on every verdict."""
    import duckdb

    monkeypatch.setattr(urlfilter, "ITERATIONS", 6)
    monkeypatch.setattr(urlfilter, "FAN", 100)
    hub = "".join(f"<a href='http://h{i}.net/x'>" for i in range(12_000)) + "<a href='http://tail.com/'>"
    rows = [(0, "http://hub.com/", hub), (0, "http://hub.com/" + "a" * 50_000, "<p>" * 100_000), (1, "http://tail.com/", "<a href='http://hub.com/'>"), (2, "http://far.com/", None)]
    rows += [(10 + i, f"http://h{i}.net/", "<a href='http://hub.com/'>" if i % 2 else None) for i in range(0, 12_000, 7)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"verdict": F.lit(1), "mass": F.lit(2), "here": F.lit(3)})
    got = sorted((r["page_id"], r["verdict"]) for r in urlfilter.url_filter(df).select("page_id", "verdict").collect())
    pages = df.toPandas()  # noqa: F841
    assert got == sorted((r[0], r[4]) for r in duckdb.sql(urlfilter.oracle_sql()).fetchall())
    assert got[:4] == [(0, "block"), (0, "block"), (1, "block"), (2, "allow")]


def test_masses_settle(spark):
    """Further steps add less than a thousandth of the seeds' mass."""
    links = spark.createDataFrame([("a", "b", 1), ("b", "c", 1), ("c", "a", 2), ("b", "a", 1)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("a", "t")], "host string, kind string")
    mass = lambda n: {r["host"]: r["trust"] for r in urlfilter.propagate(links, seeds, n).collect()}
    few, many = mass(urlfilter.ITERATIONS), mass(urlfilter.ITERATIONS + 8)
    assert sum(many.values()) - sum(few.values()) < urlfilter.SEED / 1000 and all(many[h] >= few[h] > 0 for h in few)


def test_chats_collapse(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 3)
    talk = [("user", "hi"), ("assistant", "yes"), ("user", "why"), ("assistant", "so"), ("user", "ok <|im_end|>"), (None, None), ("user", "bye")]
    rows = [(c, i, *t) for c, n in ((1, 2), (2, 7), (3, 4), (4, 7)) for i, t in enumerate(talk[:n])]
    rows += [(5, 0, "user", "hi"), (5, 1, "assistant", "no"), (5, 1, "assistant", "no"), (6, None, "user", "alone"), (None, 0, "user", "lost")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {}
    for r in chat.chat_format(df).orderBy("conv_id", "part").collect():
        out.setdefault(r["conv_id"], []).append(r)
    assert sorted(out) == [2, 5, 6] and [len(out[c]) for c in (2, 5, 6)] == [3, 1, 1]
    whole = "".join(r["rendered"] for r in out[2])
    assert whole.count("<|im_start|>") == 7 == whole.count("<|im_end|>") and "<|im_start|>unknown\n<|im_end|>\n" in whole
    assert out[2][0]["n_equal"] == 2 and out[5][0]["n_turns"] == 2
    assert chat.chat_format(df.filter("false")).count() == 0


def test_chats_with_long_texts_and_extra_columns(spark):
    long = "word " * 200_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", "yes"), (2, 0, "user", long), (3, 0, "", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("pos", "n", "h1", "block", "piece", "part", "rendered")})
    out = {r["conv_id"]: r for r in chat.chat_format(df).collect()}
    assert set(out) == {1, 3} and out[1]["rendered"] == f"<|im_start|>user\n{long}<|im_end|>\n<|im_start|>assistant\nyes<|im_end|>\n" and out[3]["n_turns"] == 1


def brute_language(docs, rows):
    """The language stage's decisions: the same learned numbers, every word summed byte by byte."""
    langs, prior, probs = langid.learn(docs.filter(langid.remainder("doc_id") != 2).select("doc_id", "text", "lang"))
    sp = langid._processor(langid.vocabulary())
    known = {}
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i):
            known.setdefault(bytes([int(sp.id_to_piece(i)[3:-1], 16)]), i)
    for i in range(sp.get_piece_size()):
        if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)):
            known[sp.id_to_piece(i).replace("▁", " ").encode()] = i
    scores = {w: forward(b" " + w.encode(), known, probs) for w in {w for _, t in rows for w in (t or "").split()}}
    out = {}
    for i, t in rows:
        if any(c.isalpha() for c in t or ""):
            total = prior + sum(scores[w] for w in t.split())
            k = int(total.argmax())
            if 1 / np.exp(total - total[k]).sum() >= 0.5:
                out[i] = langs[k]
    return out


def brute_lines(rows):
    """Texts without the lines that stand within three edits of an earlier one."""
    from .test_line_edits import distance

    seen, out = {}, {}
    for i, t in sorted(rows):
        keep = []
        for line in t.split("\n"):
            n = len(line)
            if n < 20:
                keep.append(line)
                continue
            near = [x for m in range(n - 3, n + 4) for x in seen.get(m, ())]
            quarter = [line[k * (n // 4) : (k + 1) * (n // 4)] for k in range(4)]
            if not any(x == line or (any(q in x for q in quarter) or len(x) < n) and distance(x, line) <= 3 for x in near):
                keep.append(line)
            seen.setdefault(n, set()).add(line)
        out[i] = "\n".join(keep)
    return {i: t for i, t in out.items() if t.strip(" \t\n\x0b\x0c\r")}


def brute_repeats(rows, width=100):
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = t.encode()
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            w = b[p : p + width]
            if w in seen:
                gone[p : p + width] = b"\1" * width
            seen.add(w)
        out[i] = bytes(x for x, g in zip(b, gone, strict=True) if not g).decode("utf-8", "ignore")
    return {i: t for i, t in out.items() if t.strip(" \t\n\x0b\x0c\r")}


def test_pipeline_stages(spark):
    """Each stage against a brute-force version on its own input."""
    import corpus_pipeline as cp
    from tickloom.llm.packing import encoder, piece_lengths, vocabulary

    from .test_neardup import brute as near_brute

    first = docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = lambda d: [(r["doc_id"], r["text"]) for r in d.collect()]
    steps = [texts(docs)]
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, DATA).persist()
        assert docs.columns == list(cp.COLUMNS) and docs.filter("n_chars <> length(text)").count() == 0
        steps.append(texts(docs))
        if len(steps) == 2:
            assert {r["doc_id"]: r["lang"] for r in docs.collect()} == brute_language(first, steps[0])
    assert dict(steps[2]) == brute_lines(steps[1])
    assert {i for i, *_, kept in near_brute(steps[2]) if kept} == {i for i, _ in steps[3]} and set(steps[3]) <= set(steps[2])
    assert dict(steps[4]) == brute_repeats(steps[3])
    out = cp.STAGES[-1][1](spark, docs, DATA)
    encode = encoder(vocabulary())
    assert out.count() == sum(len(piece_lengths(len(encode(t)) + 1)) for _, t in steps[4])


@pytest.mark.parametrize("stage", range(5))
def test_pipeline_stages_of_nothing(spark, odd, none, stage):
    import corpus_pipeline as cp

    make = lambda d: d.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
    assert cp.STAGES[stage][1](spark, make(none), "").count() == 0
    assert cp.STAGES[stage][1](spark, make(odd), "").count() > 0
