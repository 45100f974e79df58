from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import packing


def test_lengths():
    assert packing.piece_lengths(5000) == [2048, 2048, 512, 256, 128, 8]
    assert packing.piece_lengths(2048) == [2048] and packing.piece_lengths(1) == [1]


def test_round_trip(odd):
    """Pieces in order are the ids of the tokenizers library, each id once, and the checksums match."""
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = packing.pack(odd).withColumn("crc", F.crc32("ids")).toPandas()
    want = sorted([*own.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in odd.collect())
    got, current = [], None
    for r in out.sort_values(["sequence_id"]).itertuples():
        ids = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert len(ids) == r.length == 1 << r.bucket and r.offset == 0 and zlib.crc32(r.ids) == r.crc
        current = ids if r.start == 0 else current + ids
        assert r.start == len(current) - len(ids)
        if len(current) == r.doc_tokens:
            got.append(current)
    assert sorted(got) == want and out["sequence_id"].is_unique


@pytest.mark.parametrize("text", ["a<|endoftext|>b", " <|endoftext|><|endoftext|> x", "a" + " " * 1_200_000 + "b", "\n" * 1_000_001, "z" * 300_000 + " \u3000" * 60_000, "7" * 200_000])
def test_ids_are_the_librarys_on_hard_texts(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.encoder(path)(text) == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_a_vocabulary_of_another_kind(odd):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    own = Tokenizer.from_file(path)
    out = packing.pack(odd.filter("doc_id = 1"), vocab=path).orderBy("start").toPandas()
    want = [*own.encode(odd.filter("doc_id = 1").first()["text"], add_special_tokens=False).ids, 1]
    assert [i for x in out["ids"] for i in np.frombuffer(x, dtype="<u4").tolist()] == want


def test_empty_and_buckets(none, odd, tmp_path):
    assert packing.pack(none).count() == 0
    packing.write_buckets(packing.pack(odd), str(tmp_path / "b"))
    assert odd.sparkSession.read.parquet(str(tmp_path / "b")).count() == packing.pack(odd).count()
    with pytest.raises(ValueError):
        packing.pack(odd, max_len=1000)
