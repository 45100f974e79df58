"""Fences of rates that are zero in most texts."""

from __future__ import annotations

from tickloom.llm import quality


def test_a_text_far_outside_its_group_is_rejected(spark):
    """39 % duplicate lines, where other texts of the group have at most 8 %."""

    def text(k, copies):
        rest = iter(range(1000))
        one = lambda: " ".join(f"{k:03d}{next(rest):03d}" for _ in range(3))
        same = one()
        return "\n".join(same if j % 2 == 0 and j // 2 <= copies and copies else one() for j in range(100))

    copies = [0] * 140 + [4 + k % 5 for k in range(60)] + [39]
    df = spark.createDataFrame([(k, text(k, n), "en", "s") for k, n in enumerate(copies)], "doc_id long, text string, lang string, source string")
    out = quality.quality_rules(df).collect()
    assert {r["n_dup_lines"] for r in out} == set(copies) and not any(r["base_failed"] for r in out)
    assert {r["doc_id"] for r in out if not r["kept"]} == {200}
