import random

import pytest

from studyloom.llm import mixing

DOC, GOAL = "doc_id long, source string, text string, tokens long, copies long", "source string, target_share double, max_repeats int"


def test_tokens_of_long_texts_are_counted_in_slices(monkeypatch):
    text = "word and line\n" * 50
    whole = mixing.count_tokens(text)
    monkeypatch.setattr(mixing, "SLICE", 100)
    assert whole == mixing.count_tokens(text) > 0 and mixing.count_tokens(None) == mixing.count_tokens("") == 0


def docs(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["big", "big", "big", "mid", "small", None, "other"]), "some words of text " * rng.randint(1, 9), 0, 0) for i in range(3000)]
    return spark.createDataFrame([*rows, (9999, "mid", None, 0, 0), (9998, "mid", "", 0, 0)], DOC)


GOALS = [("big", 0.3, 1), ("mid", 0.3, 2), ("small", 0.4, 2), ("small", 0.1, 4), (None, 0.5, 1), ("absent", 0.05, 2)]


def test_shares_are_held_when_the_mix_shrinks(spark):
    d, g = docs(spark), spark.createDataFrame(GOALS, GOAL)
    tokens = mixing.with_tokens(d).persist()
    rows = mixing.plan(tokens, g)
    rep = {r.source: r for r in mixing.report(tokens, rows).collect()}
    for s, share in (("big", 0.3), ("mid", 0.3), ("small", 0.4)):
        assert rep[s].reached_share == pytest.approx(share, abs=0.03)
    assert rep["absent"].short and rep["absent"].mix_tokens == 0
    m = mixing.mix(tokens, rows).toPandas()
    assert m.groupby("doc_id").size().max() <= 3 and not m.duplicated(["doc_id", "copy_no"]).any()
    assert mixing.mix(tokens, rows).exceptAll(mixing.mix(tokens, rows)).count() == 0
    kept = mixing.plan(tokens, g, shrink=False)
    assert {r["source"]: r["rate"] for r in kept if r["short"]}["small"] == 2.0
    assert {r.source for r in mixing.short_sources(d, g).collect()} == {r["source"] for r in rows if r["short"]}


def test_empty_tables(spark):
    d, g = docs(spark), spark.createDataFrame(GOALS, GOAL)
    none = mixing.with_tokens(d.limit(0))
    assert mixing.mix(none, mixing.plan(none, g)).count() == 0 and mixing.report(none, mixing.plan(none, g)).count() == 4
    assert mixing.short_sources(d, g.limit(0)).count() == 0
