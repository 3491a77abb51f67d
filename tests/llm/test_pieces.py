import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from studyloom.llm import pieces

SCHEMA = "paper_id long, paper_text string, item string, h string, rng string"


def brute_paragraphs(text):
    out, at, start, end = [], 0, None, 0
    for line in text.split("\n"):
        ink = line.strip(" \t\r\f")
        if ink:
            first = at + len(line) - len(line.lstrip(" \t\r\f"))
            start, end = first if start is None else start, at + len(line.rstrip(" \t\r\f"))
        elif start is not None:
            out.append((start, end))
            start = None
        at += len(line) + 1
    return out + ([(start, end)] if start is not None else [])


def texts():
    rng = random.Random(3)
    parts = ["word", "Ends. ", " ", "\n", "\n\n", "\n \t\n", "\r\n\r\n", "ä€😀", "x" * 70, "\f", "\n\n\n\n", "? ", "a b c d "]
    made = ["".join(rng.choice(parts) for _ in range(n)) for n in (0, 1, 2, 5, 40, 300, 900)]
    return made + ["\n\n  a", "a\n\n", " \n \n ", "y" * 3000, "one two. " * 300, "p\n\n" * 500]


@pytest.mark.parametrize("size", [130, 1000])
def test_pieces_round_trip_and_paragraphs(spark, size):
    t = texts()
    df = spark.createDataFrame([(i, x, "c", "c", "c") for i, x in enumerate(t)] + [(99, None, "c", "c", "c"), (5, t[5], "c", "c", "c")], SCHEMA)
    got = pieces.split_cells(df, "paper_id", "paper_text", limit=100, overlap=10, size=size).toPandas()
    for i, x in enumerate(t):
        g = got[got["item"] == i].drop_duplicates().sort_values("piece_no")  # repeated rows give their pieces again
        assert list(g.piece_no) == list(range(1, len(g) + 1))
        assert "".join(r.piece[r.core_start - r.start :] for r in g.itertuples()) == x
        for r in g.itertuples():
            assert r.piece == x[r.start : r.end] and 0 < len(r.piece) <= 100
            assert r.core_start - r.start <= 12
    for x in t:
        m = pieces.cell_marks(x, size) if x else pieces.Marks(0, [], [], [], [])
        assert list(zip(m.starts, m.ends)) == brute_paragraphs(x)


@pytest.mark.parametrize("size", [64, 700, 5000])
def test_files_by_byte_ranges_of_any_size_give_the_pieces_of_cells(spark, tmp_path, size):
    t = [x for x in texts() if x] + [" " * 900 + "a. " + "b" * 40 + "\n\n" * 300 + "c d"]
    paths = []
    for i, x in enumerate(t):
        p = tmp_path / f"{i}.txt"
        p.write_bytes(x.encode())
        paths.append(p.as_uri())
    got = pieces.split_files(spark, paths, limit=100, overlap=10, size=size).toPandas()
    for p, x in zip(paths, t):
        g = got[got["item"] == p].sort_values("piece_no")
        assert [(r.start, r.core_start, r.end) for r in g.itertuples()] == pieces.cell_pieces(x, 100, 10)
        assert [r.piece for r in g.itertuples()] == [x[a:z] for a, _, z in pieces.cell_pieces(x, 100, 10)] and list(g.piece_no) == list(range(1, len(g) + 1))


def test_cuts_prefer_paragraphs_then_sentences_then_words():
    text = "Aa bb. " * 10 + "\n\n" + "cc " * 30 + "\n\n" + "z" * 250
    out = pieces.cell_pieces(text, 100, 0)
    assert out[0][2] == text.index("cc ") and text[out[1][2]] == "z" and [b - a for _, a, b in out[2:]] == [100, 100, 50]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet=" \n\tab.", max_size=300), st.integers(1, 40))
def test_marks_and_pieces_do_not_depend_on_the_range(text, size):
    m = pieces.cell_marks(text, size)
    assert m.sentences == [x.end() for x in re.finditer(r"[.!?…][\"'”’)\]]*\s+(?=\S)", text)] and m.words == [x.end() for x in re.finditer(r"\s+(?=\S)", text)]
    assert pieces.cell_pieces(text, 20, 3, size) == pieces.cell_pieces(text, 20, 3)


def test_long_paragraphs_and_empty(spark, rows):
    df = spark.createDataFrame([(1, "a\n\n" + "b" * 101 + "\n \nc", "", "", ""), (2, "d" * 100, "", "", ""), (3, None, "", "", "")], SCHEMA)
    assert rows(pieces.long_paragraphs(df, "paper_id", "paper_text", limit=100, size=64)) == [(1, 2)]
    assert pieces.split_cells(df.limit(0), "paper_id", "paper_text").count() == 0
    with pytest.raises(ValueError):
        pieces.split_cells(df, "paper_id", "paper_text", limit=10, overlap=10)
