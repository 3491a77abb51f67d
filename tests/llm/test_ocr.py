from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from studyloom.llm import ocr
from studyloom.llm.lexicon import PRINTED, Lexicon, Trie, edits_between, misreadings
from studyloom.llm.pages import analyse, asked, furniture, gone_lines, lexical_words

CLEAN = "The association between dietary fibre and school performance was small after adjustment for education. Each visit lasted about two hours and ended with the collection of samples."
PAGE = """Green space and hip fracture in adolescents of | 1
Green space and hip fracture in adolescents of the Tassu study

Domwas and Dusvun, Far Town

1 Introduction

The association between dietary fibre and school perfor-
mance was srnall after adjustrnent for education. Each visit
lasted about two hours and encled with the coll-

2

Green space and hip fracture in adolescents of | 2
ection of samples. The long-
term visit lasted about two hours.

12  40
13  41
14
15  43

Green space and hip fracture in adolescents of | 3
"""
SCHEMA = "paper_id long, paper_text string, n_pages long, damage string, line_no long, text string"


def lexicon():
    words, pairs = lexical_words(CLEAN + " The long-term visit. The performance, ended, small, collection.")
    return Lexicon({w: 5 for w in words}, dict.fromkeys(pairs, 3))


def test_page():
    found, text = analyse(PAGE, lexicon(), gone_lines(PAGE, 3))
    lines = PAGE.split("\n")
    by = {k: sorted(lines[n - 1] for n, d in found if d == k) for k in ("furniture", "broken_word", "misread")}
    assert [x[-3:] for x in by["furniture"]] == ["| 1", "| 2", "| 3"] or sorted(x[-3:] for x in by["furniture"]) == sorted(["| 1", "| 2", "| 3"] + (["2"] if "2" in by["furniture"] else []))
    assert by["broken_word"] == sorted(x for x in lines if x.endswith(("perfor-", "coll-")))
    assert by["misread"] == sorted(x for x in lines if "srnall" in x or "encled" in x)
    assert "school performance was small after adjustment for education. Each visit lasted about two hours and ended with the collection of samples. The long-term visit" in text


def test_table_rows_are_no_furniture():
    lines = PAGE.split("\n")
    gone = {lines[i] for i in furniture(lines, 3)}
    assert not {"12  40", "14", "15  43", "1 Introduction", "Green space and hip fracture in adolescents of the Tassu study"} & gone


WORDS = ["cat", "cart", "care", "scare", "tract", "a", "collection"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="acrtes", max_size=7), st.integers(0, 3))
def test_automaton_and_trie_find_all_and_only_near_words(word, limit):
    assert sorted(Trie(WORDS).search(word, limit)) == sorted((w, distance(w, word)) for w in WORDS if distance(w, word) <= limit)


def test_misreadings():
    assert misreadings("small", "srnall") == 1 and misreadings("ended", "encled") == 1 and misreadings("about", "about") == 0 and misreadings("cat", "dog", 2) == 3


def test_vocabulary_leaves_out_frequent_misreadings_and_handles_edges(spark, rows):
    p = [(i, CLEAN + (" fibrc" if i < 2 else ""), 1, "c", 0, "c") for i in range(40)] + [(90, None, None, "c", 0, "c"), (91, "", 0, "c", 0, "c"), (92, CLEAN.replace("fibre", "fibrc"), None, "c", 0, "c"), (92, CLEAN, None, "c", 0, "c")]
    df = spark.createDataFrame(p, SCHEMA)
    known = {r.a for r in ocr.lexicons(ocr.prepared(df)).filter("kind = 'word'").collect()}
    assert "fibre" in known and "fibrc" not in known
    assert rows(ocr.damage(df).filter("paper_id >= 90")) == [(92, 1, "misread")]
    fixed = {(r.paper_id, r.n_misread): r.text for r in ocr.repaired(df).filter("paper_id >= 90").collect()}
    assert fixed[92, 1] == CLEAN and fixed[90, 0] == "" and fixed[91, 0] == ""
    assert ocr.damage(df.limit(0)).count() == 0


def whole_lexicon(texts):
    """Vocabulary, bigrams and trie of all papers in one place."""
    words, pairs = Counter(), Counter()
    for t in texts:
        w, p = lexical_words(t)
        words.update(w)
        pairs.update(p)
    words = {w: n for w, n in words.items() if n >= ocr.LEAST}
    trie = Trie(words)
    bad = {w for w in words if len(w) > 2 and any(v != w and words[v] >= ocr.FAR_MORE * words[w] and misreadings(v, w) <= 2 for v, _ in trie.search(w, 2))}
    sound = {w: n for w, n in words.items() if w not in bad}
    return Lexicon(sound, {p: n for p, n in pairs.items() if n >= ocr.LEAST})


@pytest.mark.parametrize("group,block", [(3, 50_000), (40, 25)])
def test_groups_and_blocks_give_what_one_lexicon_gives(spark, monkeypatch, group, block):
    papers = spark.read.parquet("/root/testdata/sf0.001/pdf_text.parquet").unionByName(spark.read.parquet("/root/testdata/sf0.01/pdf_text.parquet").filter("paper_id % 4 = 0"))
    rows = papers.select("paper_id", "paper_text", "n_pages").collect()
    lex = whole_lexicon([r.paper_text for r in rows if r.paper_text])
    want = {(r.paper_id, n, d) for r in rows if r.paper_text for n, d in analyse(r.paper_text, lex, gone_lines(r.paper_text, r.n_pages))[0]}
    monkeypatch.setattr(ocr, "GROUP", group)
    monkeypatch.setattr(ocr, "BLOCK", block)
    assert {tuple(r) for r in ocr.damage(papers).collect()} == want and len(want) > 100


def test_rare_words_and_their_misreadings_count_at_any_size(spark):
    """A word of two papers is vocabulary whatever the number of papers, and mends a misreading of it."""
    rare = "The zymotic lattice was then described with great care by all of them."
    for many in (4, 120):
        p = [(i, CLEAN, 1, "c", 0, "c") for i in range(many)] + [(900, rare, 1, "c", 0, "c"), (901, rare, 1, "c", 0, "c"), (902, rare.replace("zymotic", "zyrnotic"), 1, "c", 0, "c")]
        assert [(r.paper_id, r.damage) for r in ocr.damage(spark.createDataFrame(p, SCHEMA)).collect()] == [(902, "misread")]


PRINTS = [*WORDS, "modern", "modem", "burn", "bum", "fill", "hill", "clown", "down", "illness", "corner", "comer", "bottle", "wavvy", "wawy"]


@settings(max_examples=200, deadline=None)
@given(st.sampled_from(PRINTS), st.lists(st.tuples(st.integers(0, 9), st.sampled_from(sorted(PRINTED))), max_size=4))
def test_walk_by_confusions_finds_all_that_confusions_explain(word, changes):
    read = word
    for at, part in changes:
        at = at % (len(read) + 1)
        read = read[:at] + part + read[at + 1 :]
    trie = Trie(PRINTS)
    for limit in (0, 1, 3):
        assert trie.explained(read, limit) == {w: k for w in PRINTS if (k := misreadings(w, read, limit)) <= limit}
    assert {w: edits_between(w, read, 3) for w in PRINTS} == {w: min(distance(w, read), 4) for w in PRINTS}


def test_sound_words_ask_for_nothing():
    """Only what is not in the vocabulary is looked up and has a context; before, every pair of every text was handed on."""
    known = lexical_words(CLEAN)[0] | {"samples", "education"}
    assert asked(CLEAN, set(), known) == (set(), set(), set())
    forms, look, pairs = asked(CLEAN.replace("fibre", "fibrc"), set(), known)
    assert forms == look == {"fibrc"} and pairs == {("dietary", "fibrc"), ("fibrc", "and")}
    every = asked(CLEAN.replace("fibre", "fibrc"), set())
    assert pairs < every[2] and "fibrc" in every[0]
