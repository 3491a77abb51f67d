import random

import numpy as np
import pytest

from studyloom.llm import leaks

DOC, ITEM = "doc_id long, text string, item_id string, edits string", "item_id long, text string, doc_id string"
RNG = random.Random(4)
VOC = ["w" + "".join(RNG.choice("abcdefgh") for _ in range(5)) for _ in range(300)]


def passage(n):
    return [RNG.choice(VOC) for _ in range(n)]


def test_words():
    assert leaks.words_of("Café-au LAIT_x, na­ïve 3.5") == ["cafe", "au", "lait", "x", "naive", "3", "5"]
    assert leaks.words_of("meas-\nured and mea‐ \r\n sured and mea­\nsured") == ["measured", "and", "measured", "and", "measured"]


def test_runs_of_twelve_words(spark, rows):
    a, b, common = passage(40), passage(40), passage(14)
    items = [(1, " ".join(common + a), "c"), (2, " ".join(common + b), "c"), (3, " ".join(common), "c"), (4, " ".join([*common, "tail"]), "c"), (5, None, "c"), (6, "short", "c")]
    docs = [
        (1, "Start " + " ".join(a[3:15]).upper() + ". End", "c", "c"), (2, " ".join(a[3:14]), "c", "c"), (3, " ".join(common), "c", "c"), (4, None, "c", "c"), (5, "", "c", "c"), (6, " ".join(b[:6]) + ", " + " -- ".join(b[6:30]), "c", "c"),
        (7, " ".join(b[5:12])[:-3] + "-\n" + b[11][-3:] + " " + " ".join(b[12:20]), "c", "c"), (8, " ".join(passage(20000)) + " " + " ".join(a[20:32]), "c", "c"), (6, " ".join(b[:30]), "c", "c"),
    ]
    d, i = spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)
    got = rows(leaks.leaks(d, i).select("doc_id", "item_id").distinct())
    assert got == [(1, 1), (6, 2), (7, 2), (8, 1)]
    assert {r.item_id: r.n_docs for r in leaks.leaked_items(d, i).collect()} == {1: 2, 2: 2, 3: 0, 4: 0, 5: 0, 6: 0}
    assert leaks.leaks(d.limit(0), i).count() == 0 and leaks.leaks(d, i.limit(0)).count() == 0


def test_blocks_of_items_give_the_same(spark, rows):
    items = spark.createDataFrame([(k, " ".join(passage(30)), "") for k in range(6)], ITEM)
    docs = spark.createDataFrame([(k, r.text[5:], "", "") for k, r in enumerate(items.collect())], DOC)
    whole = rows(leaks.leaks(docs, items))
    assert rows(leaks.leaks(docs, items, block_windows=30)) == whole and len(whole) > 90


def test_both_readings_count_the_same_places(spark):
    a = passage(40)
    items = spark.createDataFrame([(1, " ".join(a), "c")], ITEM)
    head = "com-\npound at the start, then "
    docs = spark.createDataFrame([(1, head + " ".join(a), "c", "c"), (2, head.replace("-\n", "") + " ".join(a), "c", "c"), (3, head + " ".join(a[:20]) + "-\n" + " ".join(a[20:]), "c", "c")], DOC)
    got = {r.doc_id: (r.n_windows, r.first_pos, r.last_pos) for r in leaks.leaked_pairs(docs, items).collect()}
    assert got[1] == got[2] == (29, 6, 34)
    # Words of its own stand at a line-end hyphen: it is found in the reading with the parts apart, and both parts have one place.
    assert got[3] == (28, 6, 33)


def test_slices_lose_no_cut_word_and_no_window(monkeypatch):
    text = " ".join(passage(300)).replace("w", "-\n ", 40) + " end"
    whole = leaks.readings(text)
    import pandas as pd

    docs = pd.DataFrame({"doc_id": [1], "text": [text]})
    for size in (5, 50, 333):
        monkeypatch.setattr(leaks.slices, "__defaults__", (size,))
        got = list(leaks._read(docs, 3))
        assert [w for _, _, w in got] == [w for w, _ in whole] and all((p == q).all() for (_, p, _), (_, q) in zip(got, whole))


def edited(words, kinds, rng):
    out = list(words)
    for kind in kinds:
        k = rng.randrange(1, len(out) - 1)
        if kind == "put in":
            out.insert(k, "foreign")
        elif kind == "left out":
            del out[k]
        else:
            out[k] = "foreign"
    return out


def distance(text, item):
    """Least edits of item against a beginning of text, plainly."""
    row = list(range(len(text) + 1))
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (w != v)))
        row = new
    return min(row)


KINDS = [("changed", "changed"), ("put in",), ("left out",), ("put in", "put in"), ("left out", "left out"), ("put in", "left out"), ("changed", "put in"), ("changed", "left out")]


@pytest.mark.parametrize("kinds", KINDS)
def test_recall_of_edited_passages_against_brute_force(spark, kinds):
    """Passages of the given evaluation items, edited and planted in other text; every window of every item is compared plainly."""
    window, most, rng = 16, 2, random.Random(str(kinds))
    items = [(r.item_id, leaks.words_of(r.text)) for r in spark.read.parquet("/root/testdata/sf0.001/eval_items.parquet").orderBy("item_id").limit(12).collect()]
    docs = []
    for k in range(60):
        _, ws = items[k % len(items)]
        at = rng.randrange(max(1, len(ws) - window - 4))
        docs.append((k, passage(5) + edited(ws[at : at + window + 2], kinds, rng) + passage(20)))
    d = spark.createDataFrame([(k, " ".join(ws), "", "") for k, ws in docs], DOC)
    i = spark.createDataFrame([(k, " ".join(ws), "") for k, ws in items], ITEM)
    got = {(r.doc_id, r.item_id, r.doc_pos, r.item_pos): r.edits for r in leaks.leaks(d, i, window=window, max_edits=most, max_items=99).collect()}
    true = {}
    for k, ws in docs:
        for item, iw in items:
            for p in range(len(iw) - window + 1):
                for q in range(len(ws) - window + 1):
                    part = ws[q : q + window + most]
                    if len({*part} & {*iw[p : p + window]}) >= 9 and (e := distance(part, iw[p : p + window])) <= most:
                        true[k, item, q + 1, p + 1] = e
    assert true and all(true[x] == e for x, e in got.items() if x in true) and all(x in true for x in got)
    assert len(got) >= 0.9 * len(true)
    pairs = {x[:2] for x in true}
    assert len({x[:2] for x in got} & pairs) >= 0.95 * len(pairs)


def test_edit_distances():
    item = np.array([[1, 2, 3, 4]] * 5)
    text = np.array([[1, 2, 3, 4, 9], [2, 3, 4, 9, 9], [5, 6, 7, 8, 9], [1, 8, 2, 3, 4], [1, 2, 4, 9, 9]])
    assert leaks.edit_distances(text, item).tolist() == [0, 1, 4, 1, 1]
