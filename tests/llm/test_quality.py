import random

import numpy as np

from studyloom.llm import quality
from studyloom.llm.textstats import STATS, text_stats

SCHEMA = "doc_id long, text string, lang string, shape string, distance string"
RNG = random.Random(2)
BITS = ["The association between sleep and stroke was weak after adjustment for age", "Each visit lasted about two hours and ended with the collection of blood", "Our findings suggest that diet may explain part of the link", "Those who dropped out were younger and more often reported shift work"]
DE = ["Die Ergebnisse waren für Männer und Frauen ähnlich, auch wenn die Gruppe klein war", "Wir vermuten, dass ein Teil des Unterschieds durch die Wohnlage erklärt wird", "Es ist nicht bekannt, ob die Wirkung über das Alter von 43 Jahren hinaus anhält"]


def prose(bits=BITS):
    return " ".join(RNG.choice(bits) + "." for _ in range(RNG.randint(4, 12)))


ODD = {
    "list": "Items\n" + "\n".join(f"- item {w} ({1990 + i})" for i, w in enumerate("eczema stroke asthma anaemia fever cough migraine".split())),
    "table": "Item | N | P | HR\n" + "\n".join(f"40-{i} years | {i * 7} | {i}.2 | 0.{i}" for i in range(1, 9)),
    "junk": "".join(RNG.choice("{}<>|=+*~^%#@ ") for _ in range(600)),
}
REPEAT = "page loading please wait " * 60
VERSE = "\n".join(RNG.choice(BITS) for _ in range(9))


def test_shapes_and_contributions(spark):
    rows = [(i, prose(), "en", "c", "c") for i in range(150)] + [(i, prose(DE), "EN", "c", "c") for i in range(200, 260)]
    rows += [(1000 + i, t, None, "c", "c") for i, t in enumerate([*ODD.values(), REPEAT, VERSE, None, "", " \n "])] + [(1001, ODD["table"], None, "c", "c")]
    out = {r.doc_id: r for r in quality.quality(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [out[1000 + i].shape for i in range(8)] == ["list", "table", "junk", "junk", "prose", None, None, None]
    assert sum(r.shape == "prose" for k, r in out.items() if k < 1000) == 210 and out[200].lang == "de"
    r = out[1001]
    assert np.isclose(sum(r.contributions), r.distance**2) and len(r.contributions) == len(STATS) and out[1005].contributions is None
    found = quality.not_prose(spark.createDataFrame(rows, SCHEMA))
    assert sorted(x.doc_id for x in found.collect()) == [1000, 1001, 1002, 1003] and found.columns == ["doc_id", "shape"]


def test_empty_table_and_long_text(spark):
    assert quality.not_prose(spark.createDataFrame([], SCHEMA)).count() == 0
    assert quality.quality(spark.createDataFrame([(1, prose() * 3000, None, "", "")], SCHEMA)).first().lang == "en"


def test_statistics_do_not_depend_on_hard_wraps():
    import textwrap

    text = prose() + " " + prose()
    a, b = text_stats(text), text_stats("\n".join(textwrap.wrap(text, 48)))
    assert abs(a[1 + STATS.index("log_unit_words")] - b[1 + STATS.index("log_unit_words")]) < 0.5


def test_held_out_labels(spark):
    path = "/root/testdata/sf0.01"
    got = {r.doc_id: r.shape for r in quality.not_prose(spark.read.parquet(f"{path}/documents.parquet")).collect()}
    lab = [(r.doc_id, r["shape"]) for r in spark.read.parquet(f"{path}/labels.parquet").collect()]
    assert sum(got.get(i, "prose") == s for i, s in lab) >= 0.9 * len(lab)
