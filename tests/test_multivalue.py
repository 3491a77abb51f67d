import ast
import json
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from studyloom.operators.multivalue import explode_values, split_values


def brute(cell):
    """Value by value scanner."""
    if cell is None:
        return []
    c = cell.strip()
    if c.startswith("[") and c.endswith("]"):
        try:
            items = json.loads(c)
        except ValueError:
            items = ast.literal_eval(c)
        return [s for s in (str(x).strip() for x in items if x is not None) if s]
    toks, cur, begin, strong, i = [], "", True, False, 0
    while i < len(c):
        ch = c[i]
        if begin and ch == " ":
            cur, i = cur + ch, i + 1
            continue
        if begin and ch == '"' and (m := re.compile(r'"((?:[^"]|"")*)"').match(c, i)):
            cur, i, begin = cur + m.group(1).replace('""', '"').replace(",", "\0"), m.end(), False
            continue
        if ch in ";|•\n\r\t" or (ch == "/" and 0 < i < len(c) - 1 and c[i - 1].isspace() and c[i + 1].isspace()):
            toks.append(cur)
            cur, begin, strong = "", True, True
        else:
            cur += ch
            begin = ch == ","
        i += 1
    toks.append(cur)
    values = toks if strong else toks[0].split(",")
    return [v for v in (x.replace("\0", ",").strip() for x in values) if v]


CASES = [
    (None, []), ("", []), (" ; ", []), ("a", ["a"]), ("a, b", ["a", "b"]), ("a, b; c", ["a, b", "c"]), ('"a, b", c', ["a, b", "c"]), ('x "q" y', ['x "q" y']), ('"a ""b"" c"', ['a "b" c']),
    ("a/b / c", ["a/b", "c"]), ("a;a;;a", ["a", "a", "a"]), ('["a", "b, c", null, ""]', ["a", "b, c"]), ("['it\\'s', \"d'e\", 'say \"x\"']", ["it's", "d'e", 'say "x"']), ('"open, b', ['"open', "b"]),
    ('"a;b" | "c | d"\n e', ["a;b", "c | d", "e"]), ("1;", ["1", ""]), ('"p";1', ["p", "1"]), ("work, shift;", ["work, shift"]), ('["\\u00e9"]', ["é"]),
]


@pytest.fixture(scope="module")
def run(spark):
    def go(cells):
        df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i long, c string")
        return [list(r.v) for r in df.select("i", split_values(F.col("c")).alias("v")).orderBy("i").collect()]

    return go


def test_cases(run):
    assert run([c for c, _ in CASES]) == [v for _, v in CASES]


def test_generated_cells_agree_with_a_scanner(run):
    piece = st.sampled_from(['"a"', '"b, c"', "d", "e f", ",", ";", " / ", "|", " ", "\n", '""', "•", "x/y", 'g"h', '"i;j"', "'k'"])
    cells = []

    @settings(max_examples=300, deadline=None, database=None, derandomize=True)
    @given(st.lists(piece, max_size=9))
    def collect(parts):
        cells.append("".join(parts))

    collect()
    cells = [c for c in dict.fromkeys(cells) if not c.strip().startswith("[")]
    assert run(cells) == [brute(c) for c in cells]


def test_positions_extra_columns_empty_and_long(spark, rows):
    df = spark.createDataFrame([(1, "a;;b", "p", "v"), (1, "a;;b", "p", "v"), (2, ";".join("v" * 3 for _ in range(4000)), "p", "v"), (3, None, "p", "v")], "row_id long, keywords string, pos string, val string")
    out = explode_values(df, "t", "row_id", "keywords")
    assert rows(out.filter("row_id = 1")) == sorted([("t", 1, "keywords", 1, "a"), ("t", 1, "keywords", 2, "b")] * 2)
    assert out.filter("row_id = 2").agg(F.max("pos")).first()[0] == 4000
    assert out.filter("row_id = 3").count() == 0 and explode_values(df.limit(0), "t", "row_id", "keywords").count() == 0
