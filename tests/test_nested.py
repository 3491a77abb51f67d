import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from studyloom.operators import nested

SCHEMA = "section_id long, resource string, task string, payload string, outer_pos string, nested string"


def sections(spark, *payloads, task="task_subpopulations"):
    return spark.createDataFrame([(i, f"r{i}", task, p, "clash", "clash") for i, p in enumerate(payloads)], SCHEMA)


def test_counts_keep_links_and_places(spark, rows):
    p = json.dumps({"subpopulations": ["see table", {"name": "A", "pid": "p1", "counts": [None, {"n_total": 0}, {"age_group": " "}]}, {"name": None, "counts": [{}]}]})
    t = nested.section_tables(sections(spark, p))
    assert rows(t["subpopulations"].select("section_id", "outer_pos", "name")) == [(0, 2, "A")]
    assert rows(t["counts"].select("section_id", "outer_pos", "inner_pos", "parent_name", "parent_pid", "n_total")) == [(0, 2, 2, "A", "p1", "0")]


BASE = {"external_identifiers": [{"identifier": "x"}, {"type": "y"}]}
FORMS = [
    json.dumps(BASE), "```json\n" + json.dumps(BASE) + "\n```", "Here {it} is: " + json.dumps(BASE) + " Bye.", json.dumps(json.dumps(BASE)), json.dumps({"data": BASE}),
    '{"External-Identifiers": [{"identifier": "x",}, {"type": "y"},],}', json.dumps({"externalIdentifiers": json.dumps(BASE["external_identifiers"])}),
    json.dumps({"a": "curly } brace {", **BASE}),
]


@pytest.mark.parametrize("payload", FORMS)
def test_loose_forms_read_alike(payload):
    got = nested.canonical_lists(payload, (nested.EXTERNAL,))["external_identifiers"]
    assert [(g["pos"], g["identifier"], g["type"]) for g in got] == [(1, "x", None), (2, None, "y")]


@pytest.mark.parametrize("payload", [None, "", "  ", "null", "[]", "no", json.dumps(BASE)[:-3], json.dumps(BASE)[:30], '{"external_identifiers": "see table"}', '{"external_identifiers": 3}'])
def test_unreadable_payloads_give_nothing(payload):
    assert nested.canonical_lists(payload, (nested.EXTERNAL,)) == {"external_identifiers": []}


def test_lone_object_is_a_list_of_one():
    got = nested.canonical_lists('{"external_identifiers": {"identifier": 5.0}}', (nested.EXTERNAL,))["external_identifiers"]
    assert [(g["pos"], g["identifier"]) for g in got] == [(1, "5")]


def test_nulls_repeats_empty_and_long(spark, rows):
    long = json.dumps({"external_identifiers": [{"identifier": "i" * 10}] * 5000})
    df = sections(spark, None, "", json.dumps(BASE), json.dumps(BASE), long, task="task_overview")
    out = nested.section_entries(df)
    assert out.filter("section_id < 4").count() == 4 and out.filter("section_id = 4").count() == 5000
    assert rows(nested.section_entries(df.limit(0))) == []
    assert out.columns == ["section_id", "list_name", "outer_pos", "inner_pos"]


@settings(max_examples=60, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=5), lambda c: st.lists(c, max_size=3) | st.dictionaries(st.text(max_size=4), c, max_size=3), max_leaves=8))
def test_filled_agrees_with_a_flat_walk(v):
    def leaves(x):
        if isinstance(x, dict):
            for y in x.values():
                yield from leaves(y)
        elif isinstance(x, list):
            for y in x:
                yield from leaves(y)
        else:
            yield x

    assert nested.filled(v) == any(x is not None and (not isinstance(x, str) or x.strip() != "") for x in leaves(v))


def test_no_value_of_a_subpopulation_is_dropped(spark, rows):
    entries = [{"name": "A", "Inclusion Criteria": ["adult"], "site": {"k": 1}, "empty": None, "counts": "see table"}, {"name": "B", "counts": [{"n_total": 1}]}]
    t = nested.section_tables(sections(spark, json.dumps({"subpopulations": entries})))["subpopulations"]
    assert rows(t.select("name", "inclusion_criteria", "rest")) == [("A", '["adult"]', '{"site": {"k": 1}, "counts": "see table"}'), ("B", None, None)]
