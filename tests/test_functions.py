import pytest
from pyspark.sql import functions as F

from studyloom.functions import arrays as A
from studyloom.functions import coercion as N
from studyloom.functions import text as T


@pytest.fixture(scope="module")
def one(spark):
    df = spark.range(1)
    return lambda c: df.select(c.alias("x")).first().x


def arr(*xs):
    return F.array(*[F.lit(x).cast("string") for x in xs])


def s(x):
    return F.lit(x).cast("string")


CASES = [
    (lambda: T.normalize_ws(s("a b–c \n\t d")), "a b-c d"), (lambda: T.first_doi(s("see doi:10.1186/s12967-019-2122-x). Next")), "10.1186/s12967-019-2122-x"), (lambda: T.first_doi(s(None)), None),
    (lambda: A.dedupe_ci(arr("A", "a", " B ", "b", "", "C", None)), ["A", " B ", "C"]), (lambda: A.csv_join(arr("a", "b,c", 'd"e')), 'a,"b,c","d""e"'),
    (lambda: A.allowed_only(A.parse_list(s('["data access provider","unknown role","Data access provider"]')), ["Data access provider", "Data controller"]), ["Data access provider"]),
    (lambda: A.scalar_of(s('["Data access provider"]')), "Data access provider"), (lambda: A.scalar_of(s('Data access provider"]')), "Data access provider"), (lambda: A.scalar_of(s('{"id": "x"}')), "x"), (lambda: A.scalar_of(s(None)), ""),
    (lambda: A.parse_list(s(None)), []), (lambda: A.parse_list(s("a, \"b, c\" ,,d")), ["a", "b, c", "d"]), (lambda: A.parse_list_loose(s("a; b|c")), ["a", "b", "c"]), (lambda: A.lenient_json(s('```json\nHi {"a": [1,], "b": ",}",}\n```')), '{"a": [1], "b": ",}"}'),
    (lambda: A.has_value(F.lit(None), F.lit(0)), True), (lambda: A.has_value(F.lit(" "), F.lit(None)), False),
    (lambda: N.to_int(s(" 12.0 ")), 12), (lambda: N.to_int(s("-3"), True), None), (lambda: N.to_int(s("1.5")), None), (lambda: N.to_bool(s(" YES")), "true"), (lambda: N.to_bool(s(None)), ""), (lambda: N.to_bool_or_false(s("?")), "false"),
    (lambda: N.to_date_text(s("3/2/2020")), "2020-02-03"), (lambda: N.to_date_text(s("2020-02-30")), ""), (lambda: N.to_datetime_text(s("2020-02-03T04:05:06Z")), "2020-02-03 04:05:06"), (lambda: N.to_date_text(s("2020-02-03 and more")), "2020-02-03"),
    (lambda: N.to_email(s(" a@b.c ")), "a@b.c"), (lambda: N.to_email(s("a b@c.d")), ""), (lambda: N.to_hyperlink(s("www.x.org")), "https://www.x.org"), (lambda: N.to_hyperlink(s("no link")), ""), (lambda: N.to_hyperlink(s("doi:10.1000/a."), doi=True), "https://doi.org/10.1000/a"),
    (lambda: T.event_name(s("12-month")), "m12"), (lambda: T.event_name(s("Year 2")), "m24"), (lambda: T.event_name(s("Baseline")), "m0"), (lambda: T.event_name(s(None)), ""), (lambda: T.safe_stem(s("/a/b c.d.pdf")), "b_c.d"), (lambda: T.safe_stem(s("...")), "paper"), (lambda: T.safe_stem(s(None)), "paper"),
    (lambda: T.resource_types(arr(), s("a biobank and a cohort")), ["Biobank", "Cohort study"]), (lambda: T.resource_types(arr("cohort-study", "x"), s("biobank")), ["Cohort study"]), (lambda: T.resource_types(arr(), s(None)), ["Other type"]),
    (lambda: T.geo_key(s("Côte d'Ivoire (the) & Co")), "cote d ivoire and co"), (lambda: T.alnum_ratio(s(" ä- ")), 0.5), (lambda: T.alnum_ratio(s(None)), 0.0), (lambda: T.quality_score(s("Ab ab c")), 5 + 20 + 2), (lambda: T.participant_hint(s("120 patients will be included")), 120),
    (lambda: T.pick_allowed(arr("Open access", "Restricted access"), "restricted"), "Restricted access"), (lambda: T.display_name(s("A"), s(" "), s("B")), "A B"), (lambda: T.strip_fences(s("```json\nx\n```")), "x"),
]


@pytest.mark.parametrize("k", range(len(CASES)))
def test_scalars(one, k):
    make, want = CASES[k]
    assert one(make()) == want


def test_references_are_cut_only_where_a_list_stands(one):
    body, refs = "Text of the paper. " * 200, "\nReferences\n" + "".join(f"[{i}] A. Name (20{i:02d}). Journal vol. 3, pp. 4, et al. doi 10.1000/{i}.\n" for i in range(1, 30))
    assert one(T.strip_references(s(body + refs))) == body.rstrip()
    assert one(T.strip_references(s(body + "\nReferences\nnone"))) == body + "\nReferences\nnone"
    assert one(T.strip_references(s(None))) is None
