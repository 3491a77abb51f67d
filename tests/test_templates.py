import pytest
from pyspark.sql import functions as F

from studyloom.operators import repair, templates
from studyloom.sources import pdf


@pytest.mark.parametrize("text,keys", [('{"a":1,"b":2,"c":3}', ["a", "b", "c"]), ("[1]", []), ("no", []), (None, [])])
def test_ordered_keys(text, keys):
    assert templates.ordered_keys(text) == keys


def test_leaves_and_caps(spark):
    assert templates.leaves({"a": "int", "b": ["s"], "c": [{"d": {"e": "x"}}], "f": []}) == [("a", "int"), ("b[]", "s"), ("c[].d.e", "x"), ("f[]", "string")]
    df = spark.createDataFrame([("a\nb", "a\nc"), (None, None)], "o string, n string")
    d = [r.d for r in df.select(templates.text_diff(F.col("o"), F.col("n")).alias("d")).collect()]
    assert d[0].splitlines()[-2:] == ["-b", "+c"] and d[1] == ""
    assert df.select(templates.capped_lines(F.lit("1\n2\n3"), 2)).first()[0] == "1\n2\n...[truncated]..."


def test_contact_and_ages(spark):
    people = F.from_json(F.lit('[{"first_name":"B","last_name":"Lee","email":"a@x"},{"first_name":"Bo","last_name":"Lee","email":null},{"first_name":"Al","last_name":"Ray","email":"a@x"}]'), "array<struct<first_name:string,last_name:string,email:string>>")
    get = lambda f, last, mail: tuple(spark.range(1).select(repair.contact_from_people(F.lit(f), F.lit(last), F.lit(mail), people).alias("c")).first().c)
    assert get("", "lee ", "a@x") == ("Bo", "lee ", "a@x") and get("B", None, "A@x") == ("Al", "Ray", "A@x") and get("Bob", "Ray", "a@x") == ("Bob", "Ray", "a@x") and get(None, None, None) == (None, None, None)
    assert spark.range(1).select(repair.adult_age(F.lit(3), F.array(F.lit("Adults")))).first()[0] is None


@pytest.mark.skipif(pdf.pypdf is not None, reason="a parser is installed")
def test_pdf_reader_says_that_no_parser_is_there(spark):
    with pytest.raises(RuntimeError):
        pdf.pdf_texts(spark, "/nowhere")
