"""String functions against the Python functions whose rules they follow."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from pagelarder.functions import lists, text, urls
from pagelarder.functions.phrase import UNITS, ingredient_name, name_field
from pagelarder.functions.unicode import nfkd, nfkd_each

SPACES = [chr(c) for c in range(0x110000) if chr(c).isspace()]


def samples(count=400):
    rng = random.Random(7)
    alphabet = SPACES + list("aZ9.é|:") * 6 + ["​", "﻿", "\r\n"]
    made = ["".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(count)]
    return [*made, "", " ", *SPACES, *[f"a{s}b" for s in SPACES]]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(s,) for s in samples()], "x string").coalesce(2)


def check(df, column, expected):
    for row in df.select("x", column.alias("y")).collect():
        assert row.y == expected(row.x), repr(row.x)


def test_strip(texts):
    check(texts, text.strip(F.col("x")), str.strip)


def test_words(texts):
    check(texts, text.words(F.col("x")), str.split)


def test_clean_lines(texts):
    check(
        texts,
        text.clean_lines(F.col("x")),
        lambda x: [s.strip() for s in x.splitlines() if s.strip()],
    )


def test_delimiters(texts):
    check(texts, text.after_last(F.col("x"), ":"), lambda x: x.split(":")[-1])
    check(texts, text.before_first(F.col("x"), "|"), lambda x: x.split("|")[0])
    check(texts, text.substring_after(F.col("x"), "9."), lambda x: x.partition("9.")[2])
    check(texts, text.single_spaced(F.col("x")), lambda x: x.replace("  ", " "))


def test_normalize_space_folds_xml_space_only(spark):
    df = spark.createDataFrame([("  a \t\r\n b\xa0 c\x0b ",)], "x string")
    assert df.select(text.normalize_space(F.col("x"))).first()[0] == "a b\xa0 c\x0b"


def test_drop_blank_keeps_inner_space(spark):
    df = spark.createDataFrame([([" a\r\nb ", "\n", "\xa0", "", " c\rd"],)], "x array<string>")
    assert df.select(text.drop_blank(F.col("x"))).first()[0] == [" ab ", " c\rd"]


def test_part_of(spark):
    df = spark.createDataFrame([("Veg",), ("",), ("veg",), (None,)], "x string")
    found = [r[0] for r in df.select(text.part_of(F.col("x"), "Vegetariana")).collect()]
    assert found == [True, True, False, None]


def test_nfkd(spark):
    values = ["ação", "ascii", "½ ﬁ", "", None, "´x", "ﷺ"]
    df = spark.createDataFrame([(v,) for v in values], "x string").coalesce(1)
    expected = [None if v is None else unicodedata.normalize("NFKD", v) for v in values]
    assert [r[0] for r in df.select(nfkd(F.col("x"))).collect()] == expected
    rows = [(["\u00e3", None, "b"], True), ([], True), (None, True), (["\u00e3"], False)]
    df = spark.createDataFrame(rows, "x array<string>, needed boolean").coalesce(1)
    found = [r[0] for r in df.select(nfkd_each(F.col("x"), F.col("needed"))).collect()]
    assert found == [["a\u0303", None, "b"], [], None, ["\u00e3"]]


PHRASES = [
    ("3 ovos", "ovos", "ovos"),
    ("2 colheres de sopa de açúcar", "sopa de açúcar", "sopa de açúcar"),
    ("sal q.b.", "sal", "sal"),
    ("200 g sal q.b. q.b.", "200 g sal q.b.", "200 g sal q.b."),
    ("q.b. de sal", "de sal", "de sal"),
    ("Q.B. sal", "Q.B. sal", "Q.B. sal"),
    ("1 dl leite", "dl leite", "leite"),
    ("1 gr sal", "gr sal", "sal"),
    ("1 colh. sopa sal", "colh. sopa sal", "colh. sopa sal"),
    ("100ml de água", "água", "água"),
    ("½ kg arroz", "½ kg arroz", "½ kg arroz"),
    ("1/2 kg\xa0arroz", "arroz", "arroz"),
    (".5 L vinho", "vinho", "vinho"),
    ("e alho", "alho", "alho"),
    ("d alho", "alho", "alho"),
    ("2", "", ""),
    ("de", "", ""),
    ("", "", ""),
    (" \t ", "", ""),
    ("de de sal", "de sal", "de sal"),
    ("1 de 2 sal", "2 sal", "2 sal"),
    ("kgs sal", "kgs sal", "kgs sal"),
    (". sal", ". sal", ". sal"),
    ("Colher sal\nfino", "sal fino", "sal fino"),
]


def test_ingredient_names(spark):
    df = spark.createDataFrame(PHRASES, "x string, a string, b string")
    x = F.col("x")
    found = df.select(
        "x", "a", "b",
        ingredient_name(x, UNITS["sabor_intenso"]).alias("sabor_intenso"),
        ingredient_name(x, UNITS["receitas_portugal"]).alias("receitas_portugal"),
    )
    for row in found.collect():
        assert (row.sabor_intenso, row.receitas_portugal) == (row.a, row.b), row.x


def test_ingredient_name_of_a_very_long_phrase(spark):
    df = spark.range(1).select(F.repeat(F.lit("12 kg "), 200_000).alias("n"))
    phrase = F.concat("n", F.lit("de "), F.repeat(F.lit("sal "), 200_000))
    name = df.select(ingredient_name(phrase, UNITS["vaqueiro"]).alias("x")).first().x
    assert name == " ".join(["sal"] * 200_000)


def test_name_field(spark):
    cases = [
        ("de arroz q.b.", "arroz"), ("de", ""), ("demo", "demo"), ("de  a  b", "a b"),
        ("q.b.", ""), (" de q.b. sal", "sal"), ("a de b", "a de b"), ("de\xa0sal", "de\xa0sal"),
    ]
    df = spark.createDataFrame(cases, "x string, y string")
    for row in df.select("x", "y", name_field(text.strip(F.col("x"))).alias("z")).collect():
        assert row.z == row.y, row.x


def test_lists(spark):
    df = spark.range(1).select(F.expr("sequence(1, 12)").cast("array<string>").alias("x"))
    x = F.col("x")
    row = df.select(
        lists.nth(x, 20).alias("none"),
        lists.first_half(F.slice(x, 1, 3)).alias("half_of_3"),
        lists.first_half(F.slice(x, 1, 1)).alias("half_of_1"),
        lists.zip_shortest(x, F.slice(x, 2, 2), lambda a, b: F.concat(a, b)).alias("zipped"),
        lists.from_indexed_map(
            F.from_json(F.to_json(lists.indexed_map(x)), "map<string,string>")
        ).alias("again"),
        F.to_json(lists.indexed_map(F.slice(x, 1, 0))).alias("empty"),
        lists.first_non_empty(F.slice(x, 1, 0), F.slice(x, 3, 1), x).alias("third"),
    ).first()
    assert row.none is None
    assert row.half_of_3 == ["1"] and row.half_of_1 == []
    assert row.zipped == ["12", "23"]
    assert row.again == [str(n) for n in range(1, 13)]
    assert row.empty == "{}"
    assert row.third == ["3"]


def test_url_key(spark):
    same = [
        "http://a/b?x=1&a=2#t", "http://a/b?a=2&x=1", "HTTP://A/b?a=2&x=1#", "http://a/b?a=2&x=1#?q",
    ]
    other = ["http://a/B?a=2&x=1", "http://a/b", "http://a", "http://a/", "http://a/?", "x/y"]
    df = spark.createDataFrame([(u,) for u in same + other], "x string").coalesce(1)
    keys = [r[0] for r in df.select(urls.url_key(F.col("x"))).collect()]
    assert set(keys[:4]) == {"http://a/b?a=2&x=1"}
    assert keys[4:] == ["http://a/B?a=2&x=1", "http://a/b", "http://a/", "http://a/", "http://a/", "x/y"]


def test_resolve_url(spark):
    from urllib.parse import urljoin

    bases = ["https://h.pt/a/b/c?q=1#f", "https://h.pt", "https://h.pt/receitas/page/3/"]
    hrefs = [
        "https://o.pt/x", "//o.pt/x", "/x/y", "x/y", "?k=1", "../x", "../../x/", "../../../../x",
        "./x", "x/./y/../z", "mailto:a@b", "/a/../b?x=../y", "..", "g?y/./x",
    ]
    df = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "b string, h string")
    for row in df.select("b", "h", urls.resolve_url(F.col("b"), F.col("h")).alias("u")).collect():
        assert row.u == urljoin(row.b, row.h), (row.b, row.h)
