import pytest

from pressline.functions import categories as C
from pressline.params import Categories, Site

CATS = Categories()


@pytest.mark.parametrize("url, want", [
    ("https://h/Sport/x", "Sport"), ("https://h/vjera/sport/", "Sport"), ("https://h/biskup-x", "Religija"),
    ("https://h/papa-i-politika", "Religija"), ("https://h/x", "Novice"), ("https://h/tech/", "Tehnologija"),
])
def test_from_url(one, url, want):
    assert one([C.category_from_url("u", CATS)], u=url) == want


def test_from_url_strict(one):
    assert one([C.category_from_url_strict("u", CATS)], u="https://h/NOVICE/x") == "Novice"
    assert one([C.category_from_url_strict("u", CATS)], u="https://h/vjera/x") is None


def test_lower_rule_wins(one):
    assert one([C.similar_category("c", CATS)], c="Sportski zdravstveni film") == "Sport"
    assert one([C.similar_category("c", CATS)], c="xyz") == "Novice"
    assert one([C.category_from_title("c", CATS)], c="Trener i papa") == "Sport"
    assert one([C.category_from_title("c", CATS)], c="qqq") is None


@pytest.mark.parametrize("raw, url, want", [
    ("Crna kronika", "https://h/", "Crna kronika"), ("sport", "https://h/", "Sport"), ("Xyz, Kultura", "https://h/", "Kultura"),
    ("Xyz i nogomet", "https://h/", "Sport"), ("Stil života", "https://h/", "Lifestyle"), ("Moja vjera", "https://h/", "Religija"),
    ("Qqq", "https://h/kultura/", "Kultura"), ("Qqq", "https://h/", "Novice"), (None, "https://h/sport/", "Sport"), ("", "https://h/", "Novice"),
    ("Qqq, Www", "https://h/", "Novice"), (" Vijesti ", "https://h/", "Novice"),
])
def test_standardize(spark, raw, url, want):
    df = spark.createDataFrame([(raw, url)], "category_raw string, url string")
    assert C.standardize_category(df, CATS).first().category == want


def test_slug(one):
    site = Site(domain="news.example")
    assert one([C.category_from_slug("u", site, CATS)], u="https://news.example/category/ex-yu/x/") == "Ex Yu"
    assert one([C.category_from_slug("u", site, CATS)], u="https://news.example/nova-rubrika/x/") == "Nova Rubrika"
    assert one([C.category_from_slug("u", site, CATS)], u="https://news.example/x") is None


@pytest.mark.parametrize("text", ["nova vijest", "o'brien dan", "a1b c2d", "ČETIRI šest"])
def test_title_case_like_python(one, text):
    assert one([C.title_case("t")], t=text) == text.title()
