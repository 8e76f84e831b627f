import pytest

from pressline.functions import dates as D


def run(spark, fn, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, raw string")
    return [(str(r.date) if r.date else None, r.date_text) for r in fn(df, "raw").orderBy("id").collect()]


BASIC = [
    ("21/04/2023", "2023-04-21"), ("21.04.2023", "2023-04-21"), ("21.04.2023.", "2023-04-21"), ("21 April, 2023", "2023-04-21"),
    ("21 apr 2023", "2023-04-21"), ("April 21, 2023", "2023-04-21"), ("2023-04-21", "2023-04-21"), ("1.4.2023", "2023-04-01"),
    (" 30. travnja 2025. ", "2025-04-30"), ("1 2 23", "2023-02-01"), ("31. veljače 2024.", None), ("2023-04-21T10:00", None),
    ("31/02/2024", None), ("soon", None), ("5. Svibnja 2024 u 10:15", "2024-05-05"), ("svibnja 2024", None), ("", None), (None, None),
]


def test_basic(spark):
    got = run(spark, D.parse_date_basic, [t for t, _ in BASIC])
    assert [g[0] for g in got] == [w for _, w in BASIC]
    for (text, want), (_, shown) in zip(BASIC, got):
        assert shown == (".".join(reversed(want.split("-"))) if want else text)


ISO = [
    ("2023-04-21T10:00:00Z", "2023-04-21", "21.04.2023"), ("2023-04-21 10:00", "2023-04-21", "21.04.2023"),
    ("2023-04-21T10:00:00.5+02:00", "2023-04-21", "21.04.2023"), ("20230421", "2023-04-21", "21.04.2023"),
    ("2023-4-1", "2023-04-01", "01.04.2023"), ("21 travanj 2023", "2023-04-21", "21.04.2023"),
    ("21.travnja 2023", "2023-04-21", "21.04.2023"), ("31. veljače 2024", None, "31.02.2024"), ("soon", None, "soon"),
    ("2023-04-21T25:00", None, "2023-04-21T25:00"), ("21 April 2023", "2023-04-21", "21.04.2023"), ("21 April, 2023", None, "21 April, 2023"),
    ("21.04.2023.", None, "21.04.2023."), ("", None, None), (None, None, None),
]


def test_iso_first(spark):
    got = run(spark, D.parse_date_iso_first, [t for t, _, _ in ISO])
    assert got == [(d, s) for _, d, s in ISO]


@pytest.mark.parametrize("url, want", [("https://h/2024/05/17/x/", "17.05.2024"), ("https://h/2024/05/x/", None)])
def test_date_in_url(one, url, want):
    assert one([D.date_in_url("u")], u=url) == want
