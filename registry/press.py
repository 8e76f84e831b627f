"""Article pages that Spark derives from ``documents``.

The given pages carry almost no markup, so the rules on classes and meta tags run
on pages built from the articles: each language has its own page layout, and the
source decides the written forms of date and category.  ``PRESS_SQL`` holds what
was put into each page, which is what the field rules have to find again.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pressline import fixed_values as fv
from registry.common import ARTICLES_SQL, articles, lit, sql_strip

SECTIONS = ["Sport", "Xyz, nogomet", "vijesti", "Nepoznato"]
SHARE = "share me on all the networks"
SCRIPTED = "text beside a script element"
ADVERT = "oglas: buy this thing right now"
FOOTER = "all the usual words of a page footer"
MONTHS = [name for name, _ in fv.MONTHS_BASIC]

PRESS_SQL = f"""
SELECT *, {sql_strip("split_part(content, chr(10), 1)")} AS lead,
  CASE lang WHEN 'en' THEN 'https://news.example/sport/' || doc_id || '/'
    WHEN 'es' THEN CASE WHEN s < 10 THEN 'https://news.example/vjera/' || doc_id || '/'
      ELSE 'https://news.example/' || strftime(day, '%Y/%m/%d') || '/post-' || doc_id || '/' END
    ELSE 'https://news.example/post-' || doc_id || '/' END AS page_url,
  CASE WHEN s = 0 THEN 'news.example' ELSE source END AS writer,
  CASE s % 4 WHEN 0 THEN strftime(day, '%d.%m.%Y') WHEN 1 THEN strftime(day, '%d.%m.%Y.')
    WHEN 2 THEN day(day) || '. ' || ({"[" + ", ".join(lit(m) for m in MONTHS) + "]"})[month(day)] || ' ' || year(day) || '.'
    ELSE 'nedavno' END AS written_date,
  ({"[" + ", ".join(lit(x) for x in SECTIONS) + "]"})[s % 4 + 1] AS section,
  {sql_strip('title')} AS shown_title
FROM (SELECT *, batch_no - 1 AS s, DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS day FROM ({ARTICLES_SQL}))
"""


def _esc(c):
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def press_pages(spark, sf_dir):
    """(page_id, url, html) of the derived pages."""
    a = articles(spark, sf_dir)
    s = F.col("batch_no") - 1
    day = F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("doc_id") % 365).cast("int"))
    doc = F.col("doc_id").cast("string")
    lang = F.col("lang")
    title, sub = _esc(F.col("title")), _esc(F.col("subtitle"))
    lead = _esc(F.substring_index("content", "\n", 1))
    writer = F.when(s == 0, "news.example").otherwise(F.col("source"))
    section = F.array(*[F.lit(x) for x in SECTIONS])[s % 4]
    month_name = F.array(*[F.lit(m) for m in MONTHS])[F.month(day) - 1]
    written = (
        F.when(s % 4 == 0, F.date_format(day, "dd.MM.yyyy")).when(s % 4 == 1, F.date_format(day, "dd.MM.yyyy."))
        .when(s % 4 == 2, F.concat(F.dayofmonth(day).cast("string"), F.lit(". "), month_name, F.lit(" "), F.year(day).cast("string"), F.lit(".")))
        .otherwise("nedavno")
    )
    iso = F.date_format(day, "yyyy-MM-dd")
    url = (
        F.when(lang == "en", F.concat(F.lit("https://news.example/sport/"), doc, F.lit("/")))
        .when((lang == "es") & (s < 10), F.concat(F.lit("https://news.example/vjera/"), doc, F.lit("/")))
        .when(lang == "es", F.concat(F.lit("https://news.example/"), F.date_format(day, "yyyy/MM/dd"), F.lit("/post-"), doc, F.lit("/")))
        .otherwise(F.concat(F.lit("https://news.example/post-"), doc, F.lit("/")))
    )

    def only(*langs):
        return lambda *parts: F.when(lang.isin(*langs), F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])).otherwise("")

    lines = F.transform(F.split("content", "\n"), lambda x: F.concat(F.lit("<p>"), _esc(x), F.lit("</p>")))
    box = F.when(lang.isin("fr", "de"), "td-post-content").when(lang == "en", "entry-content").otherwise("")
    html = F.concat(
        F.lit('<!DOCTYPE html><html lang="'), lang, F.lit('"><head><meta charset="utf-8"><title>'), title, F.lit(" | Site</title>"),
        only("en")('<meta property="og:title" content="', title, ' | Site"><meta name="author" content="', writer,
                   '"><meta property="article:published_time" content="', iso, 'T10:00:00+02:00"><meta property="article:section" content="', section, '">'),
        F.lit('<meta property="og:description" content="old"><meta property="og:description" content="'), sub, F.lit('">'),
        only("de")('<script type="application/ld+json">{"id": ', doc, "}</script>"),
        F.lit('</head><body class="single post-'), F.col("source"), F.lit('">'),
        only("fr")('<div class="td-Breadcrumbs"><a href="/">Home</a> <a href="/c/">', section, "</a></div>"),
        F.lit('<div class="wp-pagenavi"><a href="/page/2/">2</a><a href="?p=3">3</a></div><article class="td-module-1">'),
        only("fr", "de")('<h1 class="entry-title"><a href="https://news.example/2024/', doc, '.html">', title, "</a></h1>"),
        only("en")("<h1>", title, "</h1>", '<p class="my-intro">', lead, "</p>"),
        only("fr")('<span class="td-post-date">', written, '</span><span class="post-author">Autor: ', writer, "</span>"),
        only("de")('<time class="entry-date" datetime="', iso, 'T10:00:00+01:00">', F.date_format(day, "dd/MM/yyyy"),
                   '</time><a rel="author nofollow" href="/w/">', writer, '</a><span class="post-category">', section,
                   '</span><p class="td-post-sub-title">', lead, "</p>"),
        only("en", "fr", "de")('<div class="', box, '">'),
        F.array_join(lines, ""),
        F.lit(f'<p class="share-box">{SHARE}</p><p><script>var x = 1;</script>{SCRIPTED}</p><p>{ADVERT}</p><div class="pic"><img src="a.png">caption of a picture</div>'),
        only("en", "fr", "de")("</div>"),
        F.lit("</article>"),
        only("es")('<div class="page-meta"><span>no name</span><span>piše: ', writer, "</span></div>"),
        F.lit(f'<footer class="site-footer"><p>{FOOTER}</p></footer></body></html>'),
    )
    return a.select(F.col("doc_id").alias("page_id"), url.alias("url"), html.alias("html"))
