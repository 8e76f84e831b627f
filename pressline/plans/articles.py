"""Pages to article rows, and article rows to the final archive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressline import fixed_values as fv
from pressline.functions import urls as U
from pressline.functions.language import verdict_reason
from pressline.functions.text import clean_text, let
from pressline.operators import fields as P
from pressline.operators.dedup import later_copies, without
from pressline.operators.language import record_verdict, with_mid_reason, with_tokens
from pressline.operators.records import record_header, record_url
from pressline.params import DEFAULT_RULES, Rules
from pressline.plans.steps import Marks, Step, built, mark
from pressline.session import cut
from pressline.schemas import ARTICLE, ARTICLE_EXTRACTED
from pressline.sources.dom import parse_pages
from pressline.sources.readers import READ_ORDER


# what no step behind the marks may carry on: the nodes are by far the largest part of a row
HEAVY = ("nodes", "pieces", "piece_node", "places", "container")


def _scrape_steps(rules: Rules) -> list[Marks | Step]:
    bl = rules.blacklist

    def content(dom: DataFrame) -> DataFrame:
        return let(dom, content=P.body_in("container"))

    return [
        Marks(("_lang", "_title", "_classes"), P.html_marks),
        Marks(("date_raw", "_published"), P.date_marks_basic),
        mark("title", P.title_basic),
        mark("author", lambda: P.author_basic(rules.site)),
        mark("category_on_page", P.category_on_page),
        mark("candidates", lambda: P.subtitle_candidates(bl)),
        mark("container", lambda: P.first_element(P.BODY_BASIC)),
        mark("_no_page", lambda: F.size("nodes") == 0),
        Step(("content",), ("container",), content),
        Step(("narrow",), (), lambda df: df.drop(*HEAVY, "json_ld")),
        Step(("_html",), ("_lang", "_title", "_classes"), lambda df: P.finish_html_reason(df, bl, out="_html")),
        Step(("date", "date_value"), ("date_raw", "_published"), P.finish_date_basic),
        Step(("category",), ("category_on_page", "title"), lambda df: P.with_category_basic(df, rules)),
        Step(("subtitle",), ("candidates",), P.best_subtitle),
        Step(("reject_reason",), ("title", "content", "_html", "_no_page"), lambda df: reject_rows(df, rules)),
    ]


SCRAPED = ("page_id", *ARTICLE.names, "date_value", "reject_reason")


def scrape_rows(pages: DataFrame, *, rules: Rules = DEFAULT_RULES, columns: Sequence[str] = SCRAPED, keep: Sequence[str] = ()) -> DataFrame:
    """Basic articles with ``reject_reason`` (NULL = kept), one row per page.

    The reject rules run in their fixed order, and a rule only looks at pages
    that no earlier rule has rejected.  Pages with a blacklisted URL are emptied
    before parsing, so they cost next to nothing.  Only what ``columns`` call for
    is planned; ``keep`` names columns of the input that go along.
    """
    # built-in functions judge the short URL here: the parser is the one Python worker a task needs up to the text rules
    wanted = U.blacklist_reason("url", F.lower("url"), None, rules.blacklist).isNull()
    dom = parse_pages(pages.select("page_id", "url", F.when(wanted, F.col("html")).alias("html"), *keep), keep=keep)
    return built(dom, _scrape_steps(rules), {*columns, "narrow"}).select(*columns, *keep)


def reject_rows(rows: DataFrame, rules: Rules) -> DataFrame:
    """Add ``reject_reason`` to assembled rows."""
    bl, lex = rules.blacklist, rules.lexicon
    unwanted = U.blacklist_reason("url", F.lower("url"), None, bl).isNotNull()
    # pages without a text to look at; the rest of the rules needs the terms of the title
    shut = unwanted | F.col("_no_page") | F.col("_html").isNotNull()
    tokens = with_tokens(
        rows.withColumn("_low_title", F.lower("title")), body=F.when(~shut, F.col("content")), lex=lex, sample=True,
        _of_url=U.url_terms(F.lower("url"), bl), _of_title=U.title_terms("_low_title", bl))
    early = let(
        tokens,
        _early=F.when(U.reason_of("url", None, bl).isNotNull(), "url_blacklist")
        .when(F.col("_no_page"), "no_page")
        .when(F.col("_html").isNotNull(), "html_foreign")
        .when(U.reason_of("url", "title", bl).isNotNull(), "title_blacklist")
        .when(F.col("_of_title.rejects") > 0, "title_reject")
        .when(F.col("content").isNull(), "empty_body"),
    )
    # nothing more is asked about rejected rows
    terms = early.withColumn("_terms", F.when(F.col("_early").isNull(), F.col("body_terms.terms_b") > lex.max_substrings))
    # the missing mark stands in for an unknown title, as it does in a record
    shown_title = F.coalesce("title", F.lit("N/A"))
    language = let(
        terms,
        _lang=F.when(~F.col("_terms"), verdict_reason(shown_title, "body_lower", "body_terms", "hit_mask", lex)),
    )
    still = ~F.col("_terms") & F.col("_lang").isNull()
    judged = with_mid_reason(language, lex=lex, only=still)
    return judged.withColumn(
        "reject_reason",
        F.coalesce(
            "_early", F.when(F.col("_terms"), "indicator_terms"),
            F.when(F.col("_lang").isNotNull(), "language"),
            F.when(F.col("mid_reason").isNotNull(), "mid_sample"),
        ),
    )


def _extract_steps(rules: Rules) -> list[Marks | Step]:
    def error(df: DataFrame) -> DataFrame:
        found = F.when(F.col("_no_page"), "Failed to retrieve page content").otherwise(P.no_content("content"))
        return df.withColumn("error", found)

    return [
        Marks(("meta_entries",), P.metadata_marks),
        mark("date_raw", P.date_cascade_raw),
        mark("title", lambda: P.title_cascade("url")),
        mark("author", lambda: P.author_cascade(rules.site)),
        mark("category", lambda: P.category_cascade(rules)),
        mark("subtitle", P.subtitle_cascade),
        mark("content", lambda: P.body(rules.site)),
        mark("_no_page", lambda: F.size("nodes") == 0),
        Step(("narrow",), (), lambda df: df.drop(*HEAVY)),
        Step(("metadata", "json_ld"), ("meta_entries",), P.finish_metadata),
        Step(("date", "date_value"), ("date_raw",), P.finish_date_cascade),
        Step(("error",), ("content", "_no_page"), error),
    ]


EXTRACTED = ("page_id", *ARTICLE_EXTRACTED.names, "date_value")


def extract_rows(pages: DataFrame, *, rules: Rules = DEFAULT_RULES, columns: Sequence[str] = EXTRACTED) -> DataFrame:
    """Extracted articles: no rejects, but an ``error`` column, and metadata.  Only what ``columns`` call for is planned."""
    rows = built(parse_pages(pages), _extract_steps(rules), {*columns, "_no_page", "narrow"})
    blank = {f for f in ARTICLE.names if f != "url"}
    return rows.select(*[F.when(~F.col("_no_page"), F.col(c)).alias(c) if c in blank else c for c in columns])


def combine(records: DataFrame, *, rules: Rules = DEFAULT_RULES, deduplicate: bool = True,
            clean: bool = False, compat: bool = False) -> DataFrame:
    """Record texts -> local, first-seen records in their input columns plus ``url``.

    The texts are judged once.  What is written then is a table without texts,
    which tells the foreign records and the later copies among the local ones;
    the texts are only read a second time, against the list of those to drop.
    ``clean`` tidies the texts that are kept.  Records without a URL are all
    kept; ``compat`` takes the missing mark as a URL like any other, so only its
    first record stays.
    """
    order = [c for c in READ_ORDER if c in records.columns]

    def url_of(parsed: str) -> Column:
        return record_url("raw") if compat else F.col(parsed)

    judged = cut(record_verdict(records, lex=rules.lexicon, compat=compat).select(*order, url_of("url").alias("url"), "is_foreign"))
    dropped = judged.where("is_foreign").select(*order)
    if deduplicate:
        dropped = dropped.unionByName(later_copies(judged.where(~F.col("is_foreign")), order=order))
    kept = without(records, dropped, order)
    own_url = record_url("raw") if compat else F.nullif(record_header("raw", "url"), F.lit(fv.MISSING))
    first = kept.withColumn("url", own_url)
    return first.withColumn("raw", clean_text("raw")) if clean else first
