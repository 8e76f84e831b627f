"""Language filter over article rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressline.functions import language as L
from pressline.functions.text import let, words
from pressline.operators.records import parse_records
from pressline.params import Lexicon

LEX = Lexicon()


def with_tokens(df: DataFrame, *, body: Column | str = "content", lex: Lexicon = LEX, sample: bool = False, **searches: Column) -> DataFrame:
    """Add the lower-cased body, its terms, its words and their hit mask, the input of all rules on the text.

    ``sample`` adds the same for the words around the middle; ``searches`` are term searches of other
    columns.  All searches come last and in one step, so that a task holds one Python worker for them.
    """
    lowered = let(df, body_lower=F.lower(body))
    split = let(lowered, body_words=words("body_lower"))
    masked = let(split, hit_mask=L.hit_mask("body_words", lex))
    if sample:
        masked = let(masked, _mid_words=L.mid_words("body_words", "hit_mask", lex), _mid_mask=L.mid_mask("hit_mask", lex))
        searches["_mid_terms"] = L.body_terms("_mid_words", lex)
    return let(masked, body_terms=L.body_terms("body_lower", lex), **searches)


TOKEN_COLUMNS = ("body_lower", "body_words", "body_terms", "hit_mask")


def language_verdict(
    df: DataFrame, *, title: str | None = "title", body: str = "content", lex: Lexicon = LEX,
    metrics: bool = False,
) -> DataFrame:
    """Add ``is_foreign`` and ``foreign_reason``; with ``metrics`` the counts too."""
    out = let(
        with_tokens(df, body=body, lex=lex),
        foreign_reason=L.verdict_reason(title, body, "body_terms", "hit_mask", lex),
    ).withColumn("is_foreign", F.col("foreign_reason").isNotNull())
    if metrics:
        out = (
            out.withColumn("n_words", L.mask_words("hit_mask"))
            .withColumn("n_hits", L.mask_hits("hit_mask"))
            .withColumn("max_run", L.mask_max_run("hit_mask"))
        )
    return out.drop(*TOKEN_COLUMNS)


def mid_sample_verdict(df: DataFrame, *, body: str = "content", lex: Lexicon = LEX) -> DataFrame:
    """Add ``mid_foreign``: the verdict on the words around the middle, no title.

    Texts of up to ``sample_over`` words are not sampled and give false.
    """
    judged = with_mid_reason(with_tokens(df, body=body, lex=lex, sample=True), lex=lex)
    return judged.withColumn("mid_foreign", F.col("mid_reason").isNotNull()).drop(*TOKEN_COLUMNS, "mid_reason")


def with_mid_reason(tokens: DataFrame, *, lex: Lexicon = LEX, only: Column | None = None) -> DataFrame:
    """Add ``mid_reason`` from the tokens of the whole body and their sample, without splitting it again.

    ``only`` restricts the work to the rows where it still matters.
    """
    reason = L.verdict_reason(None, "_mid_words", "_mid_terms", "_mid_mask", lex)
    return let(tokens, mid_reason=reason if only is None else F.when(only, reason)).drop("_mid_words", "_mid_terms", "_mid_mask")


def record_verdict(records: DataFrame, *, raw: str = "raw", lex: Lexicon = LEX, compat: bool = False) -> DataFrame:
    """Parse record texts and judge their language."""
    return language_verdict(parse_records(records, raw=raw, compat=compat), lex=lex)


def local_only(records: DataFrame, *, raw: str = "raw", lex: Lexicon = LEX, compat: bool = False) -> DataFrame:
    """Records that are not foreign, in their input columns."""
    return record_verdict(records, raw=raw, lex=lex, compat=compat).where(~F.col("is_foreign")).select(*records.columns)


def split_sides(judged: DataFrame) -> DataFrame:
    """Add ``lang_side`` ('local' / 'foreign'): one pass, one partition column."""
    return judged.withColumn("lang_side", side(F.col("is_foreign")))


def side(is_foreign: Column) -> Column:
    return F.when(is_foreign, "foreign").otherwise("local")


def max_run_islands(df: DataFrame, key: str, *, body: str = "content", lex: Lexicon = LEX) -> DataFrame:
    """Longest run of lexicon words per row, relationally.

    Explodes the words and groups consecutive hits by (position - rank among
    hits).  Same result as the mask form, which needs no shuffle; kept as its
    independent check.  The words of one text spread over the whole cluster only
    up to that text's own size.
    """
    tokens = df.select(key, F.posexplode(words(F.lower(body))).alias("pos", "w"))
    hits = tokens.where(F.btrim("w", F.lit(lex.strip_chars)).isin(*lex.terms))
    ranked = hits.withColumn("rank", F.expr(f"row_number() over (partition by {key} order by pos)"))
    runs = ranked.groupBy(key, (F.col("pos") - F.col("rank")).alias("island")).agg(F.count("*").alias("run"))
    best = runs.groupBy(key).agg(F.max("run").alias("max_run"))
    return df.select(key).join(best, key, "left").select(key, F.coalesce("max_run", F.lit(0)).cast("bigint").alias("max_run"))
