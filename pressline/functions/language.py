"""Language rules as columns.

The text is tokenised once into a *hit mask*: a string with one character per
word, ``1`` where the stripped word is a lexicon term and ``0`` elsewhere.
Word count, hit count, longest run and the mid-text sample are then plain
string functions on that mask, without another pass over the text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressline.functions.terms import terms_in
from pressline.functions.text import col, contains_any, sql_text, words
from pressline.params import Lexicon


def has_body(body: Column | str) -> Column:
    body = col(body)
    return F.coalesce((body != "") & (body != "N/A"), F.lit(False))


def title_keyword(title: Column | str, lex: Lexicon) -> Column:
    return F.coalesce(contains_any(F.lower(col(title)), lex.title_keywords), F.lit(False))


def body_terms(low: Column | str, lex: Lexicon) -> Column:
    """Counts of B terms, B phrases and all phrases in the lower-cased text, in one pass over it."""
    return terms_in(low, terms_b=lex.terms_b, phrases_b=lex.phrases_b, phrases=lex.phrases)


def strong_phrase(n_phrases: Column | str) -> Column:
    """Any phrase in a text, from its count of phrases."""
    return F.coalesce(col(n_phrases) > 0, F.lit(False))


def title_word_hits(title: Column | str, lex: Lexicon) -> Column:
    """Title words in the lexicon; punctuation is *not* stripped here."""
    return F.size(F.filter(words(F.lower(col(title))), lambda w: w.isin(*lex.terms)))


def title_tokens_hit(title: Column | str, lex: Lexicon) -> Column:
    title = col(title)
    hits, n = title_word_hits(title, lex), F.size(words(title))
    return F.coalesce(
        (title != "") & ((hits >= lex.title_hits) | ((hits > 0) & (n < lex.short_title))),
        F.lit(False),
    )


def hit_mask(words_column: str, lex: Lexicon) -> Column:
    """One character per word of a column of lower-cased words: 1 for a lexicon term."""
    terms = ", ".join(sql_text(t) for t in lex.terms)
    chars = sql_text(lex.strip_chars)
    return F.expr(f"array_join(transform({words_column}, w -> if(btrim(w, {chars}) in ({terms}), '1', '0')), '')")


def mask_words(mask: Column | str) -> Column:
    return F.length(col(mask)).cast("bigint")


def mask_hits(mask: Column | str) -> Column:
    return F.length(F.replace(col(mask), F.lit("0"), F.lit(""))).cast("bigint")


def mask_max_run(mask: Column | str) -> Column:
    runs = F.transform(F.split(col(mask), "0+"), lambda r: F.length(r))
    return F.coalesce(F.array_max(runs), F.lit(0)).cast("bigint")


def mask_has_run(mask: Column | str, k: int) -> Column:
    return F.contains(col(mask), F.lit("1" * k))


def over_share(mask: Column | str, lex: Lexicon) -> Column:
    """Strictly more than ``percent`` of the words are hits (integer arithmetic)."""
    return mask_hits(mask) * 100 > mask_words(mask) * lex.percent


def max_run_folded(body: Column | str, lex: Lexicon) -> Column:
    """Longest run of hits by folding over the words (check of ``mask_max_run``)."""
    acc = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(a: Column, w: Column) -> Column:
        run = F.when(F.btrim(w, F.lit(lex.strip_chars)).isin(*lex.terms), a["run"] + 1).otherwise(0)
        return F.struct(run.alias("run"), F.greatest(a["best"], run).alias("best"))

    return F.aggregate(words(F.lower(col(body))), acc, step, lambda a: a["best"]).cast("bigint")


def verdict_reason(title: Column | str | None, body: Column | str, terms: Column | str,
                   mask: Column | str, lex: Lexicon) -> Column:
    """First rule that calls the article foreign, NULL for a local one.

    ``terms`` are the ``body_terms`` of the lower-cased body and ``mask`` its hit
    mask; both are columns of their own, so the branches below share one pass
    over the text.  The second phrase rule repeats the B phrases, which an
    earlier rule has already taken, so it can only name A phrases.
    """
    terms, mask = col(terms), col(mask)
    reason = F.when(~has_body(body), F.lit(None).cast("string"))
    if title is not None:
        reason = reason.when(title_keyword(title, lex), "title_keyword")
    reason = reason.when(strong_phrase(terms["phrases_b"]), "strong_phrase")
    if title is not None:
        reason = reason.when(title_tokens_hit(title, lex), "title_tokens")
    return (
        reason.when(over_share(mask, lex), "token_share")
        .when(mask_hits(mask) >= lex.min_hits, "token_hits")
        .when(strong_phrase(terms["phrases"]), "phrase_ab")
        .when(mask_has_run(mask, lex.min_run), "consecutive")
    )


def mid_start(mask: Column | str) -> Column:
    """1-based place of the middle word, NULL where the text is too short to sample."""
    n = F.length(col(mask))
    return F.floor(n / 2).cast("int") + 1


def mid_words(words_column: str, mask: Column | str, lex: Lexicon) -> Column:
    """Words around the middle joined by blanks; NULL for a short text."""
    sample = F.slice(col(words_column), mid_start(mask), F.lit(lex.sample_size))
    return F.when(F.length(col(mask)) > lex.sample_over, F.array_join(sample, " "))


def mid_mask(mask: Column | str, lex: Lexicon) -> Column:
    """The hit mask of ``mid_words``."""
    return F.substr(col(mask), mid_start(mask), F.lit(lex.sample_size))
