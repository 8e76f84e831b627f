"""Parameter objects handed to the operators.

Every site-specific value is a parameter; the defaults come from
``fixed_values``.  Replace a field with ``dataclasses.replace``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pressline import fixed_values as fv


@dataclass(frozen=True)
class Site:
    """The portal whose pages are processed."""

    domain: str = "news.example"
    name: str = "news"
    scheme: str = "https"

    @property
    def base_url(self) -> str:
        return f"{self.scheme}://{self.domain}"


@dataclass(frozen=True)
class Lexicon:
    """Foreign-language terms and the thresholds of the language rules."""

    terms_a: tuple[str, ...] = tuple(fv.INDICATORS_A)
    terms_b: tuple[str, ...] = tuple(fv.INDICATORS_B)
    phrases_a: tuple[str, ...] = tuple(fv.PHRASES_A)
    phrases_b: tuple[str, ...] = tuple(fv.PHRASES_B)
    title_keywords: tuple[str, ...] = tuple(fv.TITLE_KEYWORDS)
    strip_chars: str = fv.TOKEN_STRIP_CHARS
    title_hits: int = 2
    short_title: int = 5
    percent: int = 8
    min_hits: int = 15
    min_run: int = 3
    max_substrings: int = 20
    sample_over: int = 100
    sample_size: int = 50

    @property
    def terms(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(self.terms_a + self.terms_b))

    @property
    def phrases(self) -> tuple[str, ...]:
        return self.phrases_a + self.phrases_b


@dataclass(frozen=True)
class Blacklist:
    """What makes a link or a title unwanted."""

    urls: tuple[str, ...] = ()
    terms: tuple[str, ...] = tuple(fv.BLACKLISTED_TERMS)
    title_starters: tuple[str, ...] = tuple(fv.TITLE_STARTERS)
    title_indicators: tuple[str, ...] = tuple(fv.INDICATORS_B)
    title_indicator_min: int = 3
    title_rejects: tuple[str, ...] = tuple(fv.TITLE_REJECTS)
    lang_paths: tuple[str, ...] = tuple(fv.LANG_PATHS)
    url_patterns: tuple[str, ...] = tuple(fv.FOREIGN_URL_PATTERNS)
    subtitles: tuple[str, ...] = tuple(fv.BLACKLISTED_SUBTITLES)
    html_title_a: tuple[str, ...] = tuple(fv.HTML_TITLE_TERMS_A)
    html_title_b: tuple[str, ...] = tuple(fv.HTML_TITLE_TERMS_B)
    allowed_langs: tuple[str, ...] = tuple(fv.ALLOWED_LANGS)


Groups = tuple[tuple[tuple[str, ...], str], ...]


def _groups(rows) -> Groups:
    return tuple((tuple(terms), value) for terms, value in rows)


@dataclass(frozen=True)
class Categories:
    """Ordered category rule tables; the first match wins in each."""

    default: str = fv.DEFAULT_CATEGORY
    standard: tuple[str, ...] = tuple(fv.STANDARD_CATEGORIES)
    url_segments: tuple[tuple[str, str], ...] = tuple(fv.URL_CATEGORIES)
    url_keywords: Groups = field(default_factory=lambda: _groups(fv.URL_KEYWORDS))
    url_strict: tuple[tuple[str, str], ...] = tuple(fv.URL_CATEGORIES_STRICT)
    names: tuple[tuple[str, str], ...] = tuple(fv.NAME_CATEGORIES)
    stems: Groups = field(default_factory=lambda: _groups(fv.STEM_CATEGORIES))
    title: Groups = field(default_factory=lambda: _groups(fv.TITLE_CATEGORIES))
    listing: tuple[tuple[str, str], ...] = tuple(fv.LISTING_SEGMENTS)


@dataclass(frozen=True)
class Rules:
    """Everything a page-to-article job needs to know about its site."""

    site: Site = Site()
    lexicon: Lexicon = Lexicon()
    blacklist: Blacklist = Blacklist()
    categories: Categories = Categories()


DEFAULT_RULES = Rules()
