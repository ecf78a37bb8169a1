"""Text features: cleaning, counting, flags and list-of-addresses features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadmill import constants as K
from leadmill.functions.expr import any_of, flag


def clean_text(text: Column) -> Column:
    """Lower-case, without punctuation, single blanks; letters of every script stay."""
    letters = F.regexp_replace(F.lower(text), r"(?U)[^\w\s]", "")
    return F.trim(F.regexp_replace(letters, r"(?U)\s+", " "))


def combine(columns: Sequence[str]) -> Column:
    """The non-null texts joined by one blank."""
    return F.concat_ws(" ", *[F.col(c).cast("string") for c in columns])


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != "")).cast("bigint")


def _share(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))


def shape_features(text: Column) -> dict[str, Column]:
    """Length, words and character-class shares of the raw text."""
    words = word_count(text)
    return {
        "text_length": F.length(text).cast("bigint"),
        "text_word_count": words,
        "text_char_count": F.length(text).cast("bigint"),
        "text_avg_word_length": F.length(text) / F.greatest(words, F.lit(1)),
        "text_uppercase_ratio": _share(text, "[A-Z]"),
        "text_digit_ratio": _share(text, "[0-9]"),
        "text_punctuation_ratio": _share(text, r"(?U)[^\w\s]"),
    }


def content_flags(text: Column) -> dict[str, Column]:
    return {
        "has_numbers_in_text": flag(text.rlike("[0-9]")),
        "has_email_in_text": flag(F.contains(text, F.lit("@"))),
        "has_url_in_text": flag(F.contains(text, F.lit("http"))),
    }


def marketing_flags(text: Column) -> dict[str, Column]:
    """Phone and link patterns, excitement marks and the share of capitals."""
    return {
        "has_phone": flag(text.rlike(K.PHONE_PATTERN)),
        "has_url": flag(text.rlike(K.URL_PATTERN)),
        "exclamation_count": F.regexp_count(text, F.lit("!")).cast("bigint"),
        "question_count": F.regexp_count(text, F.lit("[?]")).cast("bigint"),
        "caps_ratio": F.regexp_count(text, F.lit("[A-Z]")) / (F.length(text) + 1),
    }


def quality_score(text: Column, any_source_missing: Column | None = None, legacy: bool = False) -> Column:
    """0 to 3: long enough, enough words, no missing source.

    ``legacy`` keeps the older third point, which is lost whenever the letters
    ``nan`` occur anywhere in the text.
    """
    third = ~F.contains(text, F.lit("nan")) if legacy or any_source_missing is None else ~any_source_missing
    return flag(F.length(text) > 10) + flag(word_count(text) > 3) + flag(third)


def address_list_features(text: Column) -> dict[str, Column]:
    """Number of addresses in a list text, their distinct domains, diversity and text length."""
    found = F.coalesce(F.regexp_extract_all(text, F.lit(K.EMAIL_PATTERN), F.lit(0)), F.array().cast("array<string>"))
    domains = F.size(F.array_distinct(F.transform(found, lambda a: F.split_part(a, F.lit("@"), F.lit(2)))))
    return {
        "email_count": F.size(found).cast("bigint"),
        "unique_domains": domains.cast("bigint"),
        "list_diversity": domains / F.greatest(F.size(found), F.lit(1)),
        "list_length": F.coalesce(F.length(text), F.lit(0)).cast("bigint"),
    }


def clean_profile_url(url: Column) -> Column:
    """Profile address without its query string; null when it is no personal profile."""
    bare = F.split_part(url, F.lit("?"), F.lit(1))
    return F.when(bare.rlike(K.PROFILE_URL_PATTERN), bare)


def domain_guess(company: Column) -> Column:
    """Probable web domain of a company name."""
    name = F.trim(F.lower(company))
    for suffix in (" inc", " llc", " corp", " ", "-"):
        name = F.replace(name, F.lit(suffix), F.lit(""))
    return F.concat(name, F.lit(".com"))


def interaction(left: str, right: str, missing: str = "Unknown") -> Column:
    """``left_right`` with a placeholder for nulls."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(missing)) for c in (left, right)]
    return F.concat_ws("_", *parts)


def leading_number(text: Column) -> Column:
    """First run of digits as a number."""
    return F.nullif(F.regexp_extract(text, r"\d+", 0), F.lit("")).try_cast("bigint")


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "").try_cast("bigint")


def shorten(text: Column, width: int) -> Column:
    """Cut for display, with dots when something was cut."""
    return F.when(F.length(text) > width, F.concat(F.left(text, F.lit(width)), F.lit("..."))).otherwise(text)


def keyword_flag(text: Column, words: Sequence[str]) -> Column:
    """1 when the lower-cased text holds one of the words."""
    return flag(any_of(F.lower(text), words))
