"""Keyword categorisers and numeric category ladders."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadmill import constants as K
from leadmill.functions.expr import cut, ladder, lookup
from leadmill.functions.text import leading_number

Rules = Sequence[tuple[str, Sequence[str]]]


def categorise(text: Column, rules: Rules, mode: str = "first_match", default: str | None = "Other",
               whole_words: bool = False) -> Column:
    """Category of the first (or last) rule with a keyword in the text, ignoring case.

    ``whole_words`` asks for word boundaries around a keyword, so that ``cto``
    does not hit "director".  One pattern per rule keeps the generated code small
    enough to be compiled.
    """
    if mode not in ("first_match", "last_match"):
        raise ValueError(f"unknown mode {mode}")
    result = None
    for category, words in (rules if mode == "first_match" else list(rules)[::-1]):
        hit = text.rlike(_pattern(words, whole_words))
        result = F.when(hit, F.lit(category)) if result is None else result.when(hit, F.lit(category))
    return result if default is None else result.otherwise(F.lit(default))


def _pattern(words: Sequence[str], whole_words: bool) -> str:
    """Alternation of the literal words; a word that holds another word of the list adds nothing."""
    shortest_first = sorted({w.lower() for w in words}, key=len)
    needed = [w for i, w in enumerate(shortest_first) if not any(o in w for o in shortest_first[:i])]
    edge = r"\b" if whole_words else ""
    return "(?i)" + "|".join(edge + re.sub(r"([^\w\s&/,-])", r"\\\1", w) + edge
                             for w in (shortest_first if whole_words else needed))


def first_category(steps: Sequence[tuple], unset: str = "Other") -> Column:
    """Category of the first (text, rules, mode, whole words) step that gives one other than ``unset``.

    The unset category is a null inside each step, so that every step is
    evaluated at most once per row.
    """
    known = []
    for text, rules, mode, whole_words in steps:
        open_rules = [(None if name == unset else name, words) for name, words in rules]
        known.append(categorise(text, open_rules, mode, None, whole_words))
    return F.coalesce(*known, F.lit(unset))


def json_industries(document: Column) -> Column:
    """Industry names of an organisation document as one lower-case text; null if there are none."""
    names = F.from_json(F.get_json_object(document, "$.industries"), "array<string>")
    joined = F.coalesce(F.array_join(names, " "), F.get_json_object(document, "$.industry"))
    return F.nullif(F.lower(joined), F.lit(""))


def industry_category(industry: Column, document_names: Column | None = None, domain: Column | None = None) -> Column:
    """Industry by name, then by the names in the organisation document, then by web domain.

    ``document_names`` is a column made with ``json_industries`` beforehand, so
    that the document is parsed once and not once per rule.
    """
    steps = [(industry, K.INDUSTRY_RULES, "last_match", False)]
    if document_names is not None:
        steps.append((document_names, K.JSON_INDUSTRY_RULES, "first_match", False))
    if domain is not None:
        steps.append((domain, K.DOMAIN_INDUSTRY_RULES, "first_match", False))
    return first_category(steps)


def seniority_category(seniority: Column, title: Column | None = None, whole_words: bool = False) -> Column:
    """Seniority by its own text, then by the title."""
    steps = [(seniority, K.SENIORITY_RULES, "last_match", False)]
    if title is not None:
        steps.append((title, K.TITLE_SENIORITY_RULES, "first_match", whole_words))
    return first_category(steps)


def title_category(title: Column, seniority: Column | None = None) -> Column:
    """Job family by title, then by seniority."""
    steps = [(title, K.TITLE_RULES, "last_match", False)]
    if seniority is not None:
        steps.append((seniority, K.SENIORITY_TITLE_RULES, "first_match", False))
    return first_category(steps)


def company_size_band(employees: Column) -> Column:
    """Head-count band: ``Unknown`` for a count of zero, null for a missing count."""
    return cut(F.coalesce(employees, F.lit(-1)), *K.SIZE_BINS, lowest=False)


def service_industry(industry: Column) -> Column:
    named = categorise(industry, K.SERVICE_INDUSTRY_RULES, default="other")
    return F.when(F.coalesce(industry, F.lit("")) == "", "unknown").otherwise(named)


def service_industry_code(category: Column) -> Column:
    return lookup(category, K.SERVICE_INDUSTRY_CODES, 0)


def direct_industry_code(industry: Column) -> Column:
    code = categorise(industry, [(str(c), w) for c, w in K.DIRECT_INDUSTRY_CODES], default="7").cast("int")
    return F.when(F.coalesce(industry, F.lit("")) == "", 0).otherwise(code)


def company_size(employees: Column, size_text: Column) -> Column:
    """Size word by head count, else by the words of the size text."""
    by_count = ladder(employees, [(b, name) for b, name, _ in K.EMPLOYEE_COUNT_BUCKETS], None, inclusive=False)
    by_text = categorise(size_text, K.SIZE_TEXT_RULES, default="unknown")
    return F.when(F.coalesce(employees, F.lit(0)) != 0, by_count).otherwise(by_text)


def company_size_code(category: Column) -> Column:
    return lookup(category, K.SIZE_CODES, 0)


def employee_bucket(employees: Column) -> Column:
    known = F.nullif(employees, F.lit(0).cast("bigint"))
    return ladder(known, [(b, span) for b, _, span in K.EMPLOYEE_COUNT_BUCKETS], "unknown", inclusive=False)


def revenue_category(revenue: Column) -> Column:
    """Revenue band of a text such as "5 million"; other units are unknown."""
    amount = F.when(F.contains(F.lower(revenue), F.lit("million")), leading_number(revenue))
    return ladder(amount, K.REVENUE_LEVELS, "unknown", inclusive=False)


def revenue_code(category: Column) -> Column:
    return lookup(category, K.REVENUE_CODES, 0)


def esp_category(code: Column) -> Column:
    result = None
    for codes, label in K.ESP_LABELS:
        result = F.when(code.isin(codes), label) if result is None else result.when(code.isin(codes), label)
    return result.otherwise(ladder(code, K.ESP_RANGES, K.ESP_RANGES[-1][1]))


def list_size_category(count: Column) -> Column:
    return (F.when(count.isNull(), "Unknown").when(count.between(1, 3), "Small Lists (1-3)")
            .when(count.between(4, 10), "Medium Lists (4-10)").otherwise("Large Lists (11+)"))


def domain_category(text: Column, named: Sequence[tuple[str, str]], default: str = "Other Domain") -> Column:
    """Sender group by keyword; the keywords belong to the caller."""
    groups = categorise(text, [(label, [word]) for word, label in named], default=default)
    return F.when(text.isNull(), "Unknown").otherwise(groups)


def company_age_category(founded: Column, as_of: datetime) -> Column:
    age = F.lit(as_of.year) - founded
    return F.when(age < 0, "Invalid").otherwise(ladder(age, K.COMPANY_AGE_LEVELS, "Unknown"))


def business_era(founded: Column) -> Column:
    return ladder(founded, K.BUSINESS_ERAS, "Unknown", inclusive=False)


def daily_limit_bucket(limit: Column) -> Column:
    return ladder(limit, K.DAILY_LIMIT_LEVELS, "Unknown")


def daily_limit_score(limit: Column, coarse: bool = False) -> Column:
    return ladder(limit, K.DAILY_LIMIT_SCORES_COARSE if coarse else K.DAILY_LIMIT_SCORES, 0)


def employee_level(employees: Column) -> Column:
    return ladder(employees, K.EMPLOYEE_LEVELS, "Unknown")


def correlation_label(value: Column) -> Column:
    size = F.abs(value)
    return (F.when(size.isNull(), None).when(size < 0.1, "Very weak").when(size < 0.3, "Weak")
            .when(size < 0.5, "Moderate").otherwise("Strong"))
