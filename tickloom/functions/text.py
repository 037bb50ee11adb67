"""Text predicates and extractors as column expressions (Unicode-aware, ignoring case)."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.functions.phrases import PhraseIndex, once
from tickloom.vocab import (
    COMPREHENSIVE_PHRASES,
    GREETING_PHRASES,
    NEWS_MIN_DESCRIPTION,
    NEWS_PHRASES,
    RELEVANT_TERMS,
    SPAM_TITLE_TERMS,
    SYMBOL_ALIASES,
    TECHNICAL_PHRASES,
)

PLAIN = re.compile(r"[\w ]+")


def text_or_empty(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def article_id(url: Column) -> Column:
    """md5 of the url; a missing url hashes as the empty string."""
    return F.md5(text_or_empty(url))


def clean_text(x: Column) -> Column:
    """Drop tags, squeeze whitespace runs to one blank, trim."""
    no_tags = F.regexp_replace(text_or_empty(x), r"<[^>]+>", "")
    return F.trim(F.regexp_replace(no_tags, r"(?U)\s+", " "))


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def is_spam_title(title: Column, terms: Iterable[str] = SPAM_TITLE_TERMS) -> Column:
    """Any term as a substring."""
    lowered = F.lower(text_or_empty(title))
    return once(lowered, lambda x: _any(F.contains(x, F.lit(t.lower())) for t in terms))


def is_relevant(text: Column, terms: Iterable[str] = RELEVANT_TERMS) -> Column:
    """Any term as whole words.

    One split of the text and one look-up of its words among the terms'; trying a hundred alternatives at every position
    of a long text is several times slower.
    """
    return once(F.lower(text), PhraseIndex(dict.fromkeys(terms, "")).holds)


def good_article(
    title: Column,
    description: Column,
    spam: Iterable[str] = SPAM_TITLE_TERMS,
    relevant: Iterable[str] = RELEVANT_TERMS,
    min_length: int = NEWS_MIN_DESCRIPTION,
) -> Column:
    """Long enough description, no spam term in the title, a relevant word somewhere."""
    both = F.concat_ws(" ", text_or_empty(title), text_or_empty(description))
    return (
        (F.length(text_or_empty(description)) >= min_length)
        & ~is_spam_title(title, spam)
        & is_relevant(both, relevant)
    )


def mentioned_symbols(text: Column, aliases: Mapping[str, str] = SYMBOL_ALIASES) -> Column:
    """Sorted distinct symbols whose alias occurs in `text` as whole words."""
    return once(F.lower(text_or_empty(text)), PhraseIndex(aliases).found)


def symbol_mentions(text: Column, aliases: Mapping[str, str] = SYMBOL_ALIASES) -> Column:
    """Every place of every alias in the lower-cased `text`: start, length, term and value (the symbol)."""
    return once(F.lower(text_or_empty(text)), PhraseIndex(aliases).mentions)


def _says(lowered: Column, phrases: Iterable[str]) -> Column:
    """Any phrase as a substring pattern.

    Plain phrases are substring tests; a pattern is tried only where its plain beginning occurs.
    """
    plain, rest = [], []
    for phrase in (p.lower() for p in phrases):
        head = PLAIN.match(phrase)
        if head and head.group() == phrase:
            plain.append(F.contains(lowered, F.lit(phrase)))
        elif head:
            plain.append(F.contains(lowered, F.lit(head.group())) & F.rlike(lowered, F.lit("(?U)" + phrase)))
        else:
            rest.append(phrase)
    if rest:
        plain.append(F.rlike(lowered, F.lit("(?U)(?:" + "|".join(rest) + ")")))
    return _any(plain)


def intent_labels(message: Column) -> Column:
    """Array of work areas a chat message asks for; empty for a greeting, NULL when unclear."""
    trimmed = F.lower(F.regexp_replace(text_or_empty(message), r"(?U)^\s+|\s+$", ""))
    greeting = F.lit("(?U)^(" + "|".join(GREETING_PHRASES) + ")$")
    return once(
        trimmed,
        lambda msg: F.when(F.rlike(msg, greeting), F.array().cast("array<string>")).otherwise(
            once(
                F.struct(
                    _says(msg, TECHNICAL_PHRASES).alias("technical"),
                    _says(msg, NEWS_PHRASES).alias("news"),
                    _says(msg, COMPREHENSIVE_PHRASES).alias("broad"),
                ),
                _areas,
            )
        ),
    )


def _areas(says: Column) -> Column:
    return (
        F.when(says["broad"] | (says["technical"] & says["news"]), F.lit(["technical", "news", "deep"]))
        .when(says["technical"], F.lit(["technical"]))
        .when(says["news"], F.lit(["news"]))
    )


def json_in_text(text: Column, schema: str) -> Column:
    """The outermost {...} of a free text, parsed; NULL where there is none or it is broken."""
    body = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.from_json(F.nullif(body, F.lit("")), schema)
