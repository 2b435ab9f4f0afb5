"""Category spellings, phone numbers and complaint keywords."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringwatch.schema import CHANNEL_SPELLINGS, KEYWORD_PATTERNS, LABEL_SPELLINGS, PREFIX_DIGITS, SCORE_WORDS


def respell(value: Column, spellings: Mapping[str, str]) -> Column:
    """Replace exact matches from ``spellings``; everything else passes through."""
    pairs = [F.lit(x) for pair in spellings.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), value)


def clean_channel(channel: Column) -> Column:
    return respell(channel, CHANNEL_SPELLINGS)


def clean_label(label: Column) -> Column:
    return respell(label, LABEL_SPELLINGS)


def canonical_label(label: Column) -> Column:
    """Lower snake case: trimmed, lowered, dashes to underscores; null stays null."""
    return F.regexp_replace(F.lower(F.trim(label)), "-", "_")


def digits_only(number: Column) -> Column:
    return F.regexp_replace(number, r"[^0-9]", "")


def number_prefix(number: Column, length: int = PREFIX_DIGITS) -> Column:
    """The first ``length`` digits of a phone number."""
    return F.substring(digits_only(number), 1, length)


def fold(text: Column) -> Column:
    """Lower case, null as empty text."""
    return F.lower(F.coalesce(text, F.lit("")))


def keyword_flags(text: Column, patterns: Mapping[str, str] = KEYWORD_PATTERNS) -> dict[str, Column]:
    """Keyword name -> whether the whole text holds its pattern."""
    folded = fold(text)
    return {name: folded.rlike(pattern) for name, pattern in patterns.items()}


def keyword_score(text: Column, words: Sequence[str] = SCORE_WORDS) -> Column:
    """How many of ``words`` occur in the text; 0 without text."""
    folded = fold(text)
    hits = [folded.contains(word).cast("int") for word in words]
    return sum(hits[1:], hits[0])
