"""Text matching helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPECIAL = re.compile(r"([\\.^$|?*+()\[\]{}\-&~#])")


def literal_pattern(text: str) -> str:
    """A regular expression that matches ``text`` itself."""
    return _SPECIAL.sub(r"\\\1", text)


def search_pattern(texts: list[str], match_case: bool, match_words: bool) -> str:
    """One pattern for any of ``texts``, the longest first."""
    options = []
    for text in sorted(texts, key=len, reverse=True):
        option = literal_pattern(text)
        if match_words:
            option = (r"\b" if re.match(r"\w", text) else "") + option
            option += r"\b" if re.search(r"\w$", text) else ""
        options.append(option)
    return ("" if match_case else "(?i)") + "(?:" + "|".join(options) + ")"


def literal_replacement(text: str) -> str:
    """``text`` as the replacement of ``regexp_replace``, with nothing special in it."""
    return text.replace("\\", "\\\\").replace("$", "\\$")


def replaced(
    value: Column, texts: list[str], replacement: str, match_case: bool, match_words: bool
) -> Column:
    texts = [t for t in texts if t]
    if not texts:
        return value
    if match_case and not match_words and len(texts) == 1:
        return F.replace(value, F.lit(texts[0]), F.lit(replacement))
    return F.regexp_replace(
        value, search_pattern(texts, match_case, match_words), literal_replacement(replacement)
    )
