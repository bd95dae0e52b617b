"""Edit-distance similarity and in-order matching as column expressions (X4, F19)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def string_similarity(a: Column, b: Column) -> Column:
    """X4. 1 - distance / longer length, ignoring case; two empty texts are alike. Lengths count characters."""
    longer = F.greatest(F.length(a), F.length(b))
    distance = F.levenshtein(F.lower(a), F.lower(b))
    return F.when(longer == 0, F.lit(1.0)).otherwise(1 - distance / longer)


def subsequence_pattern(pattern: str) -> str:
    """Regular expression that accepts a lower-cased text holding the characters of ``pattern`` in order.

    Each step skips only characters that differ from the next one wanted, so matching is linear in the text.
    """
    steps = []
    for ch in pattern.lower():
        quoted = re.escape(ch)
        steps.append(f"[^{quoted}]*+{quoted}")
    return "(?s)^" + "".join(steps)


def fuzzy_subsequence(c: Column, pattern: str) -> Column:
    """F19. True when the characters of ``pattern`` occur in order, ignoring case; an empty pattern is always true."""
    if pattern == "":
        return c.isNotNull()
    return F.lower(c).rlike(subsequence_pattern(pattern))
