"""Title and search expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words without meaning for the comparison of titles.
STOPWORDS = (
    "the", "a", "an", "to", "of", "in", "on", "for", "and", "is", "are", "at", "by", "with",
    "as", "it", "its", "from", "after", "over", "into", "amid", "how", "why", "what", "will",
    "says", "said", "new", "more", "than", "this", "that", "be", "has", "have", "had", "not",
    "but", "or", "was", "were", "been", "being",
)
SHORTEST_TOKEN = 3
TRUNCATION_BYTES = 260


def title_tokens(title: Column) -> Column:
    """Sorted set of the significant words of a title; empty for NULL."""
    pattern = F.lit(f"[a-z0-9]{{{SHORTEST_TOKEN},}}")
    words = F.regexp_extract_all(F.lower(title), pattern, F.lit(0))
    # array_except also removes repeats; unlike filter it needs no lambda per word.
    kept = F.array_except(words, F.array(*[F.lit(word) for word in STOPWORDS]))
    return F.coalesce(F.sort_array(kept), F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    """Shared share of two token sets; 0 when either is empty."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(shared / union)


def is_similar(a: Column, b: Column) -> Column:
    """Jaccard of at least one half, in whole numbers."""
    shared = F.size(F.array_intersect(a, b))
    return (shared > 0) & (3 * shared >= F.size(a) + F.size(b))


def is_truncated(content: Column) -> Column:
    """Whether a body has the length at which one provider cuts; counted in bytes."""
    return F.octet_length(content) >= TRUNCATION_BYTES


def contains_pattern(text: str) -> str:
    """LIKE pattern for a substring; ``%`` and ``_`` of the reader act as wildcards.

    A backslash escapes these and itself; before any other character, where Spark would refuse
    the pattern, it stands for itself.
    """
    return re.sub(r"\\(?:([%_\\])|)", lambda m: m.group() if m.group(1) else "\\\\", f"%{text}%")


def parse_time(text: Column) -> Column:
    """ISO-8601 text as a time in whole seconds; NULL when it cannot be read."""
    return F.date_trunc("second", F.try_to_timestamp(text))
