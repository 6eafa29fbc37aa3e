"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters after which a word starts, besides white space.
WORD_BREAKS = r"""!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>"""


def title_case(text: Column) -> Column:
    """Every word starts with a capital: 'jean-luc o.brien' -> 'Jean-Luc O.Brien'.

    Spark's ``initcap`` breaks at white space only, so hyphenated names need this.
    """
    words = F.regexp_extract_all(
        F.lower(text), F.lit(rf"([^\s{WORD_BREAKS}]*[\s{WORD_BREAKS}]?)"), F.lit(1)
    )
    capitals = F.transform(
        words,
        lambda w: F.concat(
            F.upper(w.substr(F.lit(1), F.lit(1))), w.substr(F.lit(2), F.length(w))
        ),
    )
    return F.array_join(capitals, "")


def contains_ignoring_case(text: Column, needle: str) -> Column:
    """The needle is plain text: '%' and '_' have no special meaning."""
    return F.contains(F.lower(text), F.lower(F.lit(needle)))
