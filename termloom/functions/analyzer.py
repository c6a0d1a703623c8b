"""Text analysis as plain column expressions.

A *chunk* is a maximal run of characters that are not Unicode white space. Its
*term* is the lower-cased chunk with everything but alphabetic and numeric
characters removed. A chunk made only of other characters becomes the empty
term, which is kept: it has postings and counts towards the field length.

Cleaning works on the whole text rather than chunk by chunk. Lower-casing a
text gives the same as lower-casing its chunks, since the only
context-dependent mapping (final sigma) never looks past white space.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java regular expressions for the two character classes.
WHITE_SPACE_RUN = r"\p{IsWhite_Space}+"
CHUNK = r"[^\p{IsWhite_Space}]+"
NOT_WHITE_SPACE = r"[^\p{IsWhite_Space}]"
NOT_IN_TERM = r"[^\p{IsAlphabetic}\p{N} ]+"


def has_chunk(text: Column) -> Column:
    """Whether there is anything but white space."""
    return text.rlike(NOT_WHITE_SPACE)


def terms_of_nonblank(text: Column) -> Column:
    """The terms of a text that :func:`has_chunk`."""
    single_spaced = F.trim(F.regexp_replace(text, WHITE_SPACE_RUN, " "))
    cleaned = F.regexp_replace(F.lower(single_spaced), NOT_IN_TERM, "")
    return F.split(cleaned, " ", -1)


def analyzed_terms(text: Column) -> Column:
    """``text`` to ``array<string>`` of terms, in text order, empties kept."""
    return F.when(has_chunk(text), terms_of_nonblank(text)).when(
        text.isNotNull(), F.array().cast("array<string>")
    )


def chunk_count(text: Column) -> Column:
    """Field length: the number of chunks, which is the number of terms."""
    return F.regexp_count(text, F.lit(CHUNK)).cast("bigint")
