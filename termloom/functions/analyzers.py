"""Analyzers that can take the place of the default one.

An analyzer turns a text into an array of terms, as a column expression. It has a name
and a version, which an index keeps: a query text is only looked up in an index of the
same analyzer. Who changes what an analyzer gives should raise its version.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from termloom.functions.analyzer import analyzed_terms

# Fixed value: what parts words, everything but letters and digits.
BETWEEN_PARTS = r"[^\p{IsAlphabetic}\p{N}]+"


@dataclass(frozen=True)
class Analyzer:
    """``terms`` maps a text to ``array<string>``, null to null. Each term counts towards
    the length of a field, the empty term too if there is one."""

    name: str
    version: int
    terms: Callable[[Column], Column] = field(compare=False)

    @property
    def label(self) -> str:
        """What is stored with an index."""
        return f"{self.name}/{self.version}"


#: Chunks between white space, without the characters that are no letter or digit.
WORDS = Analyzer("words", 1, analyzed_terms)


def word_parts(stop_words: Iterable[str] = (), plurals: bool = False) -> Analyzer:
    """Lower-cased runs of letters and digits, so that an address or ``re-use`` gives
    several terms and signs alone none. Stop words are left out; ``plurals`` takes the
    ending of English plurals off. Its choices are part of the name."""
    stops = sorted(set(stop_words))

    def terms(text: Column) -> Column:
        spaced = F.trim(F.regexp_replace(F.lower(text), BETWEEN_PARTS, " "))
        found = F.split(spaced, " ", -1)
        if plurals:
            found = F.transform(found, without_plural)
        # A text without any part is one empty string here.
        left_out = F.array(*[F.lit(word) for word in ["", *stops]])
        return F.filter(found, lambda term: ~F.array_contains(left_out, term))

    name = "parts" + ("+plurals" if plurals else "")
    return Analyzer(name + (f"-[{','.join(stops)}]" if stops else ""), 1, terms)


def without_plural(term: Column) -> Column:
    """The weak stemmer of Harman (1991): of the first ending that fits, ``ies`` becomes ``y``
    unless ``e`` or ``a`` is before it; ``es`` becomes ``e`` unless ``a``, ``e`` or ``o`` is; an
    ``s`` is dropped unless ``u`` or ``s`` is."""
    shorter = lambda n: F.substring(term, F.lit(1), F.char_length(term) - n)
    return (
        F.when(term.rlike("(^|[^ea])ies$"), F.concat(shorter(3), F.lit("y")))
        .when(term.rlike("(^|[^aeo])es$") & ~term.endswith("ies"), shorter(1))
        .when(term.rlike("[^us]s$") & ~term.endswith("es"), shorter(1))
        .otherwise(term)
    )
