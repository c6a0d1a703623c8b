"""Personal data by forms and, from there, by contexts (bootstrapping).

The forms of ``KINDS`` give the seeds. What looks like an identifier of a *class*
(something with an at sign, dotted numbers, a short or a long run of digits) but has
none of the forms is a candidate. Every mention, seed or candidate, is an instance (its
value, freed of signs and blanks) and stands in lexical patterns: the word before it,
the word after it, both, and the two words before, each with the class. Spark scores
the graph of patterns and instances in rounds, for each kind:

* A pattern's confidence is the sum of the scores of its different instances over
  their number plus one. It counts from ``LEAST_SUPPORT`` on, if it is confident enough.
* A seed's score is 1; that of another instance is 1 - product(1 - confidence) over its
  patterns. Instances that reach ``ACCEPTED`` support patterns in the next round.

Mentions of instances accepted at the end are added to the seeds, also where the value
of a seed is written in another form. Seeds stay as they are.

Texts are read once; what is kept of them are mentions and their few words of context.
Edges are counted as different pairs and are split by a salt, so neither a frequent
word nor a frequent identifier is one task.

Defined cases: a null text is empty and has no spans; texts are read whole; a context is
looked for within ``WINDOW`` characters; repeated rows and null ids give a row each;
other columns are passed over; an empty table has no rows. Of several kinds of an
instance the one with the best score counts, of equal ones the first of ``KINDS``.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.common import documents, ids_and_texts, shared_table, slices

# The kinds, in order, and the forms of their identifiers.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

#: A pattern counts with this many (scores of) different instances ...
LEAST_SUPPORT = 3.0
#: ... and this confidence; instances count from a score on.
LEAST_CONFIDENCE = 0.5
ACCEPTED = 0.8
ROUNDS = 3
#: Characters in which the words beside a mention are looked for.
WINDOW = 200
#: A frequent pattern or instance is spread over so many tasks.
SALTS = 8
SLICE_BYTES = 1 << 20

_SPAN = "struct<kind:int,start:bigint,end:bigint>"
_MENTION = "struct<kind:int,start:bigint,end:bigint,class:string,value:string,patterns:array<string>>"
_READ = f"row bigint, doc_id bigint, seeds array<{_SPAN}>, mentions array<{_MENTION}>"
_ARROW_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_ARROW_MENTION = pa.struct(
    [*_ARROW_SPAN, ("class", pa.string()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))]
)

# --- forms ----------------------------------------------------------------------------

# A match cannot begin inside a run of the characters it begins with, but for where the
# match before it has ended: the guard spares trying each character of a long run.
_LOCAL = "A-Za-z0-9._%+-"
_EMAIL_HERE = re.compile(rf"[{_LOCAL}]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_EMAIL = re.compile(rf"(?<![{_LOCAL}])" + _EMAIL_HERE.pattern)
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_DIGIT_GROUPS = re.compile(r"[0-9]+(?:[ -][0-9]+)*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def seeds_in(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the identifiers that have a form, by start and kind."""
    found = []
    at = 0
    while "@" in text:
        # Where the match before it has ended, a match may begin within a run.
        match = (at and _EMAIL_HERE.match(text, at)) or _EMAIL.search(text, at)
        if not match:
            break
        at = match.end()
        found.append((match.start(), EMAIL, at))
    for match in _IP.finditer(text):
        parts = [part.lstrip("0") for part in match[0].split(".")]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            found.append((match.start(), IP, match.end()))
    for match in _DIGIT_GROUPS.finditer(text):
        if match.end() - match.start() >= 14:
            digits = _NOT_DIGIT.sub("", match[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((match.start(), CARD, match.end()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", match[0])) <= 15:
                found.append((match.start(), PHONE, match.end()))
    return sorted(found)


# --- mentions ---------------------------------------------------------------------------

_DOMAIN = "[A-Za-z0-9-]+"
_OPEN, _CLOSE, _GAP = r"[\[({<]", r"[\])}>]", r"\s{0,3}"
_AT = rf"(?:{_GAP}{_OPEN}{_GAP}(?:at|@){_GAP}{_CLOSE}{_GAP}|\s{{1,3}}(?:at|@)\s{{1,3}}|{_GAP}@{_GAP})"
_DOT = rf"(?:{_GAP}{_OPEN}{_GAP}(?:dot|\.){_GAP}{_CLOSE}{_GAP}|\s{{1,3}}dot\s{{1,3}}|\.)"
_MAIL_LIKE = re.compile(rf"(?<![{_LOCAL}])[{_LOCAL}]+{_AT}{_DOMAIN}(?:{_DOT}{_DOMAIN})+", re.IGNORECASE)
_DOTTED = re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?![0-9])", re.IGNORECASE)
_DIGITS = re.compile(r"(?<![0-9A-Za-z])\+?\(?[0-9](?:[ ().\-/]{0,3}[0-9])+(?![0-9A-Za-z])")
# Where a stretch with too many digits is cut: at wide gaps, and then at all.
_SEPARATORS = (re.compile(r"[ ().\-/]{2,3}"), re.compile(r"[ ().\-/]+"))
_AT_WORD, _DOT_WORD = re.compile(r"[\s\[({<]at[\s\])}>]", re.IGNORECASE), re.compile(r"[\s\[({<]dot[\s\])}>]", re.IGNORECASE)
_BLANKS = re.compile(r"[\s\[\](){}<>]+")

# Which kinds a class may turn out to be.
CLASS_KINDS = {"mail": (EMAIL,), "dotted": (IP,), "long": (CARD, PHONE), "short": (PHONE,)}


def value_of(kind_class: str, written: str) -> str:
    """The identifier without the signs that come and go: two writings have one value."""
    if kind_class == "mail":
        return _BLANKS.sub("", _DOT_WORD.sub(".", _AT_WORD.sub("@", written))).lower()
    if kind_class == "dotted":
        return _BLANKS.sub("", _DOT_WORD.sub(".", written))
    digits = _NOT_DIGIT.sub("", written)
    # With and without the number of the country.
    return digits[-10:] if kind_class == "short" else digits


def _digit_class(n_digits: int) -> str | None:
    return "short" if 7 <= n_digits <= 13 else "long" if 14 <= n_digits <= 19 else None


def candidates_in(text: str) -> Iterator[tuple[int, int, str]]:
    """``(start, end, class)`` of what looks like an identifier."""
    for match in _MAIL_LIKE.finditer(text):
        yield match.start(), match.end(), "mail"
    for match in _DOTTED.finditer(text):
        yield match.start(), match.end(), "dotted"
    for match in _DIGITS.finditer(text):
        yield from _digit_candidates(text, match.start(), match.end(), _SEPARATORS)


def _digit_candidates(text: str, start: int, end: int, separators: tuple[re.Pattern, ...]) -> Iterator[tuple[int, int, str]]:
    """The stretch itself or, if it has too many digits, its parts: several identifiers
    may stand side by side."""
    n_digits = len(_NOT_DIGIT.sub("", text[start:end]))
    kind_class = _digit_class(n_digits)
    if kind_class:
        yield start, end, kind_class
    elif n_digits > 19 and separators:
        for gap in separators[0].finditer(text, start, end):
            yield from _digit_candidates(text, start, gap.start(), separators[1:])
            start = gap.end()
        yield from _digit_candidates(text, start, end, separators[1:])


def patterns_of(text: str, start: int, end: int, kind_class: str) -> list[str]:
    """The lexical patterns in which a mention stands."""

    def word(words: list[str], i: int) -> str:
        bare = words[i].strip("\"'.,;:!?()[]{}<>=*#&%$-").lower() if -len(words) <= i < len(words) else ""
        return bare if len(bare) <= 40 else bare[:20] + "…" + bare[-19:]

    before, after = text[max(0, start - WINDOW) : start].split(), text[end : end + WINDOW].split()
    left, left2, right = word(before, -1), word(before, -2), word(after, 0)
    found = []
    if left:
        found.append(f"{left} <{kind_class}>")
    if right:
        found.append(f"<{kind_class}> {right}")
    if left and right:
        found.append(f"{left} <{kind_class}> {right}")
    if left and left2:
        found.append(f"{left2} {left} <{kind_class}>")
    return found


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans, those that overlap as one."""
    found: list[tuple[int, int]] = []
    for start, end in spans:
        if found and start < found[-1][1]:
            found[-1] = found[-1][0], max(end, found[-1][1])
        else:
            found.append((start, end))
    return found


def mentions_in(text: str) -> tuple[list[dict], list[dict]]:
    """The seeds, and all mentions with their values and patterns (seeds first)."""
    seeds = seeds_in(text)
    mentions = []
    for start, kind, end in seeds:
        digits = len(_NOT_DIGIT.sub("", text[start:end]))
        kind_class = ("mail", "dotted", "long", _digit_class(digits))[kind]
        mentions.append((kind, start, end, kind_class))
    # Candidates that touch a seed or a candidate before them fall away.
    taken = _joined(sorted((start, end) for start, _, end in seeds))
    starts = [start for start, _ in taken]
    last = 0
    for start, end, kind_class in sorted(candidates_in(text)):
        before = bisect_left(starts, end)
        if start >= last and (not before or taken[before - 1][1] <= start):
            mentions.append((-1, start, end, kind_class))
            last = end
    rows = [
        {
            "kind": kind,
            "start": start,
            "end": end,
            "class": kind_class,
            "value": f"{kind_class}:{value_of(kind_class, text[start:end])}",
            "patterns": patterns_of(text, start, end, kind_class),
        }
        for kind, start, end, kind_class in mentions
    ]
    return [{"kind": kind, "start": start, "end": end} for start, kind, end in seeds], rows


def read_mentions(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, seeds, mentions)`` for every row of ``docs(doc_id, text)``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            found = [mentions_in(text.as_py() or "") for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([seeds for seeds, _ in found], pa.list_(_ARROW_SPAN)),
                    pa.array([mentions for _, mentions in found], pa.list_(_ARROW_MENTION)),
                ],
                names=["row", "doc_id", "seeds", "mentions"],
            )

    rows = ids_and_texts(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return rows.mapInArrow(each, _READ)


# --- the graph ----------------------------------------------------------------------------


def _salt(other: str) -> Column:
    return F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int")


def _salted(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _admitted() -> Column:
    """Whether the class at the beginning of a value may be of a kind."""
    pairs = [F.lit(f"{name}{kind}") for name, kinds in CLASS_KINDS.items() for kind in kinds]
    return F.concat(F.substring_index("value", ":", 1), F.col("kind").cast("string")).isin(*pairs)


def score_patterns(edges: DataFrame, scores: DataFrame) -> DataFrame:
    """``(pattern, kind, support, confidence)`` of the patterns that count."""
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    reached = edges.withColumn("salt", _salt("pattern")).join(_salted(scores), ["value", "salt"])
    support = reached.groupBy("pattern", "kind").agg(F.sum("score").alias("support"))
    support = support.where(F.col("support") >= LEAST_SUPPORT)
    scored = support.join(sizes, "pattern").withColumn("confidence", F.col("support") / (F.col("n") + 1))
    return scored.where(F.col("confidence") >= LEAST_CONFIDENCE).select("pattern", "kind", "support", "confidence")


def score_instances(edges: DataFrame, patterns: DataFrame, seeds: DataFrame) -> DataFrame:
    """``(value, kind, score)`` of the instances that are accepted, seeds included."""
    reached = edges.withColumn("salt", _salt("value")).join(_salted(patterns), ["pattern", "salt"])
    doubt = F.sum(F.log(1 - F.col("confidence")))
    found = reached.groupBy("value", "kind").agg((1 - F.exp(doubt)).alias("score"))
    found = found.where((F.col("score") >= ACCEPTED) & _admitted()).select("value", "kind", "score")
    return found.unionByName(seeds).groupBy("value", "kind").agg(F.max("score").alias("score"))


def bootstrap(mentions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``patterns(pattern, kind, support, confidence)`` and ``instances(value, kind, score)``
    of ``mentions(kind, value, patterns)``, where kind is -1 but for seeds."""
    edges = mentions.select("value", F.explode("patterns").alias("pattern")).distinct()
    edges = shared_table(edges, "edges")
    seeds = mentions.where(F.col("kind") >= 0).select("value", "kind").distinct()
    seeds = shared_table(seeds.withColumn("score", F.lit(1.0)), "seeds")
    scores = seeds
    for _ in range(ROUNDS):
        patterns = shared_table(score_patterns(edges, scores), "patterns")
        scores = shared_table(score_instances(edges, patterns, seeds), "instances")
    return patterns, scores


# --- spans ----------------------------------------------------------------------------------


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``(doc_id, seeds, added)`` for every row of ``docs(doc_id, text)``: arrays of
    ``(kind, start, end)``, in code points, the end exclusive, by start and kind."""
    read = shared_table(read_mentions(docs), "mentions")
    mentions = read.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    _, scores = bootstrap(mentions)
    best = scores.groupBy("value").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("best"))
    best = best.select("value", (-F.col("best.k")).alias("kind"))
    new = mentions.where(F.col("kind") < 0).drop("kind").withColumn("salt", _salt("row"))
    new = new.join(_salted(best), ["value", "salt"])
    spans = F.sort_array(F.collect_list(F.struct("start", "kind", "end")))
    added = new.groupBy("row").agg(spans.alias("added"))
    in_order = F.transform("added", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return read.join(added, "row", "left").select(
        "doc_id", "seeds", F.coalesce(in_order, F.array().cast(f"array<{_SPAN}>")).alias("added")
    )


def op11_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(documents(spark, sf_dir))
    names = F.array(*[F.lit(name) for name in KINDS])

    def written(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])))

    def by_start(spans: Column) -> Column:
        keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
        return F.sort_array(keyed)

    def n_of(kind: int) -> Column:
        return F.size(F.filter("seeds", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    return found.select(
        "doc_id",
        *[n_of(kind) for kind in range(len(KINDS))],
        F.sha2(written(F.col("seeds")), 256).alias("base_sha256"),
        written(by_start(F.concat("seeds", "added"))).alias("spans"),
        F.size("added").cast("bigint").alias("n_added"),
    )
