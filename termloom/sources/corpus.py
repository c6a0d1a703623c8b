"""Documents in: JSON records or any DataFrame, checked row by row.

A record is accepted or goes to the quarantine with a reason; a bad record
never stops a job. Accepted records form a :class:`Corpus`.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.scratch import scratch_path
from termloom.sources.hidden_files import list_files, read_files

# The name of the key that identifies a record, and its limit.
DOCID_KEY = "docid"
MAX_DOCID_BYTES = 32

# Why a record is refused, in the order in which it is tested.
HIDDEN_NAME = "hidden_name"
BAD_UTF8 = "bad_utf8"
BAD_JSON = "bad_json"
DOCID_MISSING = "docid_missing"
DOCID_NOT_STRING = "docid_not_string"
DOCID_TOO_LONG = "docid_too_long"
FIELD_NOT_STRING = "field_not_string"
FIELD_NAME_REFUSED = "field_name_refused"

# Names that a folder of a saved index cannot have.
REFUSED_FIELD_NAMES = ("", "__HIVE_DEFAULT_PARTITION__")

_STRICT_JSON = {
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "maxStringLen": str(2**31 - 1),
}
_STRICT_OBJECT = {**_STRICT_JSON, "columnNameOfCorruptRecord": "bad"}


@dataclass(frozen=True)
class Corpus:
    """Accepted records.

    ``records(docid)`` has one row per record, with or without fields.
    ``texts(docid, field, text)`` has one row per field that is present; an
    empty text is present. A docid may come back in several rows; their
    texts then count as one.
    ``keys(docid, field)`` has a row for each row of ``texts``, possibly more:
    it tells which docids may come back, without reading a text.
    ``quarantine(source, reason)`` holds what was refused: the path of a record,
    or the docid of a row.
    ``many_rows`` says that a docid usually has several rows for a field.
    """

    records: DataFrame
    texts: DataFrame
    keys: DataFrame
    quarantine: DataFrame
    many_rows: bool = False


# --- JSON records -----------------------------------------------------------


def read_json_directory(spark: SparkSession, directory: str) -> DataFrame:
    """``records(path, content, refused)``: the files ``*.json`` directly in a directory.

    Spark passes over names that begin with ``_`` or ``.`` and over files without a byte;
    these are read by a source of their own. One that cannot be opened there (a store
    that only Hadoop reads) has a reason in ``refused``, so that no file is lost without
    trace.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(directory)
    read = files.select("path", "content", F.lit(None).cast("string").alias("refused"))
    listed = list_files(spark, f"{directory.rstrip('/')}/*.json")
    passed_over = [(path, size) for path, size in listed if not size or path.rsplit("/", 1)[1][0] in "_."]
    if not passed_over:
        return read
    unseen = read_files(spark, passed_over)
    refused = F.when(F.col("content").isNull(), HIDDEN_NAME)
    return read.unionByName(unseen.select("path", "content", refused.alias("refused")))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """``records(path, content)``: one record per line, the form for large corpora."""
    lines = spark.read.text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("content")
    )


def parse_records(records: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """``records(path, content[, refused])`` to ``parsed(path, docid, fields, reason)``.

    ``content`` is UTF-8 JSON, binary or string. ``aliases`` maps the source
    keys to keep to index field names; other keys are ignored and an absent
    key stays absent from ``fields``. ``reason`` is null for accepted records.
    Of a repeated key the last value counts.

    Only the keys asked for are turned into values, so what the other keys hold
    does not matter, however much it is.
    """
    _check_aliases(aliases)
    refused = F.col("refused") if "refused" in records.columns else F.lit(None).cast("string")
    text = records.select(
        "path", refused.alias("refused"), F.try_validate_utf8(F.col("content").cast("string")).alias("text")
    )
    keys = [DOCID_KEY, *aliases]
    struct = "struct<" + ", ".join(f"`{key.replace('`', '``')}`: variant" for key in keys) + ">"
    t = F.col("text")
    keyed = F.from_json(_wrapped('{"r":', "text", "}"), f"r {struct}, bad string", _STRICT_OBJECT)
    parsed = _computed_once(text, ["path", "refused", "text"], keyed=keyed).select(
        "path",
        "refused",
        "text",
        "keyed",
        t.rlike(r"^[ \t\r\n]*\{").alias("is_object"),
        # The parser accepts what follows "}" if it goes on like the wrapper.
        t.rlike(r"\}[ \t\r\n]*[,}]").alias("may_go_on"),
    )
    alone = F.from_json(_wrapped("[", "text", "]"), f"array<{struct}>", _STRICT_JSON)
    other = F.from_json(_wrapped("[", "text", "]"), "array<variant>", _STRICT_JSON)
    keyed_other = F.from_json(_wrapped('{"r":', "text", "}"), "r variant, bad string", _STRICT_OBJECT)
    values = parsed.select(
        "path",
        "refused",
        t.isNotNull().alias("is_utf8"),
        F.when(
            F.col("is_object"),
            F.col("keyed.bad").isNull() & (~F.col("may_go_on") | (F.size(F.when(F.col("may_go_on"), alone)) == 1)),
        )
        .otherwise((F.size(other) == 1) & keyed_other["bad"].isNull())
        .alias("is_json"),
        *[F.col("keyed.r")[key].alias(f"v{i}") for i, key in enumerate(keys)],
    )
    typed = values.select(
        "path",
        "refused",
        "is_utf8",
        F.coalesce("is_json", F.lit(False)).alias("is_json"),
        *[
            F.struct(
                F.col(f"v{i}").isNotNull().alias("present"),
                (F.schema_of_variant(f"v{i}") == "STRING").alias("is_string"),
                F.try_variant_get(f"v{i}", "$", "string").alias("text"),
            ).alias(f"k{i}")
            for i in range(len(keys))
        ],
    )
    docid = _trimmed_docid(F.col("k0.text"))
    names = list(aliases.values())
    reason = (
        F.when(F.col("refused").isNotNull(), F.col("refused"))
        .when(~F.col("is_utf8"), BAD_UTF8)
        .when(~F.col("is_json"), BAD_JSON)
        .when(~F.col("k0.present"), DOCID_MISSING)
        .when(~F.col("k0.is_string"), DOCID_NOT_STRING)
        .when(F.octet_length("k0.text") > MAX_DOCID_BYTES, DOCID_TOO_LONG)
    )
    for i in range(1, len(keys)):
        reason = reason.when(
            F.col(f"k{i}.present") & ~F.col(f"k{i}.is_string"), FIELD_NOT_STRING
        )
    fields = _sparse_map({name: F.col(f"k{i}.text") for i, name in enumerate(names, 1)})
    return _computed_once(typed, ["path"], docid=docid, fields=fields, reason=reason)


def stage_records(parsed: DataFrame) -> DataFrame:
    """Write parsed records once, so that every later job reads the result.

    Both the accepted and the refused records come from ``parsed``; without
    this step each of them would parse all the JSON again.
    """
    spark = parsed.sparkSession
    path = scratch_path(spark, "records")
    parsed.write.parquet(path)
    return spark.read.schema(parsed.schema).parquet(path)


def split_records(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs(docid, fields)`` and ``quarantine(path, reason)``."""
    docs = parsed.where(F.col("reason").isNull()).select("docid", "fields")
    refused = parsed.where(F.col("reason").isNotNull()).select("path", "reason")
    return docs, refused


def read_corpus(
    spark: SparkSession, directory: str, aliases: Mapping[str, str], mode: str = "quarantine"
) -> Corpus:
    """The corpus of a directory of JSON files, one document per file.

    ``mode="strict"`` raises if any record was refused.
    """
    _check_mode(mode)
    parsed = stage_records(parse_records(read_json_directory(spark, directory), aliases))
    return corpus_from_records(parsed, mode)


def corpus_from_records(parsed: DataFrame, mode: str = "quarantine") -> Corpus:
    """The corpus of ``parsed(path, docid, fields, reason)``, best staged first."""
    _check_mode(mode)
    docs, refused = split_records(parsed)
    if mode == "strict":
        worst = refused.limit(1).collect()
        if worst:
            raise ValueError(f"refused {worst[0]['path']}: {worst[0]['reason']}")
    return Corpus(
        records=docs.select("docid"),
        texts=docs.select("docid", F.explode("fields").alias("field", "text")),
        keys=_one_key_per_record(docs),
        quarantine=refused.select(F.col("path").alias("source"), "reason"),
    )


# --- DataFrames -------------------------------------------------------------


def corpus_from_columns(
    df: DataFrame, docid: str, columns: Mapping[str, str]
) -> Corpus:
    """One record per row. ``columns`` maps column names to index field names.

    A null value is an absent field.
    """
    _check_aliases(columns)
    checked = df.select(
        _docid_reason(F.col(docid)).alias("reason"),
        _trimmed_docid(F.col(docid)).alias("docid"),
        *[F.col(name).cast("string").alias(f"c{i}") for i, name in enumerate(columns)],
    )
    accepted = checked.where(F.col("reason").isNull())
    pairs = [
        F.struct(F.lit(field).alias("field"), F.col(f"c{i}").alias("text"))
        for i, field in enumerate(columns.values())
    ]
    if len(pairs) == 1:
        texts = accepted.select("docid", *[pairs[0][name].alias(name) for name in ("field", "text")])
    else:
        texts = accepted.select("docid", F.inline(F.array(*pairs)))
    return Corpus(
        records=accepted.select("docid"),
        texts=texts.where(F.col("text").isNotNull()),
        keys=_one_key_per_record(accepted),
        quarantine=_refused(checked),
    )


def corpus_from_rows(df: DataFrame, docid: str, field: str, text: str) -> Corpus:
    """One row per piece of a field, in any number: all rows of a docid are one
    record, and all rows of a docid and field are one text. Rows without a field
    or text are records all the same; a field name that cannot be saved is refused."""
    bad_name = F.col(field).cast("string").isin(*REFUSED_FIELD_NAMES)
    checked = df.select(
        _docid_reason(F.col(docid)).when(bad_name, FIELD_NAME_REFUSED).alias("reason"),
        _trimmed_docid(F.col(docid)).alias("docid"),
        F.col(field).cast("string").alias("field"),
        F.col(text).cast("string").alias("text"),
    )
    accepted = checked.where(F.col("reason").isNull())
    return Corpus(
        records=accepted.select("docid").distinct(),
        texts=accepted.select("docid", "field", "text").where(
            F.col("text").isNotNull() & F.col("field").isNotNull()
        ),
        keys=accepted.select("docid", "field"),
        quarantine=_refused(checked),
        many_rows=True,
    )


# --- helpers ----------------------------------------------------------------


def _wrapped(start: str, text: str, end: str) -> Column:
    return F.concat(F.lit(start), F.col(text), F.lit("\n" + end))


def _computed_once(df: DataFrame, kept: list[str], **columns: Column) -> DataFrame:
    """``df`` with the columns ``kept`` and new ones, each computed once for a row.

    The optimizer puts the expression of a column wherever the column is used, in later
    projections and in filters that it moves down. It does not do so with what a
    generator gives, here one row for a row. The outer form has no filter on the array,
    which would be moved down with a copy as well.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*kept, F.inline_outer(F.array(row)))


def _trimmed_docid(docid: Column) -> Column:
    """Trailing NUL characters are not part of the identity."""
    return F.rtrim(docid.cast("string"), F.lit("\0"))


def _one_key_per_record(records: DataFrame) -> DataFrame:
    return records.select("docid", F.lit("").alias("field"))


def _refused(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNotNull()).select(F.col("docid").alias("source"), "reason")


def _docid_reason(docid: Column) -> Column:
    return F.when(docid.isNull(), DOCID_MISSING).when(
        F.octet_length(docid.cast("string")) > MAX_DOCID_BYTES, DOCID_TOO_LONG
    )


def _sparse_map(columns: Mapping[str, Column]) -> Column:
    """A map of the columns that are not null."""
    entries = F.array_compact(
        F.array(
            *[
                F.when(column.isNotNull(), F.struct(F.lit(name).alias("k"), column.alias("v")))
                for name, column in columns.items()
            ]
        )
    )
    return F.map_from_entries(entries)


def _check_aliases(aliases: Mapping[str, str]) -> None:
    names = list(aliases.values())
    if not names:
        raise ValueError("name at least one field")
    if len(set(names)) != len(names):
        raise ValueError(f"two source keys lead to the same index field: {names}")
    if set(names) & set(REFUSED_FIELD_NAMES):
        raise ValueError("an index field needs a name, other than Spark's name for null")


def _check_mode(mode: str) -> None:
    if mode not in ("quarantine", "strict"):
        raise ValueError(f"mode must be 'quarantine' or 'strict', got {mode!r}")
