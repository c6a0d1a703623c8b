"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ids_and_texts(docs: DataFrame) -> DataFrame:
    """``(doc_id long, text string)`` of any table that has these two columns."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def with_record(docs: DataFrame) -> DataFrame:
    """``(record struct)``: whole rows, so that no name can clash, and ``text string``
    beside them if the text within is not a string. See :func:`with_text`."""
    # An operator that keeps rows moves their text within the record only.
    record = F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("record")
    if [field.dataType for field in docs.schema if field.name == "text"] == [StringType()]:
        return docs.select(record)
    return docs.select(record, F.col("text").cast("string").alias("text"))


def with_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``text`` to batches with a ``record``; what lies within is not copied."""
    for batch in batches:
        yield batch if "text" in batch.schema.names else batch.append_column("text", column(batch, "record").field("text"))


def shared_table(df: DataFrame, label: str, folders: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it again; this cuts the lineage.

    Rows lie in folders by the columns ``folders``, so that some can be read alone.

    The folder is that of ``spark.checkpoint.dir``. Only a local session, as in
    tests, may go without the setting and then gets a temporary folder.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.partitionBy(*folders).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_remainder(doc_id: str, divisor: int):
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % divisor


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The rows in order, in batches of about ``max_bytes`` of text (one row at least).

    What a task has used is given back at its end, since its Python worker goes on."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        lengths = np.zeros(batch.num_rows, np.int64)
        lengths[:] = pa.compute.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths) // max_bytes
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            yield batch.slice(start, end - start)
    batch = column = None
    release()


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    """``malloc_trim``, where the C library has it."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give free memory back to the system."""
    pa.default_memory_pool().release_unused()
    if _trim() is not None:
        _trim()(0)


_remembered: dict[Hashable, object] = {}


def remembered(key: Hashable, make: Callable[[], object]) -> object:
    """What a Python worker keeps from one task to the next, one thing at a time."""
    if key not in _remembered:
        forget()
        _remembered[key] = make()
    return _remembered[key]


def forget() -> None:
    """Drop it: a worker outlives the tasks of an operator."""
    _remembered.clear()


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A text column as UTF-8 bytes."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def words_of(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """The words of texts (cut at ASCII white space) as numbers, the distinct words, and
    how many each text has."""
    numbers, words, sizes = _coded_words(texts)
    return numbers, words.to_pylist(), sizes


def joined_words_of(texts: list[bytes]) -> tuple[np.ndarray, bytes, np.ndarray]:
    """:func:`words_of`, with the distinct words joined by spaces."""
    numbers, words, sizes = _coded_words(texts)
    return numbers, pa.compute.binary_join(pa.ListArray.from_arrays([0, len(words)], words), b" ")[0].as_py(), sizes


def _coded_words(texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    split = pa.compute.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
    coded = split.flatten().dictionary_encode()
    numbers, words = coded.indices.to_numpy(), coded.dictionary.cast(pa.binary())
    ends = split.offsets.to_numpy() - split.offsets[0].as_py()
    # White space at the start or end of a text leaves an empty word.
    empty = pa.compute.index(words, b"").as_py()
    if empty >= 0:
        last = len(words) - 1
        # The last word takes the place of the empty one.
        order = np.arange(last)
        order[empty:][:1] = last
        words = words.take(pa.array(order))
        kept = numbers != empty
        ends = np.concatenate([[0], np.cumsum(kept)])[ends]
        numbers = numbers[kept]
        numbers = np.where(numbers == last, empty, numbers).astype(np.int32)
    return numbers, words, np.diff(ends).astype(np.int64)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def tokenizer_path(name: str) -> str:
    """A vocabulary file of the public tokenizers on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def one_thread() -> None:
    """Spark deals out the cores; a task must not start threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
