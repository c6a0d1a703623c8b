"""Log likelihoods of whole documents under a recurrent language model.

The texts are cut into words once and written as slices of bounded size: the
distinct words of a slice, and its texts as their numbers. Word counts cover all
training texts: every slice gives the counts of its own words, dealt to buckets by their
hashes, a bucket adds up its words, and each slice gets back the sums of just the
words it holds, by their numbers, so neither the driver nor any task holds the
vocabulary. The most frequent words are modelled one by one, the others as classes
by their ending, within which a word has its share of the corpus.

The network is trained on every token of every training document, in rounds with
other slices each: the slices of a round train from the same weights, and what
they come to is averaged by the number of tokens. Both the rounds and the slices
of a round grow as the root of the corpus, so more text means more updates one
after the other. Then all documents are scored, from the first token to the end.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.common import column, crc_remainder, documents, ids_and_texts, joined_words_of, shared_table, utf8
from termloom.llm.gru import CLASS_SIZE, FIRST_SQUARES, Model, Shape, first_weights

#: Held out: a tenth of the documents.
FOLDS, HELD_OUT = 10, 0
SLICE_BYTES = 10 << 20
#: Words with an output of their own at least, and classes of the others.
FREQUENT, RARE_CLASSES = 3072, 32
#: A word has an output if it occurs as often as the root of all tokens times this.
FREQUENT_ROOT = 0.25
#: Added to every count.
ADDED = 0.1
#: Buckets of words at least, and slices for each in a large corpus.
BUCKETS, BUCKET_SLICES = 128, 2
#: Counts that go back to the slices in one go.
_PAIRS = 1 << 20
_PIECE = 8192


def tokens_of(text: bytes) -> list[bytes]:
    """Words of a text: runs of bytes other than ASCII white space, A-Z as a-z."""
    return text.lower().split()


def rare_class(word: bytes) -> int:
    """The class of a rare word, by its last two bytes."""
    return zlib.crc32(word[-2:]) % RARE_CLASSES


@lru_cache(maxsize=1)
def _class_of_ending() -> np.ndarray:
    """Classes by last byte but one and last byte; with a space before a word of one byte."""
    endings = (bytes([a, b]) for a in range(256) for b in range(256))
    return np.fromiter((rare_class(ending.removeprefix(b" ")) for ending in endings), np.int32, 1 << 16)


def rare_classes(words: list[bytes]) -> np.ndarray:
    """:func:`rare_class` of words without white space."""
    raw = np.frombuffer(b" ".join([b"", *words, b""]), np.uint8)
    ends = np.flatnonzero(raw == 0x20)[1:]
    return _class_of_ending()[raw[ends - 2].astype(np.int32) << 8 | raw[ends - 1]]


# --- slices -----------------------------------------------------------------

_SLICE = "slice bigint, round int, n_training bigint, ids binary, marks binary, sizes binary, numbers binary, words binary"


def round_count(text_bytes: int, slice_bytes: int) -> int:
    """As many rounds as a round has slices."""
    return math.isqrt(max(0, -(-text_bytes // slice_bytes) - 1)) + 1


def _slices(docs: DataFrame, slice_bytes: int, rounds: int) -> DataFrame:
    """One row for about ``slice_bytes`` of text, dealt to the rounds of training.

    ``marks``: 1 training, 2 held out, 4 no id.
    """
    remainder = crc_remainder("doc_id", FOLDS)
    mark = F.when(F.col("doc_id").isNull(), 4).when(remainder == HELD_OUT, 2).otherwise(1).cast("tinyint")
    rows = ids_and_texts(docs).select("doc_id", "text", mark.alias("mark"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        base, first_round = part << 24, zlib.crc32(str(part).encode())
        ids, marks, texts, size = [], [], [], 0
        for batch in batches:
            columns = column(batch, "doc_id").to_pylist(), column(batch, "mark").to_pylist(), utf8(batch, "text")
            for doc_id, own, text in zip(*columns):
                ids.append(doc_id or 0)
                marks.append(own)
                texts.append(text or b"")
                size += len(texts[-1])
                if size >= slice_bytes:
                    yield _slice_row(base + number, (first_round + number) % rounds, ids, marks, texts)
                    ids, marks, texts, size, number = [], [], [], 0, number + 1
        if ids:
            yield _slice_row(base + number, (first_round + number) % rounds, ids, marks, texts)

    return rows.mapInArrow(gather, _SLICE)


def _slice_row(number: int, of_round: int, ids: list[int], marks: list[int], texts: list[bytes]) -> pa.RecordBatch:
    """``sizes`` are the texts' words, ``numbers`` their places among ``words``, the distinct ones."""
    numbers, words, sizes = joined_words_of([text.lower() for text in texts])
    pack = zstandard.ZstdCompressor(level=1).compress
    values = [
        pa.array([number], pa.int64()),
        pa.array([of_round], pa.int32()),
        pa.array([sum(mark == 1 for mark in marks)], pa.int64()),
        pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
        pa.array([bytes(marks)], pa.binary()),
        pa.array([sizes.tobytes()], pa.binary()),
        pa.array([pack(numbers.tobytes())], pa.binary()),
        pa.array([pack(words)], pa.binary()),
    ]
    return pa.record_batch(values, names=["slice", "round", "n_training", "ids", "marks", "sizes", "numbers", "words"])


def _words(row: dict) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(row["words"]).split()


def _numbers(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """The words of a slice's texts one after the other, as numbers, and the texts' ends among them."""
    numbers = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["numbers"]), np.int32)
    return numbers, np.cumsum(np.frombuffer(row["sizes"], np.int64))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


# --- counts -----------------------------------------------------------------


def word_counts(slices: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(word, c, slices)``: how often each word occurs in training texts, and
    which slices hold it, under which number. Words of held-out texts alone have 0.

    A slice gives one row for each of the ``buckets`` into which words fall by their hashes.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            words, (numbers, ends) = _words(row), _numbers(row)
            if not words:
                continue
            training = np.frombuffer(row["marks"], np.uint8) == 1
            learned = np.repeat(training, np.diff(ends, prepend=0))
            bucket = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)).astype(np.int64) % buckets
            order, cuts = _groups(bucket)
            values = np.bincount(numbers[learned], minlength=len(words))[order]
            words, number = np.array(words, object)[order].tolist(), order.astype(np.int32)
            yield pa.record_batch(
                [
                    pa.array(bucket[order][cuts[:-1]]),
                    pa.array(np.full(len(cuts) - 1, row["slice"], np.int64)),
                    pa.array([b" ".join(words[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    _cut(number, cuts),
                    _cut(values, cuts),
                ],
                names=["bucket", "slice", "words", "numbers", "values"],
            )

    def add(table: pa.Table) -> pa.Table:
        split = [words.split() for words in table.column("words").to_pylist()]
        coded = pa.array(list(chain.from_iterable(split)), pa.binary()).dictionary_encode()
        order, cuts = _groups(coded.indices.to_numpy())
        numbers, values = _joined(table, "numbers", np.int32), _joined(table, "values", np.int64)
        number_of_slice = np.repeat(table.column("slice").to_numpy(), [len(words) for words in split])
        places = pa.StructArray.from_arrays([pa.array(number_of_slice[order]), pa.array(numbers[order])], names=["slice", "number"])
        return pa.table(
            {
                "word": coded.dictionary.cast(pa.string()),
                "c": np.add.reduceat(values[order], cuts[:-1]),
                "slices": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), places),
            }
        )

    rows = slices.select("slice", "marks", "sizes", "numbers", "words").mapInArrow(
        deal, "bucket bigint, slice bigint, words binary, numbers binary, values binary"
    )
    return rows.groupBy("bucket").applyInArrow(add, "word string, c bigint, slices array<struct<slice:bigint,number:int>>")


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order of ``keys`` below 2^32, and where each key starts in it, with the end of all."""
    # Short numbers are sorted by their digits.
    order = np.argsort(keys.astype(np.uint16), kind="stable")
    if keys.max(initial=0) >= 1 << 16:
        order = order[np.argsort((keys[order] >> 16).astype(np.uint16), kind="stable")]
    return order, np.append(np.flatnonzero(np.diff(keys[order], prepend=-1)), len(keys))


def _cut(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    return pa.array([values[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())


def _joined(rows: pa.Table | pa.RecordBatch, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column(name).to_pylist()), kind)


class Vocabulary:
    """Frequent words, class by class, and sums for the classes of rare words."""

    def __init__(self, frequent: dict[bytes, int], rare: dict[int, tuple[int, int]], n_texts: int, total: int, distinct: int) -> None:
        # Words with the same ending lie in the same class.
        self.frequent = sorted(frequent, key=lambda word: (word[::-1], word))
        self.token = {word: i + 1 for i, word in enumerate(self.frequent)}
        self.counts = np.array([frequent[word] for word in self.frequent], np.float64)
        self.rare_sum = np.array([rare.get(k, (0, 0))[0] for k in range(RARE_CLASSES)], np.float64)
        self.rare_distinct = np.array([rare.get(k, (0, 0))[1] for k in range(RARE_CLASSES)], np.float64)
        #: Training tokens with the ends of texts, and distinct ones.
        self.n_texts, self.total, self.distinct = n_texts, total, distinct
        # The classes grow in number and in size alike.
        wider = max(1, round(math.sqrt(len(self.frequent) / FREQUENT)))
        self.shape = Shape(len(self.frequent), RARE_CLASSES, CLASS_SIZE * wider)

    def first_weights(self) -> np.ndarray:
        shape = self.shape
        shares = np.zeros(shape.n_classes)
        shares[0] = self.n_texts
        np.add.at(shares, 1 + np.arange(len(self.counts)) // shape.class_size, self.counts)
        shares[1 + shape.n_word_classes :] = self.rare_sum
        number = np.arange(len(self.counts)) // shape.class_size
        inner = self.counts / np.maximum(1.0, np.bincount(number, self.counts)[number]) if len(number) else self.counts
        return first_weights(shape, (shares + 0.1) / (shares + 0.1).sum(), inner)

    def base(self, c: np.ndarray) -> np.ndarray:
        """Base log10 probability of tokens with these counts."""
        return np.log10((c + ADDED) / (self.total + ADDED * (self.distinct + 1)))

    def model_tokens(self, words: list[bytes]) -> np.ndarray:
        found = np.fromiter(map(self.token.get, words, repeat(0)), np.int32, len(words))
        rare = found == 0
        found[rare] = 1 + self.shape.n_frequent + rare_classes(words)[rare]
        return found

    def within_rare(self, tokens: np.ndarray, c: np.ndarray) -> np.ndarray:
        """log10 share of a rare word in its class; 0 for other tokens. All
        unknown words of a class are one."""
        k = tokens - 1 - self.shape.n_frequent
        rare = k >= 0
        found = np.zeros(len(tokens))
        own = k[rare]
        found[rare] = np.log10((c[rare] + ADDED) / (self.rare_sum[own] + ADDED * (self.rare_distinct[own] + 1)))
        return found


def vocabulary(counts: DataFrame, n_texts: int) -> Vocabulary:
    """The frequent words and a few sums come to the driver.

    Words with an output of their own are those that occur ``FREQUENT_ROOT`` times
    the root of all tokens, so there are more of them in a larger corpus (at most
    that root over ``FREQUENT_ROOT``), and ``FREQUENT`` at least.
    """
    known = counts.where(F.col("c") > 0)
    ending = F.crc32(F.substring(F.col("word").cast("binary"), -2, 2)) % RARE_CLASSES
    by_class = known.groupBy(ending.alias("class")).agg(F.sum("c").alias("c"), F.count("*").alias("n"))
    rare = {row["class"]: (row["c"], row["n"]) for row in by_class.collect()}
    total, distinct = (sum(row[i] for row in rare.values()) for i in (0, 1))
    n_frequent = max(FREQUENT, known.where(F.col("c") >= FREQUENT_ROOT * math.sqrt(total)).count())
    top = known.select("word", "c").orderBy(F.desc("c"), "word").limit(n_frequent).collect()
    frequent = {row["word"].encode(): row["c"] for row in top}
    for word, c in frequent.items():
        of_class, n = rare[rare_class(word)]
        rare[rare_class(word)] = of_class - c, n - 1
    has_texts = int(n_texts > 0)
    return Vocabulary(frequent, rare, n_texts, total + n_texts, distinct + has_texts)


# --- training ---------------------------------------------------------------


def _texts(tokens: np.ndarray, numbers: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Texts as tokens, each with its end."""
    every = np.insert(tokens[numbers], ends, np.int32(0))
    return np.split(every, (ends + np.arange(1, len(ends) + 1))[:-1])


def lessons(row: dict, vocab: Vocabulary) -> list[np.ndarray]:
    """The training texts of a slice, each whole."""
    texts = _texts(vocab.model_tokens(_words(row)), *_numbers(row))
    return [text for mark, text in zip(row["marks"], texts) if mark == 1]


def _trained(slices: DataFrame, vocab: Vocabulary, weights: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One round: the means of the weights and squares that its slices come to."""
    shared = slices.sparkSession.sparkContext.broadcast((vocab, weights, squares))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, start, start_squares = shared.value
        total, seen = np.zeros(2 * len(start)), 0
        for row in _rows(batches):
            texts = lessons(row, own)
            if texts:
                model = Model(own.shape, start, start_squares)
                n = model.train(texts)
                total[: len(start)] += n * model.weights.astype(np.float64)
                total[len(start) :] += n * model.squares.astype(np.float64)
                seen += n
        if seen:
            salt = TaskContext.get().partitionId() % 64
            for piece, at in enumerate(range(0, len(total), _PIECE)):
                yield _weights_row(piece, salt, seen, total[at : at + _PIECE])

    columns = slices.select("marks", "sizes", "numbers", "words")
    sums = columns.mapInArrow(train, _WEIGHTS)
    # Added up in two steps, so that no task gets a row of every slice.
    sums = sums.repartition("piece", "salt").sortWithinPartitions("piece", "salt").mapInArrow(_added, _WEIGHTS)
    sums = sums.withColumn("salt", F.lit(0)).repartition("piece").sortWithinPartitions("piece").mapInArrow(_added, _WEIGHTS)
    rows = sorted(sums.collect(), key=lambda r: r["piece"])
    if not rows:
        return weights, squares
    means = np.concatenate([np.frombuffer(r["total"], np.float64) / r["n"] for r in rows]).astype(np.float32)
    return means[: len(weights)], means[len(weights) :]


_WEIGHTS = "piece int, salt int, n bigint, total binary"


def _weights_row(piece: int, salt: int, n: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([piece], pa.int32()), pa.array([salt], pa.int32()), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())],
        names=["piece", "salt", "n", "total"],
    )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of neighbouring rows with the same piece and salt."""
    key, n, total = None, 0, None
    for row in _rows(batches):
        own = np.frombuffer(row["total"], np.float64)
        if (row["piece"], row["salt"]) == key:
            n, total = n + row["n"], total + own
        else:
            if key is not None:
                yield _weights_row(*key, n, total)
            key, n, total = (row["piece"], row["salt"]), row["n"], own
    if key is not None:
        yield _weights_row(*key, n, total)


# --- scoring ----------------------------------------------------------------


def _by_slice(counts: DataFrame) -> DataFrame:
    """``(slice, places, c)``: counts of words that a slice holds, and the words' numbers in it."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            lists = column(batch, "slices")
            slices, numbers = lists.flatten().flatten()
            c = np.repeat(column(batch, "c").to_numpy(), np.diff(lists.offsets.to_numpy()))
            held.append((slices.to_numpy(), numbers.to_numpy(), c))
            size += len(c)
            if size >= _PAIRS:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    def packed(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        slices, numbers, c = (np.concatenate(parts) for parts in zip(*held))
        coded = pa.array(slices).dictionary_encode()
        order, cuts = _groups(coded.indices.to_numpy())
        values = [coded.dictionary, _cut(numbers[order], cuts), _cut(c[order], cuts)]
        return pa.record_batch(values, names=["slice", "places", "c"])

    return counts.select("c", "slices").mapInArrow(gather, "slice bigint, places binary, c binary")


def _scored(slices: DataFrame, counts: DataFrame, vocab: Vocabulary, weights: np.ndarray) -> DataFrame:
    shared = slices.sparkSession.sparkContext.broadcast((vocab, weights))
    contents = ("ids", "marks", "sizes", "numbers", "words")
    nothing = F.lit(None).cast("binary")
    words = _by_slice(counts).select("slice", F.lit(0).alias("kind"), "places", "c", *[nothing.alias(name) for name in contents])
    texts = slices.select("slice", F.lit(1).alias("kind"), nothing.alias("places"), nothing.alias("c"), *contents)
    met = words.unionByName(texts).repartition("slice").sortWithinPartitions("slice", "kind")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, start = shared.value
        model = Model(own.shape, start)
        places: list[np.ndarray] = []
        values: list[np.ndarray] = []
        for batch in batches:
            kinds = column(batch, "kind").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(kinds)) + 1).tolist(), len(kinds)]
            for low, high in zip(cuts, cuts[1:]):
                part = batch.slice(low, high - low)
                if high > low and kinds[low] == 0:
                    places.append(_joined(part, "places", np.int32))
                    values.append(_joined(part, "c", np.int64))
                    continue
                for row in _rows([part]):
                    counted = np.zeros(sum(map(len, places)), np.int64)
                    if places:
                        counted[np.concatenate(places)] = np.concatenate(values)
                    yield _score_slice(row, own, model, counted)
                    places, values = [], []

    schema = (
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double"
    )
    return met.mapInArrow(score, schema)


def _score_slice(row: dict, vocab: Vocabulary, model: Model, c: np.ndarray) -> pa.RecordBatch:
    """``c`` has the counts of the words of the slice."""
    tokens, (numbers, ends) = vocab.model_tokens(_words(row)), _numbers(row)
    base, within = vocab.base(c), vocab.within_rare(tokens, c)
    end_base = float(vocab.base(np.array([vocab.n_texts]))[0])
    texts = _texts(tokens, numbers, ends)
    text_of = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    known, base_scores, extra = (np.bincount(text_of, of_word[numbers], len(ends)) for of_word in (c > 0, base, within))
    scores = model.score(texts) / math.log(10) + extra
    marks = np.frombuffer(row["marks"], np.uint8)
    no_id = marks == 4
    return pa.record_batch(
        [
            pa.array(np.frombuffer(row["ids"], np.int64), mask=no_id),
            pa.array(marks == 2, mask=no_id),
            pa.array([len(text) for text in texts], pa.int64()),
            pa.array(known.astype(np.int64) + int(vocab.n_texts > 0)),
            pa.array([vocab.total] * len(texts), pa.int64()),
            pa.array(base_scores + end_base, pa.float64()),
            pa.array(scores, pa.float64()),
        ],
        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    )


def score_documents(docs: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The log10 likelihood of every row's text, and that of single words as a base.

    Learned from rows with an id whose fold is not held out. A null text is
    empty: one token, its end. A row without an id is scored, teaches nothing,
    and has no ``held_out``. Without any training row the network keeps its first
    weights. Repeated rows count as often as they come.
    """
    text_bytes = ids_and_texts(docs).agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    rounds = round_count(text_bytes, slice_bytes)
    slices = shared_table(_slices(docs, slice_bytes, rounds), "slices", ("round",))
    buckets = max(BUCKETS, -(-text_bytes // (BUCKET_SLICES * slice_bytes)))
    counts = shared_table(word_counts(slices, buckets), "word-counts")
    n_texts = slices.agg(F.coalesce(F.sum("n_training"), F.lit(0))).first()[0]
    vocab = vocabulary(counts, n_texts)
    weights = vocab.first_weights()
    squares = np.full_like(weights, FIRST_SQUARES)
    for number in range(rounds):
        weights, squares = _trained(slices.where(F.col("round") == number), vocab, weights, squares)
    return _scored(slices, counts, vocab, weights)


def op1_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of nine tenths of them."""
    return score_documents(documents(spark, sf_dir))
