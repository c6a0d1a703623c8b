"""Sampled SentencePiece segmentations, and lossless decoding.

All ways to write a word as pieces of the vocabulary form a lattice. Forward
filtering sums, for every place in the word, the weights of the ways that lead
there; backward sampling then draws pieces from the end to the start, each with
its exact share of that sum. The weight of a piece falls with its rank in the
vocabulary, since the merges of this vocabulary are ordered by frequency. The
draws are a hash of seed, row key, place and step, so a row gives the same
segmentation wherever it runs.

Spaces become U+2581, with one in front, as the vocabulary expects. Characters
without a piece, and U+2581 itself, are written as bytes. Hence decoding gives
back every text.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from termloom.llm.common import column, documents, ids_and_texts, slices, tokenizer_path, utf8

MODEL = "piece_bpe_32k.model"
SEED = 11
#: Weight of a piece: (rank + RANK_SHIFT) ** -SHARPNESS.
SHARPNESS, RANK_SHIFT = 2.0, 10.0
#: The lattice of a longer run without a space is held a stretch of this many characters
#: at a time. What is drawn does not depend on it.
STRETCH = 8192
#: Words up to this length, of characters with a piece, are filtered all at once.
SHORT_WORD = 24
_SPACE = "▁"
# Stands for U+2581 in a text; no valid text holds it.
_LITERAL = "\ud800"
# A word with the spaces before it; no piece goes past its end or a line's.
_WORD = re.compile(f"{_SPACE}*[^{_SPACE}\n]+|{_SPACE}+|\n")


class Vocabulary:
    """Pieces, their bytes and weights, read from a model file, and a trie of them."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.ids: dict[str, int] = {}
        self.weights: dict[str, float] = {}
        self.byte_ids = [0] * 256
        self.bytes: list[bytes] = [b""] * n
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i)):
                self.weights[piece] = (len(self.ids) + RANK_SHIFT) ** -SHARPNESS
                self.ids[piece] = i
                self.bytes[i] = piece.replace(_SPACE, " ").encode()
        self.longest = max(map(len, self.ids), default=1)
        self.rarest = (len(self.ids) + RANK_SHIFT) ** -SHARPNESS

        # Node 0 is the root; an edge is its node and character in one number.
        edges: dict[int, int] = {}
        ends: list[tuple[int, str]] = []
        for piece in self.ids:
            node = 0
            for char in piece:
                node = edges.setdefault((node << 21) | ord(char), len(edges) + 1)
            ends.append((node, piece))
        keys = np.array(list(edges), np.int64)
        order = np.argsort(keys)
        self.edges, self.children = keys[order], np.array(list(edges.values()), np.int64)[order]
        self.node_piece = np.full(len(edges) + 1, -1, np.int32)
        self.node_weight = np.zeros(len(edges) + 1)
        for node, piece in ends:
            self.node_piece[node], self.node_weight[node] = self.ids[piece], self.weights[piece]
        self.has_piece = np.zeros(0x110000, bool)
        self.has_piece[[ord(piece) for piece in self.ids if len(piece) == 1]] = True


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@dataclass
class Lattices:
    """The lattices of many words, as flat arrays.

    A state is a place in a word; state 0 is the start of every word. A state
    has options: a piece that ends there, the state where that piece begins, and
    the share of the options up to this one in the sum of all ways to the state.
    """

    #: The last state of each word.
    ends: np.ndarray
    first_option: np.ndarray
    n_options: np.ndarray
    share: np.ndarray
    piece: np.ndarray
    back: np.ndarray


def filtered(words: list[str], vocab: Vocabulary) -> Lattices:
    """Forward filtering of distinct words."""
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes) - sizes
    odd = np.add.reduceat(~vocab.has_piece[codes], starts) > 0 if len(words) else np.empty(0, bool)
    short = np.flatnonzero(~odd & (sizes <= SHORT_WORD))
    ends = np.empty(len(words), np.int64)
    lattices = _filter_short(codes, starts[short], sizes[short], vocab)
    ends[short] = lattices.ends
    one_by_one = _OneByOne(vocab, len(lattices.first_option), len(lattices.share))
    for i in np.setdiff1d(np.arange(len(words)), short).tolist():
        ends[i] = one_by_one.add(words[i])
    return Lattices(
        ends,
        np.concatenate([lattices.first_option, np.array(one_by_one.first_option, np.int64)]),
        np.concatenate([lattices.n_options, np.array(one_by_one.n_options, np.int64)]),
        np.concatenate([lattices.share, np.array(one_by_one.share)]),
        np.concatenate([lattices.piece, np.array(one_by_one.piece, np.int32)]),
        np.concatenate([lattices.back, np.array(one_by_one.back, np.int64)]),
    )


def _filter_short(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, vocab: Vocabulary) -> Lattices:
    """All words place by place: the state after a word's p-th character for all words at once."""
    n = int(sizes.sum())
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(n)
    codes = codes[at]
    word_start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    word_end = word_start + np.repeat(sizes, sizes)
    # All pieces from all starts, one character further down the trie at a time.
    begin, node = np.arange(n), np.zeros(n, np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for depth in range(vocab.longest):
        inside = begin + depth < word_end[begin]
        begin, node = begin[inside], node[inside]
        if not len(begin):
            break
        key = (node << 21) | codes[begin + depth]
        edge = np.minimum(np.searchsorted(vocab.edges, key), len(vocab.edges) - 1)
        known = vocab.edges[edge] == key
        begin, node = begin[known], vocab.children[edge[known]]
        whole = vocab.node_piece[node] >= 0
        found.append((begin[whole], begin[whole] + depth, node[whole]))
    begin, last, node = (np.concatenate(c) if found else np.empty(0, np.int64) for c in (zip(*found) if found else [()] * 3))
    place = last - word_start[last] if n else last
    order = np.lexsort((last, place))
    begin, last, node, place = begin[order], last[order], node[order], place[order]
    back = np.where(begin == word_start[begin], 0, begin) if n else begin
    weight, total = vocab.node_weight[node], np.zeros(n + 1)
    total[0] = 1.0
    ratio = np.empty(len(last))
    cuts = np.searchsorted(place, np.arange(int(place.max(initial=-1)) + 2))
    for low, high in zip(cuts, cuts[1:]):
        ways = total[back[low:high]] * weight[low:high]
        new = np.flatnonzero(np.diff(last[low:high], prepend=-1))
        sums = np.add.reduceat(ways, new)
        total[last[low:high][new] + 1] = sums
        ratio[low:high] = ways / np.repeat(sums, np.diff(np.append(new, high - low)))
    first_option, n_options = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    new = np.flatnonzero(np.diff(last, prepend=-1))
    counts = np.diff(np.append(new, len(last))) if len(new) else np.empty(0, np.int64)
    first_option[last[new] + 1], n_options[last[new] + 1] = new, counts
    upto = np.cumsum(ratio)
    share = upto - np.repeat(upto[new] - ratio[new], counts)
    share[new + counts - 1] = 2.0
    return Lattices(np.cumsum(sizes), first_option, n_options, share, vocab.node_piece[node], back)


class _OneByOne:
    """Long words, and words with characters that are written as bytes."""

    def __init__(self, vocab: Vocabulary, states: int, options: int) -> None:
        self.vocab, self.states, self.options = vocab, states, options
        self.first_option, self.n_options = array("q"), array("q")
        self.share, self.piece, self.back = array("d"), array("i"), array("q")

    def add(self, word: str) -> int:
        vocab = self.vocab
        n = len(word)
        total, state = [1.0] + [0.0] * n, [0] * (n + 1)
        get = vocab.weights.get
        for end in range(1, n + 1):
            ways = []
            for start in range(max(0, end - vocab.longest), end):
                weight = get(word[start:end])
                if weight is not None:
                    ways.append((total[start] * weight, vocab.ids[word[start:end]], state[start]))
            char = word[end - 1]
            if get(char) is None:
                # The character's bytes one after the other, besides longer pieces.
                encoded = (_SPACE if char == _LITERAL else char).encode()
                at = state[end - 1]
                for value in encoded[:-1]:
                    at, _ = self._state([(1.0, vocab.byte_ids[value], at)])
                ways.append((total[end - 1] * vocab.rarest, vocab.byte_ids[encoded[-1]], at))
            state[end], total[end] = self._state(ways)
            if total[end] < 1e-200:
                # Only ratios count within a word.
                for place in range(max(0, end - vocab.longest), end + 1):
                    total[place] *= 1e200
        return state[n]

    def _state(self, ways: list[tuple[float, int, int]]) -> tuple[int, float]:
        total = sum(weight for weight, _, _ in ways)
        self.first_option.append(self.options + len(self.share))
        self.n_options.append(len(ways))
        so_far = 0.0
        for weight, piece, back in ways:
            so_far += weight
            self.share.append(so_far / total)
            self.piece.append(piece)
            self.back.append(back)
        self.share[-1] = 2.0
        return self.states + len(self.n_options) - 1, total


def _random(keys: np.ndarray, step: int) -> np.ndarray:
    """Uniform numbers in [0, 1), a fixed function of key and step."""
    x = keys + np.uint64((step * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def sample_back(lattices: Lattices, ends: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A segmentation of each word, drawn from its last state to its start.

    Returns all pieces in text order and the number of pieces of each word.
    """
    first, n_options, share = lattices.first_option, lattices.n_options, lattices.share
    piece, back = lattices.piece, lattices.back
    state, alive = ends.copy(), np.arange(len(ends))
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    while len(alive):
        draw = _random(keys[alive], len(steps) + 1)
        option = first[state]
        last = option + n_options[state] - 1
        # The first option whose share exceeds the draw; most states have few.
        searching = np.flatnonzero((option < last) & (share[option] <= draw))
        while len(searching):
            option[searching] += 1
            at = option[searching]
            searching = searching[(at < last[searching]) & (share[at] <= draw[searching])]
        steps.append((alive, piece[option]))
        state = back[option]
        going = state > 0
        alive, state = alive[going], state[going]
    counts = np.zeros(len(ends), np.int64)
    for words, _ in steps:
        counts[words] += 1
    ends_at = np.cumsum(counts)
    pieces = np.empty(int(counts.sum()), np.int32)
    for k, (words, drawn) in enumerate(steps):
        pieces[ends_at[words] - 1 - k] = drawn
    return pieces, counts


def sample_long(word: str, key: np.uint64, vocab: Vocabulary) -> np.ndarray:
    """What :func:`sample_back` draws for a word, in the memory of one stretch: the filter
    keeps the sums before each stretch, and from the last stretch on filters it again."""
    cuts = [*range(0, len(word), STRETCH), len(word)]
    sums = [[1.0]]
    for low, high in zip(cuts, cuts[1:]):
        sums.append(_filter_stretch(word, low, high, sums[-1], vocab)[0])
    drawn: list[int] = []
    at, keys = len(word), np.array([key], np.uint64)
    for i in range(len(cuts) - 2, -1, -1):
        low = cuts[i]
        ways_to = _filter_stretch(word, low, cuts[i + 1], sums[i], vocab)[1] if at > low else []
        while at > low:
            ways, so_far = ways_to[at - low - 1], 0.0
            total, draw = sum(weight for weight, _, _ in ways), _random(keys, len(drawn) + 1)[0]
            for weight, piece, start in ways:
                so_far += weight
                if so_far / total > draw:
                    break
            drawn.extend([piece] if piece >= 0 else reversed(_bytes_of(word[start], vocab)))
            at = start
    return np.array(drawn[::-1], np.int32)


def _filter_stretch(word: str, low: int, high: int, sums: list[float], vocab: Vocabulary) -> tuple[list[float], list]:
    """From the sums of all ways to the last places up to ``low``: those up to ``high``, and for
    each place between the ways to it, as weight, piece (-1: the bytes) and where it begins."""
    sums, first = list(sums), low - len(sums) + 1
    longest, get, ids = vocab.longest, vocab.weights.get, vocab.ids
    ways_to = []
    for end in range(low + 1, high + 1):
        ways = []
        for start in range(max(0, end - longest), end):
            weight = get(word[start:end])
            if weight is not None:
                ways.append((sums[start - first] * weight, ids[word[start:end]], start))
        if get(word[end - 1]) is None:
            ways.append((sums[end - 1 - first] * vocab.rarest, -1, end - 1))
        ways_to.append(ways)
        sums.append(sum(weight for weight, _, _ in ways))
        if sums[-1] < 1e-200:
            for place in range(max(0, len(sums) - longest - 1), len(sums)):
                sums[place] *= 1e200
    return sums[-longest:], ways_to


def _bytes_of(char: str, vocab: Vocabulary) -> list[int]:
    encoded = (_SPACE if char == _LITERAL else char).encode()
    return [vocab.byte_ids[value] for value in encoded]


def row_key(seed: int, doc_id: int | None, text: str) -> int:
    """A number for each row; the text takes part only if there is no id."""
    name = f"{seed}:{doc_id}" if doc_id is not None else f"{seed}::{text}"
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")


def words_of(text: str) -> list[str]:
    """The words of a text with spaces as U+2581, one in front; joined they give it back."""
    if _SPACE in text:
        text = text.replace(_SPACE, _LITERAL)
    return _WORD.findall(_SPACE + text.replace(" ", _SPACE))


class Sampler:
    """Sampled segmentations of many texts at a time."""

    def __init__(self, path: str, seed: int = SEED) -> None:
        self.vocab = vocabulary(path)
        self.seed = seed

    def encode(self, ids: list[int | None], texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All pieces, and where those of each text end. Null and empty texts have none."""
        split = [words_of(text) if text else [] for text in texts]
        number: dict[str, int] = {}
        for words in split:
            number.update(dict.fromkeys(words, 0))
        distinct = list(number)
        number = dict(zip(distinct, range(len(distinct))))
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        tokens = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        keys = np.array([row_key(self.seed, i, t) if t else 0 for i, t in zip(ids, texts)], np.uint64)
        starts = np.cumsum(sizes) - sizes
        place = (np.arange(len(tokens)) - np.repeat(starts, sizes)).astype(np.uint64)
        token_keys = np.repeat(keys, sizes) + place * np.uint64(0xD1342543DE82EF95)
        pieces, counts = self._drawn(distinct, tokens, token_keys)
        pieces_to = np.concatenate([[0], np.cumsum(counts)])
        return pieces, pieces_to[np.cumsum(sizes)]

    def _drawn(self, distinct: list[str], tokens: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of all tokens, which are numbers of words, and how many each has."""
        long_words = {i: word for i, word in enumerate(distinct) if len(word) > STRETCH}
        lattices = filtered(["" if i in long_words else word for i, word in enumerate(distinct)], self.vocab)
        is_long = np.isin(tokens, list(long_words))
        pieces, counts = sample_back(lattices, lattices.ends[tokens[~is_long]], keys[~is_long])
        if not long_words:
            return pieces, counts
        drawn = [sample_long(long_words[word], key, self.vocab) for word, key in zip(tokens[is_long].tolist(), keys[is_long])]
        all_counts = np.empty(len(tokens), np.int64)
        all_counts[~is_long], all_counts[is_long] = counts, list(map(len, drawn))
        from_long = np.repeat(is_long, all_counts)
        all_pieces = np.empty(len(from_long), np.int32)
        all_pieces[~from_long], all_pieces[from_long] = pieces, np.concatenate(drawn)
        return all_pieces, all_counts


def decode(pieces: list[int], vocab: Vocabulary) -> bytes:
    """The text of a segmentation, as UTF-8; no pieces are the empty text."""
    return b"".join(map(vocab.bytes.__getitem__, pieces))[1:]


def sample_pieces(docs: DataFrame, model: str, seed: int = SEED, checked: bool = False) -> DataFrame:
    """``(doc_id, text, pieces array<int>)`` for every row; a null text has null pieces.

    With ``checked`` the pieces are decoded where they are made, and the row has
    ``round_trip boolean`` and ``decoded_sha256 string`` in place of its text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(model, seed)
        for batch in slices(batches, "text", 2 << 20):
            text = column(batch, "text")
            pieces, ends = sampler.encode(column(batch, "doc_id").to_pylist(), text.to_pylist())
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(pieces, pa.int32()))
            lists = pa.compute.if_else(pa.compute.is_null(text), pa.scalar(None, lists.type), lists)
            if not checked:
                yield pa.record_batch([column(batch, "doc_id"), text, lists], names=["doc_id", "text", "pieces"])
                continue
            every, low = pieces.tolist(), 0
            same, sums = [], []
            for own, high in zip(utf8(batch, "text"), ends.tolist()):
                decoded = decode(every[low:high], sampler.vocab)
                same.append(decoded == (own or b""))
                sums.append(hashlib.sha256(decoded).hexdigest())
                low = high
            columns = [column(batch, "doc_id"), lists, pa.array(same, pa.bool_()), pa.array(sums, pa.string())]
            yield pa.record_batch(columns, names=["doc_id", "pieces", "round_trip", "decoded_sha256"])

    kept = "pieces array<int>, round_trip boolean, decoded_sha256 string" if checked else "text string, pieces array<int>"
    return ids_and_texts(docs).mapInArrow(run, f"doc_id bigint, {kept}")


def decode_pieces(sampled: DataFrame, model: str) -> DataFrame:
    """Adds ``decoded string``, the text of ``pieces``; other columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model)
        for batch in batches:
            for part in range(0, batch.num_rows, 1000):
                rows = batch.slice(part, 1000)
                texts = [None if p is None else decode(p, vocab) for p in column(rows, "pieces").to_pylist()]
                yield pa.record_batch(
                    [*rows.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=[*rows.schema.names, "decoded"]
                )

    return sampled.mapInArrow(run, StructType([*sampled.schema.fields, StructField("decoded", StringType())]))


def op6_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every document, and whether it decodes to its text."""
    sampled = sample_pieces(documents(spark, sf_dir), tokenizer_path(MODEL), checked=True)
    n_pieces = F.coalesce(F.size(F.when(F.col("pieces").isNotNull(), F.col("pieces"))), F.lit(0))
    return sampled.select("doc_id", "pieces", n_pieces.cast("bigint").alias("n_pieces"), "round_trip", "decoded_sha256")
