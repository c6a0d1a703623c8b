"""Periodic runs of words, and texts without them.

A run is a stretch of words that repeats with a smallest period q, at least twice
and over ``LEAST`` words, and that no neighbouring word extends. Every run is found:

* Both the words and their reversal become a suffix tree (Ukkonen). On its Euler tour
  the lowest node between two leaves is their lowest common ancestor, whose depth is
  the length of what two suffixes share; a table of minima answers that at once.
* By the theorem on runs, every run contains a Lyndon word of the length of its period
  that is the longest one from its first word, in the order of the words or in the
  reverse order. The longest Lyndon word from a place ends where the next smaller
  suffix begins. Each of these candidates is extended to the right by the tree of the
  words and to the left by the tree of the reversal; it is a run if it is long enough.

Words that cannot lie in a run never reach the trees: each word of a run lies in a
stretch of ``GRAM`` words of the run that comes again in it, a period apart. What is
covered by such stretches is taken again and again until nothing more falls away.
Stretches of many texts share one tree, each closed by a symbol of its own, so nothing
is found across texts. Stretches are compared by hashes, and a wrong match only leaves
more for the trees, where words themselves are compared.

Memory is that of a slice of texts (1 MB, or one longer text), and some 500 bytes for
each word that reaches the trees. Nothing is shuffled, so no key can be heavy.

Defined cases: a text that is null, empty or blank has no words and no runs; texts are
whole, whatever their length; repeated rows and ids give a row each; other columns
are passed over; an empty table has no rows. Of several longest runs the first one
counts, of these that with the shorter period.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.common import documents, ids_and_texts, slices, utf8
from termloom.llm.words import mixed

#: Words in the shortest run, and in the stretches that come again in it (half at most).
LEAST = 12
GRAM = 6
SLICE_BYTES = 1 << 20

_RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"
_ARROW_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

# --- suffix trees -----------------------------------------------------------------


class SuffixTree:
    """The suffix tree of a list of symbols whose last one occurs nowhere else.

    ``start`` and ``end`` bound the label of the edge above each node; ``kids`` maps
    first symbols to nodes and is None for leaves.
    """

    def __init__(self, text: list[int]):
        n = len(text)
        start, end, link, kids = [0], [0], [0], [{}]
        node = edge = length = waiting = 0
        for i, symbol in enumerate(text):
            waiting += 1
            unlinked = 0
            while waiting:
                if not length:
                    edge = i
                below = kids[node].get(text[edge])
                if below is None:
                    kids[node][text[edge]] = len(start)
                    start.append(i), end.append(n), link.append(0), kids.append(None)
                    top = node
                else:
                    span = end[below] - start[below]
                    if length >= span:
                        node, edge, length = below, edge + span, length - span
                        continue
                    middle = start[below] + length
                    if text[middle] == symbol:
                        length += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    top = len(start)
                    kids[node][text[edge]] = top
                    start.append(start[below]), end.append(middle), link.append(0)
                    kids.append({text[middle]: below, symbol: top + 1})
                    start[below] = middle
                    start.append(i), end.append(n), link.append(0), kids.append(None)
                if unlinked:
                    link[unlinked] = top
                unlinked = top
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        self.n, self.start, self.end, self.kids = n, start, end, kids

    def tour(self, key: Callable[[int], int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The leaves as an Euler tour meets them: their suffixes, and the least depth
        since the leaf before. Edges are taken by their first symbol, or its ``key``."""
        start, end, all_kids, n = self.start, self.end, self.kids, self.n
        suffixes, lowest = [], []
        todo = [(0, 0, 0)]
        while todo:
            node, depth, low = todo.pop()
            kids = all_kids[node]
            if kids is None:
                suffixes.append(n - depth)
                lowest.append(low)
                continue
            symbols = sorted(kids, key=key)
            for symbol in reversed(symbols[1:]):
                below = kids[symbol]
                todo.append((below, depth + end[below] - start[below], depth))
            below = kids[symbols[0]]
            todo.append((below, depth + end[below] - start[below], low))
        return np.array(suffixes), np.array(lowest, np.int32)


class CommonPrefixes:
    """How much two suffixes share, for many pairs at a time and each in constant time."""

    def __init__(self, suffixes: np.ndarray, lowest: np.ndarray):
        self.rank = np.empty(len(suffixes), np.int64)
        self.rank[suffixes] = np.arange(len(suffixes))
        self.least = [lowest]
        width = 1
        while 2 * width <= len(lowest):
            before = self.least[-1]
            self.least.append(np.minimum(before[:-width], before[width:]))
            width *= 2

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For places ``a`` and ``b`` that differ."""
        ranks = self.rank[a], self.rank[b]
        low, high = np.minimum(*ranks) + 1, np.maximum(*ranks) + 1
        level = np.frexp(high - low)[1] - 1
        found = np.empty(len(low), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            least = self.least[k]
            found[at] = np.minimum(least[low[at]], least[high[at] - (1 << int(k))])
        return found


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each place the next one with a smaller rank, or the end."""
    found, waiting = [0] * len(rank), []
    for i, value in enumerate(rank.tolist()):
        while waiting and waiting[-1][1] > value:
            found[waiting.pop()[0]] = i
        waiting.append((i, value))
    for i, _ in waiting:
        found[i] = len(rank)
    return np.array(found, np.int64)


def runs_of(stretches: list[np.ndarray], least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(stretch, start, length, period)`` of all runs within the stretches of symbols,
    ordered by them. Symbols are numbers from 0."""
    n_closing = len(stretches) + 1
    # A symbol of its own, smaller than all others, before and after each stretch.
    pieces, owner, offset = [[0]], [np.array([0])], [np.array([-1])]
    for k, stretch in enumerate(stretches):
        pieces += [stretch + n_closing, [k + 1]]
        owner.append(np.full(len(stretch) + 1, k))
        offset.append(np.arange(len(stretch) + 1))
    symbols = np.concatenate(pieces)
    owner, offset = np.concatenate(owner), np.concatenate(offset)
    n, text = len(symbols), symbols.tolist()

    tree = SuffixTree(text)
    forward = CommonPrefixes(*tree.tour())
    backward = CommonPrefixes(*SuffixTree(text[::-1]).tour())
    reverse_order, _ = tree.tour(lambda symbol: symbol if symbol < n_closing else -symbol + (1 << 62))
    reverse_rank = np.empty(n, np.int64)
    reverse_rank[reverse_order] = np.arange(n)

    places = np.flatnonzero(symbols >= n_closing)
    a = np.concatenate([places, places])
    b = np.concatenate([next_smaller(rank)[places] for rank in (forward.rank, reverse_rank)])
    right, left = forward.shared(a, b), backward.shared(n - a, n - b)
    start, period = a - left, b - a
    length = b + right - start
    found = np.flatnonzero((length >= 2 * period) & (length >= least))
    # A run has one period for its start and length; several candidates lead to it.
    found = found[np.lexsort([length[found], period[found], start[found]])]
    triples = np.stack([start[found], length[found], period[found]])
    triples = triples[:, np.any(np.diff(triples, axis=1, prepend=-1) != 0, axis=0)]
    start, length, period = triples
    return owner[start], offset[start], length, period


# --- texts --------------------------------------------------------------------------


def candidate_stretches(ids: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of what may hold runs, each within one text."""
    starts = np.flatnonzero(np.diff(text_of, prepend=-1))
    ends = np.append(starts[1:], len(ids))
    while len(starts):
        left = int((ends - starts).sum())
        at, part = _places(starts, ends)
        key = mixed(part.astype(np.uint64) + np.uint64(1))
        whole = np.flatnonzero(at + GRAM <= ends[part])
        gram = key[whole]
        for k in range(GRAM):
            gram = mixed(gram * np.uint64(0x9E3779B97F4A7C15) + ids[at[whole] + k].astype(np.uint64))
        order = np.argsort(gram)
        same = gram[order][1:] == gram[order][:-1]
        again = np.zeros(len(whole), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        cover = np.zeros(len(at) + 1, np.int64)
        first = whole[again]
        np.add.at(cover, first, 1)
        np.add.at(cover, first + GRAM, -1)
        covered = np.cumsum(cover[:-1]) > 0
        begins = covered & ~(np.concatenate([[False], covered[:-1]]) & (np.diff(part, prepend=-1) == 0))
        begin = np.flatnonzero(begins)
        number = np.cumsum(begins)[covered]
        size = np.bincount(number, minlength=len(begin) + 1)[1:]
        starts, ends = at[begin], at[begin] + size
        long_enough = size >= LEAST
        starts, ends = starts[long_enough], ends[long_enough]
        if int((ends - starts).sum()) == left:
            break
    return starts, ends


def _places(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges one after another, and the range of each."""
    sizes = ends - starts
    part = np.repeat(np.arange(len(starts)), sizes)
    return np.arange(len(part)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[part], part


def runs_of_texts(texts: list[list[bytes]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(start, length, period)`` of the runs of each list of words, by start and period."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    sizes = [len(words) for words in texts]
    ids = np.fromiter((numbers[word] for words in texts for word in words), np.int64, sum(sizes))
    text_of = np.repeat(np.arange(len(texts)), sizes)
    starts, ends = candidate_stretches(ids, text_of)
    none = np.empty(0, np.int64)
    found = [(none, none, none)] * len(texts)
    if not len(starts):
        return found
    part, start, length, period = runs_of([ids[a:b] for a, b in zip(starts, ends)])
    start = start + starts[part]
    owner = text_of[start]
    start -= (np.cumsum(sizes) - sizes)[owner]
    for k in np.unique(owner).tolist():
        low, high = np.searchsorted(owner, [k, k + 1])
        found[k] = start[low:high], length[low:high], period[low:high]
    return found


def kept_words(n: int, runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Which of ``n`` words stay: of each run the first period."""
    start, length, period = runs
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) == 0


def as_they_are(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    return words


def find_runs(docs: DataFrame, change: Callable[[int | None, list[bytes]], list[bytes]] = as_they_are) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` for every row of ``docs(doc_id, text)``.

    ``runs`` are ordered by start and period, ``collapsed`` is the text without the
    repetitions, its words joined by one space. ``change`` is applied to the words first.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            doc_ids = batch.column(0)
            texts = [
                change(doc_id, (text or b"").split())
                for doc_id, text in zip(doc_ids.to_pylist(), utf8(batch, "text"))
            ]
            runs, collapsed = [], []
            for words, found in zip(texts, runs_of_texts(texts)):
                if len(found[0]):
                    keep = kept_words(len(words), found)
                    words = [words[i] for i in np.flatnonzero(keep).tolist()]
                collapsed.append(b" ".join(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in zip(*(x.tolist() for x in found))])
            n_words = pa.array([len(words) for words in texts], pa.int64())
            columns = [doc_ids, n_words, pa.array(runs, _ARROW_RUNS), pa.array(collapsed, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    return ids_and_texts(docs).mapInArrow(each, f"doc_id bigint, n_words bigint, runs {_RUN}, collapsed string")


def looped(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One document in ten, by its id, with a loop from one of its words to its end."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[: n - a]


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(documents(spark, sf_dir), looped)
    # The greatest struct is the longest run, of those the first, then the shortest period.
    best = F.array_max(
        F.transform("runs", lambda run: F.struct(run["length"].alias("n"), (-run["start"]).alias("s"), (-run["period"]).alias("q")))
    )
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        "n_words",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        best.alias("best"),
    ).select(
        "doc_id",
        "n_words",
        "n_runs",
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.q")).alias("period"),
        F.expr("(1000 * best.n) div (-best.q)").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
