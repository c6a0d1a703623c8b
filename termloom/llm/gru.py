"""A gated recurrent language model with a class-factored softmax, in numpy.

The state after a token is a gated mix of the state before and a candidate. The
probability of the next token is that of its class times that of the token
within its class: a softmax over classes, then, for classes of frequent words, a
softmax over their words. Rare words share classes whose inner distribution is
fixed and kept outside of the model.

Texts run side by side in lanes, one token a step. The state is carried from
window to window, so a text is scored as a whole whatever its length; training
stops the gradient at the start of a window (truncated backpropagation).
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

HIDDEN = 16
CLASS_SIZE = 32
#: Steps of a window in training and in scoring, and lanes.
TRAIN_STEPS, TRAIN_LANES = 20, 96
SCORE_STEPS, SCORE_LANES = 32, 384
RATE, FIRST_SQUARES = 0.12, 0.05
#: Choices taken at a time in scoring, and rows of one class of words.
SCORE_COLUMNS, TILE = 512, 16
#: Exponentials of numbers within this, and their sums, are within a float's range.
LARGEST = 60.0


@dataclass(frozen=True)
class Shape:
    """Token 0 ends a text; then come the frequent words, class by class; then
    one token for each class of rare words."""

    n_frequent: int
    n_rare: int
    class_size: int = CLASS_SIZE

    @property
    def n_word_classes(self) -> int:
        return -(-self.n_frequent // self.class_size)

    @property
    def n_classes(self) -> int:
        return 1 + self.n_word_classes + self.n_rare

    @property
    def n_tokens(self) -> int:
        return 1 + self.n_frequent + self.n_rare

    def class_of(self, tokens: np.ndarray) -> np.ndarray:
        frequent = (tokens - 1) // self.class_size + 1
        rare = tokens - self.n_frequent + self.n_word_classes
        return np.where(tokens == 0, 0, np.where(tokens <= self.n_frequent, frequent, rare))

    def sizes(self) -> list[tuple[int, ...]]:
        words = self.n_word_classes
        return [
            (self.n_tokens, 3 * HIDDEN),
            (HIDDEN, 3 * HIDDEN),
            (HIDDEN, self.n_classes),
            (self.n_classes,),
            (words, HIDDEN, self.class_size),
            (words, self.class_size),
        ]


def first_weights(shape: Shape, class_share: np.ndarray, word_share: np.ndarray, seed: int = 1) -> np.ndarray:
    """Small random weights; biases start at the logarithms of the corpus shares."""
    rng = np.random.default_rng(seed)
    parts = [rng.normal(0, 0.1, size).astype(np.float32) for size in shape.sizes()]
    parts[3] = np.log(class_share + 1e-6).astype(np.float32)
    inner = np.full(shape.n_word_classes * shape.class_size, -30.0)
    inner[: shape.n_frequent] = np.log(word_share + 1e-9)
    parts[5] = inner.reshape(-1, shape.class_size).astype(np.float32)
    return np.concatenate([part.ravel() for part in parts])


class Model:
    def __init__(self, shape: Shape, weights: np.ndarray, squares: np.ndarray | None = None) -> None:
        self.shape = shape
        self.weights = np.array(weights, np.float32)
        #: Sums of squared slopes, from which Adagrad's steps continue.
        self.squares = np.full_like(self.weights, FIRST_SQUARES) if squares is None else np.array(squares, np.float32)
        every = np.arange(shape.n_tokens)
        self.class_of = shape.class_of(every)
        #: For each token its class of words, or the number of them if it is in none, and its place there.
        frequent = (every > 0) & (every <= shape.n_frequent)
        self.word_class_of = np.where(frequent, (every - 1) // shape.class_size, shape.n_word_classes)
        if shape.n_word_classes < 1 << 16:  # short numbers are sorted by their digits
            self.word_class_of = self.word_class_of.astype(np.uint16)
        self.place_of = (every - 1) % shape.class_size
        self.slopes = np.empty(self.weights.size - int(np.prod(shape.sizes()[0])), np.float32)
        self.parts, start = [], 0
        for size in shape.sizes():
            end = start + int(np.prod(size))
            self.parts.append(self.weights[start:end].reshape(size))
            start = end

    # --- forward ------------------------------------------------------------
    # Within a window values lie by place and lane, so that a step is a few calls on whole rows.

    def _given(self, token: np.ndarray) -> np.ndarray:
        """What the inputs give to the gates (negated) and the candidate, by step, place and lane."""
        given = np.ascontiguousarray(self.parts[0][token].transpose(0, 2, 1))
        np.negative(given[:, : 2 * HIDDEN], out=given[:, : 2 * HIDDEN])
        return given

    def _signed(self) -> np.ndarray:
        """Weights of the state, negated for the gates, by place."""
        signed = self.parts[1].T.copy()
        signed[: 2 * HIDDEN] *= -1
        return signed

    def _step(self, token: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
        """One step of lanes in rows."""
        before, h = np.ascontiguousarray(state.T, np.float32), HIDDEN
        own, gates, candidate, after = (np.empty((n * h, len(token)), np.float32) for n in (3, 2, 1, 1))
        _advance(self._given(token[None])[0], self._signed(), before, own, gates, candidate, after)
        return after.T, gates[:h].T, gates[h:].T, candidate.T, own[2 * h :].T

    def _class_weights(self) -> np.ndarray:
        """Weights of the classes, and their biases, which lie next to them."""
        start = self.parts[0].size + self.parts[1].size
        return self.weights[start : start + self.parts[2].size + self.parts[3].size].reshape(HIDDEN + 1, -1)

    def _class_logits(self, states: np.ndarray) -> np.ndarray:
        """By class; ``states`` by place, with ones below."""
        return self._class_weights().T @ states

    def _small(self) -> bool:
        """Whether no state of this network, whose places lie within -1 and 1, gives classes large logits."""
        return bool(np.abs(self._class_weights()).sum(axis=0).max() < 0.99 * LARGEST)

    def _by_word_class(self, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows that have a frequent word, their places within the class, and where they
        lie class by class, in tiles of ``TILE`` rows; and the class of each tile."""
        n = self.shape.n_word_classes
        number = self.word_class_of[targets]
        counts = np.bincount(number, minlength=n)[:n]
        # Those in no class come last.
        rows = np.argsort(number, kind="stable")[: counts.sum()]
        tiles = -(-counts // TILE)
        shift = (np.cumsum(tiles) - tiles) * TILE - (np.cumsum(counts) - counts)
        return rows, self.place_of[targets[rows]], np.arange(len(rows)) + np.repeat(shift, counts), np.repeat(np.arange(n), tiles)

    def _tile_weights(self, tiles: np.ndarray) -> np.ndarray:
        return np.concatenate([self.parts[4], self.parts[5][:, None]], axis=1)[tiles]

    def _within(
        self, states: np.ndarray, lie: np.ndarray, tiles: np.ndarray, weights: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """``states``, by row and with a one at the end, as tiles, and their logits. What is
        left of a tile holds zeros."""
        tiled = np.zeros((len(tiles) * TILE, HIDDEN + 1), np.float32)
        tiled[lie] = states
        tiled = tiled.reshape(len(tiles), TILE, HIDDEN + 1)
        return tiled, tiled @ (self._tile_weights(tiles) if weights is None else weights)

    def log_probabilities(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural logarithms, for each row the probability of its target."""
        return self._log_probabilities(_with_ones(states.T), targets)

    def _log_probabilities(self, states: np.ndarray, targets: np.ndarray, small: bool = False) -> np.ndarray:
        found = np.empty(len(targets), np.float32)
        classes = self.class_of[targets]
        for at in range(0, len(targets), SCORE_COLUMNS):
            some = slice(at, at + SCORE_COLUMNS)
            found[some] = _log_probability(self._class_logits(states[:, some]), classes[some], 0, small)
        rows, place, lie, tiles = self._by_word_class(targets)
        logits = self._within(states.T[rows], lie, tiles)[1]
        found[rows] += _log_probability(logits.reshape(-1, self.shape.class_size)[lie], place, 1)
        return found

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """The log likelihood of each whole text (its last token is the end).

        Longest texts first, each to the lane that is free first; the lanes that
        have ended are left out of later windows.
        """
        found = np.zeros(len(texts))
        token, target, text, length = _lanes(texts, SCORE_LANES)
        signed, h, small = self._signed(), HIDDEN, self._small()
        state = np.zeros((h, len(length)), np.float32)
        for start in range(0, int(length.max(initial=0)), SCORE_STEPS):
            alive = int(np.searchsorted(-length, -start))  # lanes are in falling order of length
            end = min(start + SCORE_STEPS, token.shape[0])
            state = np.ascontiguousarray(state[:, :alive])
            goes = token[start:end, :alive] > 0
            begins = ~goes.all(axis=1)
            given = self._given(np.abs(token[start:end, :alive]) - 1)
            states = np.empty((end - start, h, alive), np.float32)
            own, gates, candidate = (np.empty((n * h, alive), np.float32) for n in (3, 2, 1))
            for t in range(end - start):
                if begins[t]:
                    state = state * goes[t]
                _advance(given[t], signed, state, own, gates, candidate, states[t])
                state = states[t]
            used = target[start:end, :alive] >= 0
            logs = self._log_probabilities(_columns(states, used), target[start:end, :alive][used], small)
            found += np.bincount(text[start:end, :alive][used], logs, minlength=len(texts))
        return found

    # --- training -----------------------------------------------------------

    def train(self, texts: list[np.ndarray], rate: float = RATE) -> int:
        """One pass of Adagrad over the texts; returns how many tokens were seen."""
        token, target, _, length = _lanes(texts, TRAIN_LANES, mixed=True)
        state = np.zeros((len(length), HIDDEN), np.float32)
        seen = 0
        for start in range(0, int(length.max(initial=0)), TRAIN_STEPS):
            alive = int(np.searchsorted(-length, -start))
            end = min(start + TRAIN_STEPS, token.shape[0])
            state, n = self._train_window(token[start:end, :alive], target[start:end, :alive], state[:alive], rate)
            seen += n
        return seen

    def _train_window(self, token: np.ndarray, target: np.ndarray, state: np.ndarray, rate: float):
        steps, lanes = token.shape
        h, signed = HIDDEN, self._signed()
        goes = token > 0
        begins = ~goes.all(axis=1)
        flat = np.abs(token) - 1
        given = self._given(flat)
        befores, candidates, states = (np.empty((steps, h, lanes), np.float32) for _ in range(3))
        gates, owns = (np.empty((steps, n * h, lanes), np.float32) for n in (2, 3))
        befores[0] = state.T
        for t in range(steps):
            if t:
                befores[t] = states[t - 1]
            if begins[t]:
                befores[t] *= goes[t]
            _advance(given[t], signed, befores[t], owns[t], gates[t], candidates[t], states[t])
        used = target >= 0
        columns = _columns(states, used)
        rows = np.ascontiguousarray(columns.T)
        slopes, parts, at = self.slopes, [], 0
        slopes.fill(0)
        for part in self.parts[1:]:
            parts.append(slopes[at : at + part.size].reshape(part.shape))
            at += part.size
        own, out, bias, inner, inner_bias = parts
        out_and_bias = slopes[own.size : own.size + out.size + bias.size].reshape(h + 1, -1)

        # Output layer: probabilities less the target.
        wanted = target[used]
        error = _probabilities(self._class_logits(columns), 0, self._small())
        error.ravel()[self.class_of[wanted] * len(wanted) + np.arange(len(wanted))] -= 1
        out_and_bias[:] = (error @ columns.T).T
        back = self.parts[2] @ error
        some, place, lie, tiles = self._by_word_class(wanted)
        tile_weights = self._tile_weights(tiles)
        tiled, error = self._within(rows[some], lie, tiles, tile_weights)
        error = _probabilities(error.reshape(-1, self.shape.class_size), 1)
        error.ravel()[lie * self.shape.class_size + place] -= 1
        error = error.reshape(-1, TILE, self.shape.class_size)
        more_back = np.zeros((len(wanted), h), np.float32)
        more_back[some] = (error @ tile_weights[:, :h].transpose(0, 2, 1)).reshape(-1, h)[lie]
        back += more_back.T
        # Zeros of a tile give no slope.
        both = tiled.transpose(0, 2, 1) @ error
        firsts, n_tiles = _runs(tiles)
        touched = tiles[firsts]
        inner[touched], inner_bias[touched] = both[firsts, :h], both[firsts, h]
        for further in range(1, n_tiles.max(initial=0)):
            more = n_tiles > further
            inner[touched[more]] += both[firsts[more] + further, :h]
            inner_bias[touched[more]] += both[firsts[more] + further, h]
        if not used.all():
            every = np.zeros((h, steps * lanes), np.float32)
            every[:, used.ravel()] = back
            back = every
        to_state = np.ascontiguousarray(back.reshape(h, steps, lanes).transpose(1, 0, 2))

        # Back through the steps of this window.
        update, reset = gates[:, :h], gates[:, h:]
        by_candidate = (1 - update) * (1 - candidates * candidates)
        by_update = (befores - candidates) * update * (1 - update)
        by_reset = owns[:, 2 * h :] * reset * (1 - reset)
        inner_slopes = np.empty((steps, 3 * h, lanes), np.float32)
        to_candidate = np.empty((steps, h, lanes), np.float32)
        carried = np.zeros((h, lanes), np.float32)
        for t in range(steps - 1, -1, -1):
            slope, slopes_in = to_state[t], inner_slopes[t]
            slope += carried
            np.multiply(slope, by_update[t], out=slopes_in[:h])
            np.multiply(slope, by_candidate[t], out=to_candidate[t])
            np.multiply(to_candidate[t], by_reset[t], out=slopes_in[h : 2 * h])
            np.multiply(to_candidate[t], reset[t], out=slopes_in[2 * h :])
            np.matmul(self.parts[1], slopes_in, out=carried)
            slope *= update[t]
            carried += slope
            if begins[t]:
                carried *= goes[t]
        own += np.matmul(befores, inner_slopes.transpose(0, 2, 1)).sum(axis=0)
        inner_slopes[:, 2 * h :] = to_candidate
        gate_slopes = inner_slopes.transpose(0, 2, 1).reshape(-1, 3 * h)
        flat = flat.ravel()
        met, met_slopes = _added_up(flat, gate_slopes, self.shape.n_tokens)

        # Inputs that were not met have no slope, and keep their weights and squares.
        n_given = self.parts[0].size
        given_squares = self.squares[:n_given].reshape(self.parts[0].shape)
        rows_squares = given_squares[met]
        self.parts[0][met] -= _step_down(met_slopes, rows_squares, rate)
        given_squares[met] = rows_squares
        self.weights[n_given:] -= _step_down(slopes, self.squares[n_given:], rate)
        return states[-1].T, len(wanted)


def _step_down(slopes: np.ndarray, squares: np.ndarray, rate: float) -> np.ndarray:
    """A step of Adagrad; adds to ``squares`` and uses up ``slopes``."""
    slopes /= TRAIN_LANES
    np.clip(slopes, -1, 1, out=slopes)
    squares += slopes * slopes
    slopes /= np.sqrt(squares)
    slopes *= rate
    return slopes


def _advance(given, signed, before, own, gates, candidate, after) -> None:
    """One step of all lanes: fills the last four from the first three."""
    h = HIDDEN
    np.matmul(signed, before, out=own)
    np.add(own[: 2 * h], given[: 2 * h], out=gates)
    np.minimum(gates, LARGEST, out=gates)
    np.exp(gates, out=gates)
    gates += 1
    np.reciprocal(gates, out=gates)
    np.multiply(gates[h:], own[2 * h :], out=candidate)
    candidate += given[2 * h :]
    np.tanh(candidate, out=candidate)
    np.subtract(before, candidate, out=after)
    after *= gates[:h]
    after += candidate


def _runs(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal numbers start, and their lengths."""
    ends = np.flatnonzero(np.append(numbers[1:] != numbers[:-1], True)[: len(numbers)]) + 1
    sizes = ends.copy()
    sizes[1:] -= ends[:-1]
    return ends - sizes, sizes


def _added_up(numbers: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of numbers below ``n``, and the sums of their rows."""
    order = _order(numbers, n)
    ordered = numbers[order]
    first, sizes = _runs(ordered)
    sums = rows[order[first]]
    # Most numbers come once or twice; the others are added up one by one.
    twice = sizes == 2
    sums[twice] += rows[order[first[twice] + 1]]
    often = sizes > 2
    if often.any():
        starts = np.cumsum(sizes[often]) - sizes[often]
        sums[often] = np.add.reduceat(rows[order[np.repeat(often, sizes)]], starts, axis=0)
    return ordered[first], sums


def _order(numbers: np.ndarray, n: int) -> np.ndarray:
    """A stable order of numbers below ``n``; short ones are sorted by their digits."""
    return np.argsort(numbers.astype(np.uint16) if n <= 1 << 16 else numbers, kind="stable")


def _with_ones(states: np.ndarray) -> np.ndarray:
    """States by place, and a row of ones for the biases."""
    found = np.ones((HIDDEN + 1, states.shape[1]), np.float32)
    found[:HIDDEN] = states
    return found


def _columns(states: np.ndarray, used: np.ndarray) -> np.ndarray:
    """States by step, place and lane as columns with a one below, where ``used``."""
    found = np.ones((HIDDEN + 1, used.size), np.float32)
    found[:HIDDEN].reshape(HIDDEN, *used.shape)[:] = states.transpose(1, 0, 2)
    return found if used.all() else found[:, used.ravel()]


def _shifted(logits: np.ndarray, axis: int, small: bool) -> np.ndarray:
    """In place, less the greatest of each choice if exponentials might leave the floats' range;
    ``small`` says that they do not."""
    if not small and logits.size and not (-LARGEST < logits.min() and logits.max() < LARGEST):
        logits -= logits.max(axis=axis, keepdims=True)
    return logits


def _log_probability(logits: np.ndarray, chosen: np.ndarray, axis: int, small: bool = False) -> np.ndarray:
    """For each choice the logarithm of the share of one place; ``logits``, whose places
    lie along ``axis``, are used up."""
    each = np.arange(len(chosen))
    _shifted(logits, axis, small)
    own = logits[(each, chosen) if axis else (chosen, each)]
    np.exp(logits, out=logits)
    return own - np.log(logits.sum(axis=axis))


def _probabilities(logits: np.ndarray, axis: int, small: bool = False) -> np.ndarray:
    """Shares of all places, in place of ``logits``."""
    np.exp(_shifted(logits, axis, small), out=logits)
    logits *= 1 / logits.sum(axis=axis, keepdims=True)
    return logits


def _lanes(texts: list[np.ndarray], most: int, mixed: bool = False) -> tuple[np.ndarray, ...]:
    """Texts laid out in lanes: inputs, targets and text numbers by step and lane.

    The texts of a lane lie in falling order of length, or ``mixed``, so that
    training does not end on the short ones. An input is the token before, plus one; it is negative at the start of a
    text, where the state is reset. Targets are -1 after the end of a lane.
    """
    sizes = np.array([len(text) for text in texts], np.int64)
    order = np.argsort(-sizes, kind="stable")
    n = max(1, min(most, len(texts)))
    heap = [(0, lane) for lane in range(n)]
    lanes: list[list[int]] = [[] for _ in range(n)]
    for i in order.tolist():
        length, lane = heapq.heappop(heap)
        lanes[lane].append(i)
        heapq.heappush(heap, (length + int(sizes[i]), lane))
    if mixed:
        rng = np.random.default_rng(1)
        lanes = [rng.permutation(own).tolist() for own in lanes]
    lengths = np.array([sizes[own].sum() if own else 0 for own in lanes], np.int64)
    by_length = np.argsort(-lengths, kind="stable")
    steps = int(lengths.max(initial=0))
    token = np.ones((steps, n), np.int32)
    target = np.full((steps, n), -1, np.int32)
    text = np.zeros((steps, n), np.int32)
    for place, lane in enumerate(by_length.tolist()):
        at = 0
        for i in lanes[lane]:
            end = at + int(sizes[i])
            target[at:end, place], text[at:end, place] = texts[i], i
            token[at + 1 : end, place] = texts[i][:-1] + 1
            if end > at:
                token[at, place] = -1
            at = end
    return token, target, text, lengths[by_length]
