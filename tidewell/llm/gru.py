"""A gated recurrent language model with class-factored output, in numpy.

Items are grouped into classes of equal size: the chance of an item is that of its class times that of
the item in its class, so a token costs two small softmaxes instead of one large one. Texts run side by
side in streams; the state is carried from window to window and cleared where a text begins, so a text's
log-likelihood is that of the whole text. Training propagates errors back within a window only.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

HIDDEN = 32
RATE = 0.08


def streams(lengths: list[int], count: int) -> list[list[int]]:
    """Texts dealt out to streams of like lengths, the longest stream first."""
    count = max(1, min(count, len(lengths)))
    heap = [(0, number) for number in range(count)]
    dealt: list[list[int]] = [[] for _ in range(count)]
    for text in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        load, number = heapq.heappop(heap)
        dealt[number].append(text)
        heapq.heappush(heap, (load + lengths[text], number))
    return sorted(dealt, key=lambda texts: -sum(lengths[i] for i in texts))


class Windows:
    """Texts laid out in streams, window by window: what is held is a number or two for each token, however
    much the streams differ in length."""

    def __init__(self, texts: list[np.ndarray], count: int, start: int):
        dealt = streams([len(text) for text in texts], count)
        order = [number for numbers in dealt for number in numbers]
        self.item = np.concatenate([texts[number] for number in order]).astype(np.int32)
        lengths = np.array([len(texts[number]) for number in order])
        first = np.cumsum(lengths) - lengths
        self.before = np.append(np.int32(start), self.item[:-1])
        self.before[first] = start
        self.goes_on = np.ones(len(self.item), np.float32)
        self.goes_on[first] = 0
        #: The texts in the order of their tokens, and where each begins.
        self.order, self.first = np.array(order), first
        #: Of each stream its tokens and its first one; the longest stream comes first.
        self.lengths = np.array([sum(len(texts[number]) for number in numbers) for numbers in dealt])
        self.starts = np.cumsum(self.lengths) - self.lengths

    def __len__(self) -> int:
        return int(self.lengths[0])

    def steps(self, size: int) -> Iterator[tuple[int, int]]:
        """Where windows begin and their steps: ``size`` while all streams run, and more as they become fewer, so
        that the last long texts don't make many windows of a few tokens."""
        at = 0
        while at < len(self):
            steps = size * len(self.lengths) // int((self.lengths > at).sum())
            yield at, steps
            at += steps

    def window(self, at: int, size: int):
        """Steps x streams that still run: the item before, whether the text goes on, the item itself (-1 after
        a stream's end), and the number of the token."""
        n = int((self.lengths > at).sum())
        step = at + np.arange(min(size, len(self) - at))[:, None]
        there = step < self.lengths[:n]
        token = np.where(there, self.starts[:n] + step, 0)
        item = np.where(there, self.item[token], -1)
        return self.before[token], self.goes_on[token][..., None], item, token

    def sums(self, tokens: np.ndarray, values: np.ndarray, texts: int) -> np.ndarray:
        """Of each text the sum of ``values`` of its ``tokens``."""
        return np.bincount(self.order[np.searchsorted(self.first, tokens, side="right") - 1], values, texts)


def _in_range(x: np.ndarray) -> None:
    """Move the rows (last axis), in place, if ``exp`` can't take them as they are."""
    if x.size and (x.max() > 60 or x.min() < -60):
        x -= x.max(axis=-1, keepdims=True)


def _exp(x: np.ndarray) -> np.ndarray:
    """``exp`` in place, but for a factor of each row, and the sums of the rows."""
    _in_range(x)
    np.exp(x, out=x)
    return x @ np.ones(x.shape[-1], x.dtype)


def _log_share(x: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Log of the softmax of each row at one place; ``x`` is used up."""
    _in_range(x)
    picked = x[np.arange(len(x)), place]
    return picked - np.log(np.exp(x, out=x) @ np.ones(x.shape[-1], x.dtype))


def _logistic_of_negative(x: np.ndarray) -> None:
    """In place; ``exp`` may overflow."""
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)


#: Tokens that are worth a product of their own; groups of fewer are done side by side.
MANY = 128


def _laid_out(group: np.ndarray, groups: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Groups that occur, those of like sizes together: their numbers, the places of their members, groups x
    width, and which of these there are. Small groups are filled up to ``least`` or a higher power of two."""
    order = np.argsort(group.astype(np.min_scalar_type(groups)), kind="stable")
    count = np.bincount(group, minlength=groups)
    first = np.cumsum(count) - count
    large, small = np.flatnonzero(count > MANY), np.flatnonzero((count > 0) & (count <= MANY))
    for one in large:
        places = order[first[one] : first[one] + count[one]]
        yield np.array([one]), places[None], np.ones((1, len(places)), bool)
    width = np.maximum(least, 1 << np.ceil(np.log2(count[small])).astype(np.int64))
    for size in np.unique(width):
        some = small[width == size]
        step = np.arange(size)
        there = step < count[some, None]
        yield some, order[first[some, None] + step * there], there


def _sums_by(rows: np.ndarray, values: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``rows``, and of each the sum of its ``values``, which end in a row of zeros."""
    present, sums = [], []
    for some, places, there in _laid_out(rows, number, 1):
        present.append(some)
        part = values.take(np.where(there, places, len(rows)), 0)
        if len(some) == 1:
            sums.append(np.ones((1, part.shape[1]), values.dtype) @ part[0])
        else:
            sums.append(part[:, 0] if part.shape[1] == 1 else part.sum(axis=1))
    return np.concatenate(present), np.concatenate(sums)


class Model:
    """``inputs`` holds, per item, what it adds to the three gates; ``loop`` what the state adds."""

    NAMES = ("inputs", "loop", "class_weights", "class_bias", "item_weights", "item_bias")

    def __init__(self, counts: np.ndarray, seed: int = 7):
        """``counts``, classes x items: how often each item occurs; the untrained model gives these shares."""
        rng = np.random.default_rng(seed)
        classes, size = counts.shape
        self.size, self.classes = size, classes
        self.inputs = (rng.standard_normal((classes * size, 3 * HIDDEN)) * 0.1).astype(np.float32)
        self.inputs[:, HIDDEN : 2 * HIDDEN] += 1.0  # at first, keep the state
        self.loop = (rng.standard_normal((HIDDEN, 3 * HIDDEN)) / np.sqrt(HIDDEN)).astype(np.float32)
        self.class_weights = np.zeros((classes, HIDDEN), np.float32)
        self.item_weights = np.zeros((classes, size, HIDDEN), np.float32)
        share = counts + 0.1
        self.class_bias = np.log(share.sum(axis=1) / share.sum()).astype(np.float32)
        self.item_bias = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)
        self.squares = None

    def vector(self) -> np.ndarray:
        return np.concatenate([getattr(self, name).ravel() for name in self.NAMES])

    def load(self, vector: np.ndarray) -> None:
        at = 0
        for name in self.NAMES:
            old = getattr(self, name)
            setattr(self, name, vector[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size

    def _run(self, before, goes_on, state, keep: bool):
        """States of a window, and with ``keep`` what the way back needs: by step, the state before, both gates,
        what the state adds to the new one, and the new one.

        The parts of the gates lie apart and have the sign and factor that ``exp`` wants.
        """
        steps, n = before.shape[0], len(state)
        kind = self.inputs.dtype
        factor = np.array([-1, -1, -2], kind)[:, None, None]
        inputs = np.ascontiguousarray(self.inputs.reshape(-1, 3, HIDDEN).transpose(1, 0, 2)) * factor
        add = inputs.take(before, axis=1, mode="clip")
        loop = self.loop.reshape(HIDDEN, 3, HIDDEN).transpose(1, 0, 2) * factor
        states = np.empty((steps, n, HIDDEN), kind)
        kept = steps if keep else 1
        olds, freshes = np.empty((2, kept, n, HIDDEN), kind)
        gates, adds = np.empty((kept, 2, n, HIDDEN), kind), np.empty((kept, 3, n, HIDDEN), kind)
        begins = goes_on[..., 0] == 0
        with np.errstate(over="ignore"):
            for step in range(steps):
                at = step if keep else 0
                old, gate, from_state, fresh = olds[at], gates[at], adds[at], freshes[at]
                old[:] = state
                old[begins[step]] = 0
                np.matmul(old, loop, out=from_state)
                np.add(add[:2, step], from_state[:2], out=gate)
                _logistic_of_negative(gate)
                np.multiply(gate[0], from_state[2], out=fresh)
                fresh += add[2, step]
                _logistic_of_negative(fresh)
                fresh *= 2
                fresh -= 1
                state = np.subtract(old, fresh, out=states[step])
                state *= gate[1]
                state += fresh
        return states, state, (olds, gates[:, 0], gates[:, 1], adds[:, 2] * kind.type(-0.5), freshes) if keep else None

    def _by_class(self, item: np.ndarray):
        """Tokens laid out by class: of each place the token, its class and place in it, and whether there is one
        (the smaller classes are filled up to a power of two), and slices of places: classes of one width each."""
        tokens, there, parts, at = [], [], [], 0
        for kinds, places, is_token in _laid_out(item // self.size, self.classes, 16):
            tokens.append(places.ravel())
            there.append(is_token.ravel())
            parts.append((kinds, slice(at, at + places.size)))
            at += places.size
        token, there = np.concatenate(tokens), np.concatenate(there)
        item = item[token]
        return token, item // self.size, item % self.size, there, parts

    def log_chances(self, states: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Natural log of each item's chance after its state."""
        result = np.empty(len(item), np.result_type(states, self.item_weights))
        if not len(item):
            return result
        token, kind, place, there, parts = self._by_class(item)
        states = states.take(token, 0)
        logits = states @ self.class_weights.T
        logits += self.class_bias
        chances = _log_share(logits, kind)
        for kinds, part in parts:
            logits = states[part].reshape(len(kinds), -1, HIDDEN) @ self.item_weights[kinds].transpose(0, 2, 1)
            logits += self.item_bias[kinds, None]
            chances[part] += _log_share(logits.reshape(-1, self.size), place[part])
        result[token[there]] = chances[there]
        return result

    def score(self, texts: list[np.ndarray], start: int, count: int = 256, window: int = 96) -> np.ndarray:
        """Natural log-likelihood of each whole text."""
        total = np.zeros(len(texts))
        if not texts:
            return total
        laid = Windows(texts, count, start)
        state = np.zeros((len(laid.lengths), HIDDEN), np.float32)
        for at, steps in laid.steps(window):
            before, goes_on, item, token = laid.window(at, steps)
            states, state, _ = self._run(before, goes_on, state[: item.shape[1]], False)
            there = item >= 0
            total += laid.sums(token[there], self.log_chances(states[there], item[there]), len(texts))
        return total

    def train(self, texts: list[np.ndarray], start: int, count: int = 256, window: int = 24) -> None:
        """One pass over the texts by Adagrad."""
        if not texts:
            return
        if self.squares is None:
            self.squares = {name: np.full(getattr(self, name).shape, 1e-7, np.float32) for name in self.NAMES}
        laid = Windows(texts, count, start)
        state = np.zeros((len(laid.lengths), HIDDEN), np.float32)
        for at, steps in laid.steps(window):
            before, goes_on, item, _ = laid.window(at, steps)
            states, new_state, kept = self._run(before, goes_on, state[: item.shape[1]], True)
            there = item >= 0
            self._learn(before, goes_on, states, there, item[there], kept)
            state = new_state

    def _learn(self, before, goes_on, states, there, item, kept) -> None:
        token, kind, place, is_token, parts = self._by_class(item)
        token = np.flatnonzero(there)[token]
        flat = states.reshape(-1, HIDDEN).take(token, 0)
        scale = is_token * flat.dtype.type(1 / len(item))
        every = np.arange(len(token))
        error = flat @ self.class_weights.T
        error += self.class_bias
        error *= (scale / _exp(error))[:, None]
        error[every, kind] -= scale
        back = error @ self.class_weights
        self._step("class_weights", error.T @ flat)
        self._step("class_bias", np.ones(len(error), error.dtype) @ error)
        slopes, shifts = [], []
        for kinds, part in parts:
            shape = (len(kinds), -1, HIDDEN)
            of_part, weights = flat[part].reshape(shape), self.item_weights[kinds]
            error = of_part @ weights.transpose(0, 2, 1)
            error += self.item_bias[kinds, None]
            by_token = error.reshape(-1, self.size)
            by_token *= (scale[part] / _exp(by_token))[:, None]
            by_token[every[: len(by_token)], place[part]] -= scale[part]
            back[part].reshape(shape)[...] += error @ weights
            slopes.append(error.transpose(0, 2, 1) @ of_part)
            shifts.append((np.ones((1, error.shape[1]), error.dtype) @ error)[:, 0])
        present = np.concatenate([kinds for kinds, _ in parts])
        self._step("item_weights", np.concatenate(slopes), present)
        self._step("item_bias", np.concatenate(shifts), present)

        errors = np.zeros_like(states)
        errors.reshape(-1, HIDDEN)[token[is_token]] = back[is_token]
        olds, reset, stay, from_state, fresh = kept
        # What an error of the state is, by step, at the new state and at both gates, each before its curve.
        leave = 1 - stay
        to_fresh = fresh * fresh
        np.subtract(1, to_fresh, out=to_fresh)
        to_fresh *= leave
        to_stay = olds - fresh
        to_stay *= stay
        to_stay *= leave
        to_reset = 1 - reset
        to_reset *= reset
        to_reset *= from_state
        every_gate = np.zeros((before.size + 1, 3 * HIDDEN), states.dtype)
        gates = every_gate[:-1].reshape(*before.shape, 3 * HIDDEN)
        through = np.empty_like(states)
        carried = np.zeros_like(states[0])
        begins = goes_on[..., 0] == 0
        of_gates, of_fresh = self.loop[:, : 2 * HIDDEN].T.copy(), self.loop[:, 2 * HIDDEN :].T.copy()
        for step in range(len(before) - 1, -1, -1):
            error, add = errors[step], gates[step]
            error += carried
            new = error * to_fresh[step]
            np.multiply(new, to_reset[step], out=add[:, :HIDDEN])
            np.multiply(error, to_stay[step], out=add[:, HIDDEN : 2 * HIDDEN])
            add[:, 2 * HIDDEN :] = new
            np.multiply(new, reset[step], out=through[step])
            carried = np.multiply(error, stay[step], out=new)
            carried += add[:, : 2 * HIDDEN] @ of_gates
            carried += through[step] @ of_fresh
            carried[begins[step]] = 0
        of_state, gates = olds.reshape(-1, HIDDEN).T, gates.reshape(-1, 3 * HIDDEN)
        self._step("loop", np.hstack([of_state @ gates[:, : 2 * HIDDEN], of_state @ through.reshape(-1, HIDDEN)]))
        present, sums = _sums_by(before.ravel(), every_gate, len(self.inputs))
        self._step("inputs", sums, present)

    def _step(self, name: str, slope: np.ndarray, rows=slice(None)) -> None:
        values = getattr(self, name)
        squares = slope * slope
        squares += self.squares[name][rows]
        self.squares[name][rows] = squares
        change = slope / np.sqrt(squares, out=squares)
        change *= RATE
        values[rows] -= change
