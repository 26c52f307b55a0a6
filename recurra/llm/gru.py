"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation, state carried along a text.

Many texts are read side by side, one in each lane; a lane takes up the next text where one ends, with its state set back to zero.
A window of steps is run forward, then (in training) backward, and the states at its end begin the next window, so a text of any
length is scored whole while gradients reach back one window.

P(word | before) = P(class of the word | state) * P(word | class, state). Both factors begin at the corpus's own frequencies
(their biases), so an untrained model is the unigram model and training only adds to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np

WINDOW = 32
LANES = 512
HIDDEN = 12
CLIP = 1.0


@dataclass
class Parameters:
    """Input weights by word, recurrent weights and biases of the three gates; weights and biases of classes and of words in classes."""

    inputs: np.ndarray  # words + 1 (the start of a text) x 3 hidden
    recurrent: np.ndarray  # hidden x 2 hidden: update and reset
    candidate: np.ndarray  # hidden x hidden
    classes: np.ndarray  # hidden x classes
    class_bias: np.ndarray
    words: np.ndarray  # words x hidden
    word_bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    @classmethod
    def shaped(cls, flat: np.ndarray, like: Parameters) -> Parameters:
        out, at = [], 0
        for a in like.arrays():
            out.append(flat[at: at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return cls(*out)

    def zeros(self) -> Parameters:
        return Parameters(*[np.zeros_like(a) for a in self.arrays()])


def class_bounds(counts: np.ndarray, classes: int) -> np.ndarray:
    """Where each class begins among words in order of frequency: classes share the square roots of the counts evenly."""
    mass = np.cumsum(np.sqrt(np.maximum(counts, 1)))
    cuts = np.searchsorted(mass, mass[-1] * np.arange(1, classes) / classes) + 1
    return np.unique(np.concatenate([[0], np.minimum(cuts, len(counts) - 1)]))


def initial(counts: np.ndarray, bounds: np.ndarray, hidden: int = HIDDEN, seed: int = 7) -> Parameters:
    """The unigram model of the counts, with small random weights."""
    random = np.random.default_rng(seed)
    n = len(counts)
    share = np.log((counts + 1.0) / (counts + 1.0).sum())
    size = np.logaddexp.reduceat(share, bounds)
    of = np.repeat(np.arange(len(bounds)), np.diff(bounds, append=n))

    def small(*shape: int) -> np.ndarray:
        return random.normal(0, 0.1, shape).astype(np.float32)

    return Parameters(
        small(n + 1, 3 * hidden), small(hidden, 2 * hidden), small(hidden, hidden),
        small(hidden, len(bounds)), size.astype(np.float32), small(n, hidden), (share - size[of]).astype(np.float32),
    )


def lanes(texts: Iterator[tuple[int, np.ndarray]], width: int, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Windows (words, owners, starts) of `window` x `width`: word ids, -1 for none; the text each belongs to; whether it begins a text."""
    rest: list[np.ndarray | None] = [None] * width
    owner = np.full(width, -1, np.int64)
    more = True
    while True:
        words = np.full((window, width), -1, np.int64)
        owners = np.full((window, width), -1, np.int64)
        starts = np.zeros((window, width), bool)
        for lane in range(width):
            at = 0
            while at < window:
                if rest[lane] is None or not len(rest[lane]):
                    found = next(texts, None) if more else None
                    if found is None:
                        more = False
                        break
                    owner[lane], rest[lane] = found
                    if len(rest[lane]):
                        starts[at, lane] = True
                    continue
                part = rest[lane][: window - at]
                words[at: at + len(part), lane] = part
                owners[at: at + len(part), lane] = owner[lane]
                rest[lane] = rest[lane][len(part):]
                at += len(part)
        if not (words >= 0).any():
            return
        yield words, owners, starts


def _busy(words: np.ndarray) -> np.ndarray:
    """The lanes that have a word in this window; near the end of the texts the others stand still and cost nothing."""
    return np.flatnonzero((words >= 0).any(axis=0))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Model:
    def __init__(self, parameters: Parameters, bounds: np.ndarray) -> None:
        self.p, self.bounds = parameters, bounds
        self.n = len(parameters.word_bias)
        self.hidden = parameters.candidate.shape[0]
        self.of = np.repeat(np.arange(len(bounds)), np.diff(bounds, append=self.n))
        self.ends = np.append(bounds[1:], self.n)

    def forward(self, words: np.ndarray, starts: np.ndarray, state: np.ndarray, last: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray]:
        """States before each word of a window, the state after it, and the last words. `last` is the word before each lane's next."""
        p, h = self.p, self.hidden
        steps, width = words.shape
        before = np.empty_like(words)
        before[0], before[1:] = last, words[:-1]
        before[starts] = self.n
        before[before < 0] = self.n
        given = p.inputs[before]
        keep = {"before": before, "old": np.empty((steps, width, h), np.float32), "gates": np.empty((steps, width, 2 * h), np.float32),
                "new": np.empty((steps, width, h), np.float32), "state": np.empty((steps, width, h), np.float32)}
        for t in range(steps):
            if starts[t].any():
                state = np.where(starts[t][:, None], np.float32(0), state)
            gates = _sigmoid(given[t, :, : 2 * h] + state @ p.recurrent)
            new = np.tanh(given[t, :, 2 * h:] + (gates[:, h:] * state) @ p.candidate)
            keep["old"][t], keep["gates"][t], keep["new"][t] = state, gates, new
            state = state + gates[:, :h] * (new - state)
            keep["state"][t] = state
        return keep, state, words[-1]

    def log_probabilities(self, states: np.ndarray, words: np.ndarray, gradient: Parameters | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural logarithms for each (state, word); with a gradient to add to, also the gradient by state."""
        p = self.p
        scores = states @ p.classes + p.class_bias
        scores -= scores.max(axis=1, keepdims=True)
        shares = np.exp(scores)
        total = shares.sum(axis=1, keepdims=True)
        of = self.of[words]
        rows = np.arange(len(words))
        out = scores[rows, of] - np.log(total[:, 0])
        back = None
        if gradient is not None:
            shares /= total
            shares[rows, of] -= 1
            gradient.classes += states.T @ shares
            gradient.class_bias += shares.sum(axis=0)
            back = shares @ p.classes.T
        # Words of one class are scored together, so that each class is one product.
        order = np.argsort(of, kind="stable")
        cuts = np.searchsorted(of[order], np.arange(len(self.bounds) + 1))
        for c in np.flatnonzero(np.diff(cuts)):
            first, end = self.bounds[c], self.ends[c]
            if end - first == 1:
                continue
            mine = order[cuts[c]: cuts[c + 1]]
            inner = states[mine] @ p.words[first:end].T + p.word_bias[first:end]
            inner -= inner.max(axis=1, keepdims=True)
            parts = np.exp(inner)
            whole = parts.sum(axis=1, keepdims=True)
            place = (np.arange(len(mine)), words[mine] - first)
            out[mine] += inner[place] - np.log(whole[:, 0])
            if gradient is not None:
                parts /= whole
                parts[place] -= 1
                gradient.words[first:end] += parts.T @ states[mine]
                gradient.word_bias[first:end] += parts.sum(axis=0)
                back[mine] += parts @ p.words[first:end]
        return out, back

    def backward(self, keep: dict, back: np.ndarray, starts: np.ndarray, gradient: Parameters) -> None:
        """Adds the gradient of a window; nothing reaches back before it or across the beginning of a text."""
        p, h = self.p, self.hidden
        steps, width, _ = back.shape
        given = np.empty((steps, width, 3 * h), np.float32)
        carried = np.zeros((width, h), np.float32)
        for t in reversed(range(steps)):
            old, gates, new = keep["old"][t], keep["gates"][t], keep["new"][t]
            update, reset = gates[:, :h], gates[:, h:]
            d = carried + back[t]
            d_new = d * update * (1 - new * new)
            d_reset_old = d_new @ p.candidate.T
            d_gates = given[t, :, : 2 * h]
            np.multiply(d * (new - old), update * (1 - update), out=d_gates[:, :h])
            np.multiply(d_reset_old * old, reset * (1 - reset), out=d_gates[:, h:])
            given[t, :, 2 * h:] = d_new
            carried = d * (1 - update) + d_reset_old * reset + d_gates @ p.recurrent.T
            carried[starts[t]] = 0
        # All steps at once: what the weights between states have given to the gates and to the new states.
        old, all_given = keep["old"].reshape(-1, h), given.reshape(-1, 3 * h)
        gradient.candidate += (keep["gates"].reshape(-1, 2 * h)[:, h:] * old).T @ all_given[:, 2 * h:]
        gradient.recurrent += old.T @ all_given[:, : 2 * h]
        # Equal input words are summed before they are added.
        flat = keep["before"].ravel()
        order = np.argsort(flat, kind="stable")
        first = np.flatnonzero(np.diff(flat[order], prepend=-1))
        gradient.inputs[flat[order][first]] += np.add.reduceat(all_given[order], first, axis=0)

    def score(self, texts: Iterator[tuple[int, np.ndarray]], totals: np.ndarray, width: int = LANES, window: int = WINDOW) -> None:
        """Adds the log-likelihood (natural) of every text to its place in `totals`."""
        state, last = np.zeros((width, self.hidden), np.float32), np.full(width, -1, np.int64)
        for words, owners, starts in lanes(texts, width, window):
            busy = _busy(words)
            words, owners, starts = words[:, busy], owners[:, busy], starts[:, busy]
            keep, state[busy], last[busy] = self.forward(words, starts, state[busy], last[busy])
            real = words.ravel() >= 0
            found, _ = self.log_probabilities(keep["state"].reshape(-1, self.hidden)[real], words.ravel()[real])
            totals += np.bincount(owners.ravel()[real], weights=found, minlength=len(totals))

    def train(
        self, texts: Iterator[tuple[int, np.ndarray]], rate: float, squares: list[np.ndarray] | None = None,
        width: int = LANES, window: int = WINDOW,
    ) -> tuple[int, list[np.ndarray]]:
        """One pass of AdaGrad over the texts, window by window; returns how many words it saw, and its squares to go on with."""
        state, last, seen = np.zeros((width, self.hidden), np.float32), np.full(width, -1, np.int64), 0
        squares = squares or [np.full_like(a, 1e-6) for a in self.p.arrays()]
        for words, _, starts in lanes(texts, width, window):
            gradient, busy = self.p.zeros(), _busy(words)
            words, starts = words[:, busy], starts[:, busy]
            keep, state[busy], last[busy] = self.forward(words, starts, state[busy], last[busy])
            real = words.ravel() >= 0
            n = int(real.sum())
            seen += n
            back = np.zeros((words.size, self.hidden), np.float32)
            _, back[real] = self.log_probabilities(keep["state"].reshape(-1, self.hidden)[real], words.ravel()[real], gradient)
            self.backward(keep, back.reshape(*words.shape, self.hidden), starts, gradient)
            for a, g, s in zip(self.p.arrays(), gradient.arrays(), squares):
                # By the size of a full window, so that one with few words left moves the model by as little.
                g /= width * window
                np.clip(g, -CLIP, CLIP, out=g)
                s += g * g
                a -= rate * g / np.sqrt(s)
        return seen, squares
