"""A gated recurrent language model in numpy with a class-factored output.

An output is a class, and for classes of listed words the word within it. Lanes run in step; each is a row of documents one
after the other, at whose starts the state is cleared. Between windows the state is carried on; in training the slope
goes back to the start of the window only.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

HIDDEN = 16
#: Listed words, in classes of equal size by frequency; the first is the end of a text.
CLASSES, CLASS_WORDS = 32, 32
LISTED = CLASSES * CLASS_WORDS
#: Groups of other words, each a class of its own.
GROUPS = 32
START = LISTED + GROUPS
WINDOW = 20
LANES = 512
#: Fewer lanes make more steps of learning from the same texts.
TRAINING_LANES, FIRST_LANES = 256, 64
#: Tokens that are laid out in lanes at once; a long text is one lane.
AT_ONCE = 1 << 20
#: Rows whose class outputs are worked out at once.
ROWS = 1024

SHAPES = {
    "input": (START + 1, 3 * HIDDEN), "back": (HIDDEN, 3 * HIDDEN), "classes": (HIDDEN, CLASSES + GROUPS), "class_bias": (CLASSES + GROUPS,),
    "words": (CLASSES, HIDDEN, CLASS_WORDS), "word_bias": (CLASSES, CLASS_WORDS),
}


def initial(counts: np.ndarray | None = None, seed: int = 1) -> dict[str, np.ndarray]:
    """A network that gives each id about its share of counts, whatever came before."""
    random = np.random.default_rng(seed)
    spread = {"input": 0.2, "back": 0.25, "classes": 0.02, "words": 0.02}
    weights = {k: (random.normal(0, spread[k], s) if k in spread else np.zeros(s)).astype(np.float32) for k, s in SHAPES.items()}
    if counts is not None:
        smooth = counts + 0.5
        listed = smooth[:LISTED].reshape(CLASSES, CLASS_WORDS)
        classes = np.concatenate((listed.sum(1), smooth[LISTED:START]))
        weights["class_bias"][:] = np.log(classes / classes.sum())
        weights["word_bias"][:] = np.log(listed / listed.sum(1, keepdims=True))
    return weights


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in SHAPES])


def _views(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[k] = values[at : at + size].reshape(shape)
        at += size
    return out


def unflat(values: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v.astype(np.float32) for k, v in _views(values).items()}


@dataclass
class Lanes:
    """Texts in lanes, one lane after the other in flat arrays: begin and size of each lane, longest first.

    inputs, targets and owner hold a value for each token, so that a long text beside short ones takes no more than its own tokens.
    """

    inputs: np.ndarray
    targets: np.ndarray
    owner: np.ndarray
    begin: np.ndarray
    size: np.ndarray

    @property
    def steps(self) -> int:
        return int(self.size[0])

    def window(self, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """By step from t on and lane that still runs at t: inputs, targets and owners, and whether the lane still runs."""
        step = np.arange(t, min(t + WINDOW, self.steps))
        n = len(self.size) - np.searchsorted(self.size[::-1], t, "right")
        live = step[:, None] < self.size[:n]
        at = np.where(live, self.begin[:n] + step[:, None], 0)
        return np.where(live, self.inputs[at], np.int16(START)), np.where(live, self.targets[at], np.int16(0)), np.where(live, self.owner[at], np.int32(0)), live


def lay_out(texts: list[np.ndarray], most: int = LANES) -> Lanes:
    """Each text in the lane that is shortest so far, long texts first; lanes then by length."""
    n = max(1, min(most, len(texts)))
    lanes: list[list[int]] = [[] for _ in range(n)]
    queue = [(0, k) for k in range(n)]
    for i in sorted(range(len(texts)), key=lambda i: (-len(texts[i]), i)):
        size, k = queue[0]
        lanes[k].append(i)
        heapq.heapreplace(queue, (size + len(texts[i]), k))
    lanes.sort(key=lambda own: -sum(len(texts[i]) for i in own))
    order = np.random.default_rng(len(texts)).permutation(len(texts))
    for own in lanes:  # else long texts would all come first
        own.sort(key=order.__getitem__)
    sizes = np.array([sum(len(texts[i]) for i in own) for own in lanes])
    row = np.array([i for own in lanes for i in own], np.int32)
    lengths = np.array([len(texts[i]) for i in row], np.int64)
    targets = np.concatenate([*(texts[i] for i in row), np.empty(0, np.int16)]).astype(np.int16, copy=False)
    inputs = np.empty_like(targets)
    inputs[1:] = targets[:-1]
    inputs[(np.cumsum(lengths) - lengths)[lengths > 0]] = START
    return Lanes(inputs, targets, np.repeat(row, lengths), np.cumsum(sizes) - sizes, sizes)


def _sigmoid(x: np.ndarray) -> None:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)


def _steps(weights: dict[str, np.ndarray], state: np.ndarray, inputs: np.ndarray, keep: bool) -> tuple[np.ndarray, np.ndarray, tuple]:
    """States after each step of a window, the last state, and what the way back needs.

    By step, unit and lane, so that a step's values lie in one piece.
    """
    steps, n = inputs.shape
    back = np.ascontiguousarray(weights["back"].T)
    # the inputs' part of the gates, which become the gates z and r and the new value step by step
    gates = np.ascontiguousarray(weights["input"].take(inputs, axis=0).swapaxes(1, 2))
    fresh = inputs == START
    begins, stays = fresh.any(1).tolist(), (~fresh).astype(np.float32)
    states = np.empty((steps, HIDDEN, n), np.float32)
    from_state = np.empty((steps if keep else 1, 3 * HIDDEN, n), np.float32)
    h, part = state, np.empty((HIDDEN, n), np.float32)
    for t in range(steps):
        if begins[t]:
            h = h * stays[t]
        u = np.matmul(back, h, out=from_state[t if keep else 0])
        zr, new = gates[t, : 2 * HIDDEN], gates[t, 2 * HIDDEN :]
        zr += u[: 2 * HIDDEN]
        _sigmoid(zr)
        np.multiply(zr[HIDDEN:], u[2 * HIDDEN :], out=part)
        part += new
        np.tanh(part, out=new)
        np.subtract(h, new, out=part)
        part *= zr[:HIDDEN]
        h = np.add(part, new, out=states[t])
    return states, h.copy(), (gates, from_state[:, 2 * HIDDEN :], stays, begins)


def _rows_of(states: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The states at places by step and lane, by unit; a row of ones, for the bias, comes last."""
    steps, _, n = states.shape
    out = np.empty((HIDDEN + 1, len(at)), np.float32)
    np.ascontiguousarray(states.swapaxes(0, 1)).reshape(HIDDEN, steps * n).take(at, axis=1, out=out[:HIDDEN], mode="clip")
    out[HIDDEN] = 1
    return out


def _with_bias(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """By output the weights of all units, then the bias, which belongs to the row of ones."""
    return np.ascontiguousarray(np.concatenate((weights, bias[..., None, :]), axis=-2).swapaxes(-1, -2))


def _bounded(weights: np.ndarray) -> bool:
    """Whether no output can pass 80: units lie between -1 and 1."""
    return bool(np.abs(weights).sum(-1).max() <= 80)


def _classes_of(y: np.ndarray) -> np.ndarray:
    return np.where(y < LISTED, y // CLASS_WORDS, y - LISTED + CLASSES)


class _Outputs:
    """The rows of a window by class, in pieces that the processor's cache holds: their states, classes and words.

    Outputs over 80 count as 80, so that float32 holds the sums of their exponentials.
    """

    def __init__(self, weights: dict[str, np.ndarray]):
        self.classes, self.words = _with_bias(weights["classes"], weights["class_bias"]), _with_bias(weights["words"], weights["word_bias"])
        self.clip = not (_bounded(self.classes) and _bounded(self.words))

    def exps(self, out: np.ndarray) -> np.ndarray:
        if self.clip:
            np.minimum(out, np.float32(80), out=out)
        return np.exp(out, out=out)

    def word_outputs(self, h: np.ndarray, cuts: list[int]) -> np.ndarray:
        """Outputs by place in the class, for rows whose classes end at cuts."""
        out = np.empty((CLASS_WORDS, h.shape[1]), np.float32)
        for c in range(CLASSES):
            if cuts[c] < cuts[c + 1]:
                np.matmul(self.words[c], h[:, cuts[c] : cuts[c + 1]], out=out[:, cuts[c] : cuts[c + 1]])
        return out


def _by_class(own: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Rows in the order of their classes, and where each class of listed words begins and the last one ends."""
    order = np.argsort(own.astype(np.int8), kind="stable")
    return order, np.concatenate(([0], np.cumsum(np.bincount(own, minlength=CLASSES)[:CLASSES]))).tolist()


def log_probabilities(weights: dict[str, np.ndarray], texts: list[np.ndarray]) -> np.ndarray:
    """log10 of the probability of each text (ids under START, the last one the end), by the state of all before."""
    out = np.zeros(len(texts))
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (size < AT_ONCE or end == at):
            size += len(texts[end])
            end += 1
        out[at:end] = _score(weights, texts[at:end])
        at = end
    return out / np.log(10)


def _score(weights: dict[str, np.ndarray], texts: list[np.ndarray]) -> np.ndarray:
    lanes, outputs = lay_out(texts), _Outputs(weights)
    total, state = np.zeros(len(texts)), np.zeros((HIDDEN, len(lanes.size)), np.float32)
    for t in range(0, lanes.steps, WINDOW):
        x, y, who, live = lanes.window(t)
        states, state, _ = _steps(weights, state[:, : x.shape[1]], x, keep=False)
        rows = np.flatnonzero(live)
        y, who = y.ravel()[rows].astype(np.int64), who.ravel()[rows]
        order, cuts = _by_class(_classes_of(y))
        y, who = y[order], who[order]
        own, h = _classes_of(y), _rows_of(states, rows[order])
        value = np.empty(len(y), np.float32)
        for a in range(0, len(y), ROWS):
            b = min(a + ROWS, len(y))
            out = outputs.classes @ h[:, a:b]
            value[a:b] = out[own[a:b], np.arange(b - a)]
            value[a:b] -= np.log(outputs.exps(out).sum(0))
        listed = cuts[-1]
        out = outputs.word_outputs(h[:, :listed], cuts)
        value[:listed] += out[y[:listed] % CLASS_WORDS, np.arange(listed)]
        value[:listed] -= np.log(outputs.exps(out).sum(0))
        total += np.bincount(who, value, len(texts))
    return total


class Trainer:
    """Adam on windows of lanes."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.values = flat(weights)
        self.weights = _views(self.values)
        self.first, self.second = np.zeros_like(self.values), np.zeros_like(self.values)
        self.rate, self.step, self.tokens = rate, 0, 0

    def learn(self, texts: list[np.ndarray], most: int = TRAINING_LANES) -> None:
        lanes = lay_out(texts, most)
        state = np.zeros((HIDDEN, len(lanes.size)), np.float32)
        for t in range(0, lanes.steps, WINDOW):
            state = self._window(lanes, t, state)
        self.tokens += sum(map(len, texts))

    def _window(self, lanes: Lanes, t: int, state: np.ndarray) -> np.ndarray:
        w, outputs = self.weights, _Outputs(self.weights)
        x, y, _, live = lanes.window(t)
        steps, n = x.shape
        state = state[:, :n]
        states, last, tape = _steps(w, state, x, keep=True)
        # a window in which few lanes still run moves the network by as much less
        some = int(live.sum())
        full, share = min(WINDOW, lanes.steps) * len(lanes.size), np.float32(1 / max(some, 1))
        y = y.ravel().astype(np.int64)
        order, cuts = _by_class(np.where(live.ravel(), _classes_of(y), CLASSES + GROUPS))
        order, place = order[:some], np.zeros(steps * n, np.int64)
        place[order] = np.arange(some)
        y = y[order]
        own, h = _classes_of(y), _rows_of(states, order)
        slope, g_classes = np.empty((HIDDEN, some), np.float32), np.zeros_like(outputs.classes)
        for a in range(0, some, ROWS):
            b = min(a + ROWS, some)
            p = outputs.exps(outputs.classes @ h[:, a:b])
            p *= share / p.sum(0)
            p[own[a:b], np.arange(b - a)] -= share
            g_classes += p @ h[:, a:b].T
            np.matmul(w["classes"], p, out=slope[:, a:b])
        g = {"classes": g_classes[:, :HIDDEN].T, "class_bias": g_classes[:, HIDDEN]}
        listed = cuts[-1]
        q = outputs.exps(outputs.word_outputs(h[:, :listed], cuts))
        q *= share / q.sum(0)
        q[y[:listed] % CLASS_WORDS, np.arange(listed)] -= share
        g_words, back_words = np.zeros_like(outputs.words), np.empty((HIDDEN, listed), np.float32)
        for c in range(CLASSES):
            a, b = cuts[c], cuts[c + 1]
            if a < b:
                np.matmul(q[:, a:b], h[:, a:b].T, out=g_words[c])
                np.matmul(w["words"][c], q[:, a:b], out=back_words[:, a:b])
        slope[:, :listed] += back_words
        g["words"], g["word_bias"] = g_words[:, :, :HIDDEN].swapaxes(1, 2), g_words[:, :, HIDDEN]
        slope = slope.take(place, axis=1)
        if some < steps * n:
            slope *= live.ravel()
        g["back"], g["input"] = self._back(state, states, slope.reshape(HIDDEN, steps, n), x, tape)
        self._move(g, some / full)
        return last

    def _back(self, state: np.ndarray, states: np.ndarray, slope: np.ndarray, x: np.ndarray, tape: tuple) -> tuple[np.ndarray, np.ndarray]:
        """The slopes of back and input, from those of the states."""
        gates, un, stays, begins = tape
        steps, _, n = states.shape
        z, r, new = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        before = np.empty_like(states)
        before[0], before[1:] = state, states[:-1]
        before *= stays[:, None]
        # what a state's slope is multiplied by for those of new, z and r
        by_new, by_z, by_r, rest = new * new, before - new, 1 - r, 1 - z
        np.subtract(1, by_new, out=by_new)
        by_new *= rest
        by_z *= z
        by_z *= rest
        by_r *= r
        by_r *= un
        # slopes of the state's part of new, then those of the inputs' parts of z, r and new
        moves = np.empty((steps, 4 * HIDDEN, n), np.float32)
        to_state = np.ascontiguousarray(np.roll(self.weights["back"], HIDDEN, axis=1))
        later, d, part = np.zeros((HIDDEN, n), np.float32), np.empty((HIDDEN, n), np.float32), np.empty((HIDDEN, n), np.float32)
        for k in range(steps - 1, -1, -1):
            own = moves[k]
            np.add(slope[:, k], later, out=d)
            dn = np.multiply(d, by_new[k], out=own[3 * HIDDEN :])
            np.multiply(dn, r[k], out=own[:HIDDEN])
            np.multiply(d, by_z[k], out=own[HIDDEN : 2 * HIDDEN])
            np.multiply(dn, by_r[k], out=own[2 * HIDDEN : 3 * HIDDEN])
            np.multiply(d, z[k], out=part)
            np.matmul(to_state, own[: 3 * HIDDEN], out=later)
            later += part
            if begins[k]:
                later *= stays[k]
        g_back = np.matmul(before, moves[:, : 3 * HIDDEN].swapaxes(1, 2)).sum(0)
        at = x.ravel().astype(np.int64)
        g_input = np.empty((3 * HIDDEN, START + 1), np.float32)
        for i in range(3 * HIDDEN):
            g_input[i] = np.bincount(at, moves[:, HIDDEN + i].ravel(), START + 1)
        return np.roll(g_back, -HIDDEN, axis=1), g_input.T

    def _move(self, g: dict[str, np.ndarray], part: float) -> None:
        s, m, v = flat(g), self.first, self.second
        s *= np.float32(min(1.0, 1.0 / max(float(np.sqrt(s @ s)), 1e-9)))
        self.step += 1
        lift1, lift2 = 1 - 0.9**self.step, 1 - 0.99**self.step
        step = s - m
        step *= np.float32(0.1)
        m += step
        s *= s
        s -= v
        s *= np.float32(0.01)
        v += s
        np.divide(v, np.float32(lift2), out=s)
        np.sqrt(s, out=s)
        s += np.float32(1e-6)
        np.multiply(m, np.float32(self.rate * part / lift1), out=step)
        step /= s
        self.values -= step
