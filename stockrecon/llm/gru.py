"""A gated recurrent network over token ids, in numpy, with a class-factored softmax."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import islice
from math import prod

import numpy as np


#: Bound of the weights from state to logits, so that a logit is within 2 * hidden of its bias.
LARGEST = 2.0
#: Rows of states whose probabilities are worked out together.
RUN = 1_024


class Layout:
    """How token ids fall into classes: ``of_class[id]``, and for ids with a softmax their place in it.

    Ids from 0 to ``n_words - 1`` are words with a softmax of their own within their class, all
    of the same size ``per_class``; an id from ``n_words`` on is a class without one.
    """

    def __init__(self, n_words: int, per_class: int, n_open: int):
        self.n_words, self.per_class, self.n_open = n_words, per_class, n_open
        self.closed = -(-n_words // per_class)
        self.classes = self.closed + n_open
        self.ids = n_words + n_open
        words = np.arange(n_words)
        self.of_class = np.concatenate([words // per_class, self.closed + np.arange(n_open)]).astype(np.int64)


class Network:
    """Weights: ``x`` (input to the gates, one row per id and one for the start), ``u`` and ``v``
    (state to the gates), ``b``, ``c`` and ``d`` (state to classes), ``w`` and ``e`` (state to the
    words of each class)."""

    NAMES = ("x", "u", "v", "c", "d", "w", "e")

    def __init__(self, layout: Layout, hidden: int):
        self.layout, self.hidden = layout, hidden
        self._rooms: dict[tuple, np.ndarray] = {}
        rng = np.random.default_rng(7)

        def start(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        h, n = hidden, layout
        self.x = start(n.ids + 1, 3 * h, scale=0.1)
        self.u = start(h, 2 * h, scale=h**-0.5)
        self.v = start(h, h, scale=h**-0.5)
        self.c = start(h, n.classes, scale=0.05)
        self.d = np.zeros(n.classes, np.float32)
        self.w = start(n.closed, h, n.per_class, scale=0.05)
        self.e = np.zeros((n.closed, n.per_class), np.float32)
        # A last class that is not full: the places beyond the words never get probability.
        if n.n_words % n.per_class:
            self.e[-1, n.n_words % n.per_class :] = -1e9

    def vector(self) -> np.ndarray:
        return np.concatenate([getattr(self, name).ravel() for name in self.NAMES])

    def load(self, vector: np.ndarray) -> Network:
        at = 0
        for name in self.NAMES:
            old = getattr(self, name)
            setattr(self, name, vector[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return self

    def room(self, name: str, *shape: int, kind: np.dtype | None = None) -> np.ndarray:
        """Memory that is used again from window to window, whose pages would cost as much as the
        steps themselves; finite numbers are left in it."""
        kind, size = self.x.dtype if kind is None else kind, prod(shape)
        if (name, kind) not in self._rooms or self._rooms[name, kind].size < size:
            self._rooms[name, kind] = np.zeros(size, kind)
        return self._rooms[name, kind][:size].reshape(shape)

    def _by_gate(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``x`` (3, ids, hidden), ``u`` (2, hidden, hidden) and ``v`` times -1, -1 and -2, as exp takes them in :meth:`_step`."""
        H, factors = self.hidden, np.array([-1, -1, -2], self.x.dtype)[:, None, None]
        x = np.multiply(self.x.reshape(-1, 3, H).swapaxes(0, 1), factors, order="C")
        return x, np.negative(self.u.reshape(H, 2, H).swapaxes(0, 1), order="C"), -2 * self.v

    @staticmethod
    def _step(weights: tuple, given: np.ndarray, before: np.ndarray, after: np.ndarray, g: np.ndarray, s: np.ndarray, m: np.ndarray) -> None:
        """One step from ``before`` to ``after``; leaves both gates in ``g``, the reset state in ``s`` and the new one in ``m``.

        exp may run over to infinity, which gives a gate of 0 and a new state of -1.
        """
        _, u, v = weights
        np.matmul(before, u, out=g)
        g += given[:2]
        np.exp(g, out=g)
        g += 1
        np.reciprocal(g, out=g)
        np.multiply(g[1], before, out=s)
        np.matmul(s, v, out=m)
        m += given[2]
        np.exp(m, out=m)
        m += 1
        np.divide(2, m, out=m)
        m -= 1
        np.subtract(m, before, out=after)
        after *= g[0]
        after += before

    @np.errstate(over="ignore")
    def run(self, ids: np.ndarray, h: np.ndarray, lanes: np.ndarray) -> tuple[np.ndarray, tuple]:
        """States before each of the steps' targets are read, and what the way back needs.

        ``ids``: (steps, lanes) inputs; ``lanes``: how many lanes, from the first, live in each step.
        Both hold until the next run; they mean nothing in lanes that no longer live.
        """
        H, (steps, n) = self.hidden, ids.shape
        # One more in front: the states that the window begins with.
        states = self.room("states", steps + 1, n, H)
        states[0] = h
        reset, new, gates = self.room("reset", steps, n, H), self.room("new", steps, n, H), self.room("gates", steps, 2, n, H)
        weights = self._by_gate()
        for t, live in enumerate(lanes.tolist()):
            given = self.room("given", 3, live, H)
            weights[0].take(ids[t, :live], axis=1, out=given, mode="clip")
            self._step(weights, given, states[t, :live], states[t + 1, :live], gates[t, :, :live], reset[t, :live], new[t, :live])
        return states[1:], (states[:-1], gates, reset, new)

    @np.errstate(over="ignore")
    def states(self, ids: np.ndarray, h: np.ndarray, lanes: np.ndarray) -> np.ndarray:
        """The states of :meth:`run` alone, in memory that is used again from step to step."""
        H, (steps, n) = self.hidden, ids.shape
        result = self.room("states", steps, n, H)
        weights, before = self._by_gate(), h.astype(self.x.dtype)
        for t, live in enumerate(lanes.tolist()):
            given, g, m = self.room("given", 3, live, H), self.room("gates", 2, live, H), self.room("new", live, H)
            weights[0].take(ids[t, :live], axis=1, out=given, mode="clip")
            # The reset state may stand where the states after it will.
            after = result[t, :live]
            self._step(weights, given, before[:live], after, g, after, m)
            before = result[t]
        return result

    def log_probabilities(self, states: np.ndarray, targets: np.ndarray, grow: Network | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """ln P of each target after its state; with ``grow`` also the gradient by the states.

        ``states`` (n, hidden), ``targets`` (n). P is the class's probability, times the word's
        within its class if the class has a softmax. Words are taken class by class, all in
        runs that stay in the processor's cache.
        """
        n, H = self.layout, self.hidden
        order = _by_size(n.of_class[targets], n.classes)
        targets = targets[order]
        classes = n.of_class[targets]
        # A last component of 1 meets the bias.
        ahead = self.room("ahead", len(targets), H + 1, kind=states.dtype)
        ahead[:, :H] = states[order]
        ahead[:, H] = 1
        c, w = np.vstack([self.c, self.d]), np.concatenate([self.w, self.e[:, None]], axis=1)
        found = np.empty(len(targets), np.float32)
        back = None if grow is None else self.room("back", len(targets), H, kind=states.dtype)
        for a in range(0, len(targets), RUN):
            part = slice(a, a + RUN)
            share = ahead[part] @ c
            found[part] = _softmax(share, classes[part], grow is not None)
            if grow is not None:
                np.matmul(share, self.c.T, out=back[part])
                grow.c += ahead[part, :H].T @ share
                grow.d += np.ones(len(share), share.dtype) @ share
        bounds = np.searchsorted(classes, np.arange(n.closed + 1)).tolist()
        for k in range(n.closed):
            for a in range(bounds[k], bounds[k + 1], RUN):
                part = slice(a, min(a + RUN, bounds[k + 1]))
                share = ahead[part] @ w[k]
                found[part] += _softmax(share, targets[part] - k * n.per_class, grow is not None)
                if grow is not None:
                    back[part] += share @ self.w[k].T
                    grow.w[k] += ahead[part, :H].T @ share
                    grow.e[k] += np.ones(len(share), share.dtype) @ share
        result = np.empty_like(found)
        result[order] = found
        if grow is not None:
            found, back = back, np.empty_like(back)
            back[order] = found
        return result, back

    def gradient(self, kept: tuple, ids: np.ndarray, lanes: np.ndarray, back: np.ndarray, grow: Network) -> None:
        """Adds to ``grow`` what the window's steps pass back; truncated where the window begins.

        ``kept`` is of :meth:`run`; ``back`` is read where lanes live.
        """
        H = self.hidden
        before, gates, reset, new = kept
        z, r = gates[:, 0], gates[:, 1]
        z, r = gates[:, 0], gates[:, 1]
        # What the loop multiplies by, for all steps at once.
        stays, to_new, to_z, to_r, rest = (self.room(name, *z.shape) for name in ("stays", "to_new", "to_z", "to_r", "rest"))
        np.subtract(1, z, out=stays)
        np.multiply(new, new, out=to_new)
        np.subtract(1, to_new, out=to_new)
        to_new *= z
        np.subtract(new, before, out=to_z)
        to_z *= z
        to_z *= stays
        np.multiply(before, r, out=to_r)
        np.subtract(1, r, out=rest)
        to_r *= rest
        passed = self.room("passed", *ids.shape, 3 * H)
        later = np.zeros((ids.shape[1], H), self.x.dtype)
        to_gates, to_reset = self.u.T.copy(), self.v.T.copy()
        for t in range(len(lanes) - 1, -1, -1):
            live = lanes[t]
            d, p = later[:live], passed[t, :live]
            passed[t, live:] = 0
            d += back[t, :live]
            np.multiply(d, to_new[t, :live], out=p[:, 2 * H :])
            d_reset = p[:, 2 * H :] @ to_reset
            np.multiply(d, to_z[t, :live], out=p[:, :H])
            np.multiply(d_reset, to_r[t, :live], out=p[:, H : 2 * H])
            d *= stays[t, :live]
            d_reset *= r[t, :live]
            d += d_reset
            d += p[:, : 2 * H] @ to_gates
        flat = passed.reshape(-1, 3 * H)
        grow.u += before.reshape(-1, H).T @ flat[:, : 2 * H]
        grow.v += reset.reshape(-1, H).T @ flat[:, 2 * H :]
        used = np.flatnonzero(np.arange(ids.shape[1])[None, :] < lanes[:, None])
        _add_rows(grow.x, ids.reshape(-1)[used], flat, used)


def _by_size(numbers: np.ndarray, end: int) -> np.ndarray:
    """Places of ``numbers`` (0 to ``end - 1``) by size; numpy sorts short ones by their digits."""
    return np.argsort(numbers.astype(np.uint16) if end <= 1 << 16 else numbers, kind="stable")


def _softmax(logits: np.ndarray, targets: np.ndarray, back: bool) -> np.ndarray:
    """ln P of the targets; ``logits`` are used up, with ``back`` as the gradient of -ln P by them."""
    places = np.arange(len(targets)) * logits.shape[1] + targets
    flat = logits.reshape(-1)
    # LARGEST keeps exp from overflowing, and normalised biases keep the sum above 0.
    found = flat.take(places)
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], logits.dtype)
    found -= np.log(total)
    if back:
        logits *= (1 / total)[:, None]
        flat[places] -= 1
    return found


#: Rows of one id that are added up in turn, beside those of other ids.
FEW = 8


def _add_rows(table: np.ndarray, ids: np.ndarray, values: np.ndarray, at: np.ndarray) -> None:
    """table[ids] += values[at], ids that occur again included."""
    order = _by_size(ids, len(table))
    ids, values = ids[order], values.take(at[order], axis=0)
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    count = np.diff(np.r_[first, len(ids)])
    sums = np.empty((len(first), values.shape[1]), values.dtype)
    # The order of additions is that of numpy's sums: the first row meets the sum of the others.
    few = np.flatnonzero(count <= FEW)
    more = few[count[few] > 1]
    others = values[first[more] + 1]
    for turn in range(2, FEW):
        which = np.flatnonzero(count[more] > turn)
        others[which] += values[first[more[which]] + turn]
    sums[few] = values[first[few]]
    sums[more] += others
    for i in np.flatnonzero(count > FEW).tolist():
        sums[i] = np.add.reduceat(values[first[i] : first[i] + count[i]], [0], axis=0)[0]
    table[ids[first]] += sums


class Lanes:
    """Texts read side by side: a lane reads one window by window to its end, carrying the state,
    and then takes the next text."""

    def __init__(self, texts: Iterable[np.ndarray], lanes: int, steps: int, network: Network):
        self.lanes, self.steps, self.start, self.hidden = lanes, steps, network.layout.ids, network.hidden
        self.source = ((number, text) for number, text in enumerate(texts) if len(text))
        #: Number of the text, text, tokens read, state.
        self.reading: list[tuple[int, np.ndarray, int, np.ndarray]] = []

    def window(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Inputs, targets, live lanes of each step and states; None after the last text.

        The input of a step is the id before its target, ``start`` at first.
        """
        for number, text in islice(self.source, self.lanes - len(self.reading)):
            self.reading.append((number, text, 0, np.zeros(self.hidden, np.float32)))
        if not self.reading:
            return None
        self.reading.sort(key=lambda lane: min(self.steps, len(lane[1]) - lane[2]), reverse=True)
        sizes = self._sizes()
        targets = np.zeros((int(sizes[0]), len(sizes)), np.int64)
        inputs = np.zeros_like(targets)
        for i, ((_, text, at, _), n) in enumerate(zip(self.reading, sizes.tolist())):
            targets[:n, i] = text[at : at + n]
            inputs[1:n, i] = text[at : at + n - 1]
            inputs[0, i] = text[at - 1] if at else self.start
        live = np.array([(sizes > t).sum() for t in range(len(targets))])
        return inputs, targets, live, np.stack([state for *_, state in self.reading])

    def move(self, states: np.ndarray) -> None:
        """Goes on behind the window; ``states`` are those after each of its steps."""
        sizes = self._sizes().tolist()
        moved = [(k, text, at + n, states[n - 1, i].copy()) for i, ((k, text, at, _), n) in enumerate(zip(self.reading, sizes))]
        self.reading = [lane for lane in moved if lane[2] < len(lane[1])]

    def _sizes(self) -> np.ndarray:
        return np.array([min(self.steps, len(text) - at) for _, text, at, _ in self.reading])


class Adam:
    """Steps of falling size along the running mean of gradients, scaled by their running size.

    Input rows that a step has no gradient for are left alone, means included.
    """

    def __init__(self, network: Network, rate: float):
        self.rate, self.t = rate, 0
        self.first = {n: np.zeros_like(getattr(network, n)) for n in network.NAMES}
        self.second = {n: np.zeros_like(getattr(network, n)) for n in network.NAMES}

    def step(self, network: Network, grow: Network, scale: float) -> None:
        self.t += 1
        rate = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for name in network.NAMES:
            weights, g, first, second = getattr(network, name), getattr(grow, name), self.first[name], self.second[name]
            rows = np.flatnonzero(g.any(axis=1)) if name == "x" else slice(None)
            change, m, v = g[rows] * scale, first[rows], second[rows]
            np.clip(change, -1, 1, out=change)
            m += 0.1 * (change - m)
            change *= change
            v += 0.001 * (change - v)
            np.sqrt(v, out=change)
            change += 1e-6
            np.divide(m, change, out=change)
            change *= rate
            weights[rows] -= change
            first[rows], second[rows] = m, v
            g[rows] = 0
        for weights in (network.c, network.w):
            np.clip(weights, -LARGEST, LARGEST, out=weights)


def train(network: Network, texts: Iterable[np.ndarray], lanes: int, steps: int, rate: float) -> None:
    """One pass over all of the texts by backpropagation through time, truncated to windows.

    Weights move once a third of what all lanes hold has been read since they last moved, so
    that a long text that is left alone doesn't pull them at every window.
    """
    enough, pending = lanes * steps // 3, 0
    grow = Network(network.layout, network.hidden)
    grow.load(np.zeros(len(network.vector()), np.float32))
    adam, reading = Adam(network, rate), Lanes(texts, lanes, steps, network)
    while (window := reading.window()) is not None:
        inputs, targets, live, h = window
        states, kept = network.run(inputs, h, live)
        used = np.arange(len(h))[None, :] < live[:, None]
        _, back = network.log_probabilities(states[used], targets[used], grow)
        spread = network.room("spread", *states.shape)
        spread[used] = back
        network.gradient(kept, inputs, live, spread, grow)
        pending += int(used.sum())
        if pending >= enough:
            adam.step(network, grow, 32.0 / pending)
            pending = 0
        reading.move(states)
    if pending:
        adam.step(network, grow, 32.0 / max(1, enough))


def score(network: Network, texts: list[np.ndarray], lanes: int, steps: int) -> np.ndarray:
    """ln P of each whole text, in double precision sums, with states carried across windows.

    The longest texts begin, so that others are read beside them.
    """
    result = np.zeros(len(texts))
    order = np.array(sorted(range(len(texts)), key=lambda i: -len(texts[i])), int)
    reading = Lanes((texts[i] for i in order.tolist()), lanes, steps, network)
    while (window := reading.window()) is not None:
        inputs, targets, live, h = window
        states = network.states(inputs, h, live)
        used = np.arange(len(h))[None, :] < live[:, None]
        found, _ = network.log_probabilities(states[used], targets[used])
        table = np.zeros(used.shape)
        table[used] = found
        result[order[[number for number, *_ in reading.reading]]] += table.sum(axis=0)
        reading.move(states)
    return result
