"""A gated recurrent language model in numpy with a class-factored softmax.

Frequent words have ids; all others share the last id. A word's probability is that of its
class times that within the class. Texts run in lanes side by side, step by step, one after the other in each, so that all lanes
stay busy; a lane's state is carried from window to window until its text ends, so a text is
scored whole whatever its length. Training goes back through one window (truncated).
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 32
LANES = 512
LEARNING_LANES = 64
TOGETHER = 400  # classes times words of a group; more of them share calls, but also compute what they do not need
BLOCK = 16_384  # parameters changed at once
ONE = np.float32(1)
STEEP = 80  # beyond, a float's exponential may overflow
NAMES = ["embed", "inner", "state", "gate", "to_class", "class_bias", "to_word", "word_bias"]


class Gru:
    """Ids 0 to ``n - 1`` are words, id 0 the end of a text; id ``n`` is every other word.

    ``counts`` are how often each id occurs; they order the words into classes of about equal weight
    and are the biases to begin with.
    """

    def __init__(self, counts: np.ndarray, hidden: int = 32, embed: int = 16, classes: int = 32, seed: int = 1):
        random = np.random.default_rng(seed)
        n = len(counts) - 1
        weight = np.maximum(counts[:n], 0.5)
        order = np.argsort(-weight, kind="stable")
        upto = np.cumsum(weight[order]) - weight[order] / 2
        group = np.minimum((upto / max(weight.sum(), 1e-9) * classes).astype(np.int64), classes - 1)
        self.of_class = np.empty(n + 1, np.int64)
        self.of_class[order] = np.unique(group, return_inverse=True)[1] if n else group
        used = int(self.of_class[:n].max()) + 1 if n else 0
        self.of_class[n] = used
        self.classes = used + 1
        self.members = [np.flatnonzero(self.of_class[:n] == c) for c in range(used)]
        self.place = np.zeros(n + 1, np.int64)
        for inside in self.members:
            self.place[inside] = np.arange(len(inside))
        mass = np.bincount(self.of_class, np.append(weight, max(counts[n], 0.5)), self.classes)
        scale = hidden**-0.5
        self.embed = random.normal(0, 0.3, (n + 1, embed)).astype(np.float32)
        self.inner = random.normal(0, embed**-0.5, (embed, 3 * hidden)).astype(np.float32)
        self.state = random.normal(0, scale, (hidden, 3 * hidden)).astype(np.float32)
        self.gate = np.zeros(3 * hidden, np.float32)
        self.to_class = np.zeros((hidden, self.classes), np.float32)
        self.class_bias = np.log(mass / mass.sum()).astype(np.float32)
        self.to_word = np.zeros((n + 1, hidden), np.float32)
        self.word_bias = np.append(np.log(weight), 0).astype(np.float32)
        self.hidden = hidden
        self.moments: list[np.ndarray] = []
        self.steps = 0
        # Words by class, and classes of several words: each alone, and in groups that learning computes at once.
        self.words = np.concatenate(self.members) if self.members else np.empty(0, np.int64)
        self.starts = np.cumsum([0, *(len(inside) for inside in self.members)])
        self.groups: list[list[int]] = []
        for c, inside in enumerate(self.members):
            if len(inside) > 1:
                at = self.groups[-1][0] if self.groups else c
                if not self.groups or (c + 1 - at) * (self.starts[c + 1] - self.starts[at]) > TOGETHER:
                    self.groups.append([])
                self.groups[-1].append(c)
        self.alone = [[c] for group in self.groups for c in group]
        self.class_in_order = self.of_class[self.words]
        self.rooms: dict[str, np.ndarray] = {}

    def parameters(self) -> list[np.ndarray]:
        return [getattr(self, name) for name in NAMES]

    def set_parameters(self, values: list[np.ndarray]) -> None:
        for name, value in zip(NAMES, values, strict=True):
            setattr(self, name, value.astype(np.float32))

    # -- running -----------------------------------------------------------------------

    def _room(self, name: str, *shape: int) -> np.ndarray:
        """An array that all windows use in turn; a new one for each would cost as much as filling it."""
        if name not in self.rooms or self.rooms[name].shape != shape:
            self.rooms[name] = np.empty(shape, np.float32)
        return self.rooms[name]

    def _weights(self) -> tuple[np.ndarray, np.ndarray]:
        """What the state (candidate, reset, update) and the input (reset, update, candidate) add to the gates.

        The input's last column is the bias. Reset and update have their sign turned, as the sigmoid wants it.
        """
        n = self.hidden
        from_state = _turned(self.state, n, last_first=True).T.astype(np.float32)
        from_state[n:] *= -1
        from_input = _turned(np.concatenate([self.inner, self.gate[None]]), n).T.astype(np.float32)
        from_input[: 2 * n] *= -1
        return np.ascontiguousarray(from_state), np.ascontiguousarray(from_input)

    def _given(self, inputs: np.ndarray) -> np.ndarray:
        """The embedded inputs, a matrix for each step, with a one for the bias."""
        steps, lanes = inputs.shape
        given = self._room("given", steps, self.embed.shape[1] + 1, lanes)
        given[:, -1] = 1
        given[:, :-1] = np.take(self.embed, inputs, axis=0).transpose(0, 2, 1)
        return given

    def _output(self) -> tuple[np.ndarray, np.ndarray, bool]:
        """Rows of classes and of words, the words by class; the last column is the bias. And if results may be large."""
        to_class = np.concatenate([self.to_class, self.class_bias[None]]).T.astype(np.float32)
        to_word = np.empty((len(self.words), self.hidden + 1), np.float32)
        to_word[:, :-1] = np.take(self.to_word, self.words, axis=0)
        to_word[:, -1] = self.word_bias[self.words]
        # States lie between -1 and 1.
        most = max((float((np.abs(x) @ np.ones(x.shape[1], np.float32)).max()) for x in (to_class, to_word) if len(x)), default=0)
        return to_class, to_word, not most < STEEP

    def _by_class(self, states: np.ndarray, target: np.ndarray, there: np.ndarray):
        """Places with a target, sorted by class: which, their targets and classes, each class's cuts, and states.

        States come as a matrix of lanes for each step; they leave as rows with a one for the bias.
        """
        group = np.where(there, self.of_class[target], self.classes)
        order = np.argsort(group.astype(np.uint16), kind="stable")[: np.count_nonzero(there)]
        target, group = target[order], group[order]
        steps, n, lanes = states.shape
        rows = self._room("rows", steps, lanes, n)
        rows[...] = states.transpose(0, 2, 1)
        seen = self._room("seen", steps * lanes, n + 1)[: len(order)]
        seen[:, -1] = 1
        seen[:, :-1] = np.take(rows.reshape(-1, n), order, axis=0)
        return order, target, group, np.searchsorted(group, np.arange(self.classes + 1)), seen

    def _grouped(self, groups: list[list[int]], cuts: np.ndarray, target: np.ndarray, group: np.ndarray):
        """Of each group of classes: the places with one of its words, its words, where the targets are, what to leave out."""
        place = self.place[target] + self.starts[group]
        for classes in groups:
            own = slice(int(cuts[classes[0]]), int(cuts[classes[-1] + 1]))
            if own.start < own.stop:
                inside = slice(int(self.starts[classes[0]]), int(self.starts[classes[-1] + 1]))
                apart = None
                if len(classes) > 1:
                    apart = self.class_in_order[inside, None] == group[own]
                yield own, inside, place[own] - inside.start, apart

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of every text; each ends with id 0, which also comes before it."""
        total = np.zeros(len(texts))
        if not texts:
            return total
        n = self.hidden
        from_state, from_input = self._weights()
        to_class, to_word, steep = self._output()
        rows, owner = _lanes(texts)
        lanes = len(rows)
        begins = np.ones(rows.shape, bool)
        begins[:, 1:] = owner[:, 1:] != owner[:, :-1]
        inputs = np.zeros_like(rows)
        inputs[:, 1:] = np.where(begins[:, 1:], 0, rows[:, :-1])
        h = np.zeros((n, lanes), np.float32)
        x, u, rz, passed, new = (np.empty((k * n, lanes), np.float32) for k in (3, 3, 2, 1, 1))
        blocks = x[: 2 * n], x[2 * n :], u[:n], u[n:], rz, rz[:n], rz[n:], passed, new
        for at in range(0, rows.shape[1], WINDOW):
            part, entered, fresh, whose = (np.ascontiguousarray(y[:, at : at + WINDOW].T) for y in (rows, inputs, begins, owner))
            given = self._given(entered)
            states = self._room("states", len(part), n, lanes)
            for t in range(len(part)):
                h = h.copy() if t == 0 else states[t - 1]
                if fresh[t].any():
                    h = h * ~fresh[t]
                np.matmul(from_input, given[t], out=x)
                np.matmul(from_state, h, out=u)
                _cell(*blocks, h, states[t])
            h = states[-1]
            # A target's log probability; for the shared id, that of its class only.
            whose = whose.ravel()
            order, target, group, cuts, seen = self._by_class(states, part.ravel(), whose >= 0)
            logs = _log_share(to_class @ seen.T, group, steep)
            for own, inside, place, apart in self._grouped(self.alone, cuts, target, group):
                logs[own] += _log_share(to_word[inside] @ seen[own].T, place, steep, apart)
            total += np.bincount(whose[order], logs, len(texts))
        return total

    # -- learning ----------------------------------------------------------------------

    def train(self, texts: list[np.ndarray], rate: float, lanes: int = LEARNING_LANES) -> int:
        """One pass over the texts; tokens seen.

        The texts follow one another in one stream, which is cut into lanes of equal length, so all lanes are
        always busy, however long a text is. The state is carried from window to window and begins anew with
        each text and each lane.
        """
        stream = np.concatenate(texts) if texts else np.empty(0, np.int64)
        if not len(stream):
            return 0
        lanes = max(1, min(lanes, len(stream) // WINDOW))
        length = -(-len(stream) // lanes)
        padded = np.zeros(lanes * length, np.int64)
        padded[: len(stream)] = stream
        rows, valid = padded.reshape(lanes, length), (np.arange(lanes * length) < len(stream)).reshape(lanes, length)
        before = np.concatenate([[0], rows[:-1, -1]])
        h = np.zeros((self.hidden, lanes), np.float32)
        for at in range(0, length, WINDOW):
            part = rows[:, at : at + WINDOW]
            h = self._train_window(part, valid[:, at : at + WINDOW], before, h, rate)
            before = part[:, -1]
        return len(stream)

    def _over_steps(self, name: str, x: np.ndarray) -> np.ndarray:
        """The steps' matrices side by side."""
        steps, rows, lanes = x.shape
        out = self._room(f"{name} over steps", rows, steps, lanes)
        out[...] = x.transpose(1, 0, 2)
        return out.reshape(rows, -1)

    def _train_window(self, part, valid, before, h, rate) -> np.ndarray:
        """Matrices have a column a lane: parts of the gates are then blocks of rows, which lie together."""
        lanes, steps = part.shape
        n = self.hidden
        from_state, from_input = self._weights()
        to_class, to_word, steep = self._output()
        inputs = np.concatenate([before[None], part.T[:-1]])  # step by step
        begins = inputs == 0
        fresh = begins.any(axis=1).tolist()
        given = self._given(inputs)
        past, states, passed, new = (self._room(name, steps, n, lanes) for name in ("past", "states", "passed", "new"))
        rz = self._room("rz", steps, 2 * n, lanes)
        r, z = rz[:, :n], rz[:, n:]
        x, u = self._room("x", 3 * n, lanes), self._room("u", 3 * n, lanes)
        blocks = x[: 2 * n], x[2 * n :], u[:n], u[n:]
        each = zip(fresh, begins, given, past, rz, r, z, passed, new, states, strict=True)
        for some, those, entered, own, *inside, state in each:
            if some:
                np.multiply(h, ~those, out=own)
            else:
                own[...] = h
            np.matmul(from_input, entered, out=x)
            np.matmul(from_state, own, out=u)
            _cell(*blocks, *inside, own, state)
            h = state
        order, target, group, cuts, seen = self._by_class(states, part.T.ravel(), valid.T.ravel())
        scale = np.float32(1 / max(1, len(target)))
        slope = {}
        wrong = _softmax(to_class @ seen.T, group, scale, steep)
        of_class = seen.T @ wrong.T
        slope["to_class"], slope["class_bias"] = of_class[:-1], of_class[-1]
        back = wrong.T @ to_class[:, :-1]
        of_word = np.zeros_like(to_word)
        for own, inside, place, apart in self._grouped(self.groups, cuts, target, group):
            wrong = _softmax(to_word[inside] @ seen[own].T, place, scale, steep, apart)
            np.matmul(wrong, seen[own], out=of_word[inside])
            back[own] += wrong.T @ to_word[inside, :-1]
        slope["to_word"], slope["word_bias"] = np.zeros((len(self.place), n), np.float32), np.zeros(len(self.place), np.float32)
        slope["to_word"][self.words], slope["word_bias"][self.words] = of_word[:, :-1], of_word[:, -1]
        by_place = self._room("by place", steps * lanes, n)
        by_place[...] = 0
        by_place[order] = back
        outer = self._room("outer", steps, n, lanes)
        outer[...] = by_place.reshape(steps, lanes, n).transpose(0, 2, 1)
        # A slope of the state, times these, is that of update and candidate; the candidate's, times
        # those, what passes the reset gate and the slope of reset.
        to_both, from_new = (self._room(name, steps, 2, n, lanes) for name in ("to_both", "from_new"))
        to_update, to_new = to_both[:, 0], to_both[:, 1]
        from_new[:, 0] = r
        to_reset = from_new[:, 1]
        np.subtract(1, r, out=to_reset)
        to_reset *= passed
        rest = np.subtract(1, z, out=self._room("rest", steps, n, lanes))
        np.subtract(past, new, out=to_update)
        to_update *= z
        to_update *= rest
        np.multiply(new, new, out=to_new)
        np.subtract(1, to_new, out=to_new)
        to_new *= rest
        # Candidate behind the reset gate, reset, update, candidate: the first three are the state's, the last three
        # the input's.
        of = self._room("of", steps, 4, n, lanes)
        turned = _turned(self.state, n, last_first=True).astype(np.float32)
        d, through = np.zeros((n, lanes), np.float32), np.empty((n, lanes), np.float32)
        of_state = of.reshape(steps, 4 * n, lanes)[:, : 3 * n]
        each = zip(fresh, begins, outer, to_both, from_new, of[:, :2], of[:, 2:], of[:, 3], of_state, z, strict=True)
        for some, those, own, both, behind, first, last, candidate, all_three, update in reversed(list(each)):
            d += own
            np.multiply(both, d, out=last)
            np.multiply(behind, candidate, out=first)
            d *= update
            d += np.matmul(turned, all_three, out=through)
            if some:
                d *= ~those
        of = of.reshape(steps, 4 * n, lanes)
        past, of, given = (self._over_steps(*named) for named in (("past", past), ("of", of), ("given", given)))
        of_state = past @ of[: 3 * n].T
        slope["state"] = np.concatenate([of_state[:, 2 * n :], of_state[:, n : 2 * n], of_state[:, :n]], axis=1)
        of_input = _turned(given @ of[n:].T, n)
        slope["inner"], slope["gate"] = of_input[:-1], of_input[-1]
        entered = _turned(self.inner, n).astype(np.float32) @ of[n:]
        width, ids = len(entered), len(self.embed)
        at = np.arange(width)[:, None] * ids + inputs.ravel()
        sums = np.bincount(at.ravel(), entered.ravel(), width * ids).reshape(width, ids)
        slope["embed"] = sums.T.astype(np.float32)
        self._adam(slope, rate)
        return h

    def _adam(self, slope: dict[str, np.ndarray], rate: float) -> None:
        self.steps += 1
        flat = np.concatenate([s.ravel() for s in slope.values()])
        if not self.moments:
            self.moments = [np.zeros_like(flat), np.zeros_like(flat)]
        clip = min(1.0, 1.0 / (float(np.vdot(flat, flat)) ** 0.5 + 1e-9))
        lift = (1 - 0.99**self.steps) ** 0.5
        for at in range(0, len(flat), BLOCK):
            s, first, second = (x[at : at + BLOCK] for x in (flat, *self.moments))
            s *= np.float32(0.1 * clip)
            first *= np.float32(0.9)
            first += s
            s *= s
            second *= np.float32(0.99)
            second += s
            np.sqrt(second, out=s)
            s += np.float32(1e-7 * lift)
            np.divide(first, s, out=s)
            s *= np.float32(rate * lift / (1 - 0.9**self.steps))
        at = 0
        for name, s in slope.items():
            own = getattr(self, name)
            own -= flat[at : at + s.size].reshape(s.shape)
            at += s.size


def _turned(x: np.ndarray, n: int, last_first: bool = False) -> np.ndarray:
    """Columns of update, reset and candidate as reset, update, candidate, or as candidate, reset, update."""
    blocks = [x[:, n : 2 * n], x[:, :n]]
    return np.concatenate([x[:, 2 * n :], *blocks] if last_first else [*blocks, x[:, 2 * n :]], axis=1)


def _cell(x_rz, x_new, u_new, u_rz, rz, r, z, passed, new, h, out) -> None:
    """A step from state ``h`` to ``out``; fills in the gates, reset and update, what passes reset, and the candidate."""
    np.add(x_rz, u_rz, out=rz)
    np.exp(rz, out=rz)
    np.add(rz, ONE, out=rz)
    np.divide(ONE, rz, out=rz)
    np.multiply(r, u_new, out=passed)
    np.add(passed, x_new, out=new)
    np.tanh(new, out=new)
    np.subtract(h, new, out=out)
    np.multiply(out, z, out=out)
    np.add(out, new, out=out)


def _exponentials(x: np.ndarray, steep: bool, apart: np.ndarray | None) -> np.ndarray:
    """The sums of each column's exponentials, which replace ``x``; those not in ``apart`` are 0.

    Only steep ones need the largest taken off. They are taken off in place, which no share notices.
    """
    if steep:
        if apart is not None:
            x[~apart] = -np.inf
        x -= x.max(axis=0)
    np.exp(x, out=x)
    if apart is not None:
        x *= apart
    return np.ones(len(x), np.float32) @ x


def _log_share(x: np.ndarray, place: np.ndarray, steep: bool, apart: np.ndarray | None = None) -> np.ndarray:
    """Of each column the log of one entry's share in the softmax."""
    at = place * x.shape[1] + np.arange(x.shape[1])
    if steep:
        x -= x.max(axis=0) if apart is None else np.where(apart, x, -np.inf).max(axis=0)
        if apart is not None:
            x[~apart] = -np.inf
    own = x.ravel()[at]
    return own - np.log(_exponentials(x, False, apart))


def _softmax(x: np.ndarray, place: np.ndarray, scale: np.float32, steep: bool, apart: np.ndarray | None = None) -> np.ndarray:
    """Of each column less one for its own entry, times ``scale``."""
    at = place * x.shape[1] + np.arange(x.shape[1])
    x *= scale / _exponentials(x, steep, apart)
    x.ravel()[at] -= scale
    return x


def _lanes(texts: list[np.ndarray], lanes: int = LANES) -> tuple[np.ndarray, np.ndarray]:
    """Texts in lanes of about equal length, one after the other: their ids, and whose each is, -1 after the last.

    There are no more lanes than keep them busy while the longest text runs.
    """
    sizes = [len(text) for text in texts]
    lanes = max(1, min(lanes, len(texts), sum(sizes) // max(sizes)))
    filled = [(0, lane) for lane in range(lanes)]
    places = []
    for i in sorted(range(len(texts)), key=lambda i: (-sizes[i], i)):
        at, lane = heapq.heappop(filled)
        places.append((lane, at, i))
        heapq.heappush(filled, (at + sizes[i], lane))
    length = max(at for at, _ in filled)
    rows, owner = np.zeros((lanes, length), np.int32), np.full((lanes, length), -1, np.int32)
    for lane, at, i in places:
        rows[lane, at : at + sizes[i]] = texts[i]
        owner[lane, at : at + sizes[i]] = i
    return rows, owner
