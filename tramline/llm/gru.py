"""A gated recurrent language model in numpy with a class-factored softmax."""

from __future__ import annotations

import ctypes

import numpy as np


def keep_heap() -> None:
    """Lets this process keep what a step of the network frees (at most 128 MB) for the next, where the C library can.

    Else the arrays of each step are given back and their pages faulted in again, a quarter of all time.
    """
    try:
        mallopt = ctypes.CDLL(None).mallopt
    except (AttributeError, OSError, TypeError):
        return
    for what, size in ((-3, 32 << 20), (-1, 128 << 20)):  # the least size that is mapped alone; what is kept free
        mallopt(what, size)


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= np.float32(0.5)
    np.tanh(x, out=x)
    x += np.float32(1)
    x *= np.float32(0.5)
    return x


def tame(weights: np.ndarray, bias: np.ndarray) -> bool:
    """Whether no softmax of a state times these weights can overflow or vanish: each number of a state is within -1 and 1."""
    reach = np.abs(weights).sum(-2)
    return bool((bias + reach).max() < 60 and (bias - reach).max(-1).min() > -60)


def softmax(x: np.ndarray, tame: bool) -> np.ndarray:
    """Of each row, in place. The greatest need not be taken off first where the numbers are tame."""
    if not tame:
        x -= x.max(1, keepdims=True)
    np.exp(x, out=x)
    x /= x @ np.ones((x.shape[1], 1), np.float32)
    return x


def picked(logit: np.ndarray, which: np.ndarray, tame: bool) -> np.ndarray:
    """Natural log of the softmax of one column of each row; the rows are overwritten."""
    if not tame:
        logit -= logit.max(1, keepdims=True)
    out = logit[np.arange(len(which)), which]
    np.exp(logit, out=logit)
    out -= np.log(logit @ np.ones(logit.shape[1], np.float32))
    return out


def pieces(*vectors: np.ndarray, size: int = 1 << 15):
    """The same pieces of each vector, small enough for a processor's own cache."""
    for at in range(0, len(vectors[0]), size):
        yield [v[at : at + size] for v in vectors]


def order_of(small: np.ndarray) -> np.ndarray:
    """The order of small numbers; equal ones stay in theirs. Those of 16 bits are sorted by their digits."""
    return np.argsort(small.astype(np.uint16) if small.size and small.max() < 1 << 16 else small, kind="stable")


def lanes_of(sizes: np.ndarray, lanes: int) -> list[list[int]]:
    """Documents dealt to lanes, longest first to the emptiest, so that lanes end at about the same step."""
    import heapq

    heap = [(0, k) for k in range(min(lanes, max(1, len(sizes))))]
    out: list[list[int]] = [[] for _ in heap]
    for d in np.argsort(-sizes, kind="stable").tolist():
        n, k = heapq.heappop(heap)
        out[k].append(d)
        heapq.heappush(heap, (n + int(sizes[d]), k))
    return sorted((x for x in out if x), key=lambda x: -sum(int(sizes[d]) for d in x))


class Model:
    """P(token) = P(class | state) * P(word | class, state); a class of rare words has its words' shares elsewhere.

    Symbols 0..words-1 are frequent words, `per` to a class in order of frequency, then come the rare classes. The
    state starts at zero with each document and is carried from window to window through the whole of it.
    """

    def __init__(self, counts: np.ndarray, rare: np.ndarray, per: int, hidden: int, seed: int):
        rng = np.random.default_rng(seed)
        words, self.per, self.hidden = len(counts), per, hidden
        self.words, self.rare = words, len(rare)
        self.groups = -(-words // per)
        small = lambda *s: (rng.standard_normal(s) * 0.1).astype(np.float32)
        mass = np.concatenate(([counts[k * per : (k + 1) * per].sum() for k in range(self.groups)], rare)) + 1.0
        self.p = {
            "E": small(words + self.rare, 3 * hidden),
            "U": (np.linalg.qr(rng.standard_normal((3 * hidden, hidden)))[0].T * 0.8).astype(np.float32),
            "C": small(hidden, self.groups + self.rare),
            "c": np.log(mass / mass.sum()).astype(np.float32),
            "W": small(self.groups, hidden, per),
            "w": np.full((self.groups, per), -40, np.float32),
        }
        self.p["E"][:, :hidden] += 1  # keep most of the state at first
        for k in range(self.groups):
            c = counts[k * per : (k + 1) * per] + 1.0
            self.p["w"][k, : len(c)] = np.log(c / c.sum())
        self.class_of = np.concatenate((np.arange(words) // per, self.groups + np.arange(self.rare))).astype(np.int64)

    def flat(self) -> np.ndarray:
        """All parameters as one vector."""
        return np.concatenate([v.reshape(-1) for v in self.p.values()])

    def load(self, flat: np.ndarray) -> Model:
        at = 0
        for k, v in self.p.items():
            self.p[k] = flat[at : at + v.size].astype(np.float32).reshape(v.shape)
            at += v.size
        return self

    def window(self, x: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: bool):
        """States after each step of a window, steps x lanes; with `keep`, also what the way back needs."""
        E, U, H = self.p["E"], self.p["U"], self.hidden
        out, saved, begins = np.empty((*x.shape, H), np.float32), [], fresh.any(1).tolist()
        (ez, er, en), (uz, ur, uc) = ([np.ascontiguousarray(v[:, k * H : (k + 1) * H]) for k in range(3)] for v in (E, U))
        for t in range(len(x)):
            if begins[t]:
                h = np.where(fresh[t][:, None], np.float32(0), h)
            z, r, n, un = h @ uz, h @ ur, en[x[t]], h @ uc
            z += ez[x[t]]
            r += er[x[t]]
            sigmoid(z)
            n += sigmoid(r) * un
            np.tanh(n, out=n)
            if keep:
                saved.append((h, un, z, r, n))
            new = np.subtract(h, n, out=out[t])
            new *= z
            new += n
            h = new
        return out, h, saved

    def log_probabilities(self, states: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each symbol given the state before it."""
        cls = self.class_of[y]
        logit = states @ self.p["C"]
        logit += self.p["c"]
        out = picked(logit, cls, tame(self.p["C"], self.p["c"]))
        by, parts = self._by_class(cls)
        own, word, a = states[by], cls[by], np.empty((len(by), self.per), np.float32)
        for k, at in parts:
            np.matmul(own[at], self.p["W"][k], out=a[at])
        a += self.p["w"][word]
        out[by] += picked(a, y[by] - word * self.per, tame(self.p["W"], self.p["w"]))
        return out

    def _by_class(self, cls: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
        """The places of frequent words, class by class, and of each class that is there its part of them."""
        by = order_of(cls)
        edges = np.searchsorted(cls[by], np.arange(self.groups + 1)).tolist()
        return by[: edges[-1]], [(k, slice(edges[k], edges[k + 1])) for k in range(self.groups) if edges[k] < edges[k + 1]]

    def score(self, sequences: np.ndarray, sizes: np.ndarray, start: int, lanes: int = 256, steps: int = 64) -> np.ndarray:
        """Natural log-likelihood of each whole document, from its symbols; they stand one document after the other."""
        total = np.zeros(len(sizes))
        if not len(sequences):
            return total
        keep_heap()
        first = np.concatenate(([0], np.cumsum(sizes)))
        plan = lanes_of(sizes, lanes)
        length = np.array([sum(int(sizes[d]) for d in lane) for lane in plan])
        n = int(length[0])
        y, fresh = np.zeros((n, len(plan)), np.int32), np.zeros((n, len(plan)), bool)
        for k, lane in enumerate(plan):
            at = 0
            for d in lane:
                m = int(sizes[d])
                y[at : at + m, k] = sequences[first[d] : first[d + 1]]
                fresh[at : at + 1, k] = m > 0
                at += m
        x = np.empty_like(y)
        x[0], x[1:] = start, y[:-1]
        x[fresh] = start
        got = np.zeros((n, len(plan)), np.float32)
        h = np.zeros((len(plan), self.hidden), np.float32)
        for at in range(0, n, steps):
            on = int(np.searchsorted(-length, -at, "left"))  # lanes that go on past here
            out, h, _ = self.window(x[at : at + steps, :on], fresh[at : at + steps, :on], h[:on], False)
            got[at : at + steps, :on] = self.log_probabilities(out.reshape(-1, self.hidden), y[at : at + steps, :on].reshape(-1)).reshape(-1, on)
        for k, lane in enumerate(plan):
            at = 0
            for d in lane:
                total[d] = got[at : at + int(sizes[d]), k].sum(dtype=np.float64)
                at += int(sizes[d])
        return total

    def train(self, sequences: np.ndarray, sizes: np.ndarray, start: int, epochs: int, lanes: int = 96, steps: int = 24, rate: float = 8e-3, seed: int = 0) -> None:
        """Truncated backpropagation through windows of `steps` over every symbol, Adam with a falling rate.

        The symbols are dealt to lanes of one length; what the last ones have too little is filled and teaches nothing.
        """
        if not len(sequences):
            return
        keep_heap()
        lanes = int(np.clip(len(sequences) // (8 * steps), 4, lanes))  # a few steps at least from a small lesson
        rng = np.random.default_rng(seed)
        first = np.concatenate(([0], np.cumsum(sizes)))
        use = min(lanes, len(sequences))
        n = -(-len(sequences) // use)
        flat = self.flat()
        self.p = self._views(flat)
        mean, square, some = (np.zeros_like(flat) for _ in range(3))
        count, turn = epochs * -(-n // steps), 0
        for _ in range(epochs):
            order = rng.permutation(len(sizes))
            seq = np.full(use * n, start, np.int32)
            seq[: len(sequences)] = np.concatenate([sequences[first[d] : first[d + 1]] for d in order])
            new, live = np.zeros(use * n, bool), np.arange(use * n) < len(sequences)
            new[np.concatenate(([0], np.cumsum(sizes[order])))[:-1][sizes[order] > 0]] = True
            y, fresh, live = (a.reshape(use, n).T for a in (seq, new, live))
            x = np.vstack((np.full((1, use), start, np.int32), y[:-1]))
            x[fresh] = start
            h = np.zeros((use, self.hidden), np.float32)
            for at in range(0, n, steps):
                s = slice(at, at + steps)
                g, h = self._gradients(x[s], fresh[s], y[s], h, live[s])
                turn += 1
                lr = rate * max(0.05, 1 - turn / (count + 1))
                up, down = np.float32(lr / (1 - 0.9**turn)), np.float32(1 / np.sqrt(1 - 0.99**turn))
                for p, g_, m, v in pieces(flat, g, mean, square):
                    np.clip(g_, -0.05, 0.05, out=g_)
                    step = some[: len(p)]
                    m *= np.float32(0.9)
                    m += np.multiply(g_, np.float32(0.1), out=step)
                    g_ *= g_
                    g_ *= np.float32(0.01)
                    v *= np.float32(0.99)
                    v += g_
                    np.sqrt(v, out=step)
                    step *= down
                    step += np.float32(1e-6)
                    np.divide(m, step, out=step)
                    step *= up
                    p -= step

    def _views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """The parts of a vector that stand for the parameters, which can be changed through it as a whole."""
        out, at = {}, 0
        for k, v in self.p.items():
            out[k] = flat[at : at + v.size].reshape(v.shape)
            at += v.size
        return out

    def _gradients(self, x, fresh, y, h0, live):
        """Of the mean loss of a window's live symbols by all parameters, as one vector; and the last states."""
        p, H = self.p, self.hidden
        out, last, saved = self.window(x, fresh, h0, True)
        flat, t_y, use = out.reshape(-1, H), y.reshape(-1), live.reshape(-1)
        rows = len(t_y)
        m = np.float32(max(1, np.count_nonzero(use)))
        whole = np.zeros(sum(v.size for v in p.values()), np.float32)
        g = self._views(whole)
        d = flat @ p["C"]
        d += p["c"]
        softmax(d, tame(p["C"], p["c"]))
        cls = self.class_of[t_y]
        d[np.arange(rows), cls] -= 1
        d /= m
        if not use.all():
            d[~use] = 0
            cls = np.where(use, cls, len(p["c"]))
        np.matmul(flat.T, d, out=g["C"])
        np.matmul(np.ones(rows, np.float32), d, out=g["c"])
        back = d @ p["C"].T
        by, parts = self._by_class(cls)
        own, word, near = flat[by], cls[by], np.empty((len(by), H), np.float32)
        a = np.empty((len(by), self.per), np.float32)
        for k, at in parts:
            np.matmul(own[at], p["W"][k], out=a[at])
        a += p["w"][word]
        softmax(a, tame(p["W"], p["w"]))
        a[np.arange(len(by)), t_y[by] - word * self.per] -= 1
        a /= m
        for k, at in parts:
            np.matmul(own[at].T, a[at], out=g["W"][k])
            np.matmul(a[at], p["W"][k].T, out=near[at])
        if parts:
            g["w"][[k for k, _ in parts]] = np.add.reduceat(a, [at.start for _, at in parts])
        back[by] += near
        back = back.reshape(out.shape)
        dh = np.zeros_like(h0)
        dz, dr, dn, nr, held = (np.empty((*x.shape, H), np.float32) for _ in range(5))
        begins, (uz, ur, uc) = fresh.any(1).tolist(), (np.ascontiguousarray(p["U"][:, k * H : (k + 1) * H].T) for k in range(3))
        for t in range(len(x) - 1, -1, -1):
            h, un, z, r, n = saved[t]
            held[t] = h
            dh += back[t]
            keep = dh * z
            a = np.subtract(dh, keep, out=dn[t])
            a *= 1 - n * n
            c = np.multiply(a, r, out=nr[t])
            a = np.multiply(c, un, out=dr[t])
            a *= 1 - r
            b = np.subtract(h, n, out=dz[t])
            b *= keep
            b *= 1 - z
            dh = b @ uz
            dh += a @ ur
            dh += c @ uc
            dh += keep
            if begins[t]:
                dh[fresh[t]] = 0
        wide = lambda *v: np.concatenate(v, 2).reshape(rows, -1)
        np.matmul(held.reshape(rows, H).T, wide(dz, dr, nr), out=g["U"])
        into = wide(dz, dr, dn)
        flat_x = x.reshape(-1)
        order = order_of(flat_x)
        flat_x = flat_x[order]
        first = np.flatnonzero(np.concatenate(([True], flat_x[1:] != flat_x[:-1])))
        seen = flat_x[first]
        g["E"][seen] = np.add.reduceat(into[order], first)
        return whole, last
