"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation, state across windows.

A unit is an output of the model. Units stand in classes of equal size: P(unit) = P(class | state) * P(unit | class,
state). Inputs are the unit before, through a table of gate inputs. Streams of documents run side by side in lanes; a
lane's state is carried from window to window and set to zero where a document begins.
"""

from __future__ import annotations

import heapq

import numpy as np

WINDOW = 32


def normalise(x: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """x: logits in rows; becomes their exponentials, and the logarithms of the sums are returned, of what they are above
    each row's greatest if `bound`, the greatest size a logit can have, says that they might overflow; and the sums."""
    top = x.max(-1, keepdims=True) if bound > 60 else None
    if top is not None:
        x -= top
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    out = np.log(total)
    return out if top is None else out + top[:, 0], total


class Gru:
    def __init__(self, classes: int = 32, in_class: int = 32, hidden: int = 32):
        self.c, self.s, self.h = classes, in_class, hidden
        rng = np.random.default_rng(1)
        wide = 3 * hidden
        self.p = {
            "in": rng.normal(0, 0.1, (classes * in_class, wide)), "rec": rng.normal(0, hidden**-0.5, (hidden, wide)),
            "class": np.zeros((hidden, classes)), "class_bias": np.zeros(classes), "word": np.zeros((classes, hidden, in_class)), "word_bias": np.zeros((classes, in_class)),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def set_frequencies(self, counts: np.ndarray) -> None:
        """Biases such that the model without any training gives units their share of the counts (one added to each)."""
        f = (counts + 1.0).reshape(self.c, self.s)
        self.p["class_bias"] = np.log(f.sum(1) / f.sum()).astype(np.float32)
        self.p["word_bias"] = np.log(f / f.sum(1, keepdims=True)).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def load(self, flat: np.ndarray) -> Gru:
        at = 0
        for k, v in self.p.items():
            self.p[k] = flat[at : at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size
        return self

    def _bound(self, weights: np.ndarray, bias: np.ndarray) -> float:
        """States lie between -1 and 1."""
        return float((np.abs(weights).sum(0) + np.abs(bias)).max())

    def states(self, h: np.ndarray, x: np.ndarray, keep: np.ndarray, held: dict | None = None) -> np.ndarray:
        """x, keep: (steps, lanes); keep is 0 where a document begins. States after each step; held gets what the gradients
        need: the state before each step, the candidate's part of it, both gates and the candidate. Inside, lanes come last
        (held: steps, units, lanes), so that the parts of gates and states are whole slices."""
        n, half = self.h, np.repeat(np.array([0.5, 1], h.dtype), [2 * self.h, self.h])  # of the gates: the logistic function, by way of tanh
        rec, table = np.ascontiguousarray((self.p["rec"] * half).T), np.ascontiguousarray((self.p["in"] * half).T)
        (steps, lanes), h = x.shape, np.ascontiguousarray(h.T)
        out = np.empty((steps, n, lanes), h.dtype)
        if held is not None:
            held |= {"before": np.empty_like(out), "an": np.empty_like(out), "zr": np.empty((steps, 2 * n, lanes), h.dtype), "m": np.empty_like(out)}
        for t in range(steps):
            g = table.take(x[t], axis=1)
            h = h * keep[t]
            a = rec @ h
            zr, m, an = g[: 2 * n], g[2 * n :], a[2 * n :]
            zr += a[: 2 * n]
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            if held is not None:
                held["before"][t], held["an"][t], held["zr"][t] = h, an, zr
            an *= zr[n:]
            m += an
            np.tanh(m, out=m)
            if held is not None:
                held["m"][t] = m
            h = np.subtract(h, m, out=out[t])
            h *= zr[:n]
            h += m
        return out.transpose(0, 2, 1)

    def log_probs(self, h: np.ndarray, y: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """h (n, hidden), y (n): natural logarithms of the units' probabilities; with grads, also the gradient of their
        negated sum by h, and those by the parameters put into grads."""
        order = np.argsort((y // self.s).astype(np.uint16), kind="stable")  # by class, so that each is one slice
        cls, word = np.divmod(y[order], self.s)
        at, h = np.arange(len(y)), h[order]
        cuts = np.searchsorted(cls, np.arange(self.c + 1))
        logits = h @ self.p["class"]
        logits += self.p["class_bias"]
        lp, dh = logits[at, cls], None
        log_total, total = normalise(logits, self._bound(self.p["class"], self.p["class_bias"]))
        lp -= log_total
        if grads is not None:
            logits /= total[:, None]
            logits[at, cls] -= 1
            grads["class"], grads["class_bias"], dh = h.T @ logits, logits.sum(0), logits @ self.p["class"].T
            grads["word"], grads["word_bias"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["word_bias"])
        for c in np.flatnonzero(np.diff(cuts)):
            own = slice(cuts[c], cuts[c + 1])
            of, hc = word[own], h[own]
            logits = hc @ self.p["word"][c]
            logits += self.p["word_bias"][c]
            lp[own] += logits[at[: len(of)], of]
            log_total, total = normalise(logits, self._bound(self.p["word"][c], self.p["word_bias"][c]))
            lp[own] -= log_total
            if grads is not None:
                logits /= total[:, None]
                logits[at[: len(of)], of] -= 1
                grads["word"][c], grads["word_bias"][c] = hc.T @ logits, logits.sum(0)
                dh[own] += logits @ self.p["word"][c].T
        out = np.empty_like(lp)
        out[order] = lp
        if grads is not None:
            dh[order] = dh.copy()
        return out, dh

    def gradients(self, h: np.ndarray, x: np.ndarray, y: np.ndarray, keep: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, dict, float]:
        """One window of truncated backpropagation. real: which places hold a token. Returns the last state, gradients
        of the mean loss, and that loss."""
        held, grads, n = {}, {}, self.h
        hs = self.states(h, x, keep, held)
        dhs = np.zeros(hs.shape, hs.dtype)
        lp, dhs[real] = self.log_probs(hs[real], y[real], grads)
        dhs = np.ascontiguousarray(dhs.transpose(0, 2, 1))
        before, an, m, z, r = held["before"], held["an"], held["m"], held["zr"][:, :n], held["zr"][:, n:]
        by_m = (1 - z) * (1 - m * m)
        by_z = (before - m) * z * (1 - z)
        by_r = an * r * (1 - r)
        back, carry = self.p["rec"], np.zeros((n, x.shape[1]), h.dtype)
        d_in, d_a = np.empty((len(x), 3 * n, x.shape[1]), h.dtype), np.empty((len(x), 3 * n, x.shape[1]), h.dtype)
        for t in range(len(x) - 1, -1, -1):
            dh = dhs[t]
            dh += carry
            da, di = d_a[t], d_in[t]
            dm = np.multiply(dh, by_m[t], out=di[2 * n :])
            np.multiply(dh, by_z[t], out=da[:n])
            np.multiply(dm, by_r[t], out=da[n : 2 * n])
            np.multiply(dm, r[t], out=da[2 * n :])
            di[: 2 * n] = da[: 2 * n]
            carry = back @ da
            carry += dh * z[t]
            carry *= keep[t]
        d_in, d_a, before = (v.transpose(0, 2, 1).reshape(-1, v.shape[1]) for v in (d_in, d_a, before))
        grads["in"], grads["rec"] = np.zeros_like(self.p["in"]), before.T @ d_a
        order = np.argsort(x.ravel().astype(np.uint16), kind="stable")
        used, begin = np.unique(x.ravel()[order], return_index=True)
        grads["in"][used] = np.add.reduceat(d_in[order], begin)
        total = max(1, int(real.sum()))
        return hs[-1], {k: v / total for k, v in grads.items()}, -float(lp.sum()) / total


class Lanes:
    """Pieces of text side by side: pieces are dealt to at most so many lanes, the longest first to the shortest lane, and
    stand one behind the other there. Windows are cut out as they are asked for, so that memory follows the tokens and
    not the longest lane."""

    def __init__(self, docs: list[np.ndarray], first: int, most: int, piece: int = 0):
        """piece: documents are cut into pieces of so many tokens (0: they are not cut); every piece begins anew, but knows
        the unit before it."""
        cut = [(d, i, min(i + (piece or len(u)), len(u))) for d, u in enumerate(docs) for i in range(0, len(u), piece or len(u))]
        sizes = np.array([b - a for _, a, b in cut], np.int64)
        heap: list[tuple[int, int]] = [(0, i) for i in range(min(most, len(cut)))]
        dealt: list[list[int]] = [[] for _ in heap]
        for c in np.argsort(-sizes, kind="stable").tolist():
            load, i = heapq.heappop(heap)
            dealt[i].append(c)
            heapq.heappush(heap, (load + int(sizes[c]), i))
        dealt.sort(key=lambda own: -sum(sizes[c] for c in own))
        order = [cut[c] for own in dealt for c in own]
        self.y = np.concatenate([docs[d][a:b] for d, a, b in order]).astype(np.int32)
        self.doc = np.repeat([d for d, _, _ in order], [b - a for _, a, b in order]).astype(np.int32)
        begins = np.cumsum([0, *(b - a for _, a, b in order)])[:-1]
        self.x = np.concatenate([[first], self.y[:-1]]).astype(np.int32)
        self.x[begins] = [docs[d][a - 1] if a else first for d, a, _ in order]
        self.keep = np.ones(len(self.y), np.float32)
        self.keep[begins] = 0
        self.lengths = np.array([sum(sizes[c] for c in own) for own in dealt], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def windows(self, cells: int = 0):
        """(inputs, targets, keep, document, which are real), each (steps, lanes), of the lanes that still run. cells: windows
        are longer where few lanes are left, so that they have about so many places."""
        t, end = 0, int(self.lengths.max(initial=0))
        while t < end:
            k = int((self.lengths > t).sum())
            steps = max(WINDOW, min(cells // k, end - t))
            at = np.arange(t, t + steps)[:, None]
            real = at < self.lengths[None, :k]
            at = np.where(real, at + self.starts[None, :k], 0)
            yield self.x[at], self.y[at], self.keep[at], self.doc[at], real
            t += steps


def score(model: Gru, docs: list[np.ndarray], end: int, most: int = 512) -> np.ndarray:
    """The natural log-likelihood of each whole document. docs: units, the end unit last; none of them is empty."""
    total = np.zeros(len(docs))
    if not docs:
        return total
    h = np.zeros((most, model.h), np.float32)
    for x, y, keep, doc, real in Lanes(docs, end, most).windows(WINDOW * most // 2):
        hs = model.states(h[: x.shape[1]], x, keep)
        lp, _ = model.log_probs(hs[real], y[real])
        total += np.bincount(doc[real], weights=lp, minlength=len(docs))
        h = hs[-1]
    return total


def fit(model: Gru, docs: list[np.ndarray], end: int, most: int = 256, rate: float = 0.016, steps: int = 96, piece: int = 512) -> int:
    """One pass over the documents with Adam; returns the tokens seen. As many lanes as give about so many steps."""
    if not docs:
        return 0
    tokens = sum(map(len, docs))
    lanes = Lanes(docs, end, max(1, min(most, tokens // (WINDOW * steps))), piece)
    h = np.zeros((len(lanes.lengths), model.h), np.float32)
    first, second, step = {k: np.zeros_like(v) for k, v in model.p.items()}, {k: np.zeros_like(v) for k, v in model.p.items()}, 0
    for x, y, keep, _, real in lanes.windows():
        h, grads, _ = model.gradients(h[: x.shape[1]], x, y, keep, real)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        step += 1
        for name, g in grads.items():
            g *= min(1.0, 2.0 / (norm + 1e-9))
            first[name] += 0.1 * (g - first[name])
            second[name] += 0.01 * (g * g - second[name])
            model.p[name] -= (rate / (1 - 0.9**step) * first[name] / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return tokens
