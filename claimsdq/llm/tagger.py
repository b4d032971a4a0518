"""A character-level bidirectional LSTM with CRF transitions in numpy.

``fit`` trains it from labelled windows by Adam on the exact CRF likelihood;
``decode`` gives each window's best tag sequence and the tags' score margins.
Windows are rows of character classes, all of one width.
"""

from __future__ import annotations

import numpy as np

#: Classes: printable ASCII by itself, then tab and line feed, other control
#: characters, everything beyond ASCII, and padding.
N_CLASSES = 95 + 5
PAD = N_CLASSES - 1


def char_classes(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    out = np.where(code < 32, 97, code - 32)
    out[code >= 127] = 98
    out[code == 9] = 95
    out[code == 10] = 96
    return out


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _lse(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    def __init__(self, n_tags: int, embed: int = 10, hidden: int = 16, seed: int = 0):
        r = np.random.default_rng(seed)
        self.hidden, self.n_tags = hidden, n_tags
        p = {"embed": r.normal(0, 0.3, (N_CLASSES, embed))}
        for d in "fb":
            p["x" + d] = r.normal(0, embed ** -0.5, (embed, 4 * hidden))
            p["h" + d] = r.normal(0, hidden ** -0.5, (hidden, 4 * hidden))
            p["b" + d] = np.zeros(4 * hidden)
            p["b" + d][hidden:2 * hidden] = 1.0      # remember at first
        p["out"] = r.normal(0, (2 * hidden) ** -0.5, (2 * hidden, n_tags))
        p["bias"] = np.zeros(n_tags)
        p["move"] = np.zeros((n_tags, n_tags))
        p["start"] = np.zeros(n_tags)
        self.p = {k: v.astype(np.float32) for k, v in p.items()}

    # ------------------------------------------------------------ the network

    def _pass(self, x, d):
        n, t, _ = x.shape
        k, p = self.hidden, self.p
        gates_x = x @ p["x" + d] + p["b" + d]
        h, c = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32)
        hs, keep = np.empty((n, t, k), np.float32), []
        for s in (range(t) if d == "f" else range(t - 1, -1, -1)):
            a = gates_x[:, s] + h @ p["h" + d]
            ifo, g = _sigmoid(a[:, :3 * k]), np.tanh(a[:, 3 * k:])
            i, f, o = ifo[:, :k], ifo[:, k:2 * k], ifo[:, 2 * k:]
            c2 = f * c + i * g
            tc = np.tanh(c2)
            keep.append((s, h, c, i, f, o, g, tc))
            h, c = o * tc, c2
            hs[:, s] = h
        return hs, keep

    def _back(self, x, keep, dhs, d, grad):
        k, p = self.hidden, self.p
        wh, wx = p["h" + d], p["x" + d]
        da_all = np.empty((*x.shape[:2], 4 * k), np.float32)
        dh, dc = np.zeros((len(x), k), np.float32), np.zeros((len(x), k), np.float32)
        for s, h0, c0, i, f, o, g, tc in reversed(keep):
            dh = dh + dhs[:, s]
            dc = dc + dh * o * (1 - tc * tc)
            da = np.concatenate([dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o),
                                 dc * i * (1 - g * g)], axis=1)
            grad["h" + d] += h0.T @ da
            da_all[:, s] = da
            dh, dc = da @ wh.T, dc * f
        grad["x" + d] += np.einsum("nte,ntk->ek", x, da_all)
        grad["b" + d] += da_all.sum((0, 1))
        return da_all @ wx.T

    def emissions(self, ids):
        x = self.p["embed"][ids]
        hf, kf = self._pass(x, "f")
        hb, kb = self._pass(x, "b")
        h = np.concatenate([hf, hb], axis=2)
        return h @ self.p["out"] + self.p["bias"], (x, h, kf, kb)

    # -------------------------------------------------------------- the chain

    def _chain(self, e):
        """Forward and backward log sums of all tag paths."""
        n, t, _ = e.shape
        move = self.p["move"]
        fwd, bwd = np.empty_like(e), np.zeros_like(e)
        fwd[:, 0] = e[:, 0] + self.p["start"]
        for s in range(1, t):
            fwd[:, s] = _lse(fwd[:, s - 1][:, :, None] + move, 1) + e[:, s]
        for s in range(t - 2, -1, -1):
            bwd[:, s] = _lse(move + (e[:, s + 1] + bwd[:, s + 1])[:, None, :], 2)
        return fwd, bwd, _lse(fwd[:, -1], 1)

    def step(self, ids, tags):
        """Mean negative log likelihood and its gradients."""
        e, (x, h, kf, kb) = self.emissions(ids)
        fwd, bwd, z = self._chain(e)
        n, t = ids.shape
        rows = np.arange(n)[:, None]
        gold = e[rows, np.arange(t), tags].sum(1) + self.p["start"][tags[:, 0]] \
            + self.p["move"][tags[:, :-1], tags[:, 1:]].sum(1)
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        de = np.exp(fwd + bwd - z[:, None, None])
        grad["start"] += de[:, 0].sum(0)
        pair = np.exp(fwd[:, :-1, :, None] + self.p["move"] + (e[:, 1:] + bwd[:, 1:])[:, :, None, :]
                      - z[:, None, None, None])
        grad["move"] += pair.sum((0, 1))
        np.add.at(grad["move"], (tags[:, :-1], tags[:, 1:]), -1)
        np.add.at(grad["start"], tags[:, 0], -1)
        np.subtract.at(de, (rows, np.arange(t), tags), 1)
        de = (de / n).astype(np.float32)
        grad["move"] /= n
        grad["start"] /= n
        grad["out"] += np.einsum("nth,ntk->hk", h, de)
        grad["bias"] += de.sum((0, 1))
        dh = de @ self.p["out"].T
        k = self.hidden
        dx = self._back(x, kf, dh[:, :, :k], "f", grad) + self._back(x, kb, dh[:, :, k:], "b", grad)
        np.add.at(grad["embed"], ids, dx)
        return float((z - gold).mean()), grad

    def fit(self, ids, tags, epochs: int, batch: int = 64, rate: float = 0.01, seed: int = 0):
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        n, losses = 0, []
        for _ in range(epochs):
            total = 0.0
            order = r.permutation(len(ids))
            for at in range(0, len(order), batch):
                some = order[at:at + batch]
                loss, grad = self.step(ids[some], tags[some])
                total += loss * len(some)
                size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                scale, n = min(1.0, 5.0 / max(size, 1e-9)), n + 1
                for k, g in grad.items():
                    g = g * scale
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** n)) / (np.sqrt(v[k] / (1 - 0.999 ** n)) + 1e-8)
            losses.append(total / max(1, len(ids)))
        return losses

    def _hidden(self, ids, d):
        """The hidden states of one direction, (time, hidden, window): as
        ``_pass``, without what training keeps.  The inputs' share of the gates
        is looked up by class, and one tanh serves all gates."""
        k, p = self.hidden, self.p
        half = np.repeat(np.array([0.5, 1.0], p["b" + d].dtype), [3 * k, k])     # sigmoid(x) = (1 + tanh(x / 2)) / 2
        table = np.ascontiguousarray(((p["embed"] @ p["x" + d] + p["b" + d]) * half).T)
        wh = np.ascontiguousarray((p["h" + d] * half).T)
        n, t = ids.shape
        h, c = np.zeros((k, n), table.dtype), np.zeros((k, n), table.dtype)
        hs = np.empty((t, k, n), table.dtype)
        columns = np.ascontiguousarray(ids.T)
        for s in (range(t) if d == "f" else range(t - 1, -1, -1)):
            a = wh @ h
            a += table.take(columns[s], axis=1)
            np.tanh(a, out=a)
            gate = a[:3 * k]
            gate += 1
            gate *= 0.5
            c = gate[k:2 * k] * c + gate[:k] * a[3 * k:]
            h = gate[2 * k:] * np.tanh(c)
            hs[s] = h
        return hs

    def decode(self, ids):
        """Best tags of each window, and each tag's margin over tag 0."""
        p, k = self.p, self.hidden
        out = np.ascontiguousarray(p["out"].T)
        e = out[:, :k] @ self._hidden(ids, "f")
        e += out[:, k:] @ self._hidden(ids, "b")
        e += p["bias"][:, None]                  # (time, tag, window)
        t, _, n = e.shape
        scores = np.empty_like(e)
        scores[0] = e[0] + p["start"][:, None]
        into = [np.ascontiguousarray(p["move"][:, j])[:, None] for j in range(self.n_tags)]
        for s in range(1, t):
            for j, move in enumerate(into):
                (scores[s - 1] + move).max(0, out=scores[s, j])
            scores[s] += e[s]
        tags = np.empty((n, t), np.int64)
        tags[:, -1] = scores[-1].argmax(0)
        for s in range(t - 1, 0, -1):
            tags[:, s - 1] = (scores[s - 1] + p["move"][:, tags[:, s]]).argmax(0)
        e = e.transpose(2, 0, 1)
        margin = np.take_along_axis(e, tags[:, :, None], 2)[:, :, 0] - e[:, :, 0]
        return tags, margin
