"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

import numpy as np

ASCII = 128
ALPHABET = ASCII + 4  # other letters, digits, spaces, rest
NEVER = -1e4


def encode(text: str) -> np.ndarray:
    """Symbols of a text's characters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    wide = np.flatnonzero(points >= ASCII)
    for i in wide.tolist():
        c = chr(points[i])
        points[i] = ASCII + (0 if c.isalpha() else 1 if c.isdigit() else 2 if c.isspace() else 3)
    return points


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def _logsumexp(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Tags 0 (outside), then 2k+1 (begin) and 2k+2 (inside) of kind k."""

    def __init__(self, kinds: int, embed: int = 12, hidden: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.kinds, self.hidden, self.tags = kinds, hidden, 2 * kinds + 1
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"embed": 0.3 * rng.standard_normal((ALPHABET, embed)).astype(np.float32)}
        for side in "fb":
            self.p[f"wx_{side}"] = draw(embed, 4 * hidden)
            self.p[f"wh_{side}"] = draw(hidden, 4 * hidden)
            bias = np.zeros(4 * hidden, dtype=np.float32)
            bias[hidden : 2 * hidden] = 1
            self.p[f"b_{side}"] = bias
        self.p["out"] = draw(2 * hidden, self.tags)
        self.p["out_b"] = np.zeros(self.tags, dtype=np.float32)
        self.p["trans"] = np.zeros((self.tags, self.tags), dtype=np.float32)
        self.barred = np.zeros((self.tags, self.tags), dtype=np.float32)
        for k in range(kinds):
            for t in range(self.tags):
                if t not in (2 * k + 1, 2 * k + 2):
                    self.barred[t, 2 * k + 2] = NEVER

    def _pass(self, x, side, keep):
        """Hidden states (T, N, H) of one direction."""
        steps, n = x.shape[0], x.shape[1]
        h = np.zeros((n, self.hidden), dtype=np.float32)
        c = np.zeros_like(h)
        wh, hid = self.p[f"wh_{side}"], self.hidden
        pre = x @ self.p[f"wx_{side}"] + self.p[f"b_{side}"]
        out = np.empty((steps, n, hid), dtype=np.float32)
        trail = []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = pre[t] + h @ wh
            gates = _sigmoid(z[:, : 3 * hid])
            i, f, o = gates[:, :hid], gates[:, hid : 2 * hid], gates[:, 2 * hid :]
            g = np.tanh(z[:, 3 * hid :])
            before, h_before = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            if keep:
                trail.append((t, i, f, o, g, before, tc, h_before))
        return out, trail

    def emissions(self, symbols: np.ndarray, keep: bool = False):
        """(T, N, tags) scores of symbol rows (N, T)."""
        x = self.p["embed"][symbols.T]
        hf, tf = self._pass(x, "f", keep)
        hb, tb = self._pass(x, "b", keep)
        both = np.concatenate([hf, hb], axis=2)
        return both @ self.p["out"] + self.p["out_b"], (x, both, tf, tb)

    def decode(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(best tags (N, T), emissions (N, T, tags)) by Viterbi."""
        e, _ = self.emissions(symbols)
        trans = self.p["trans"] + self.barred
        steps, n, _ = e.shape
        score = e[0].copy()
        score[:, 2::2] += NEVER
        back = np.zeros((steps, n, self.tags), dtype=np.int8)
        for t in range(1, steps):
            cand = score[:, :, None] + trans[None]
            back[t] = cand.argmax(axis=1)
            score = cand.max(axis=1) + e[t]
        tags = np.zeros((n, steps), dtype=np.int64)
        tags[:, -1] = score.argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[t][np.arange(n), tags[:, t]]
        return tags, e.transpose(1, 0, 2)

    def _gradients(self, symbols, gold, weight):
        e, (x, both, tf, tb) = self.emissions(symbols, keep=True)
        e = e.astype(np.float64)
        trans = (self.p["trans"] + self.barred).astype(np.float64)
        steps, n, k = e.shape
        start = np.zeros(k)
        start[2::2] = NEVER
        alpha = np.empty_like(e)
        alpha[0] = e[0] + start
        for t in range(1, steps):
            alpha[t] = _logsumexp(alpha[t - 1][:, :, None] + trans[None], 1) + e[t]
        beta = np.zeros_like(e)
        for t in range(steps - 2, -1, -1):
            beta[t] = _logsumexp(trans[None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        log_z = _logsumexp(alpha[-1], 1)
        de = np.exp(alpha + beta - log_z[None, :, None])
        d_trans = np.zeros_like(trans)
        for t in range(1, steps):
            joint = np.exp(alpha[t - 1][:, :, None] + trans[None] + (e[t] + beta[t])[:, None, :] - log_z[:, None, None])
            d_trans += (joint * weight[:, None, None]).sum(axis=0)
        rows = np.arange(n)
        for t in range(steps):
            de[t][rows, gold[:, t]] -= 1
            if t:
                np.add.at(d_trans, (gold[:, t - 1], gold[:, t]), -weight)
        de = (de * weight[None, :, None]).astype(np.float32)
        d_trans[self.barred < 0] = 0
        grads = {"trans": d_trans.astype(np.float32), "out": np.einsum("tnh,tnk->hk", both, de), "out_b": de.sum(axis=(0, 1))}
        d_both = de @ self.p["out"].T
        dx = np.zeros_like(x)
        hid = self.hidden
        for side, trail, dh_all in (("f", tf, d_both[:, :, :hid]), ("b", tb, d_both[:, :, hid:])):
            wx, wh = self.p[f"wx_{side}"], self.p[f"wh_{side}"]
            dz_all = np.zeros((steps, n, 4 * hid), dtype=np.float32)
            d_wh = np.zeros_like(wh)
            dh, dc = np.zeros((n, hid), dtype=np.float32), np.zeros((n, hid), dtype=np.float32)
            for t, i, f, o, g, before, tc, h_before in reversed(trail):
                dh = dh + dh_all[t]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                dz_all[t] = dz
                d_wh += h_before.T @ dz
                dh = dz @ wh.T
                dc = dc * f
            grads[f"wh_{side}"] = d_wh
            grads[f"wx_{side}"] = np.einsum("tne,tnz->ez", x, dz_all)
            grads[f"b_{side}"] = dz_all.sum(axis=(0, 1))
            dx += dz_all @ wx.T
        d_embed = np.zeros_like(self.p["embed"])
        np.add.at(d_embed, symbols.T.ravel(), dx.reshape(-1, dx.shape[2]))
        grads["embed"] = d_embed
        path = sum(e[t][rows, gold[:, t]] for t in range(steps)) + sum(trans[gold[:, t - 1], gold[:, t]] for t in range(1, steps))
        return grads, float(((log_z - path) * weight).sum())

    def train(self, symbols: np.ndarray, gold: np.ndarray, epochs: int = 14, batch: int = 64, rate: float = 0.02, seed: int = 11) -> list[float]:
        """Adam over shuffled batches; the mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses, t = [], 0
        for epoch in range(epochs):
            total = 0.0
            order = rng.permutation(len(symbols))
            for at in range(0, len(order), batch):
                own = order[at : at + batch]
                grads, loss = self._gradients(symbols[own], gold[own], np.full(len(own), 1 / len(own), dtype=np.float32))
                total += loss * len(own)
                t += 1
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                clip = min(1.0, 5.0 / (norm + 1e-9))
                now = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
                for k, g in grads.items():
                    g = g * clip
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v2[k] = 0.999 * v2[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - now * (m[k] / (1 - 0.9**t)) / (np.sqrt(v2[k] / (1 - 0.999**t)) + 1e-8)
            losses.append(total / max(1, len(symbols)))
        return losses
