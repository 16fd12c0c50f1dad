"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Tags are O and, for each kind, B (first character) and I (further ones); the
transitions into I from anything but its own kind are closed.  Training
maximises the CRF likelihood of labelled spans by Adam.
"""

from __future__ import annotations

import numpy as np

from offerlake.llm.pii_rules import KINDS, Span

TAGS = 1 + 2 * len(KINDS)
CODES = 132
SIZES = {"embed": 12, "hidden": 20}
CLOSED = -1e4


def codes(text: str) -> np.ndarray:
    """Characters as small numbers: ASCII as it is, the rest by class; 0 is padding."""
    a = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    for i in np.flatnonzero(a > 127):
        c = chr(a[i])
        a[i] = 128 if c.isalpha() else 129 if c.isdigit() else 130 if c.isspace() else 131
    return a


def tags(length: int, spans: list[Span]) -> np.ndarray:
    y = np.zeros(length, np.int64)
    for a, b, kind in spans:
        k = KINDS.index(kind)
        y[a:b] = 2 + 2 * k
        y[a] = 1 + 2 * k
    return y


def closed() -> np.ndarray:
    """Transitions that no path may take."""
    m = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        m[:, 2 + 2 * k] = CLOSED
        m[1 + 2 * k, 2 + 2 * k] = m[2 + 2 * k, 2 + 2 * k] = 0
    return m


def new_model(seed: int = 11) -> dict[str, np.ndarray]:
    rng, d, h = np.random.default_rng(seed), SIZES["embed"], SIZES["hidden"]
    p = {"E": rng.normal(0, 0.3, (CODES, d)), "Wo": rng.normal(0, 0.2, (2 * h, TAGS)), "bo": np.zeros(TAGS), "A": np.zeros((TAGS, TAGS))}
    for side in "fb":
        p["Wx" + side] = rng.normal(0, d**-0.5, (d, 4 * h))
        p["Wh" + side] = rng.normal(0, h**-0.5, (h, 4 * h))
        p["b" + side] = np.r_[np.zeros(h), np.ones(h), np.zeros(2 * h)]
    return p


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def lstm(x: np.ndarray, wh: np.ndarray, keep: bool):
    """States [T, B, H] for projected inputs [T, B, 4H] (gates: in, forget, out, new)."""
    t, b, h4 = x.shape
    h = h4 // 4
    out = np.empty((t, b, h), x.dtype)
    memo = [] if keep else None
    s, c = np.zeros((b, h), x.dtype), np.zeros((b, h), x.dtype)
    for k in range(t):
        z = x[k] + s @ wh
        g = sigmoid(z[:, : 3 * h])
        n = np.tanh(z[:, 3 * h :])
        before = c
        c = g[:, h : 2 * h] * c + g[:, :h] * n
        tc = np.tanh(c)
        if keep:
            memo.append((g, n, before, tc, s))
        s = g[:, 2 * h : 3 * h] * tc
        out[k] = s
    return out, memo


def lstm_back(d_out: np.ndarray, memo, wh: np.ndarray):
    """Gradients of the projected inputs and of the recurrent weights."""
    t, b, h = d_out.shape
    dx, dwh = np.empty((t, b, 4 * h)), np.zeros_like(wh)
    ds, dc = np.zeros((b, h)), np.zeros((b, h))
    for k in range(t - 1, -1, -1):
        g, n, before, tc, s_before = memo[k]
        gi, gf, go = g[:, :h], g[:, h : 2 * h], g[:, 2 * h :]
        ds = ds + d_out[k]
        dc = dc + ds * go * (1 - tc * tc)
        dz = np.concatenate([dc * n * gi * (1 - gi), dc * before * gf * (1 - gf), ds * tc * go * (1 - go), dc * gi * (1 - n * n)], axis=1)
        dx[k] = dz
        dwh += s_before.T @ dz
        ds = dz @ wh.T
        dc = dc * gf
    return dx, dwh


def emissions(p: dict[str, np.ndarray], x: np.ndarray, keep: bool = False):
    """Tag scores [T, B, TAGS] of coded windows [T, B]."""
    f, mf = lstm((p["E"] @ p["Wxf"] + p["bf"])[x], p["Whf"], keep)
    b, mb = lstm((p["E"] @ p["Wxb"] + p["bb"])[x[::-1]], p["Whb"], keep)
    both = np.concatenate([f, b[::-1]], axis=2)
    return both @ p["Wo"] + p["bo"], (both, mf, mb)


def logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


def crf(e: np.ndarray, a: np.ndarray, y: np.ndarray):
    """Negative log-likelihood of the tags and its gradients for scores and transitions."""
    t, b, k = e.shape
    fwd, bwd = np.empty_like(e), np.empty_like(e)
    fwd[0] = e[0]
    fwd[0, :, 2::2] += CLOSED  # no path opens with I
    for i in range(1, t):
        fwd[i] = logsumexp(fwd[i - 1][:, :, None] + a, 1) + e[i]
    bwd[-1] = 0
    for i in range(t - 2, -1, -1):
        bwd[i] = logsumexp(a + (e[i + 1] + bwd[i + 1])[:, None, :], 2)
    z = logsumexp(fwd[-1], 1)
    de = np.exp(fwd + bwd - z[None, :, None])
    pair = np.exp(fwd[:-1, :, :, None] + a + (e[1:] + bwd[1:])[:, :, None, :] - z[None, :, None, None])
    da = pair.sum(axis=(0, 1))
    ti, bi = np.meshgrid(np.arange(t), np.arange(b), indexing="ij")
    gold = e[ti, bi, y].sum() + a[y[:-1], y[1:]].sum()
    de[ti, bi, y] -= 1
    np.add.at(da, (y[:-1].ravel(), y[1:].ravel()), -1)
    return z.sum() - gold, de, da


def gradients(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray):
    e, (both, mf, mb) = emissions(p, x, keep=True)
    loss, de, da = crf(e, p["A"] + closed(), y)
    n = x.shape[1]
    de, da = de / n, da / n
    g = {"A": np.where(closed() < 0, 0, da), "Wo": np.tensordot(both, de, ((0, 1), (0, 1))), "bo": de.sum(axis=(0, 1))}
    d_both = de @ p["Wo"].T
    h = SIZES["hidden"]
    g["E"] = np.zeros_like(p["E"])
    for side, d, memo, xs in (("f", d_both[:, :, :h], mf, x), ("b", d_both[::-1, :, h:], mb, x[::-1])):
        dx, g["Wh" + side] = lstm_back(d, memo, p["Wh" + side])
        rows = np.zeros((CODES, dx.shape[2]))
        np.add.at(rows, xs.ravel(), dx.reshape(-1, dx.shape[2]))
        g["Wx" + side], g["b" + side] = p["E"].T @ rows, rows.sum(axis=0)
        g["E"] += rows @ p["Wx" + side].T
    return loss / n, g


def train(samples: list[tuple[str, list[Span]]], width: int, epochs: int = 9, batch: int = 48, rate: float = 0.01, seed: int = 5):
    """A model from labelled windows of up to ``width`` characters; none at all gives an untrained one."""
    p = new_model()
    if not samples:
        return p
    x, y = np.zeros((width, len(samples)), np.int64), np.zeros((width, len(samples)), np.int64)
    for i, (text, spans) in enumerate(samples):
        c = codes(text[:width])
        x[: len(c), i] = c
        y[: len(c), i] = tags(len(c), [s for s in spans if s[1] <= width])
    rng, step = np.random.default_rng(seed), 0
    m, v = {k: np.zeros_like(w) for k, w in p.items()}, {k: np.zeros_like(w) for k, w in p.items()}
    for epoch in range(epochs):
        order = rng.permutation(len(samples))
        for lo in range(0, len(order), batch):
            pick = order[lo : lo + batch]
            _, g = gradients(p, x[:, pick], y[:, pick])
            norm = np.sqrt(sum((d * d).sum() for d in g.values()))
            step += 1
            now = rate * (1 - 0.9 * epoch / epochs)
            for k, d in g.items():
                d = d * min(1.0, 5.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                p[k] -= now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return p


def decode(p: dict[str, np.ndarray], windows: list[str], batch: int = 512) -> list[list[tuple[int, int, str, float]]]:
    """Spans (start, end, kind, score) of each window, by Viterbi.

    The score is what the span's tags gain over O.  Windows of like length
    share a batch.
    """
    p = {k: w.astype(np.float32) for k, w in p.items()}
    a = p["A"] + closed().astype(np.float32)
    out: list = [None] * len(windows)
    order = sorted(range(len(windows)), key=lambda i: len(windows[i]))
    for lo in range(0, len(order), batch):
        pick = order[lo : lo + batch]
        width = len(windows[pick[-1]])
        x = np.zeros((width, len(pick)), np.int64)
        for j, i in enumerate(pick):
            c = codes(windows[i])
            x[: len(c), j] = c
        if width == 0:
            for i in pick:
                out[i] = []
            continue
        e, _ = emissions(p, x)
        back = np.empty(e.shape, np.int8)
        s = e[0].copy()
        s[:, 2::2] += CLOSED
        for t in range(1, width):
            by = s[:, :, None] + a
            back[t] = by.argmax(axis=1)
            s = np.take_along_axis(by, back[t][:, None, :].astype(np.int64), 1)[:, 0] + e[t]
        path = np.empty((width, len(pick)), np.int64)
        path[-1] = s.argmax(axis=1)
        for t in range(width - 1, 0, -1):
            path[t - 1] = back[t][np.arange(len(pick)), path[t]]
        gain = np.take_along_axis(e, path[:, :, None], 2)[:, :, 0] - e[:, :, 0]
        for j, i in enumerate(pick):
            out[i] = spans_of(path[: len(windows[i]), j], gain[:, j])
    return out


def spans_of(path: np.ndarray, gain: np.ndarray) -> list[tuple[int, int, str, float]]:
    out: list = []
    for t in np.flatnonzero(path):
        if path[t] % 2 == 1:
            out.append([int(t), int(t) + 1, KINDS[(path[t] - 1) // 2], float(gain[t])])
        elif out and out[-1][1] == t:
            out[-1][1] = int(t) + 1
            out[-1][3] += float(gain[t])
    return [tuple(s) for s in out]
