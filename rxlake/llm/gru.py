"""A gated recurrent language model in numpy with a class-factored softmax.

Words are numbered by falling frequency; number i belongs to class i // BLOCK.
A word's probability is that of its class times its own within the class. Words
beyond the vocabulary form one more class, RARE, in which the caller spreads
the probability. Texts run in lanes, several at once; the state is carried from
window to window of a text and set to zero where the next one begins.
"""

from __future__ import annotations

import numpy as np

EMBED, HIDDEN, CLASSES, BLOCK = 16, 16, 48, 48
VOCAB = CLASSES * BLOCK
RARE, BEGIN = VOCAB, VOCAB + 1
WINDOW = 32
#: Windows, hence weight updates, that a pass over a stream takes at least.
STEPS = 16
SHAPES = {"emb": (VOCAB + 2, EMBED), "wx": (EMBED, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN), "b": (3 * HIDDEN,), "wc": (HIDDEN, CLASSES + 1), "bc": (CLASSES + 1,), "wo": (CLASSES, HIDDEN, BLOCK), "bo": (CLASSES, BLOCK)}
F4 = np.float32


def flatten(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES])


def unflatten(x: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[k] = x[at : at + n].reshape(shape).astype(F4)
        at += n
    return out


def start(counts: np.ndarray, rare: int, seed: int = 5) -> dict[str, np.ndarray]:
    """Weights of a model that gives each word its relative frequency. ``counts``:
    of the vocabulary in order, at most VOCAB; ``rare``: tokens beyond it."""
    rng = np.random.default_rng(seed)
    p = {k: (rng.normal(size=s) * (0.3 if k in ("emb", "wx", "u") else 0.05)).astype(F4) for k, s in SHAPES.items()}
    full = np.zeros(VOCAB)
    full[: len(counts)] = counts
    by_class = full.reshape(CLASSES, BLOCK)
    with np.errstate(divide="ignore"):
        p["bo"] = np.where(by_class > 0, np.log(by_class), -30.0).astype(F4)
        total = np.append(by_class.sum(1), rare + 0.5)
        p["bc"] = np.where(total > 0, np.log(total / total.sum()), -30.0).astype(F4)
    p["b"][:] = 0
    p["wc"][:] = 0
    p["wo"][:] = 0
    return p


def lanes(texts: list[np.ndarray], most: int) -> tuple[np.ndarray, ...]:
    """Inputs, targets and texts of all tokens, lane after lane, and each lane's
    first token and length, longest lane first. Long texts are dealt first, each
    to the lane that is shortest so far. Nothing is padded: a very long text takes
    the room of its own tokens."""
    size = np.array([len(t) for t in texts], np.int64)
    n = max(1, min(most, len(texts)))
    load, dealt = np.zeros(n, np.int64), [[] for _ in range(n)]
    for i in np.argsort(-size, kind="stable"):
        if size[i]:
            k = int(np.argmin(load))
            dealt[k].append(i)
            load[k] += size[i]
    by_load = np.argsort(-load, kind="stable")
    own = np.array([i for k in by_load for i in dealt[k]], np.int64)
    load = load[by_load]
    y = np.concatenate([texts[i] for i in own]) if len(own) else np.zeros(0, np.int32)
    x = np.append(np.int32(BEGIN), y[:-1])[: len(y)]
    x[np.cumsum(size[own]) - size[own]] = BEGIN
    return x, y, np.repeat(own, size[own]), np.cumsum(load) - load, load


def _sig(a: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-a))


def run(p: dict[str, np.ndarray], table: np.ndarray, x: np.ndarray, h: np.ndarray, trace: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """States of all steps of one window and the last; ``table``: inputs' part of the gates."""
    H, out = HIDDEN, np.empty((len(x), x.shape[1], HIDDEN), F4)
    for t in range(len(x)):
        h = h * (x[t] != BEGIN)[:, None]
        a, g = table[x[t]], h @ p["u"]
        zr = _sig(a[:, : 2 * H] + g[:, : 2 * H])
        z, r = zr[:, :H], zr[:, H:]
        n = np.tanh(a[:, 2 * H :] + r * g[:, 2 * H :])
        new = n + z * (h - n)
        if trace is not None:
            trace.append((h, z, r, n, g[:, 2 * H :]))
        out[t] = h = new
    return out, h


def _soft(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials (in place) and their sums. Weights are small and clipped
    steps keep them so; logits stay far from where exponentials overflow."""
    e = np.exp(np.minimum(logits, 80, out=logits), out=logits)
    return e, e.sum(1)


def predict(p: dict[str, np.ndarray], h: np.ndarray, y: np.ndarray, grad: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log-probability of each target, RARE as a class alone; with
    ``grad``, adds gradients of the negative sum and gives those of the states."""
    order = np.argsort(y, kind="stable")
    h, target = h[order], y[order]
    cls = np.minimum(target // BLOCK, CLASSES)
    ends = np.searchsorted(cls, np.arange(CLASSES + 1))
    rows = np.arange(len(y))
    e, total = _soft(h @ p["wc"] + p["bc"])
    prob, dh = e[rows, cls] / total, None
    if grad is not None:
        e /= total[:, None]
        e[rows, cls] -= 1
        grad["wc"] += h.T @ e
        grad["bc"] += e.sum(0)
        dh = e @ p["wc"].T
    for c in range(CLASSES):
        a, z = ends[c], ends[c + 1]
        if a == z:
            continue
        e, total = _soft(h[a:z] @ p["wo"][c] + p["bo"][c])
        word, k = target[a:z] - c * BLOCK, rows[: z - a]
        prob[a:z] *= e[k, word] / total
        if grad is not None:
            e /= total[:, None]
            e[k, word] -= 1
            grad["wo"][c] += h[a:z].T @ e
            grad["bo"][c] += e.sum(0)
            dh[a:z] += e @ p["wo"][c].T
    lp = np.empty(len(y))
    lp[order] = np.log(np.maximum(prob, 1e-30))
    if dh is not None:
        back = np.empty_like(dh)
        back[order] = dh
        dh = back
    return lp, dh


def train(p: dict[str, np.ndarray], texts: list[np.ndarray], *, width: int = 256, rate: float = 0.25) -> int:
    """One pass of truncated backpropagation over the texts, in place, with
    steps scaled by past gradients. Gives the number of tokens. The texts end to
    end are cut into lanes of one length, so every step sees all lanes; lanes are
    at least STEPS windows long, as fewer steps would hardly move the weights."""
    stream = np.concatenate(texts) if texts else np.zeros(0, np.int32)
    if not len(stream):
        return 0
    width = max(1, min(width, len(stream) // (STEPS * WINDOW)))
    begins = np.append(0, stream[:-1])
    begins[np.cumsum([0] + [len(t) for t in texts if len(t)])[:-1]] = BEGIN
    steps = -(-len(stream) // width)
    y = np.full(steps * width, -1, np.int32)
    x = np.full(steps * width, BEGIN, np.int32)
    y[: len(stream)], x[: len(stream)] = stream, begins
    x, y = (np.ascontiguousarray(a.reshape(width, steps).T) for a in (x, y))
    x[0] = BEGIN
    h = np.zeros((x.shape[1], HIDDEN), F4)
    H, seen = HIDDEN, 0
    past = {k: np.full(s, 1e-2, F4) for k, s in SHAPES.items()}
    for lo in range(0, len(x), WINDOW):
        xs, ys = x[lo : lo + WINDOW], y[lo : lo + WINDOW]
        grad = {k: np.zeros(s, F4) for k, s in SHAPES.items()}
        table = p["emb"] @ p["wx"] + p["b"]
        trace: list = []
        states, last = run(p, table, xs, h, trace)
        ok = ys >= 0
        if not ok.any():
            break
        seen += int(ok.sum())
        _, d = predict(p, states[ok], ys[ok], grad)
        dstates = np.zeros_like(states)
        dstates[ok] = d
        carry = np.zeros_like(h)
        gates = np.empty((*xs.shape, 3 * H), F4)
        for t in range(len(xs) - 1, -1, -1):
            hp, z, r, n, gn = trace[t]
            dh = dstates[t] + carry
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (hp - n) * z * (1 - z)
            dr = dn * gn * r * (1 - r)
            dg = np.concatenate([dz, dr, dn * r], 1)
            grad["u"] += hp.T @ dg
            carry = (dh * z + dg @ p["u"].T) * (xs[t] != BEGIN)[:, None]
            gates[t, :, : 2 * H], gates[t, :, 2 * H :] = dg[:, : 2 * H], dn
        flat = xs.ravel()
        order = np.argsort(flat, kind="stable")
        words, first = np.unique(flat[order], return_index=True)
        dtable = np.zeros_like(table)
        dtable[words] = np.add.reduceat(gates.reshape(-1, 3 * H)[order], first)
        grad["emb"] = dtable @ p["wx"].T
        grad["wx"] = p["emb"].T @ dtable
        grad["b"] = dtable.sum(0)
        scale = F4(1 / np.sqrt(max(1, ok.sum())))
        for k in SHAPES:
            g = np.clip(grad[k] * scale, -5, 5)
            past[k] += g * g
            p[k] -= rate * g / np.sqrt(past[k])
        h = last
    return seen


def score(p: dict[str, np.ndarray], texts: list[np.ndarray], *, width: int = 512) -> np.ndarray:
    """Natural log-probability of each whole text."""
    x, y, owner, first, load = lanes(texts, width)
    out = np.zeros(len(texts))
    table = (p["emb"] @ p["wx"] + p["b"]).astype(F4)
    h = np.zeros((len(load), HIDDEN), F4)
    for lo in range(0, int(load.max(initial=0)), WINDOW):
        # Lanes that have ended drop out; they are the last ones.
        live = int((load > lo).sum())
        step = lo + np.arange(min(WINDOW, int(load[0]) - lo))[:, None]
        ok = step < load[:live]
        at = np.where(ok, first[:live] + step, 0)
        states, h = run(p, table, np.where(ok, x[at], BEGIN), h[:live])
        at = at[ok]
        lp, _ = predict(p, states[ok], y[at])
        out += np.bincount(owner[at], lp, len(texts))
    return out
