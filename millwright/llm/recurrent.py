"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation, state carried along texts.

Texts are dealt to lanes that advance together, a window of steps at a time. The state runs on from window to window until
its text ends; backpropagation stops at the window's border.
"""

from __future__ import annotations

import heapq

import numpy as np

HIDDEN, CLASSES, CLASS_WORDS = 16, 32, 32
#: Words with an output of their own; one more output is for all other words and one for the end of a text.
OUTPUTS = CLASSES * CLASS_WORDS
OTHER, END = OUTPUTS - 2, OUTPUTS - 1
SHAPES = {"x": (OUTPUTS, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN), "c": (HIDDEN, CLASSES), "cb": (CLASSES,), "w": (CLASSES, HIDDEN, CLASS_WORDS), "wb": (CLASSES, CLASS_WORDS)}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())

Params = dict[str, np.ndarray]


def unpack(flat: np.ndarray) -> Params:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = flat[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def pack(p: Params) -> np.ndarray:
    return np.concatenate([p[name].ravel() for name in SHAPES]).astype(np.float64)


def start(counts: np.ndarray, seed: int = 11) -> Params:
    """Small random weights; the biases say what the counts of the outputs say. Outputs of neighbouring counts share a class."""
    random = np.random.default_rng(seed)
    p = {name: random.normal(0, 0.1, shape).astype(np.float32) for name, shape in SHAPES.items()}
    share = (counts + 0.5).reshape(CLASSES, CLASS_WORDS)
    p["cb"] = np.log(share.sum(axis=1) / share.sum()).astype(np.float32)
    p["wb"] = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)
    return p


def lanes(texts: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts (each with its END) one after another in ``width`` lanes of like length: outputs (-1 after the last), where texts start, and which text."""
    width = max(1, min(width, len(texts)))
    heap = [(0, k) for k in range(width)]
    held: list[list[int]] = [[] for _ in range(width)]
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        n, k = heapq.heappop(heap)
        held[k].append(i)
        heapq.heappush(heap, (n + len(texts[i]), k))
    longest = max(n for n, _ in heap)
    outputs = np.full((longest, width), -1, np.int16)
    opens, owner = np.zeros((longest, width), bool), np.full((longest, width), -1, np.int32)
    for k, own in enumerate(held):
        at = 0
        for i in own:
            n = len(texts[i])
            outputs[at : at + n, k], owner[at : at + n, k], opens[at, k] = texts[i], i, True
            at += n
    return outputs, opens, owner


def run(p: Params, inputs: np.ndarray, opens: np.ndarray, h: np.ndarray, keep: bool = True) -> tuple[np.ndarray, list]:
    """States after each step of a window, and what the way back needs if ``keep``. ``opens`` resets a lane's state."""
    steps, width = inputs.shape
    kind = np.result_type(p["u"], h)
    # A sigmoid is the tanh of half its input: the halves are taken of the weights.
    half = np.repeat(np.array([0.5, 0.5, 1], kind), HIDDEN)
    px, pu, resets = p["x"] * half, p["u"] * half, opens.any(axis=1).tolist()
    states, x, tape = np.empty((steps, width, HIDDEN), kind), np.empty((width, 3 * HIDDEN), kind), []
    hu, own = np.empty((steps if keep else 1, width, 3 * HIDDEN), kind), np.empty((steps if keep else 1, 3, width, HIDDEN), kind)
    gates, new = x.reshape(width, 3, HIDDEN).swapaxes(0, 1)[:2], x[:, 2 * HIDDEN :]
    for t in range(steps):
        before, out, at = h, states[t], t if keep else 0
        if resets[t]:
            before = np.where(opens[t][:, None], np.zeros((), kind), h)
        zr, n, hn = own[at, :2], own[at, 2], hu[at, :, 2 * HIDDEN :]
        px.take(inputs[t], axis=0, out=x, mode="clip")
        np.matmul(before, pu, out=hu[at])
        np.add(gates, hu[at].reshape(width, 3, HIDDEN).swapaxes(0, 1)[:2], out=zr)
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        np.multiply(zr[1], hn, out=n)
        n += new
        np.tanh(n, out=n)
        np.subtract(before, n, out=out)
        out *= zr[0]
        out += n
        h = out
        if keep:
            tape.append((before, zr[0], zr[1], n, hn))
    return states, tape


def _columns(rows: int, columns: int, kind: np.dtype) -> np.ndarray:
    """An empty array whose rows lie no power of two apart, else its columns share few cache lines."""
    return np.empty((rows, columns + 16), kind)[:, :columns]


def _softmax(a: np.ndarray, picked: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """For the logits ``a``, a column for each output: the log probability of each column's row ``picked``; if ``back``, also the gradients of the negative sum, a row for each output."""
    a -= a.max(axis=0)
    logs = a[picked, np.arange(a.shape[1])]
    np.exp(a, out=a)
    total = a[:8] + a[8:16]  # the order of a sum along 32 neighbours
    for k in range(16, len(a), 8):
        total += a[k : k + 8]
    while len(total) > 1:
        total = total[::2] + total[1::2]
    logs -= np.log(total[0])
    if not back:
        return logs, None
    a /= total[0]
    d = np.ascontiguousarray(a.T)
    d.ravel()[np.arange(0, d.size, d.shape[1]) + picked] -= 1
    return logs, d


def log_probabilities(p: Params, h: np.ndarray, outputs: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log probability of each output given its state. With ``grads``, also adds the output layers' gradients of the negative sum and returns that of the states."""
    back, dh = grads is not None, None
    cls, word = (outputs // CLASS_WORDS).astype(np.uint8), outputs % CLASS_WORDS
    a = _columns(CLASSES, len(h), np.result_type(h, p["c"]))
    np.add((h @ p["c"]).T, p["cb"][:, None], out=a)
    logs, d = _softmax(a, cls, back)
    if back:
        grads["c"], grads["cb"], dh = h.T @ d, np.einsum("ij->j", d), d @ p["c"].T
        grads["w"], grads["wb"] = np.zeros_like(p["w"]), np.zeros_like(p["wb"])
    # Outputs of one class side by side.
    order = np.argsort(cls, kind="stable")
    cuts = np.searchsorted(cls[order], np.arange(CLASSES + 1)).tolist()
    parts = [(k, slice(cuts[k], cuts[k + 1])) for k in range(CLASSES) if cuts[k] < cuts[k + 1]]
    own = h.take(order, axis=0)
    for k, part in parts:
        np.add((own[part] @ p["w"][k]).T, p["wb"][k][:, None], out=a[:, part])
    more, d = _softmax(a, word[order], back)
    logs[order] += more
    if back:
        down = np.empty_like(dh)
        for k, part in parts:
            grads["w"][k], grads["wb"][k] = own[part].T @ d[part], np.einsum("ij->j", d[part])
            np.matmul(d[part], p["w"][k].T, out=down[part])
        dh[order] += down
    return logs, dh


def gradients(p: Params, inputs: np.ndarray, outputs: np.ndarray, opens: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray, dict]:
    """Sum of log probabilities of a window, the state after it, and the gradients of the negative sum; those of ``x`` as (rows, sums)."""
    states, tape = run(p, inputs, opens, h)
    at = np.flatnonzero(outputs >= 0)
    grads: dict = {}
    logs, back = log_probabilities(p, states.reshape(-1, HIDDEN).take(at, axis=0), outputs.ravel()[at], grads)
    dstates = np.zeros((outputs.size, HIDDEN), back.dtype)
    dstates[at] = back
    dstates = dstates.reshape(*outputs.shape, HIDDEN)
    du, dx = np.zeros_like(p["u"]), np.empty((*inputs.shape, 3 * HIDDEN), back.dtype)
    dh, dg, resets = np.zeros_like(dstates[0]), np.empty_like(dx[0]), opens.any(axis=1).tolist()
    for t in range(len(inputs) - 1, -1, -1):
        before, z, r, n, hn = tape[t]
        dh += dstates[t]
        rest = 1 - z
        dn = dh * rest
        dn *= 1 - n * n
        dz = (before - n) * dh
        dz *= z
        np.multiply(dz, rest, out=dg[:, :HIDDEN])
        dr = dn * hn
        dr *= r
        np.multiply(dr, 1 - r, out=dg[:, HIDDEN : 2 * HIDDEN])
        dx[t, :, : 2 * HIDDEN], dx[t, :, 2 * HIDDEN :] = dg[:, : 2 * HIDDEN], dn
        np.multiply(dn, r, out=dg[:, 2 * HIDDEN :])
        du += before.T @ dg
        dh *= z
        dh += dg @ p["u"].T
        if resets[t]:
            dh[opens[t]] = 0
    grads["u"] = du
    grads["x"] = _by_id(inputs.ravel(), dx.reshape(-1, 3 * HIDDEN))
    return float(logs.sum()), states[-1], grads


def _by_id(ids: np.ndarray, rows: np.ndarray, many: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, ascending, and the sums of their rows. Runs of ``many`` rows are summed as columns side by side, which reduceat does slowly."""
    ids = ids.astype(np.int16, copy=False)
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows.take(order, axis=0)
    firsts = np.flatnonzero(np.diff(ids, prepend=-1))
    counts = np.diff(firsts, append=len(ids))
    short, sums = counts < many, np.empty((len(firsts), rows.shape[1]), rows.dtype)
    if short.any():
        sums[short] = np.add.reduceat(rows[np.repeat(short, counts)], np.cumsum(counts[short]) - counts[short], axis=0)
    for k in np.flatnonzero(~short):
        first, rest = rows[firsts[k]], rows[firsts[k] + 1 : firsts[k] + counts[k]]
        sums[k] = first + np.ascontiguousarray(rest.T).sum(axis=1)
    return ids[firsts], sums


class Trainer:
    """Adagrad over windows. ``squares`` carries the sums of squared gradients on from earlier training."""

    def __init__(self, p: Params, squares: Params | None = None, rate: float = 0.08, width: int = 512, steps: int = 16, longest: int = 2048) -> None:
        self.p, self.rate, self.width, self.steps, self.longest = {k: v.copy() for k, v in p.items()}, rate, width, steps, longest
        self.squares = {k: v.copy() for k, v in squares.items()} if squares else {k: np.full_like(v, 1e-3) for k, v in p.items()}
        self.tokens = 0

    def learn(self, texts: list[np.ndarray]) -> None:
        """One pass over whole texts; one of more than ``longest`` words is learnt in stretches of this length, so that lanes stay even."""
        width = min(self.width, max(32, sum(map(len, texts)) // self.longest))  # few words: fewer lanes, so that there are windows enough
        outputs, opens, _ = lanes([t[i : i + self.longest] for t in texts for i in range(0, len(t), self.longest)], width)
        inputs = np.concatenate([np.full((1, outputs.shape[1]), END, np.int16), outputs[:-1]])
        inputs = np.where((inputs < 0) | opens, END, inputs)
        h = np.zeros((outputs.shape[1], HIDDEN), np.float32)
        for t in range(0, len(outputs), self.steps):
            part = slice(t, t + self.steps)
            seen = int((outputs[part] >= 0).sum())
            _, h, grads = gradients(self.p, inputs[part], outputs[part], opens[part], h)
            self.tokens += seen
            scale = np.float32(1 / np.sqrt(max(1, seen)))
            for name, g in grads.items():
                at, g = g if name == "x" else (slice(None), g)
                g = np.clip(g * scale, -1, 1)
                self.squares[name][at] += g * g
                self.p[name][at] -= self.rate * g / np.sqrt(self.squares[name][at])


def even(sizes: list[int], width: int, spare: int = 16) -> list[list[int]]:
    """Numbers of texts by groups, longest first, whose lanes hold at most ``spare`` cells a word: very long texts get lanes of their own."""
    order, groups = sorted(range(len(sizes)), key=lambda i: -sizes[i]), []
    while order:
        longest, total = sizes[order[0]], sum(sizes[i] for i in order)
        cut = len(order)
        if longest * min(width, len(order)) > spare * total:
            cut = next(k for k, i in enumerate(order) if 8 * sizes[i] < longest)
        groups.append(order[:cut])
        order = order[cut:]
    return groups


def score(p: Params, texts: list[np.ndarray], width: int = 512, steps: int = 32, wide: int = 16_384) -> np.ndarray:
    """Natural log probability of each text, its END included. Memory follows the words, however uneven the texts are."""
    out = np.zeros(len(texts))
    for group in even([len(t) for t in texts], width):
        out[group] = _scored(p, [texts[i] for i in group], width, steps, wide)
    return out


def _scored(p: Params, texts: list[np.ndarray], width: int, steps: int, wide: int) -> np.ndarray:
    out = np.zeros(len(texts))
    outputs, opens, owner = lanes(texts, width)
    inputs = np.concatenate([np.full((1, outputs.shape[1]), END, np.int16), outputs[:-1]])
    inputs = np.where(inputs < 0, END, inputs)
    h = np.zeros((outputs.shape[1], HIDDEN), np.float32)
    while len(outputs):
        # Longer windows as lanes grow few; lanes that have ended are left out.
        size, live = max(steps, min(512, wide // outputs.shape[1])), np.flatnonzero(outputs[0] >= 0)
        if len(live) < outputs.shape[1]:
            inputs, outputs, opens, owner, h = inputs[:, live], outputs[:, live], opens[:, live], owner[:, live], h[live]
        states, _ = run(p, inputs[:size], opens[:size], h, keep=False)
        h = states[-1]
        at = np.flatnonzero(outputs[:size] >= 0)
        logs, _ = log_probabilities(p, states.reshape(-1, HIDDEN).take(at, axis=0), outputs[:size].ravel()[at])
        out += np.bincount(owner[:size].ravel()[at], weights=logs, minlength=len(texts))
        inputs, outputs, opens, owner = inputs[size:], outputs[size:], opens[size:], owner[size:]
    return out
