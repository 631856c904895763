"""A small causal self-attention model over subword ids, in numpy."""

from __future__ import annotations

import numpy as np

WINDOW = 16
# Targets a window scores; the rest of it repeats the window before as context.
FRESH = 12
WIDTH = 8
BATCH = 256
RATE = 0.02
LEAST_STEPS = 60

# Scores stay within what single precision can add up after the exponential.
LARGEST = 60.0
_SEEN = np.tril(np.ones((WINDOW, WINDOW), np.float32))


def shapes(rows: int, classes: int) -> dict[str, tuple[int, ...]]:
    square = (WIDTH, WIDTH)
    return {
        "embed": (rows, WIDTH), "place": (WINDOW, WIDTH), "query": square, "key": square, "value": square, "mix": square,
        "out": (WIDTH, classes), "bias": (classes,),
    }


def start(rows: int, classes: int, seed: int = 7) -> dict[str, np.ndarray]:
    """The same first weights on every machine."""
    rng = np.random.default_rng(seed)
    return {k: (rng.normal(size=s) * (0 if k == "bias" else 0.3)).astype(np.float32) for k, s in shapes(rows, classes).items()}


def flatten(params: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p.ravel() for p in params.values()])


def unflatten(flat: np.ndarray, rows: int, classes: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes(rows, classes).items():
        size = int(np.prod(shape))
        out[name] = flat[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def forward(p: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Class scores (batch, WINDOW, classes) of input rows ``x``; a place sees itself and those before it."""
    h = p["embed"][x] + p["place"]
    q, k, v = h @ p["query"], h @ p["key"], h @ p["value"]
    a = q @ k.transpose(0, 2, 1)
    a *= WIDTH**-0.5
    np.clip(a, -LARGEST, LARGEST, out=a)
    np.exp(a, out=a)
    a *= _SEEN
    a /= (a @ np.ones(WINDOW, a.dtype))[..., None]
    o = a @ v
    z = h + o @ p["mix"]
    return z @ p["out"] + p["bias"], (h, q, k, v, a, o, z)


def gradients(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy of classes ``y`` and its slopes; places of weight zero do not count."""
    scores, (h, q, k, v, a, o, z) = forward(p, x)
    scores -= scores.max(axis=2, keepdims=True)
    # ``mine`` are the places of the classes that came.
    mine = np.arange(0, scores.size, scores.shape[2]) + y.ravel()
    picked = scores.reshape(-1)[mine].reshape(y.shape)
    ds = np.exp(scores, out=scores)
    total = ds.sum(axis=2, keepdims=True)
    picked = picked - np.log(total[..., 0])
    count = max(1.0, float(weight.sum()))
    ds /= total
    ds.reshape(-1)[mine] -= 1
    ds *= (weight / count)[..., None]

    def across(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.reshape(-1, left.shape[2]).T @ right.reshape(-1, right.shape[2])

    g = {"out": across(z, ds), "bias": ds.sum(axis=(0, 1))}
    dz = ds @ p["out"].T
    g["mix"] = across(o, dz)
    do = dz @ p["mix"].T
    dv = a.transpose(0, 2, 1) @ do
    da = do @ v.transpose(0, 2, 1)
    da -= (da * a).sum(axis=2, keepdims=True)
    da *= a
    da *= WIDTH**-0.5
    dq, dk = da @ k, da.transpose(0, 2, 1) @ q
    g["query"], g["key"], g["value"] = across(h, dq), across(h, dk), across(h, dv)
    dh = dz + dq @ p["query"].T + dk @ p["key"].T + dv @ p["value"].T
    g["place"] = dh.sum(axis=0)
    g["embed"] = np.zeros_like(p["embed"])
    # Number by number, which numpy adds much faster than row by row.
    np.add.at(g["embed"].reshape(-1), (x[..., None] * WIDTH + np.arange(WIDTH)).ravel(), dh.ravel())
    return float(-(picked * weight).sum() / count), g


def train(
    p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, weight: np.ndarray, seed: int = 3, done: float = 0.0, share: float = 1.0
) -> dict[str, np.ndarray]:
    """Adam over shuffled batches of windows, each seen once (more often where they are few).

    ``done`` and ``share`` say which part of the whole training this is; the
    rate falls to zero over all of it.
    """
    p = {k: v.copy() for k, v in p.items()}
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    rng, batches = np.random.default_rng(seed), -(-len(x) // BATCH)
    steps = max(batches, LEAST_STEPS) if len(x) else 0
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        if not len(order):
            order = rng.permutation(len(x))
        rows, order = order[:BATCH], order[BATCH:]
        _, g = gradients(p, x[rows], y[rows], weight[rows])
        rate = RATE * (1 - done - share * (step - 1) / steps)
        for k in p:
            first[k] += 0.1 * (g[k] - first[k])
            second[k] += 0.01 * (g[k] ** 2 - second[k])
            p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
    return p


def windows(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping windows over documents whose targets begin at ``starts`` (the last entry ends them all).

    Returns target positions (n, WINDOW), -1 past the end of a document, and
    which of them the window scores: every target exactly once.
    """
    lengths = np.diff(starts)
    count = 1 + -(-np.maximum(lengths - WINDOW, 0) // FRESH)
    count[lengths == 0] = 0
    owner = np.repeat(np.arange(len(lengths)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    place = (starts[owner] + nth * FRESH)[:, None] + np.arange(WINDOW)
    place[place >= starts[owner + 1][:, None]] = -1
    fresh = (place >= 0) & ((nth == 0)[:, None] | (np.arange(WINDOW) >= WINDOW - FRESH))
    return place, fresh
