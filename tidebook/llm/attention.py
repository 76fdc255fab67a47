"""A small causal self-attention model of subword classes, in numpy.

One attention layer with learned biases by distance and one hidden layer read the classes so far and weigh
some distributions over the next class: the corpus's own within-word successor distribution (a fixed table
of counts), and ``MIX`` learned ones.  The probability of a class is the weighted mean of theirs, so a score
needs no sum over all classes.
"""

from __future__ import annotations

import numpy as np

WIDTH = 16
HIDDEN = 32
MIX = 48
SPAN = 64  # inputs that a window holds; scored windows overlap by half
BLOCK = SPAN // 2
BATCH = 128  # windows of a step of learning
#: How much faster the distributions learn than the rest.  At one pace the gate settles on the successor table for good, before
#: they differ enough for it to choose among them.
PACE = 50

_AGO = np.arange(SPAN)[:, None] - np.arange(SPAN)[None, :]
_FUTURE = np.where(_AGO < 0, np.float32(-1e9), np.float32(0))
_AGO = np.maximum(_AGO, 0)


def start(unigram: np.ndarray, seed: int = 1) -> dict[str, np.ndarray]:
    """Parameters before learning: most of the weight is on the successor table."""
    r = np.random.default_rng(seed)
    n = len(unigram)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (r.standard_normal(shape) * scale).astype(np.float32)

    p = {"emb": normal(n, WIDTH, scale=0.3), "near": np.linspace(0, -2, SPAN).astype(np.float32)}
    p |= {k: normal(WIDTH, WIDTH, scale=WIDTH**-0.5) for k in ("wq", "wk", "wv", "wo")}
    p |= {"w1": normal(WIDTH, HIDDEN, scale=WIDTH**-0.5), "b1": np.zeros(HIDDEN, np.float32), "w2": normal(HIDDEN, WIDTH, scale=0.1)}
    p |= {"wg": normal(WIDTH, MIX + 1, scale=0.1), "bg": np.append(np.float32(np.log(2 * MIX)), np.zeros(MIX, np.float32)).astype(np.float32)}
    p["logq"] = (np.log(unigram)[None, :] + r.standard_normal((MIX, n)) * 0.7).astype(np.float32)
    return p


def _softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=-1, keepdims=True)
    return x


def distributions(p: dict[str, np.ndarray]) -> np.ndarray:
    """The learned distributions, class by class: (classes, MIX)."""
    return np.ascontiguousarray(_softmax(p["logq"].copy()).T)


#: Windows whose arrays are worked on at once, so that they stay in a core's cache.
TOGETHER = 16
#: A window's halves, and what they may look at: the first one sees nothing of the second.
HALVES = ((slice(0, BLOCK), slice(0, BLOCK)), (slice(BLOCK, SPAN), slice(0, SPAN)))
#: Classes of which so many are left are summed one by one.
FEW = 64
#: Exponents up to here are taken as they are; rows of larger ones are first lowered by their largest.
LARGE = 40


def _tables(p: dict[str, np.ndarray]) -> list[np.ndarray]:
    """What each class is, asks, and offers as key and as value for the output; last a row of zeros for no class.

    Tables of their own, so that products are of rows that are WIDTH wide and lie one after another.
    """
    emb = p["emb"]
    rows = emb, emb @ p["wq"] * emb.dtype.type(WIDTH**-0.5), emb @ p["wk"], emb @ p["wv"] @ p["wo"]
    return [np.concatenate([x, np.zeros_like(x[:1])]) for x in rows]


def _bias(p: dict[str, np.ndarray]) -> np.ndarray:
    return (p["near"] - p["near"][0])[_AGO] + _FUTURE.astype(p["near"].dtype)


def _small(ask: np.ndarray, key: np.ndarray, p: dict[str, np.ndarray]) -> bool:
    """Whether no exponent of any classes at any distance can be large, so that none need be looked at."""
    most = [np.sqrt(np.einsum("nd,nd->n", x, x).max()) for x in (ask, key)]
    return bool(most[0] * most[1] + np.abs(p["near"] - p["near"][0]).max() <= LARGE)


def _weights(x: np.ndarray, small: bool) -> np.ndarray:
    """Exponentials of rows in place, up to a factor of each row."""
    if not small:
        x -= x.max(axis=-1, keepdims=True)
    return np.exp(x, out=x)


def _gate(p: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The gate's weights and biases over those of the successor table."""
    return p["wg"][:, 1:] - p["wg"][:, :1], p["bg"][1:] - p["bg"][0]


def _shares(x: np.ndarray) -> tuple[np.ndarray, np.ndarray | float]:
    """Exponentials of the learned distributions' logits in place, and that of the successor table's, which is zero."""
    if x.max() <= LARGE:
        return np.exp(x, out=x), 1.0
    top = np.maximum(x.max(axis=-1), 0)
    x -= top[:, None]
    return np.exp(x, out=x), np.exp(-top)


def score(p: dict[str, np.ndarray], q: np.ndarray, successor: np.ndarray, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Log probability of the targets of windows.

    inputs: (windows, SPAN) classes, -1 where there is none; targets: (windows, BLOCK), those of the second
    half, -1 where there is none.
    """
    emb, ask, key, value = _tables(p)
    bias, (wg, bg), ones, small = _bias(p)[BLOCK:], _gate(p), np.ones(MIX, np.float32), _small(ask, key, p)
    out = np.empty(targets.shape, np.float32)
    for a in range(0, len(inputs), TOGETHER):
        given, t = inputs[a : a + TOGETHER], np.maximum(targets[a : a + TOGETHER], 0).reshape(-1)
        there = (given >= 0).astype(np.float32)
        given = np.where(given < 0, len(emb) - 1, given)
        own = given[:, BLOCK:]
        e = ask.take(own, axis=0, mode="clip") @ key.take(given, axis=0, mode="clip").transpose(0, 2, 1)
        e += bias
        if not small:  # no class is not to be the largest
            e += (there[:, None] - 1) * np.float32(1e9)
        total = _weights(e, small) @ there[:, :, None]
        h = e @ value.take(given, axis=0, mode="clip")
        h /= np.maximum(total, np.float32(1e-30), out=total)
        h = h.reshape(-1, WIDTH)
        h += emb.take(own.reshape(-1), axis=0, mode="clip")
        z = h @ p["w1"]
        z += p["b1"]
        h += np.maximum(z, 0, out=z) @ p["w2"]
        g = h @ wg
        g += bg
        g, base = _shares(g)
        total = g @ ones + base
        g *= q.take(t, axis=0, mode="clip")
        prob = (g @ ones + base * successor[np.where(own < len(successor), own, 0).reshape(-1), t]) / total
        out[a : a + TOGETHER] = np.log(np.maximum(prob, 1e-30)).reshape(own.shape)
    return np.where(targets < 0, 0.0, out)


def _by_class(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows over places of one class: (n, columns).

    Rows are sorted by class, and then all classes' first rows are added, all second ones of those that have so many, and
    so on; what is left of the few frequent classes is summed class by class.
    """
    order = at.astype(np.int16).argsort(kind="stable")
    which, rows = at[order], rows.take(order, axis=0)
    first = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
    size = np.diff(np.append(first, len(which)))
    falling = np.argsort(-size, kind="stable")
    first, size = first[falling], size[falling]
    sums, ones, k = rows.take(first, axis=0), np.ones(len(rows), rows.dtype), 1
    while (left := int(np.searchsorted(-size, -k))) > FEW:
        sums[:left] += rows.take(first[:left] + k, axis=0)
        k += 1
    for j, (a, m) in enumerate(zip(first[:left].tolist(), size[:left].tolist(), strict=True)):
        sums[j] += ones[k:m] @ rows[a + k : a + m]
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    out[which[first]] = sums
    return out


def gradient(p: dict[str, np.ndarray], successor: np.ndarray, inputs: np.ndarray, targets: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss over windows (windows, SPAN) without gaps, and its gradient."""
    kind, count, classes = p["emb"].dtype, targets.size, len(p["emb"])
    scale = kind.type(WIDTH**-0.5)
    q = distributions(p)
    (emb, ask, key, value), bias, (wg, bg), ones = _tables(p), _bias(p), _gate(p), np.ones(TOGETHER * SPAN, kind)
    small, each = _small(ask, key, p), ones[:MIX]
    biases = [np.ascontiguousarray(bias[half]) for half in HALVES]
    inputs, targets = inputs.astype(np.intp), targets.astype(np.intp)
    likely = successor[inputs, targets].reshape(-1)
    back = p["wq"].T, p["wk"].T, (p["wv"] @ p["wo"]).T
    g = {k: np.zeros_like(p[k]) for k in ("w1", "b1", "w2")}
    dgate, dbias, dnear, dproject = np.zeros_like(wg), np.zeros_like(bg), np.zeros_like(bias), np.zeros((3, WIDTH, WIDTH), kind)
    # Per place, for sums by class: shares of the learned distributions, and the inputs' gradient.
    shares, dinputs = np.empty((count, MIX), kind), np.empty((count, WIDTH), kind)
    loss = 0.0
    for a in range(0, len(inputs), TOGETHER):
        here = slice(a * SPAN, (a + TOGETHER) * SPAN)
        i, t = inputs[a : a + TOGETHER], targets[a : a + TOGETHER].reshape(-1)
        x, asks, keys, values = (rows.take(i, axis=0, mode="clip") for rows in (emb, ask, key, value))
        o, part, halves = np.empty_like(x), np.empty((*i.shape, 1), kind), []
        for (asking, seen), near in zip(HALVES, biases, strict=True):
            e = asks[:, asking] @ keys[:, seen].transpose(0, 2, 1)
            e += near
            np.matmul(_weights(e, small), values[:, seen], out=o[:, asking])
            part[:, asking] = e @ ones[: e.shape[2], None]
            halves.append(e)
        np.divide(1, part, out=part)
        o *= part
        x = x.reshape(-1, WIDTH)
        h1 = o.reshape(-1, WIDTH) + x
        z = h1 @ p["w1"]
        z += p["b1"]
        np.maximum(z, 0, out=z)
        h2 = z @ p["w2"]
        h2 += h1
        w = h2 @ wg
        w += bg
        w, base = _shares(w)
        r = q.take(t, axis=0, out=shares[here], mode="clip")
        r *= w
        prob, total = np.maximum(r @ each + base * likely[here], 1e-30), w @ each + base
        loss -= float(np.log(prob / total).sum())
        r *= (1 / prob)[:, None]
        w *= (1 / total)[:, None]
        w -= r
        dgate += h2.T @ w
        dbias += ones[: len(w)] @ w
        dh = w @ wg.T
        g["w2"] += z.T @ dh
        dz = dh @ p["w2"].T
        dz *= z > 0
        g["w1"] += h1.T @ dz
        g["b1"] += ones[: len(w)] @ dz
        dh += dz @ p["w1"].T
        do = dh.reshape(o.shape) * part
        o *= do
        own = o @ ones[:WIDTH, None]
        d = np.empty((3, *o.shape), kind)  # by what is asked, keys and values
        for e, (asking, seen) in reversed(list(zip(halves, HALVES, strict=True))):
            y = do[:, asking] @ values[:, seen].transpose(0, 2, 1)
            y -= own[:, asking]
            y *= e
            dnear[asking, seen] += (ones[: len(y)] @ y.reshape(len(y), -1)).reshape(y.shape[1:])
            np.matmul(y, keys[:, seen], out=d[0, :, asking])
            dk, dv = y.transpose(0, 2, 1) @ asks[:, asking], e.transpose(0, 2, 1) @ do[:, asking]
            if seen.stop == SPAN:
                d[1], d[2] = dk, dv
            else:
                d[1, :, seen] += dk
                d[2, :, seen] += dv
        d[0] *= scale
        d = d.reshape(3, -1, WIDTH)
        dx = np.matmul(d[0], back[0], out=dinputs[here])
        for k in range(3):
            dproject[k] += x.T @ d[k]
            dx += d[k] @ back[k] if k else dh
    g["wq"], g["wk"], joined = dproject
    g["wv"], g["wo"] = joined @ p["wo"].T, p["wv"].T @ joined
    g["near"] = np.bincount(_AGO.reshape(-1), dnear.reshape(-1), SPAN)
    g["wg"], g["bg"] = np.insert(dgate, 0, -dgate.sum(axis=1), axis=1), np.insert(dbias, 0, -dbias.sum())
    g["emb"] = np.stack([np.bincount(inputs.reshape(-1), c, classes) for c in dinputs.T], axis=1)
    sums = _by_class(targets.reshape(-1), shares, classes)
    g["logq"] = (q * sums.sum(axis=0) - sums).T
    return loss / count, {k: np.asarray(x / count, kind) for k, x in g.items()}


def learn(p: dict[str, np.ndarray], successor: np.ndarray, windows: np.ndarray, steps: int, batch: int = BATCH, rate: float = 0.004) -> dict[str, np.ndarray]:
    """Some steps of Adam over windows of SPAN + 1 classes, in order and again from the start."""
    names = sorted(p)
    flat = np.concatenate([p[k].reshape(-1) for k in names])
    ends = np.cumsum([p[k].size for k in names])
    p = {k: x.reshape(p[k].shape) for k, x in zip(names, np.split(flat, ends[:-1]), strict=True)}  # views of flat
    pace = np.repeat(np.array([PACE if k == "logq" else 1 for k in names], flat.dtype), np.diff(ends, prepend=0))
    m, v, work = (np.zeros_like(flat) for _ in range(3))
    for t in range(1, steps + 1):
        at = np.arange((t - 1) * batch, t * batch) % len(windows)
        w = windows[np.unique(at)]
        _, g = gradient(p, successor, w[:, :-1], w[:, 1:])
        d = np.concatenate([g[k].reshape(-1) for k in names])
        # m and v are means of d and its square; their shares of steps not yet taken are put right in the rate.
        m += np.multiply(np.subtract(d, m, out=work), 0.1, out=work)
        d *= d
        d -= v
        d *= 0.01
        v += d
        np.sqrt(v, out=work)
        late = (1 - 0.99**t) ** 0.5
        work += 1e-8 * late
        np.divide(m, work, out=work)
        work *= pace
        work *= rate * late / (1 - 0.9**t)
        flat -= work
    return p
