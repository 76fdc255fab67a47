"""External induced sorting of suffixes with common-prefix values, to a bounded depth.

The order of a text's suffixes is induced from that of a sample, those that start at a local minimum.

* Sample.  The stretches between sampled places get names in their order (words of six symbols are compared at
  a time).  The names form a shorter string, whose suffixes are ordered by recursion: each level names pairs
  of the names before it, so a level doubles what a name stands for; it ends when all names differ or
  stand for ``depth`` symbols, beyond which nobody looks.
* Induction.  One priority queue per first symbol holds (place, rank of the place after it).  A sweep takes
  the queues in symbol order; each batch that leaves a queue gets the next ranks and puts the places before its own
  into their queues.  Ranks only grow, so a queue's entries arrive in order and it is read as it was written.
  The first sweep, upwards, orders places whose symbol is greater than the one after it, the second, downwards,
  the others.
* Common prefixes travel along: of neighbours in a queue, it is one more than the least common prefix between the
  places after them, a minimum over the ranks between the two.

Arrays above ``MEMORY`` bytes are mapped to a spill file of the task, and so are queue blocks once all queues exceed it;
the file has no name and goes with the task.
"""

from __future__ import annotations

import tempfile

import numpy as np

MEMORY = 256_000_000


class Spill:
    """Arrays in memory or, when large, in a nameless file."""

    def __init__(self, memory: int = MEMORY):
        self.memory, self.held = memory, 0

    def array(self, n: int, dtype: type) -> np.ndarray:
        size = n * np.dtype(dtype).itemsize
        if size <= self.memory // 8 or not n:
            return np.empty(n, dtype=dtype)
        with tempfile.TemporaryFile() as f:
            return np.memmap(f, dtype=dtype, mode="w+", shape=(n,))

    def hold(self, x: np.ndarray) -> np.ndarray:
        """A queue's block."""
        self.held += x.nbytes
        if self.held <= self.memory:
            return x
        out = self.array(len(x), x.dtype) if x.nbytes > self.memory // 8 else None
        if out is None:
            with tempfile.TemporaryFile() as f:
                out = np.memmap(f, dtype=x.dtype, mode="w+", shape=x.shape)
        out[:] = x
        self.held -= x.nbytes
        return out

    def release(self, x: np.ndarray) -> None:
        if not isinstance(x, np.memmap):
            self.held -= x.nbytes


class Queues:
    """A queue of (place, rank of the next place) per first symbol."""

    def __init__(self, spill: Spill):
        self.blocks: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(257)]
        self.spill = spill

    def put(self, symbol: np.ndarray, place: np.ndarray, rank: np.ndarray) -> None:
        if not len(symbol):
            return
        order = np.argsort(symbol, kind="stable")
        symbol = symbol[order]
        cut = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1])).tolist()
        for a, b in zip(cut, [*cut[1:], len(symbol)], strict=True):
            self.blocks[int(symbol[a])].append((self.spill.hold(place[order[a:b]]), self.spill.hold(rank[order[a:b]])))

    def take(self, symbol: int) -> tuple[np.ndarray, np.ndarray] | None:
        blocks = self.blocks[symbol]
        if not blocks:
            return None
        self.blocks[symbol] = []
        out = np.concatenate([p for p, _ in blocks]), np.concatenate([r for _, r in blocks])
        for b in blocks:
            for x in b:
                self.spill.release(x)
        return out


def _ranks(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """For rows in the given order: where the row's class (equal keys) starts in it."""
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return out


def _refine(rank: np.ndarray, key: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Splits classes by a further key of the rows among; ranks stay places in the order."""
    r, k = rank[among], key
    order = np.lexsort((k, r))
    rs, ks = r[order], k[order]
    at = np.arange(len(order))
    first = np.append(True, rs[1:] != rs[:-1]) if len(rs) else np.zeros(0, bool)
    split = first.copy()
    split[1:] |= ks[1:] != ks[:-1]
    begin = np.maximum.accumulate(np.where(first, at, 0))
    out = rank.copy()
    out[among[order]] = rs + np.maximum.accumulate(np.where(split, at, 0)) - begin
    return out


def _tied(rank: np.ndarray) -> np.ndarray:
    """Rows that share their rank."""
    return np.flatnonzero(np.bincount(rank, minlength=len(rank))[rank] > 1)


def sample_order(symbols: np.ndarray, low: np.ndarray, sample: np.ndarray, depth: int) -> np.ndarray:
    """The sampled suffixes' order, to the depth.  low: whether a suffix is less than the next one."""
    wide = symbols.astype(np.int64) * 2 + low
    pad = np.concatenate([wide + 1, np.zeros(8, np.int64)])
    length = np.diff(np.append(sample, sample[-1])) + 1

    def word(rows: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros(len(rows), dtype=np.int64)
        begin, size = sample[rows], length[rows]
        for j in range(6 * k, 6 * k + 6):
            out = (out << 10) | np.where(j < size, pad[np.minimum(begin + j, len(pad) - 1)], 0)
        return out

    everyone = np.arange(len(sample))
    key = word(everyone, 0)
    rank = _ranks(np.argsort(key, kind="stable"), key)
    k = 1
    while True:
        tied = _tied(rank)
        tied = tied[length[tied] > 6 * k]
        if not len(tied):
            break
        rank = _refine(rank, word(tied, k), tied)
        k += 1
    # The recursion: names of pairs of names.
    span = 1
    while span < len(sample):
        tied = _tied(rank)
        tied = tied[sample[np.minimum(tied + span, len(sample) - 1)] - sample[tied] < depth]
        if not len(tied):
            break
        after = np.where(tied + span < len(sample), rank[np.minimum(tied + span, len(sample) - 1)], -1)
        # Whoever is tied with a row that goes on must go on with it: classes are of equal reach.
        rank = _refine(rank, after, tied)
        span *= 2
    return np.argsort(rank, kind="stable")


def common_prefix(data: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefixes of pairs of suffixes, by eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(depth + 16, np.uint8)])
    at = np.ndarray((len(padded) - 8,), dtype=">u8", buffer=padded, strides=(1,))
    out = np.minimum(depth, len(data) - np.maximum(a, b)).astype(np.int64)
    live = np.arange(len(a))
    for k in range(0, depth, 8):
        x = at[a[live] + k].astype(np.uint64) ^ at[b[live] + k].astype(np.uint64)
        stop = x != 0
        if stop.any():
            # The first byte that differs: the number of leading zero bytes.
            zeros = sum((x[stop] >> np.uint64(8 * j) == 0).astype(np.int64) for j in range(1, 8))
            rows = live[stop]
            out[rows] = np.minimum(out[rows], k + zeros)
            live = live[~stop]
        if not len(live):
            break
    return out


def suffix_order(data: np.ndarray, depth: int, memory: int = MEMORY) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in their order to the depth (ties beyond it in any order), and each one's common prefix with the one
    before it, at most depth (which is at most 254)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    spill = Spill(memory)
    symbols = np.zeros(n + 1, dtype=np.int16)
    symbols[:n] = data
    symbols[:n] += 1
    # low: the suffix is less than the next one.  A run of one symbol is as its last place.
    ends = np.append(np.flatnonzero(symbols[1:] != symbols[:-1]), n)
    runs = np.diff(np.append(-1, ends))
    ends_low = np.append(symbols[ends[:-1]] < symbols[ends[:-1] + 1], True)
    low = np.repeat(ends_low, runs)
    left_in_run = np.repeat(ends, runs) - np.arange(n + 1) + 1
    sampled = low.copy()
    sampled[0] = False
    sampled[1:] &= ~low[:-1]
    sample = np.flatnonzero(sampled)  # the end itself is one
    order = sample[sample_order(symbols, low, sample, depth)]
    near = np.zeros(len(order), dtype=np.uint8)
    near[1:] = common_prefix(data, order[:-1], order[1:], depth)
    seeds = np.searchsorted(symbols[order], np.arange(258))

    def sweep(up: bool, seed_of) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:  # noqa: ANN001
        """One pass.  seed_of(symbol): places that are given, with common prefixes among them."""
        out, lcp = spill.array(n + 1, np.int64), spill.array(n + 1, np.uint8)
        queues, done = Queues(spill), 0
        spans: list[tuple[int, int]] = [(0, 0)] * 257
        wanted = ~low if up else low

        def place(p: np.ndarray, common: np.ndarray) -> None:
            nonlocal done
            out[done : done + len(p)], lcp[done : done + len(p)] = p, common
            rank = np.arange(done, done + len(p))
            done += len(p)
            use = p > 0
            use[use] = wanted[p[use] - 1]
            before = p[use] - 1
            queues.put(symbols[before], before, rank[use])

        for symbol in range(257) if up else range(256, -1, -1):
            begin, last_next, last = done, -1, -1
            while (batch := queues.take(symbol)) is not None:
                p, nxt = batch
                common = np.zeros(len(p), dtype=np.uint8)
                starts = np.append(last_next, nxt[:-1]) + 1
                if last_next >= 0:
                    least = np.minimum.reduceat(lcp[: nxt[-1] + 1], starts)
                    common[:] = np.minimum(least.astype(np.int64) + 1, depth)
                elif len(p) > 1:
                    least = np.minimum.reduceat(lcp[: nxt[-1] + 1], starts[1:])
                    common[1:] = np.minimum(least.astype(np.int64) + 1, depth)
                last_next, last = int(nxt[-1]), int(p[-1])
                place(p, common)
            spans[symbol] = (begin, done)
            given, common = seed_of(symbol)
            if len(given):
                common = common.copy()
                common[0] = min(left_in_run[last], left_in_run[given[0]], depth) if last >= 0 else 0
                place(given, common)
        return out[:done], lcp[:done], spans

    up, up_lcp, spans = sweep(True, lambda c: (order[seeds[c] : seeds[c + 1]], near[seeds[c] : seeds[c + 1]]))

    def high(c: int) -> tuple[np.ndarray, np.ndarray]:
        """The places that the first sweep ordered, downwards, each with what it shares with the one above it."""
        a, b = spans[c]
        return up[a:b][::-1], np.append(np.uint8(0), up_lcp[a + 1 : b][::-1]) if b > a else up_lcp[:0]

    # The end of the text is the least suffix; it is given to the sweep that starts from the other side.
    down, down_lcp, _ = sweep(False, lambda c: (np.array([n]), np.zeros(1, np.uint8)) if c == 0 else high(c))
    result, common = down[::-1], down_lcp[::-1]
    keep = result != n
    shared = np.append(np.uint8(0), common[:-1])
    return result[keep], shared[keep]
