"""Token ids of whole texts by a byte-level BPE file of the tokenizers library.

Such a tokenizer first cuts a text into words and encodes each word by itself.  The cut is done here by
array operations over all texts of a group at once, and a word's ids come from the library once and from a
bounded cache afterwards, which goes with the task.  Texts with code points whose class may differ between libraries go to the
tokenizer as they are, and so do texts that hold the string of an added token (``<|endoftext|>``), which is one id.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np

from .hashing import range_hashes

#: Places for words in the cache, and ids that it holds before it is cleared: some 100 MB, for two million words.
CACHE_SLOTS = 1 << 21
CACHE_IDS = 9_000_000
#: Letters, digits and white space below this code point are the same in all Unicode versions.
SURE = 0x590
OTHER, LETTER, NUMBER, SPACE = range(4)


@lru_cache(1)
def classes() -> np.ndarray:
    import unicodedata

    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(SURE)], dtype=np.uint8)
    out[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0]] = SPACE
    return out


def word_starts(code: np.ndarray, row_start: np.ndarray) -> np.ndarray:
    """Where the tokenizer's words start: contractions, letters, digits or other signs with one space before
    them at most, and white space, of which the last sign before a word stands alone."""
    n = len(code)
    kind = classes()[code]
    run = row_start.copy()
    run[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    ends = np.ones(n, dtype=bool)  # the run's last sign
    ends[:-1] = run[1:]
    row_end = np.ones(n, dtype=bool)
    row_end[:-1] = row_start[1:]
    start = run.copy()
    last = space & ends & ~row_end  # the last white space before a word
    start |= last
    joins = last & (code == 0x20)
    start[1:] &= ~joins[:-1]
    # 's 't 'm 'd 're 've 'll, where the apostrophe starts a word
    at = np.flatnonzero((code == 0x27) & start & run & ends & ~row_end)
    at = at[at + 1 < n]
    if len(at):
        a, b = code[at + 1], np.where(at + 2 < n, code[np.minimum(at + 2, n - 1)], 0)
        b = np.where((at + 2 < n) & ~row_start[np.minimum(at + 2, n - 1)], b, 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        hit = one | two
        start[at[hit] + 1] = False
        rest = at[hit] + np.where(one[hit], 2, 3)
        rest = rest[rest < n]
        start[rest[(kind[rest] == LETTER)]] = True
    return start


def _with_room(x: np.ndarray, n: int) -> np.ndarray:
    """x, twice as long if n do not fit, so that adding bit by bit copies little."""
    return x if len(x) >= n else np.concatenate([x, np.zeros(max(n - len(x), len(x)), x.dtype)])


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Strings that stand for an id of their own wherever a text holds them.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        # Byte-level files write a byte that can't be seen as a character from 256 on.
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in seen]
        self.signs = {b: b for b in seen} | {b: 256 + k for k, b in enumerate(hidden)}
        self.small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.clear()

    def clear(self) -> None:
        self.hashes, self.places = np.zeros(CACHE_SLOTS, np.uint64), np.full(CACHE_SLOTS, -1, np.int32)
        self.bounds, self.ids = np.zeros(1, np.int64), np.zeros(0, np.uint16 if self.small else np.uint32)
        self.n_words, self.n_ids = 0, 0  # used of these

    def _slots(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        for shift in (0, 40):
            yield ((hashes >> np.uint64(shift)) & np.uint64(CACHE_SLOTS - 1)).astype(np.int64)

    def ids_of(self, hashes: np.ndarray, word: Callable[[int], bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given by hash; word(k) gives the bytes of the k-th.  Returns all ids and each word's number."""
        if self.n_ids > CACHE_IDS:
            self.clear()
        which = np.full(len(hashes), -1, np.int64)
        for slot in self._slots(hashes):
            hit = self.hashes[slot] == hashes
            which[hit] = self.places[slot[hit]]
        new = np.flatnonzero(which < 0)
        if len(new):
            different, first, back = np.unique(hashes[new], return_index=True, return_inverse=True)
            tokenize, signs = self.model.tokenize, self.signs
            found = [[t.id for t in tokenize(word(k).decode("latin-1").translate(signs))] for k in new[first].tolist()]
            n = np.fromiter(map(len, found), np.int64, len(found))
            own = self.n_words + np.arange(len(found))
            which[new] = own[back]
            words, ids = self.n_words + len(found), self.n_ids + int(n.sum())
            self.bounds, self.ids = _with_room(self.bounds, words + 1), _with_room(self.ids, ids)
            self.bounds[self.n_words + 1 : words + 1] = self.n_ids + np.cumsum(n)
            self.ids[self.n_ids : ids] = np.fromiter(chain.from_iterable(found), self.ids.dtype, ids - self.n_ids)
            self.n_words, self.n_ids = words, ids
            # A word goes to one of its two places that is free; whoever came first stays, as frequent words come early.
            left = np.ones(len(own), dtype=bool)
            for slot in self._slots(different):
                free = left & (self.places[slot] < 0)
                self.hashes[slot[free]], self.places[slot[free]] = different[free], own[free]
                left &= self.hashes[slot] != different
        start = self.bounds[which]
        n = self.bounds[which + 1] - start
        ends = np.cumsum(n)
        return self.ids[np.repeat(start - ends + n, n) + np.arange(int(n.sum()))].astype(np.uint32), n

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, and each text's number of them."""
        joined = "".join(texts)
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(size, out=bounds[1:])
        marked = {k for a in self.added if a in joined for k, t in enumerate(texts) if a in t}
        if marked or len(code) and int(code.max()) >= SURE:
            odd = np.flatnonzero(code >= SURE)
            return self._with_odd(texts, marked | set(np.unique(np.searchsorted(bounds, odd, side="right") - 1).tolist()))
        row_start = np.zeros(len(code), dtype=bool)
        row_start[bounds[:-1][size > 0]] = True
        if not len(code):
            return np.zeros(0, np.uint32), size
        start = np.flatnonzero(word_starts(code, row_start))
        stop = np.append(start[1:], len(code))
        narrow = code.astype(np.uint16).view(np.uint8)
        ids, n = self.ids_of(range_hashes(narrow, 2 * start, 2 * stop), lambda k: joined[start[k] : stop[k]].encode())
        ends = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=ends[1:])
        return ids, np.diff(ends[np.searchsorted(start, bounds)])

    def _with_odd(self, texts: list[str], odd: set[int]) -> tuple[np.ndarray, np.ndarray]:
        plain, n = self.encode([t for k, t in enumerate(texts) if k not in odd])
        whole = iter(self.tokenizer.encode_batch([texts[k] for k in sorted(odd)], add_special_tokens=False))
        ends = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=ends[1:])
        parts, k = [], 0
        for row in range(len(texts)):
            if row in odd:
                parts.append(np.array(next(whole).ids, np.uint32))
            else:
                parts.append(plain[ends[k] : ends[k + 1]])
                k += 1
        return np.concatenate([*parts, np.zeros(0, np.uint32)]), np.array([len(p) for p in parts], np.int64)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One per Python worker and file."""
    return Encoder(path)


def starting_ids(path: str) -> np.ndarray:
    """Which ids of a file begin with a space."""
    vocab = encoder(path).tokenizer.get_vocab()
    out = np.zeros(max(vocab.values()) + 1, dtype=bool)
    out[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True  # a space in byte-level files
    return out


def public_file(name: str) -> Callable[[], str]:
    """Where an installed vocabulary file lies, asked on the executor that reads it."""

    def find() -> str:
        import public_tokenizers

        return public_tokenizers.path(name)

    return find
