"""Order MinHash sketches of word sequences, and their banded alignment.

A sketch component takes the L minimum k-mers under one hash function, k-mers labelled by
occurrence (the second "a b c d e" of a text differs from its first), and keeps them in
text order: two texts agree in a component if they share these k-mers and their order, so
agreement follows edit similarity rather than set overlap.
"""

from __future__ import annotations

from collections import Counter
from operator import ne

import numpy as np
import xxhash

#: Words of a k-mer, k-mers of a component, components of a sketch.
K, L, M = 5, 2, 128
#: Texts of at most LONG words have too few k-mers of K words for a pair near the threshold to share any: their sketches
#: are of shorter k-mers. Texts of up to LONG / 0.8 words have both kinds, so that any two near texts have one in common.
LONG, SHORT_K, SHORT_M = 100, 3, 48
#: Texts of at most so many words also have segment keys.
SHORT = 24
#: Bins of words that bound the edit distance of a pair from below.
BINS = 256
_rng = np.random.default_rng(20)
XOR = _rng.integers(0, 2**63, 512, dtype=np.uint64)
#: Functions that order k-mers, of 32 bits.
XOR_32 = _rng.integers(0, 2**32, 512, dtype=np.uint32)
MUL_32 = _rng.integers(0, 2**31, 512, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
POWERS = np.array([pow(0x9E3779B97F4A7C15, j, 2**64) for j in range(64)], np.uint64)
#: Words of a block of rows of an alignment.
BLOCK = 4096
#: k-mer hashes times components that are held at once.
AT_ONCE = 65_536
#: Bits of a set of pairs of words at least, and 64-bit words of such sets that are compared at once.
BITS, HELD = 512, 2**18


class Words(dict):
    """Word to 64-bit number; forgets all when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        self[word] = x = xxhash.xxh64_intdigest(word)
        return x


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def kmers(numbers: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of the k-mers of a word sequence, labelled by occurrence. A sequence shorter than k is one k-mer; an empty one has none."""
    n = len(numbers)
    if not n:
        return numbers
    k = min(k, n)
    h = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        h += numbers[j : n - k + 1 + j] * POWERS[j]
    h = mixed(h)
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.concatenate(([True], s[1:] != s[:-1]))
    if not new.all():
        place = np.arange(len(s))
        label = place - np.maximum.accumulate(np.where(new, place, 0))
        again = label > 0
        h[order[again]] = mixed(s[again] + label[again].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return h


def sketch(h: np.ndarray, m: int = M, size: int = L) -> np.ndarray:
    """m components of the labelled k-mer hashes in text order, each a hash of the `size` minima under one function. No k-mers: no components."""
    if not len(h):
        return np.zeros(0, np.int64)
    size = min(size, len(h))
    out = np.empty(m, np.uint64)
    step = max(1, AT_ONCE // len(h))
    upper = (h >> np.uint64(32)).astype(np.uint32)[None, :]
    for a in range(0, m, step):
        b = min(m, a + step)
        v = (upper ^ XOR_32[a:b, None]) * MUL_32[a:b, None]
        rows = np.arange(b - a)
        least = np.empty((b - a, size), np.int64)
        for i in range(size):
            least[:, i] = v.argmin(axis=1)
            v[rows, least[:, i]] = 2**32 - 1
        least.sort(axis=1)
        x = XOR[a:b].copy()
        for i in range(size):
            x = mixed(x * np.uint64(0x9E3779B97F4A7C15) + h[least[:, i]])
        out[a:b] = x
    return out.view(np.int64)


def segments(numbers: np.ndarray, least: float = 0.8) -> np.ndarray:
    """Keys of a text of at most SHORT words: any two such texts with `similar` share one.

    The longer text of n words in k + 1 segments, k the edits allowed, has one that no edit
    touches; the shorter has it too, moved by what the edits before and after it allow.
    """
    m, out = len(numbers), set()
    if m > SHORT:
        return np.zeros(0, np.int64)
    for n in range(m, SHORT + 1) if m else ():
        k, gap = int((1 - least) * n + 1e-9), n - m
        if gap > k:
            break
        for i in range(k + 1):
            a, b = i * n // (k + 1), (i + 1) * n // (k + 1)
            for at in range(max(0, a - (k + gap) // 2), min(m - (b - a), a + (k - gap) // 2) + 1):
                out.add(xxhash.xxh64_intdigest(numbers[at : at + b - a].tobytes(), seed=n * 32 + i))
    return np.array(sorted(out), np.uint64).view(np.int64)


def keys(numbers: np.ndarray, least: float = 0.8) -> np.ndarray:
    """Bucket keys of a word sequence: components of its sketches, and segments if it is short. No words: no keys."""
    n = len(numbers)
    if not n:
        return np.zeros(0, np.int64)
    found = []
    if n > LONG:
        found.append(sketch(kmers(numbers, K), M))
    if n * least <= LONG:
        found.append(sketch(kmers(numbers, SHORT_K), SHORT_M))
    if n <= SHORT:
        found.append(segments(numbers, least))
    return np.unique(np.concatenate(found))


def bag(numbers: np.ndarray) -> bytes:
    """Counts of the words in BINS bins, 255 at most: half the distance of two bags is a lower bound of the edit distance."""
    return np.minimum(np.bincount((numbers & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS), 255).astype(np.uint8).tobytes()


def possible(x: int, near: np.ndarray, bags: np.ndarray, coarse: np.ndarray, n: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Those of near that may be similar to x by their bags, and the bounds of their distances. No pair that is similar is left out."""
    most = (1 - least) * np.maximum(n[near], n[x]) + 1e-6
    apart = np.abs(n[near] - n[x])
    for counts in (coarse, bags):
        moved = (np.abs(counts[near].astype(np.int32) - counts[x]).sum(axis=1) + apart) / 2
        keep = moved <= most
        near, most, apart, moved = near[keep], most[keep], apart[keep], moved[keep]
    return near, moved


def grams(numbers: np.ndarray) -> bytes:
    """The set of a text's pairs of neighbouring words, as bits: a power of two of them, of four times its words or more.

    An edit takes away or adds four pairs at most, so a quarter of the number of bits in which two
    texts differ is a lower bound of their edit distance that feels order.
    """
    bits = max(BITS, 1 << (4 * len(numbers) - 1).bit_length()) if len(numbers) else BITS
    h = mixed(numbers[:-1] * POWERS[1] + numbers[1:] * POWERS[2])
    out = np.zeros(bits, np.uint8)
    out[(h & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out).tobytes()


def folded(bits: np.ndarray, words_: int) -> np.ndarray:
    """Rows of bits in fewer 64-bit words."""
    return np.bitwise_or.reduce(bits.reshape(len(bits), -1, words_), axis=1)


def in_order(x: int, near: np.ndarray, grams_: list[bytes], n: np.ndarray, least: float) -> np.ndarray:
    """Which of near may be similar to x by their pairs of words. No pair that is similar is left out."""
    mine = np.frombuffer(grams_[x], np.uint64)[None, :]
    sizes = np.array([len(grams_[y]) // 8 for y in near])
    most = 4 * ((1 - least) * np.maximum(n[near], n[x]) + 1e-6)
    out = np.ones(len(near), bool)
    for size in np.unique(sizes):
        words_ = min(int(size), mine.shape[1])
        own = folded(mine, words_)
        which = np.flatnonzero(sizes == size)
        step = max(1, HELD // int(size))
        for at in range(0, len(which), step):
            some = which[at : at + step]
            others = np.frombuffer(b"".join(grams_[near[i]] for i in some), np.uint64).reshape(len(some), size)
            out[some] = np.bitwise_count(folded(others, words_) ^ own).sum(axis=1) <= most[some]
    return out


def bag_distance(a: list, b: list) -> int:
    """A lower bound of the edit distance: words of the longer sequence that the other lacks."""
    return max(len(a), len(b)) - sum((Counter(a) & Counter(b)).values())


def distance(a: list, b: list, most: int, block: int = BLOCK) -> int | None:
    """Edit distance of two word sequences if it is at most `most`, else None.

    Banded alignment: cells further than `most` from the diagonal are left out, as paths
    through them cost more. Rows go in blocks of words whose columns are bit vectors, so
    memory is that of a block and one row of deltas, whatever the texts' length.
    """
    lo, n = 0, min(len(a), len(b))
    while lo < n and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < n - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    a, b = a[lo : len(a) - hi], b[lo : len(b) - hi]
    longest = max(len(a), len(b))
    if abs(len(a) - len(b)) > most:
        return None
    if not a or not b:
        return longest
    if most < longest and bag_distance(a, b) > most:
        return None
    n = len(b)
    above: list[int] | None = None  # deltas of the row above, from column above_at on
    above_at, corner = 0, 0  # corner: distance at the row above, column above_at
    for top in range(0, len(a), block):
        part = a[top : top + block]
        size = len(part)
        places: dict = {}
        for i, w in enumerate(part):
            places[w] = places.get(w, 0) | (1 << i)
        start, stop = max(0, top - most), min(n, top + size + most)
        if above is None:
            corner = start
        else:
            corner += sum(above[: start - above_at])
        mask, high = (1 << size) - 1, 1 << (size - 1)
        pv, mv, out = mask, 0, []
        for j in range(start, stop):
            at = j - above_at
            into = 1 if above is None or at >= len(above) else above[at]
            eq = places.get(b[j], 0)
            xv = eq | mv
            if into < 0:
                eq |= 1
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | (mask & ~(xh | pv))
            mh = pv & xh
            out.append(1 if ph & high else -1 if mh & high else 0)
            ph = ((ph << 1) & mask) | (into > 0)
            mh = ((mh << 1) & mask) | (into < 0)
            pv = mh | (mask & ~(xv | ph))
            mv = ph & xv
        above, above_at = out, start
        corner += size
    found = corner + sum(above)
    return found if found <= most else None


def edits(a: list, b: list, least: float = 0.8) -> tuple[bool, int]:
    """Whether 1 - distance / longer length >= least, and a bound of the distance: from above if so, else from below.

    Where the alignment without gaps already has few enough edits, the band isn't needed; of
    texts of one block the band is as wide as they are, at no more work.
    """
    longest = max(len(a), len(b))
    most = int((1 - least) * longest + 1e-9)
    if len(a) == len(b) and (n := sum(map(ne, a, b))) <= most:
        return True, n
    if (n := max(abs(len(a) - len(b)), bag_distance(a, b))) > most:
        return False, n
    d = distance(a, b, longest if longest <= BLOCK else most)
    return (False, most + 1) if d is None else (d <= most, d)


def similar(a: list, b: list, least: float = 0.8) -> bool:
    """1 - distance / longer length >= least. Two empty sequences are similar."""
    return edits(a, b, least)[0]
