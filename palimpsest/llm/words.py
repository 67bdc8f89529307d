"""Words and phrases of many texts at once: hashes by array arithmetic, no loop over words.

A word is a longest run of Unicode letters and digits of the lower-cased text. Texts are laid end to end as code points; a
polynomial hash of every prefix, taken modulo 2**64 over randomised code points, gives each word's hash by one subtraction.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15 | 1)
#: Texts are hashed in groups of about this many characters (one longer text is a group by itself).
GROUP = 400_000
#: Code points hashed at once.
BLOCK = 4_000_000
_tables: dict = {}


def mix(x):
    """Finaliser of a 64-bit hash (splitmix64's constants)."""
    x = np.asarray(x, dtype=_U)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _table():
    if "c" not in _tables:
        n = 0x110000
        alnum = np.zeros(n, bool)
        # Letters and digits lie in the planes below 0x40000 and have no gaps that matter for speed.
        alnum[:0x40000] = [chr(i).isalnum() for i in range(0x40000)]
        _tables["c"] = alnum, mix(np.arange(n, dtype=_U) + _U(1))
    return _tables["c"]


def _powers(n: int):
    """Powers of the step and of its inverse; extended as needed."""
    p = _tables.get("p")
    if p is None or len(p[0]) < n:
        size = max(n, GROUP + 1)
        inverse = _U(pow(int(_STEP), -1, 1 << 64))
        one = np.ones(size, _U)
        up, down = one.copy(), one.copy()
        up[1:], down[1:] = _STEP, inverse
        _tables["p"] = p = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return p


def groups(texts: list[str]):
    """Slices (from, to) of the list with about ``GROUP`` characters each."""
    a = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > GROUP:
            yield a, i
            a, size = i, 0
        size += len(t) + 1
    if len(texts) > a:
        yield a, len(texts)


def laid_out(texts: list[str]):
    """(lower-cased texts with a line feed after each as one string, its code points, offset of each text)."""
    lowered = [t.lower() for t in texts]
    joined = "\n".join(lowered) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    return joined, points, np.r_[0, np.cumsum([len(t) + 1 for t in lowered])]


def hash_words(points, offsets):
    """(hash, text number, first and last+1 position) per word, in order.

    Works through the code points in blocks cut between words, so one very long text needs little more memory than its code points.
    """
    alnum, _ = _table()
    inside, n, at, parts = alnum[points], len(points), 0, []
    while at < n:
        to = min(at + BLOCK, n)
        if to < n and inside[to - 1] and inside[to]:
            gaps = np.flatnonzero(~inside[at:to])
            to = at + int(gaps[-1]) + 1 if len(gaps) else n if (end := np.flatnonzero(~inside[to:])).size == 0 else to + int(end[0])
        parts.append((at, *_hash_block(points[at:to], inside[at:to])))
        at = to
    if not parts:
        return np.empty(0, _U), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    h, start, end = (np.concatenate(x) for x in ([p[1] for p in parts], [p[0] + p[2] for p in parts], [p[0] + p[3] for p in parts]))
    return h, np.searchsorted(offsets, start, "right") - 1, start, end


def _hash_block(points, inside):
    _, values = _table()
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(len(points) + 1)
    sums = np.empty(len(points) + 1, _U)
    sums[0] = 0
    np.cumsum(values[points] * up[: len(points)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start]), start, end


def word_hashes(texts: list[str]):
    """``hash_words`` of the lower-cased texts, and the texts' offsets."""
    _, points, offsets = laid_out(texts)
    return *hash_words(points, offsets), offsets


def whole_phrases(texts: list[str], size: int):
    """Distinct runs of ``size`` words per text as 64-bit hashes: (phrases, bounds), sorted within each text."""
    h, of, *_ = word_hashes(texts)
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, _U), np.zeros(len(texts) + 1, np.int64)
    p = h[:n].copy()
    for k in range(1, size):
        p = p * _U(0xD6E8FEB86659FD93) + h[k : k + n]
    whole = of[:n] == of[size - 1 :]
    p, of = mix(p[whole]), of[:n][whole]
    order = np.lexsort((p, of))
    p, of = p[order], of[order]
    new = np.r_[True, (p[1:] != p[:-1]) | (of[1:] != of[:-1])] if len(p) else np.empty(0, bool)
    return p[new], np.searchsorted(of[new], np.arange(len(texts) + 1))


def phrases(texts: list[str], size: int):
    """Distinct runs of ``size`` words per text: (phrases, bounds), phrases of text i at bounds[i]:bounds[i + 1], sorted.

    A phrase is a 44-bit hash. Texts of fewer words have none.
    """
    h, of, *_ = word_hashes(texts)
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, _U), np.zeros(len(texts) + 1, np.int64)
    p = h[:n].copy()
    for k in range(1, size):
        p = p * _U(0xD6E8FEB86659FD93) + h[k : k + n]
    whole = of[:n] == of[size - 1 :]
    key = np.sort((of[:n][whole].astype(_U) << _U(44)) | (mix(p[whole]) >> _U(20)))
    key = key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key
    bounds = np.searchsorted(key, np.arange(len(texts) + 1, dtype=_U) << _U(44))
    return key & _U((1 << 44) - 1), bounds
