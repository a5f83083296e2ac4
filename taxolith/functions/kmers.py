"""K-mers by minimiser: stretches of k-mers travel together, equal k-mers meet."""

from __future__ import annotations

#: Letters of a minimiser.
MINIMISER = 12
BASES = "ACGT"


def codes_of(texts: list[str], letters: str | None = None):
    """Code points of texts one after the other, one mark between them; which places no k-mer may cover; where each text starts.

    With ``letters`` all others are such places.
    """
    import numpy as np

    codes = np.frombuffer("\0".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    bad = np.zeros(len(codes), bool) if letters is None else ~np.isin(codes, [ord(c) for c in letters])
    bad[starts[1:] - 1] = True
    return codes, bad, starts


def super_kmers(codes, bad, k: int):
    """Maximal stretches whose k-mers share a minimiser: arrays of starts, ends and minimisers.

    The minimiser of a k-mer is its m-mer with the least hash; equal k-mers have equal ones.
    K-mers that cover a place marked ``bad`` belong to no stretch.
    """
    import numpy as np

    m, n = min(MINIMISER, k), len(codes) - k + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none
    before = np.concatenate([[0], np.cumsum(bad)])
    good = before[k:] == before[:-k]
    mixed = np.zeros(len(codes) - m + 1, np.uint64)
    for j in range(m):
        mixed = (mixed ^ codes[j : j + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed >>= np.uint64(1)
    # the least of every k - m + 1 neighbours, from the least of powers of two of them
    least, width, window = mixed, 1, k - m + 1
    while 2 * width <= window:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    least = np.minimum(least[:n], least[window - width : window - width + n])
    moved = least[1:] != least[:-1]
    begin = good & np.concatenate([[True], moved | ~good[:-1]])
    end = good & np.concatenate([moved | ~good[1:], [True]])
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + k, least[starts].astype(np.int64)
