"""Fuzzy string ratios on a 0 to 100 scale, one Arrow round trip for all of a pair.

The functions of two texts say what a ratio is; those of many pairs (_many) give the same values, pairs side by side.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over a."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Twice the common subsequence over both lengths; two empty texts are alike."""
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter text with a window of the longer, windows clipped at its ends included.

    Two texts of one length are tried either way.
    """
    if not a or not b:
        return 100.0 if a == b else 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    best = _windows(short, long)
    return max(best, _windows(long, short)) if len(a) == len(b) and best < 100 else best


def _windows(short: str, long: str) -> float:
    n, best, letters = len(short), 0.0, set(short)
    for end in range(1, len(long) + n):
        part = long[max(0, end - n) : end]
        # a best window starts or ends at a letter that the short text has
        if part and (part[-1] in letters or part[0] in letters):
            best = max(best, ratio(short, part))
            if best == 100.0:
                break
    return best


def _sorted(text: str) -> str:
    return " ".join(sorted(text.split()))


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(_sorted(a), _sorted(b))


def _sets(a: str, b: str) -> tuple[str, str, str]:
    x, y = set(a.split()), set(b.split())
    return " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))


def token_set_ratio(a: str, b: str) -> float:
    """Best ratio among the common words and the common words with either rest; 100 when a rest is empty."""
    if not a.split() or not b.split():
        return 0.0
    both, x, y = _sets(a, b)
    if both and not (x and y):
        return 100.0
    first, second = f"{both} {x}".strip(), f"{both} {y}".strip()
    best = ratio(first, second)
    return max(best, ratio(both, first), ratio(both, second)) if both else best


def partial_token_ratio(a: str, b: str) -> float:
    """Partial ratio of sorted words and of the words not in common; 100 when a word is in common."""
    if not a.split() or not b.split():
        return 0.0
    both, x, y = _sets(a, b)
    return 100.0 if both else max(partial_ratio(_sorted(a), _sorted(b)), partial_ratio(x, y))


def weighted_ratio(a: str, b: str) -> float:
    """Ratio of whole texts, or of parts and words at a discount; parts count where lengths differ by half."""
    if not a or not b:
        return 0.0
    apart = max(len(a), len(b)) / min(len(a), len(b))
    if apart < 1.5:
        return max(ratio(a, b), 0.95 * max(token_sort_ratio(a, b), token_set_ratio(a, b)))
    part = 0.9 if apart <= 8 else 0.6
    return max(ratio(a, b), part * partial_ratio(a, b), 0.95 * part * partial_token_ratio(a, b))


def jaro_winkler(a: str, b: str, scale: float = 0.1) -> float:
    """Similarity from 0 to 1; a common start of up to four letters counts extra above 0.7."""
    if a == b:
        return 1.0 if a else 0.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    used = [False] * len(b)
    found = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                found.append(c)
                break
    m = len(found)
    if not m:
        return 0.0
    turned = sum(x != y for x, y in zip(found, (c for c, u in zip(b, used, strict=True) if u), strict=True)) / 2
    jaro = (m / len(a) + m / len(b) + (m - turned) / m) / 3
    start = 0
    while start < min(4, len(a), len(b)) and a[start] == b[start]:
        start += 1
    return jaro + start * scale * (1 - jaro) if jaro > 0.7 else jaro


#: Pairs that are compared side by side: their columns stay in a core's cache.
SIDE = 4096


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(places x texts) of characters as numbers from 2 on, 0 beyond a text's end, and the lengths."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(int(flat.max(initial=0)) + 1, bool)
    seen[flat] = True
    number = seen.cumsum() + 1
    out = np.zeros((len(texts), int(sizes.max(initial=0))), np.uint8 if number[-1] < 256 else np.uint32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = number[flat]
    return np.ascontiguousarray(out.T), sizes


def _side_by_side(a: list[str], b: list[str], f: Callable) -> np.ndarray:
    """f of (codes, codes, lengths, lengths) for pairs of about one length, in the order of the pairs."""
    out = np.zeros(len(a))
    order = np.lexsort((np.fromiter(map(len, b), np.int64, len(b)), np.fromiter(map(len, a), np.int64, len(a))))
    for at in range(0, len(a), SIDE):
        part = order[at : at + SIDE]
        both, sizes = _codes([a[k] for k in part] + [b[k] for k in part])
        n = len(part)
        x, y = both[: sizes[:n].max(), :n], both[: sizes[n:].max(), n:]
        out[part] = f(np.ascontiguousarray(x), np.where(y, y, 1).astype(y.dtype), sizes[:n], sizes[n:])
    return out


def _lcs(x: np.ndarray, y: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Strands of the alignment grid as bits: those that leave below a text's characters came in from its left."""
    down = np.ones(y.shape, bool)
    for row in x:
        across = np.zeros(row.shape, bool)
        for j, column in enumerate(y):
            equal, v = row == column, down[j]
            turn = v & (across | equal)
            down[j] = across | (v > equal)
            across = turn
    return n - (down & (np.arange(len(y))[:, None] < n)).sum(0)


def _best_window(x: np.ndarray, y: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Best ratio of x with a window of y, from one pass over the grid that serves all windows (semi-local LCS).

    Every strand carries the place where it came in. A window's LCS is its length less the strands that come in and
    leave within it: such a strand leaving at j that came in at s counts for the windows that end at j + 1 to s + m.
    Windows without a letter of x at either end are never better than one that has it, so all may count.
    """
    rows, columns, pairs = len(x), len(y), len(m)
    kind = np.uint8 if rows + columns < 256 else np.int32
    down = np.repeat(np.arange(rows, rows + columns, dtype=kind)[:, None], pairs, 1)
    for i, row in enumerate(x):
        across = np.full(pairs, rows - 1 - i, kind)
        for j, column in enumerate(y):
            v = down[j]
            low, high = np.minimum(across, v), np.maximum(across, v)
            change = (low ^ high) * ((row == column) & (across < v))
            across = low ^ change
            down[j] = high ^ change
    start = down.astype(np.int32) - rows
    j, k = np.nonzero((start >= 0) & (np.arange(columns)[:, None] < n) & (start + m > np.arange(columns)[:, None]))
    ends = rows + columns + 1
    inside = np.bincount((j + 1) * pairs + k, minlength=ends * pairs) - np.bincount((start[j, k] + m[k] + 1) * pairs + k, minlength=ends * pairs)
    inside = inside.reshape(ends, pairs).cumsum(0)
    end = np.arange(ends)[:, None]
    width = np.minimum(end, n) - np.maximum(end - m, 0)
    return np.where(width > 0, 200.0 * (width - inside) / np.maximum(m + width, 1), 0.0).max(0)


def ratio_many(a: list[str], b: list[str]) -> np.ndarray:
    """ratio() of pairs; equal pairs are compared once."""
    known = {p: k for k, p in enumerate(dict.fromkeys(zip(a, b, strict=True)))}
    found = _side_by_side([x for x, _ in known], [y for _, y in known], lambda x, y, m, n: np.where(m + n > 0, 200.0 * _lcs(x, y, m, n) / np.maximum(m + n, 1), 100.0))
    return found[[known[p] for p in zip(a, b, strict=True)]]


def partial_ratio_many(a: list[str], b: list[str]) -> np.ndarray:
    """partial_ratio() of pairs of which no text is empty."""
    short = [x if len(x) <= len(y) else y for x, y in zip(a, b, strict=True)]
    long = [y if len(x) <= len(y) else x for x, y in zip(a, b, strict=True)]
    best = _side_by_side(short, long, _best_window)
    turn = [k for k, (x, y) in enumerate(zip(short, long, strict=True)) if len(x) == len(y)]
    best[turn] = np.maximum(best[turn], _side_by_side([long[k] for k in turn], [short[k] for k in turn], _best_window))
    return best


def _jaro_winkler(x: np.ndarray, y: np.ndarray, m: np.ndarray, n: np.ndarray, scale: float = 0.1) -> np.ndarray:
    """jaro_winkler() of texts of up to 64 characters, their places as bits."""
    pairs, one = np.arange(len(m)), np.uint64(1)
    letters = int(max(x.max(), y.max())) + 1
    table = np.zeros(len(m) * letters, np.uint64)
    for j, column in enumerate(y):
        table[pairs * letters + column] |= one << np.uint64(j)
    below = np.r_[(one << np.arange(64, dtype=np.uint64)) - one, ~np.uint64(0)]  # bits below a place
    reach = np.maximum(m, n) // 2 - 1
    used, same, found = np.zeros(len(m), np.uint64), [], []
    for i, row in enumerate(x):
        same.append(np.where(i < m, table[pairs * letters + row], np.uint64(0)))
        open_ = below[np.clip(i + reach + 1, 0, n)] & ~below[np.clip(i - reach, 0, 64)] & same[-1] & ~used
        low = open_ & (~open_ + one)
        used |= low
        found.append(low != 0)
    rest, turned = used.copy(), np.zeros(len(m))
    for hit, places in zip(found, same, strict=True):
        low = rest & (~rest + one)
        turned += hit & ((low & places) == 0)
        rest = np.where(hit, rest ^ low, rest)
    hits = np.bitwise_count(used).astype(np.int64)
    jaro = np.where(hits > 0, (hits / m + hits / n + (hits - turned / 2) / np.maximum(hits, 1)) / 3, 0.0)
    begin = np.zeros(len(m), np.int64)
    for i in range(min(4, len(x), len(y))):
        begin += (begin == i) & (x[i] == y[i])
    return np.where(jaro > 0.7, jaro + begin * scale * (1 - jaro), jaro)


def jaro_winkler_many(a: list[str], b: list[str]) -> np.ndarray:
    """jaro_winkler() of pairs of which no text is empty."""
    fit = [k for k, (x, y) in enumerate(zip(a, b, strict=True)) if max(len(x), len(y)) <= 64]
    out = np.array([0.0 if max(len(x), len(y)) <= 64 else jaro_winkler(x, y) for x, y in zip(a, b, strict=True)])
    out[fit] = _side_by_side([a[k] for k in fit], [b[k] for k in fit], _jaro_winkler)
    out[[x == y for x, y in zip(a, b, strict=True)]] = 1.0
    return out


#: Columns of the name struct and what makes them.
NAME = {"wratio": weighted_ratio, "ratio": ratio, "partial_ratio": partial_ratio, "token_sort_ratio": token_sort_ratio, "token_set_ratio": token_set_ratio}
ADDRESS = ("token_sort_ratio", "token_set_ratio")


def _words_many(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray, list[tuple[str, str, str]]]:
    """token_sort_ratio() and token_set_ratio() of pairs, and _sets() of every pair."""
    words = {t: (_sorted(t), frozenset(t.split())) for t in {*a, *b}}
    first, second = [words[t][0] for t in a], [words[t][0] for t in b]
    sets = []
    for x, y in zip(a, b, strict=True):
        x, y = words[x][1], words[y][1]
        sets.append((" ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))))
    open_ = [k for k, (both, x, y) in enumerate(sets) if first[k] and second[k] and not (both and not (x and y))]
    left, right = ([f"{sets[k][0]} {sets[k][side]}".strip() for k in open_] for side in (1, 2))
    found = ratio_many(first + left, second + right)
    # the common words begin either side, so they are the LCS with it
    n, m, best = (np.array([len(t) for t in x], float) for x in ([sets[k][0] for k in open_], left, right))
    common = np.where(n > 0, np.maximum(200.0 * n / (n + m), 200.0 * n / (n + best)), 0.0)
    whole = np.array([100.0 if x and y else 0.0 for x, y in zip(first, second, strict=True)])
    whole[open_] = np.maximum(found[len(a) :], common)
    return found[: len(a)], whole, sets


def _names_many(a: list[str], b: list[str]) -> dict[str, np.ndarray]:
    """All ratios of pairs of which no text is empty."""
    by_sort, by_set, sets = _words_many(a, b)
    whole, part = ratio_many(a, b), partial_ratio_many(a, b)
    sizes = np.array([(max(len(x), len(y)) / min(len(x), len(y))) for x, y in zip(a, b, strict=True)])
    weight = np.where(sizes <= 8, 0.9, 0.6)
    words = np.array([100.0 if both and x.split() and y.split() else 0.0 for x, y, (both, _, _) in zip(a, b, sets, strict=True)])
    apart = [k for k in np.flatnonzero(sizes >= 1.5) if not words[k] and a[k].split() and b[k].split()]
    if apart:
        words[apart] = np.maximum(
            partial_ratio_many([_sorted(a[k]) for k in apart], [_sorted(b[k]) for k in apart]), partial_ratio_many([sets[k][1] for k in apart], [sets[k][2] for k in apart])
        )
    near = np.maximum(whole, 0.95 * np.maximum(by_sort, by_set))
    far = np.maximum(np.maximum(whole, weight * part), 0.95 * weight * words)
    return {"wratio": np.where(sizes < 1.5, near, far), "ratio": whole, "partial_ratio": part, "token_sort_ratio": by_sort, "token_set_ratio": by_set, "jaro_winkler": jaro_winkler_many(a, b)}


def _all(a: pd.Series, b: pd.Series, names: tuple[str, ...]) -> pd.DataFrame:
    columns = [*names, "jaro_winkler"] if len(names) > 2 else [*names]
    known = {p: k for k, p in enumerate(dict.fromkeys(zip(a, b, strict=True)))}
    full = [k for (x, y), k in known.items() if x and y]
    out = np.full((len(known), len(columns)), -1.0)
    if full:
        pairs = list(known)
        x, y = [pairs[k][0] for k in full], [pairs[k][1] for k in full]
        found = _names_many(x, y) if len(names) > 2 else dict(zip(ADDRESS, _words_many(x, y)[:2], strict=True))
        out[full] = np.stack([found[c] / (1 if c == "jaro_winkler" else 100) for c in columns], 1)
    return pd.DataFrame(out[[known[p] for p in zip(a, b, strict=True)]], columns=columns)


@F.pandas_udf(T.StructType([T.StructField(n, T.DoubleType()) for n in (*NAME, "jaro_winkler")]))
def name_ratios(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """All ratios of two names from 0 to 1, -1 when either is empty."""
    return _all(a, b, tuple(NAME))


@F.pandas_udf(T.StructType([T.StructField(n, T.DoubleType()) for n in ADDRESS]))
def address_ratios(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    return _all(a, b, ADDRESS)

