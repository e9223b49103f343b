"""String similarity, 0 to 100, of one query against many candidates.

A query is known when the plan is made, so its characters become bit masks and candidates are worked as one array of
character codes: a step of the bit-parallel longest-common-subsequence recurrence handles all rows of a batch. The scalar
forms define the scores; tests hold the array forms against them.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_NOT_WORD = re.compile(r"\W")

#: Weights of the composite score's parts and the length ratios that choose them.
TOKEN_WEIGHT, PARTIAL_WEIGHT, FAR_PARTIAL_WEIGHT = 0.95, 0.9, 0.6
PARTIAL_FROM, FAR_FROM = 1.5, 8.0
#: Candidates with fewer processed characters than this are scored by plain ratio: a stub is no abbreviation.
SHORT = 3


def processed(text: str | None) -> str:
    """Characters that are no letter, digit or underscore become spaces; lower case; trimmed; inner spaces stay."""
    text = text or ""
    # most names hold letters, digits and blanks alone, where the pattern would change nothing
    plain = text.replace(" ", "").isalnum()
    return (text if plain else _NOT_WORD.sub(" ", text)).lower().strip()


def processed_column(text: Column) -> Column:
    """processed() as a Column; letters and digits by Unicode category."""
    return F.trim(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}_]", " ")))


# scalar forms ------------------------------------------------------------------------------------------------------


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    open_ = full
    for c in b:
        u = open_ & masks.get(c, 0)
        open_ = ((open_ + u) | (open_ - u)) & full
    return len(a) - open_.bit_count()


def ratio(a: str, b: str) -> float:
    """Share of characters that a longest common subsequence keeps; 100 for two empty strings."""
    size = len(a) + len(b)
    return 100.0 * 2 * lcs(a, b) / size if size else 100.0


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    one, two = set(a.split()), set(b.split())
    if not one or not two:
        return 0.0
    both = " ".join(sorted(one & two))
    left, right = " ".join(sorted(one - two)), " ".join(sorted(two - one))
    if both and not (left and right):
        return 100.0
    whole = [" ".join(filter(None, (both, x))) for x in (left, right)]
    found = ratio(*whole)
    return max(found, ratio(both, whole[0]), ratio(both, whole[1])) if both else found


def partial(a: str, b: str) -> float:
    """Best ratio of the shorter string with a window of the longer; windows may be cut at both ends."""
    if not a or not b:
        return 100.0 if a == b else 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    n = len(short)
    best = max(ratio(short, long[max(0, i) : i + n]) for i in range(1 - n, len(long)))
    if len(a) == len(b):
        best = max(best, max(ratio(long, short[max(0, i) : i + n]) for i in range(1 - n, n)))
    return best


def partial_token(a: str, b: str) -> float:
    one, two = a.split(), b.split()
    if set(one) & set(two):
        return 100.0
    best = partial(" ".join(sorted(one)), " ".join(sorted(two)))
    if len(set(one)) < len(one) or len(set(two)) < len(two):
        best = max(best, partial(" ".join(sorted(set(one))), " ".join(sorted(set(two)))))
    return best


def weighted(a: str, b: str) -> float:
    """Composite of plain, token and partial ratios of two processed strings."""
    if not a or not b:
        return 0.0
    longer = max(len(a), len(b)) / min(len(a), len(b))
    plain = ratio(a, b)
    if longer < PARTIAL_FROM:
        return max(plain, TOKEN_WEIGHT * max(token_sort(a, b), token_set(a, b)))
    weight = PARTIAL_WEIGHT if longer <= FAR_FROM else FAR_PARTIAL_WEIGHT
    return max(plain, weight * partial(a, b), TOKEN_WEIGHT * weight * partial_token(a, b))


def wratio(query: str, candidate: str | None) -> float:
    a, b = processed(query), processed(candidate)
    return ratio(a, b) if len(b) < SHORT else weighted(a, b)


def jaro(a: str, b: str) -> float:
    if not a or not b:
        return float(a == b)
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used = [False] * len(a)
    hits = []
    for j, c in enumerate(b):
        for i in range(max(0, j - reach), min(len(a), j + reach + 1)):
            if not used[i] and a[i] == c:
                used[i] = True
                hits.append(c)
                break
    m = len(hits)
    if not m:
        return 0.0
    moved = sum(x != y for x, y in zip((c for c, u in zip(a, used) if u), hits)) // 2
    return (m / len(a) + m / len(b) + (m - moved) / m) / 3


def jaro_winkler(query: str, candidate: str | None) -> float:
    a, b = processed(query), processed(candidate)
    score = jaro(a, b)
    if score > 0.7:
        same = 0
        for x, y in zip(a[:4], b[:4]):
            if x != y:
                break
            same += 1
        score += 0.1 * same * (1 - score)
    return 100.0 * score


# array forms -------------------------------------------------------------------------------------------------------


def _codes(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters as a (row, place) array padded with 0, and lengths."""
    n = np.fromiter(map(len, strings), np.int64, len(strings))
    flat = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros((len(strings), int(n.max(initial=0))), np.uint32)
    out[np.arange(out.shape[1])[None, :] < n[:, None]] = flat
    return out, n


def _masks(query: str, codes: np.ndarray) -> np.ndarray:
    """For every place, the bits of the query's places that hold its character; padding has none."""
    letters = np.array(sorted({ord(c) for c in query}), np.uint32)
    bits = np.zeros(len(letters) + 1, np.uint64)
    for i, c in enumerate(query):
        bits[np.searchsorted(letters, ord(c))] |= np.uint64(1 << i)
    at = np.searchsorted(letters, codes)
    known = letters[np.minimum(at, len(letters) - 1)] == codes
    return np.ascontiguousarray(bits[np.where(known, at, len(letters))].T)


def _lcs_masks(masks: np.ndarray, size: int) -> np.ndarray:
    """LCS length from masks (place, row) over ``size`` query places."""
    full = np.uint64((1 << size) - 1)
    open_ = np.full(masks.shape[1], full)
    for row in masks:
        u = open_ & row
        open_ = ((open_ + u) | (open_ - u)) & full
    return size - np.bitwise_count(open_).astype(np.int64)


def _lcs_many(query: str, codes: np.ndarray) -> np.ndarray:
    """LCS of a query of at most 64 characters with every row."""
    with np.errstate(over="ignore"):
        return _lcs_masks(_masks(query, codes), len(query))


def partial_many(query: str, strings: list[str]) -> np.ndarray:
    """partial() of a query with every string."""
    if not strings:
        return np.empty(0)
    if not query or len(query) > 64 or "\0" in query:
        return np.array([partial(query, s) for s in strings])
    codes, n = _codes(strings)
    masks, m = _masks(query, codes), len(query)
    best = np.zeros(len(strings))
    with np.errstate(over="ignore"):
        rows = np.flatnonzero(n > m)
        if len(rows):
            own = masks[:, rows]
            for start in range(1 - m, int(n[rows].max())):
                size = np.minimum(start + m, n[rows]) - max(0, start)
                found = 200.0 * _lcs_masks(own[max(0, start) : start + m], m) / (m + np.maximum(size, 0))
                best[rows] = np.maximum(best[rows], np.where(size > 0, found, 0.0))
        for size in np.unique(n[(n < m) & (n > 0)]).tolist():
            rows = np.flatnonzero(n == size)
            own = masks[:size, rows]
            for start in range(1 - size, m):
                lo, hi = max(0, start), min(m, start + size)
                window = (own >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)
                best[rows] = np.maximum(best[rows], 200.0 * _lcs_masks(window, hi - lo) / (size + hi - lo))
    for i in np.flatnonzero(n == m).tolist():
        best[i] = partial(query, strings[i])
    return best


def ratio_many(query: str, strings: list[str]) -> np.ndarray:
    if not strings:
        return np.empty(0)
    if not query or len(query) > 64 or "\0" in query:
        return np.array([ratio(query, s) for s in strings])
    codes, n = _codes(strings)
    return 100.0 * 2 * _lcs_many(query, codes) / (len(query) + n)


def wratio_many(query: str, candidates: list[str | None]) -> np.ndarray:
    q = processed(query)
    strings = [processed(c) for c in candidates]
    n = np.fromiter(map(len, strings), np.int64, len(strings))
    plain = ratio_many(q, strings)
    out = plain.copy()
    if not q:
        return np.where(n < SHORT, plain, 0.0)
    with np.errstate(divide="ignore"):
        longer = np.maximum(n, len(q)) / np.minimum(np.maximum(n, 1), len(q))
    near = np.flatnonzero((n >= SHORT) & (longer < PARTIAL_FROM))
    if len(near):
        split = [strings[i].split() for i in near]
        best = ratio_many(" ".join(sorted(q.split())), [" ".join(sorted(t)) for t in split])
        mine = set(q.split())
        shared: dict[frozenset[str], list[int]] = {}
        for k, t in enumerate(split):
            shared.setdefault(frozenset(mine.intersection(t)), []).append(k)
        for both, rows in shared.items():
            best[rows] = np.maximum(best[rows], _token_set_many(mine, both, [set(split[k]) for k in rows]))
        out[near] = np.maximum(plain[near], TOKEN_WEIGHT * best)
    far = np.flatnonzero((n >= SHORT) & (longer >= PARTIAL_FROM))
    if len(far):
        weight = np.where(longer[far] <= FAR_FROM, PARTIAL_WEIGHT, FAR_PARTIAL_WEIGHT)
        whole = partial_many(q, [strings[i] for i in far])
        words = _partial_token_many(q, [strings[i] for i in far])
        out[far] = np.maximum(plain[far], np.maximum(weight * whole, TOKEN_WEIGHT * weight * words))
    return out


def _partial_token_many(query: str, strings: list[str]) -> np.ndarray:
    mine = query.split()
    split = [s.split() for s in strings]
    out = partial_many(" ".join(sorted(mine)), [" ".join(sorted(t)) for t in split])
    twice = [i for i, t in enumerate(split) if len(set(mine)) < len(mine) or len(set(t)) < len(t)]
    if twice:
        out[twice] = np.maximum(out[twice], partial_many(" ".join(sorted(set(mine))), [" ".join(sorted(set(split[i]))) for i in twice]))
    shared = set(mine)
    out[[i for i, t in enumerate(split) if not shared.isdisjoint(t)]] = 100.0
    return out


def _token_set_many(mine: set[str], both: frozenset[str], theirs: list[set[str]]) -> np.ndarray:
    """Token-set ratio for candidates that share exactly ``both`` with the query."""
    left = " ".join(sorted(mine - both))
    rights = [" ".join(sorted(t - both)) for t in theirs]
    if not both:
        return ratio_many(left, rights)
    if not left:
        return np.full(len(theirs), 100.0)
    core = " ".join(sorted(both))
    out = ratio_many(f"{core} {left}", [f"{core} {r}" if r else core for r in rights])
    sizes = np.fromiter(map(len, rights), np.int64, len(rights))
    alone = lambda n: 100.0 * 2 * len(core) / (2 * len(core) + 1 + n)
    out = np.maximum(out, np.maximum(alone(len(left)), alone(sizes)))
    return np.where(sizes == 0, 100.0, out)


def jaro_winkler_many(query: str, candidates: list[str | None]) -> np.ndarray:
    a = processed(query)
    strings = [processed(c) for c in candidates]
    if not strings:
        return np.empty(0)
    codes, n = _codes(strings)
    if not a or codes.shape[1] > 64:
        return np.array([jaro_winkler(query, c) for c in candidates])
    q = np.array([ord(c) for c in a], np.uint32)
    rows = len(strings)
    reach = np.maximum(0, np.maximum(n, len(a)) // 2 - 1)
    used = np.zeros((rows, len(a)), np.bool_)
    hit = np.zeros(codes.shape, np.bool_)
    for j in range(codes.shape[1]):
        todo = j < n
        for i in range(max(0, j - int(reach.max())), min(len(a), j + int(reach.max()) + 1)):
            now = todo & (codes[:, j] == q[i]) & ~used[:, i] & (abs(i - j) <= reach)
            used[:, i] |= now
            hit[:, j] |= now
            todo &= ~now
    m = hit.sum(axis=1)
    lined = np.zeros((2, rows, len(a) + 1), np.uint32)
    for side, (flags, chars) in enumerate(((used, np.broadcast_to(q, used.shape)), (hit, codes))):
        r, c = np.nonzero(flags)
        place = np.cumsum(flags, axis=1)[r, c] - 1
        lined[side, r, place] = chars[r, c]
    moved = (lined[0] != lined[1]).sum(axis=1) // 2
    safe = np.maximum(m, 1)
    score = np.where(m > 0, (m / len(a) + m / np.maximum(n, 1) + (m - moved) / safe) / 3, 0.0)
    head = min(4, len(a), codes.shape[1])
    same = np.cumprod(codes[:, :head] == q[:head], axis=1).sum(axis=1) if head else np.zeros(rows)
    return 100.0 * np.where(score > 0.7, score + 0.1 * same * (1 - score), score)


# registry ----------------------------------------------------------------------------------------------------------

Many = Callable[[str, list[str | None]], np.ndarray]

#: name -> (label, scalar form, array form).
ALGORITHMS: dict[str, tuple[str, Callable[[str, str | None], float], Many]] = {
    "wratio": ("Composite token ratio", wratio, wratio_many),
    "jaro_winkler": ("Jaro-Winkler, prefix-weighted", jaro_winkler, jaro_winkler_many),
    "ratio": ("Plain ratio", lambda q, c: ratio(processed(q), processed(c)), lambda q, cs: ratio_many(processed(q), [processed(c) for c in cs])),
}
DEFAULT_ALGORITHM = "wratio"


def _known(algorithm: str):
    if algorithm not in ALGORITHMS:
        raise ValueError(f"Unknown algorithm {algorithm!r}. Choose one of: {', '.join(ALGORITHMS)}")
    return ALGORITHMS[algorithm]


def scalar(algorithm: str = DEFAULT_ALGORITHM) -> Callable[[str, str | None], float]:
    return _known(algorithm)[1]


def batch(algorithm: str = DEFAULT_ALGORITHM) -> Many:
    return _known(algorithm)[2]


def score(candidate: Column, query: str, algorithm: str = DEFAULT_ALGORITHM) -> Column:
    """Score of a column against a literal query. A null candidate counts as empty. Equal strings of a batch are scored
    once. Marked nondeterministic, so that a filter on the score doesn't score the rows again."""
    many = _known(algorithm)[2]

    @F.pandas_udf(DoubleType())
    def run(batch: pd.Series) -> pd.Series:
        places, values = pd.factorize(batch.fillna(""), sort=False)
        return pd.Series(many(query, values.tolist())[places] if len(values) else np.empty(0))

    return run.asNondeterministic()(candidate)


def pair_score(left: Column, right: Column, algorithm: str = DEFAULT_ALGORITHM) -> Column:
    """Score of two columns, row by row; distinct lefts of a batch are taken as queries one after the other."""
    return _pair_udf(_known(algorithm)[2])(left, right)


def _pair_udf(many: Many):
    @F.pandas_udf(DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        out = np.zeros(len(a))
        for query, rows in a.fillna("").groupby(a.fillna("")).indices.items():
            out[rows] = many(query, b.iloc[rows].fillna("").tolist())
        return pd.Series(out)

    return run


def mean_score(queries: list[str | None], columns: list[Column], algorithm: str = DEFAULT_ALGORITHM) -> Column:
    """Mean over the fields whose query is given; null if none is."""
    parts = [score(c, q, algorithm) for q, c in zip(queries, columns) if q]
    if not parts:
        return F.lit(None).cast("double")
    return sum(parts[1:], parts[0]) / len(parts)


def register_sql(spark: SparkSession) -> None:
    """Make every algorithm an SQL function (query, candidate) -> score."""
    for name, (_, _, many) in ALGORITHMS.items():
        spark.udf.register(name, _pair_udf(many))
