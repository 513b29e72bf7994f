"""Similarities that SQL lacks, as Arrow-batched UDFs (others are in functions.places). difflib's ratio is not a Levenshtein
distance, so Python's own matcher computes it."""

from __future__ import annotations

import difflib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """difflib ratio; null if either is null."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("ratio", T.DoubleType())]))
def first_alike(a: pd.Series, b: pd.Series, least: pd.Series) -> pd.DataFrame:
    """Of two arrays of texts, the first place where the difflib ratio is above ``least``, else null."""

    def one(xs, ys, bound: float) -> tuple:
        for i, (x, y) in enumerate(zip(xs if xs is not None else (), ys if ys is not None else ())):
            if (r := difflib.SequenceMatcher(None, x, y).ratio()) > bound:
                return i, r
        return None, None

    return pd.DataFrame([one(*row) for row in zip(a, b, least)], columns=["at", "ratio"]).astype({"at": "Int32", "ratio": "Float64"})


@F.pandas_udf(T.DoubleType())
def coverage(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of the shorter text that matching blocks cover."""

    def one(x: str | None, y: str | None) -> float | None:
        if not x or not y:
            return None if x is None or y is None else 0.0
        return sum(m.size for m in difflib.SequenceMatcher(None, x, y).get_matching_blocks()) / min(len(x), len(y))

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.ArrayType(T.BooleanType()))
def alike(a: pd.Series, b: pd.Series, least: pd.Series) -> pd.Series:
    """Of two arrays of texts, place by place, whether the difflib ratio is ``least`` or more; null where
    either is null. Pairs whose characters do not suffice are not matched."""

    def one(x: str | None, y: str | None, bound: float) -> bool | None:
        if x is None or y is None:
            return None
        if x == y:
            return bound <= 1.0
        other = Counter(y)
        if 2.0 * sum(min(n, other[c]) for c, n in Counter(x).items()) / (len(x) + len(y)) < bound:
            return False
        return difflib.SequenceMatcher(None, x, y).ratio() >= bound

    return pd.Series([[one(x, y, bound) for x, y in zip(xs, ys)] for xs, ys, bound in zip(a, b, least)], dtype="object")


#: Counts of characters that are held at once.
MOST_COUNTS = 1 << 20


def _bounds(xs: list[str], ys: list[str]) -> Iterator[np.ndarray]:
    """For each of xs how many characters it shares with each of ys, each as often as the rarer side has it."""
    codes = np.frombuffer("".join([*xs, *ys]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letters, codes = np.unique(codes, return_inverse=True)
    ends = np.cumsum([len(t) for t in (*xs, *ys)])
    cut = lambda i: codes[ends[i] - len(xs[i] if i < len(xs) else ys[i - len(xs)]) : ends[i]]
    count = lambda i: np.bincount(cut(i), minlength=len(letters))
    step = max(1, MOST_COUNTS // max(1, len(letters)))
    if len(ys) <= step:
        asked = np.array([count(len(xs) + j) for j in range(len(ys))])
        yield from (np.minimum(asked, count(i)).sum(axis=1) for i in range(len(xs)))
        return
    for i in range(len(xs)):  # many lines with many characters: their counts are made block by block
        own = count(i)
        yield np.concatenate([np.minimum(np.array([count(len(xs) + j) for j in range(k, min(k + step, len(ys)))]), own).sum(axis=1) for k in range(0, len(ys), step)])


@F.pandas_udf(T.StructType([T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("cover", T.ArrayType(T.DoubleType()))]))
def best_covers(a: pd.Series, b: pd.Series, low: pd.Series) -> pd.DataFrame:
    """For each of an array of texts, which of another array shares most of the shorter text's characters
    in matching blocks with it, the first of equals, and that share; null where none reaches ``low``.

    The characters that two texts share bound their blocks. Those with the highest bound are matched
    first, and none whose bound is below the best so far: it could not be the best. No text is empty."""

    def one(xs, ys, least: float) -> tuple[list, list]:
        xs, ys = list(xs), list(ys)
        sizes = np.array([len(y) for y in ys])
        found = []
        for x, shared in zip(xs, _bounds(xs, ys)):
            most = shared / np.minimum(sizes, len(x))
            best, at = least, None
            for i in np.flatnonzero(most >= least)[np.argsort(-most[most >= least], kind="stable")].tolist():
                if most[i] < best:
                    break
                if at is not None and most[i] == best and i > at:
                    continue
                c = sum(m.size for m in difflib.SequenceMatcher(None, x, ys[i]).get_matching_blocks()) / min(len(x), len(ys[i]))
                if c > best or c == best and (at is None or i < at):
                    best, at = c, i
            found.append((at, best if at is not None else None))
        return [f[0] for f in found], [f[1] for f in found]

    return pd.DataFrame([one(*row) for row in zip(a, b, low)], columns=["at", "cover"])
