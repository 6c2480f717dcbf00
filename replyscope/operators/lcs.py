"""Longest-common-subsequence length over token arrays, as an ``arrow_udf``
that holds the tokens of a slice of its batch only. Used by ROUGE-L (M4).

Bit-parallel LCS (Hyyrö 2004, after Allison & Dix 1986): one bit per
position of the second sequence; each token of the first sequence updates
the whole bit row with an add and a few logical operations, so a pair costs
O(|a| x |b| / w) word operations instead of a full DP table."""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .packed import list_sizes, slices


def lcs_length(a, b) -> int:
    """LCS length of two token sequences."""
    if a is None or b is None or len(a) == 0 or len(b) == 0:
        return 0
    masks: dict[str, int] = {}
    for j, tok in enumerate(b):
        masks[tok] = masks.get(tok, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v = full
    for tok in a:
        u = v & masks.get(tok, 0)
        v = ((v + u) | (v - u)) & full
    return len(b) - v.bit_count()


@F.arrow_udf(LongType())
def lcs_udf(a: pa.Array, b: pa.Array) -> pa.Array:
    out: list[int] = []
    for start, stop in slices(list_sizes(a), list_sizes(b)):
        n = stop - start
        out += map(lcs_length, a.slice(start, n).to_pylist(), b.slice(start, n).to_pylist())
    return pa.array(out, pa.int64())
