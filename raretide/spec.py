"""Feature specifications: which columns play which role in ``engineer``.

A spec is plain data.  The row-level feature step is one ``select`` built from
it (see :mod:`raretide.functions.features`); presets v1-v4 describe the four
published feature sets over the 50-column reference table, ``FIXTURE`` the same
roles mapped onto the 12-column ``entity_features`` view.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class FeatureSpec:
    """Roles of the input columns; every list may be empty.

    ``ratios`` holds ``(num, den, null_safe)``: ``num / (den + 1)``; with
    ``null_safe`` both operands are null-filled with 0 first.
    ``logs`` holds ``(col, null_safe)``: ``log1p(max(x, 0))``.
    ``dominant`` is the column crossed with ``dominant_with``: a list of
    ``(col, null_safe)`` products; ``dominant_div`` divides by ``col + 1``.
    """

    version: int = 4
    miss_cols: tuple[str, ...] = ()
    binary_cols: tuple[str, ...] = ()
    auto_binary: bool = False  # v2: detect binary columns from the data
    binary_mean: bool = True
    pairwise: bool = True
    ratios: tuple[tuple[str, str, bool], ...] = ()
    products: tuple[tuple[str, str], ...] = ()
    squares: tuple[str, ...] = ()
    logs: tuple[tuple[str, bool], ...] = ()
    dominant: str | None = None
    dominant_with: tuple[tuple[str, bool], ...] = ()
    dominant_div: str | None = None
    dominant_square: bool = False
    row_median: bool = True
    row_skew: bool = True
    row_kurt: bool = True
    miss_pattern_sum: bool = True
    te_cols: tuple[str, ...] = ()


def _f(*nums: int) -> tuple[str, ...]:
    return tuple(f"feature_{n}" for n in nums)


# ---------------------------------------------------------------------------
# Column roles of the reference's 50-feature table, as published.
# high-missing (v3/v4): 8, 39, 45, 38, 28, 12, 31, 34, 35, 15, 42
#   (v2 uses the first four: 8, 39, 45, 38)
# binary: 4, 5, 6, 8, 11, 14, 15, 16, 18, 19, 20, 21, 22, 27, 28, 30, 32, 39,
#   41, 42, 44, 46, 49
# ratios a/(b+1): 25/7, 13/2, 40/47, 50/26 (v2); + 24/25, null-safe 45/38 (v3);
#   + 29/7 (v4)
# products 25*29, 7*2; square 24; logs 25 (nulls kept), 45 and 38 (null -> 0)
# dominant feature 12 crossed with 24 (24 keeps nulls), 16, 22, 31; 12/(31+1); 12^2
# target-encoded (v3): 24, 25, 29, 38, 45, 2, 7, 10, 40, 47, 48, 33; v4 adds 36, 37
# ---------------------------------------------------------------------------
REF_HIGH_MISS = _f(8, 39, 45, 38, 28, 12, 31, 34, 35, 15, 42)
REF_BINARY = _f(4, 5, 6, 8, 11, 14, 15, 16, 18, 19, 20, 21, 22, 27, 28, 30, 32, 39, 41, 42, 44, 46, 49)
REF_TE_V3 = _f(24, 25, 29, 38, 45, 2, 7, 10, 40, 47, 48, 33)
REF_TE_V4 = REF_TE_V3 + _f(36, 37)

REF_V1 = FeatureSpec(
    version=1, binary_mean=False, pairwise=False, row_median=False, row_skew=False, row_kurt=False,
    miss_pattern_sum=False,
)
REF_V2 = FeatureSpec(
    version=2, miss_cols=REF_HIGH_MISS[:4], auto_binary=True, binary_mean=False, pairwise=False,
    ratios=(("feature_25", "feature_7", False), ("feature_13", "feature_2", False),
            ("feature_40", "feature_47", False), ("feature_50", "feature_26", False)),
    row_kurt=False, miss_pattern_sum=False,
)
REF_V3 = FeatureSpec(
    version=3, miss_cols=REF_HIGH_MISS, binary_cols=REF_BINARY, pairwise=False,
    ratios=(("feature_25", "feature_7", False), ("feature_13", "feature_2", False),
            ("feature_40", "feature_47", False), ("feature_24", "feature_25", False),
            ("feature_45", "feature_38", True)),
    products=(("feature_25", "feature_29"), ("feature_7", "feature_2")),
    squares=("feature_24",),
    logs=(("feature_25", False), ("feature_45", True)),
    row_median=False, row_skew=False, row_kurt=False,
    te_cols=REF_TE_V3,
)
REF_V4 = FeatureSpec(
    version=4, miss_cols=REF_HIGH_MISS, binary_cols=REF_BINARY,
    ratios=(("feature_25", "feature_7", False), ("feature_13", "feature_2", False),
            ("feature_40", "feature_47", False), ("feature_50", "feature_26", False),
            ("feature_24", "feature_25", False), ("feature_45", "feature_38", True),
            ("feature_29", "feature_7", False)),
    products=(("feature_25", "feature_29"), ("feature_7", "feature_2")),
    squares=("feature_24",),
    logs=(("feature_25", False), ("feature_45", True), ("feature_38", True)),
    dominant="feature_12",
    dominant_with=(("feature_24", False), ("feature_16", True), ("feature_22", True), ("feature_31", True)),
    dominant_div="feature_31",
    dominant_square=True,
    te_cols=REF_TE_V4,
)
PRESETS = {1: REF_V1, 2: REF_V2, 3: REF_V3, 4: REF_V4}

# Same roles on the 12-column fixture view (FIXTURES.md section 3).
FIXTURE = FeatureSpec(
    version=4,
    miss_cols=_f(3, 4, 5, 6, 7, 8, 9),
    binary_cols=_f(7, 8, 9, 10),
    ratios=(("feature_1", "feature_4", False), ("feature_5", "feature_3", False),
            ("feature_2", "feature_11", False), ("feature_5", "feature_9", True)),
    products=(("feature_4", "feature_3"),),
    squares=("feature_1",),
    logs=(("feature_2", False), ("feature_5", True)),
    dominant="feature_12",
    dominant_with=(("feature_1", False), ("feature_7", True), ("feature_8", True), ("feature_9", True)),
    dominant_div="feature_9",
    dominant_square=True,
    te_cols=_f(1, 2, 4, 5, 6, 11),
)
# The earlier published feature sets on the same view.
FIXTURE_V1 = FeatureSpec(
    version=1, binary_mean=False, pairwise=False, row_median=False, row_skew=False, row_kurt=False, miss_pattern_sum=False,
)
FIXTURE_V2 = FeatureSpec(
    version=2, miss_cols=_f(3, 4, 5, 6), auto_binary=True, binary_mean=False, pairwise=False,
    ratios=(("feature_1", "feature_4", False), ("feature_5", "feature_3", False)),
    row_kurt=False, miss_pattern_sum=False,
)
FIXTURE_V3 = FeatureSpec(
    version=3, miss_cols=FIXTURE.miss_cols, binary_cols=FIXTURE.binary_cols, pairwise=False,
    ratios=FIXTURE.ratios[:3], products=FIXTURE.products, squares=FIXTURE.squares, logs=FIXTURE.logs[:1],
    row_median=False, row_skew=False, row_kurt=False, te_cols=_f(1, 2, 4, 5),
)
FIXTURE_PRESETS = {1: FIXTURE_V1, 2: FIXTURE_V2, 3: FIXTURE_V3, 4: FIXTURE}
