"""Every constant of the engine, grouped in frozen dataclasses."""

from __future__ import annotations

import random
from dataclasses import dataclass, field

# Largest prime below 2**31. Ids are hashed in words of 22 bits, so that the sum of all products
# stays below 2**55 and a BIGINT never overflows.
HASH_PRIME = 2147483647
WORD_BITS = 22
WORDS = 3


@dataclass(frozen=True)
class LshConfig:
    bands: int = 20
    rows: int = 5
    seed: int = 42
    min_item_ratings: int = 100

    @property
    def n_hashes(self) -> int:
        return self.bands * self.rows

    def hash_table(self) -> list[tuple[int, ...]]:
        """Distinct parameters (a0, a1, a2, b, c0, c1, c2, d) of the hash family.

        An id of the words w0, w1, w2 has the 62-bit hash
        ((a0*w0 + a1*w1 + a2*w2 + b) mod P) * 2**31 + ((c0*w0 + c1*w1 + c2*w2 + d) mod P).
        """
        rng = random.Random(self.seed)
        table: dict[tuple[int, ...], None] = {}
        while len(table) < self.n_hashes:
            halves = [[*(rng.randint(1, HASH_PRIME - 1) for _ in range(WORDS)), rng.randint(0, HASH_PRIME - 1)] for _ in "ac"]
            table[*halves[0], *halves[1]] = None
        return list(table)


@dataclass(frozen=True)
class ModelConfig:
    """Boosted-tree settings; ``seed`` also drives row and column subsampling.

    The trees are fitted to all labelled rows, unless a caller sets ``max_training_rows``; then about
    that many are drawn by a hash of the pair, before any profile is joined. Nothing here sets it.
    """

    n_estimators: int = 1000
    max_depth: int = 5
    learning_rate: float = 0.05
    subsample: float = 0.8
    colsample: float = 0.7
    min_child_weight: int = 4
    seed: int = 42
    max_training_rows: int | None = None


@dataclass(frozen=True)
class SkewConfig:
    """When a key counts as hot.

    A key is hot when it holds more than ``share`` of all rows, so there are at most ``1 / share``
    hot keys whatever the data size: that is the proven bound behind each broadcast of hot keys.
    Below ``min_rows`` rows a key is never worth splitting. ``part_pairs`` is how many pairs of items
    the users of one part have together, at most; see ``similarity``.
    """

    share: float = 1e-5
    min_rows: int = 1_000_000
    part_pairs: int = 1 << 21


# Fixed values below: the constants of the published scoring rules.
@dataclass(frozen=True)
class Config:
    lsh: LshConfig = field(default_factory=LshConfig)
    model: ModelConfig = field(default_factory=ModelConfig)
    skew: SkewConfig = field(default_factory=SkewConfig)

    # users counted as co-raters: 1 < n < 500
    min_user_ratings: int = 2
    max_user_ratings: int = 499

    # item similarity
    min_co_raters: int = 2
    shrink_at: int = 60
    variance_floor: float = 1e-9
    top_k: int = 35

    # collaborative-filtering score, smoothed towards the global mean
    cf_smooth_base: float = 0.05
    cf_smooth_per: float = 400.0
    cf_smooth_max: float = 0.20

    # model score
    model_smooth: float = 0.03
    fallback_mean_share: float = 0.7

    # blend
    gate_neighbors: int = 25
    cf_conf_base: float = 0.70
    cf_conf_span: float = 0.24
    cf_conf_half: float = 3.0
    alpha_base: float = 0.1
    alpha_span: float = 0.1
    alpha_half: float = 2.0
    final_smooth: float = 0.02

    min_stars: float = 1.0
    max_stars: float = 5.0
