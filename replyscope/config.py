"""Run parameters, validated on the driver before any job starts."""
from __future__ import annotations

from dataclasses import dataclass, field

# Defaults of the evaluated system.
DEFAULT_RUBRIC = ("correctness", "professionalism", "empathy", "completeness",
                  "grammar", "tone", "actionability")
DEFAULT_SEED = 42
DEFAULT_TOP_K = 3
DEFAULT_MAX_FEATURES = 4096
DEFAULT_HOLDOUT = 20
DEFAULT_PER_CATEGORY = 2
GENERATION_TEMPERATURE = 0.3
GENERATION_MAX_TOKENS = 400
JUDGE_TEMPERATURE = 0.0
JUDGE_MAX_TOKENS = 300


@dataclass(frozen=True)
class Weights:
    llm_judge: float = 0.50
    bertscore: float = 0.30
    cosine: float = 0.20

    def __post_init__(self) -> None:
        total = self.llm_judge + self.bertscore + self.cosine
        if abs(total - 1.0) > 1e-6:
            raise ValueError(f"score weights must sum to 1.0, got {total:.6f}")

    def as_dict(self) -> dict[str, float]:
        return {"llm_judge": self.llm_judge, "bertscore": self.bertscore,
                "cosine": self.cosine}


@dataclass(frozen=True)
class RunConfig:
    seed: int = DEFAULT_SEED
    top_k: int = DEFAULT_TOP_K
    exclude_self: bool = True
    max_features: int | None = DEFAULT_MAX_FEATURES
    holdout_n: int | None = DEFAULT_HOLDOUT
    per_category: int = DEFAULT_PER_CATEGORY
    rubric: tuple[str, ...] = DEFAULT_RUBRIC
    weights: Weights = field(default_factory=Weights)
    stop_words: tuple[str, ...] | None = None   # None -> English default list
    max_df: float | None = None                 # drop terms in > max_df of texts
    limit: int | None = None                    # shortens the holdout of a run
    holdout_rank_first: bool = False            # order holdout by (draw, category)

    def __post_init__(self) -> None:
        if not self.rubric:
            raise ValueError("judge rubric must not be empty")
        if self.top_k < 0:
            raise ValueError("top_k must be >= 0")
        if self.per_category < 0:
            raise ValueError("per_category must be >= 0")
        if self.limit is not None and self.limit < 0:
            raise ValueError("limit must be >= 0")
        if self.max_features is not None and self.max_features <= 0:
            raise ValueError("max_features must be positive or None")
        if self.max_df is not None and not 0.0 < self.max_df <= 1.0:
            raise ValueError("max_df must be in (0, 1]")
