"""Scoring configuration.

Everything that decides a score lives here as plain data. The operators
compile these values into native Spark ``Column`` expressions (literal maps,
literal arrays, ``CASE`` chains), so no Python runs per row.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

# ---------------------------------------------------------------------------
# FIXED VALUES — these must equal the published scoring rules exactly.
# ---------------------------------------------------------------------------

# Normalised result text -> numeric outcome. ``None`` marks an unusable
# result (the row is dropped); any text not listed here is unusable too.
RESULT_SCORES = {
    "pass": 0.0,
    "pass w/ conditions": 0.5,
    "fail": 1.0,
    "no entry": None,
    "not ready": None,
    "out of business": None,
    "business not located": None,
}

# Numbered violation codes and their tiers.
CRITICAL_CODES = (1, 14)   # inclusive range 1..14
SERIOUS_CODES = (15, 29)   # inclusive range 15..29
MINOR_CODES = (30, 44)     # inclusive range 30..44, plus the single code 70
MINOR_EXTRA_CODE = 70
CODE_WEIGHTS = {"critical": 3.0, "serious": 2.0, "minor": 1.0}

# Keyword tiers. Order inside each tier is the order of ``kw_found``.
KEYWORD_TIERS = {
    "critical": [
        "rodent", "rodents", "mice", "mouse", "rat", "rats",
        "roach", "roaches", "cockroach", "cockroaches",
        "sewage", "toxic", "poisonous", "vomit",
        "feces", "fecal", "droppings", "urine",
        "e. coli", "e.coli", "salmonella", "listeria", "norovirus",
    ],
    "major": [
        "mold", "moldy", "spoiled", "rotten", "expired", "rancid",
        "temperature", "cold holding", "hot holding", "danger zone",
        "contaminated", "cross-contamination", "cross contamination",
        "raw meat", "undercooked",
        "hand washing", "handwashing", "bare hands",
        "pesticide", "chemical", "sanitizer",
        "fly", "flies", "insect", "insects", "pest", "pests",
    ],
    "minor": [
        "dust", "dusty", "clutter", "cluttered",
        "floor", "wall", "ceiling", "ventilation",
        "lighting", "plumbing", "leak", "leaking",
        "garbage", "trash", "waste", "debris",
        "label", "labeling", "signage",
        "hair restraint", "hair net", "gloves",
    ],
}
KEYWORD_WEIGHTS = {"critical": 3.0, "major": 2.0, "minor": 1.0}

# How the inspection was triggered -> weight of its outcome (exact match
# after strip + lower-case; anything else gets the default).
INSPECTION_TYPE_WEIGHTS = {
    "suspect food poisoning": 2.0,
    "complaint": 1.5,
    "task-force": 1.3,
    "canvass re-inspection": 1.1,
    "canvass": 1.0,
    "license": 0.8,
    "consultation": 0.5,
}
INSPECTION_TYPE_WEIGHT_DEFAULT = 1.0

# Blend of the four 0-100 components into the composite score.
RISK_SCORE_WEIGHTS = {
    "failure_rate": 0.25,
    "recency": 0.25,
    "violation_severity": 0.30,
    "trend": 0.20,
}
TREND_WINDOW = 5
TREND_MIN_INSPECTIONS = 3
RECENCY_HALF_LIFE_DAYS = 180.0
RECENCY_DECAY = 0.693          # the literal used by the published formula (not ln 2)
SEVERITY_CURVE_SCALE = 10.0    # severity = 100 * (1 - e^(-raw / 10))

# Dashboard thresholds.
HIGH_RISK = 70.0
MEDIUM_RISK = 40.0
TREND_WORSENING = 55.0
TREND_IMPROVING = 45.0

# Violation-code regex: 1-2 digits and a dot followed by whitespace, at the
# start of the text or right after a pipe. ``(?U)`` gives Java the Unicode
# meaning of ``\s`` that the published rule has.
CODE_PATTERN = r"(?U)(?:^|\|)\s*([0-9]{1,2})\.\s"

# Ingest paging.
PAGE_SIZE = 50_000

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ScoringConfig:
    """Immutable bundle of the values above; pass a modified copy to experiment."""

    result_scores: dict = field(default_factory=lambda: dict(RESULT_SCORES))
    keyword_tiers: dict = field(default_factory=lambda: {k: list(v) for k, v in KEYWORD_TIERS.items()})
    keyword_weights: dict = field(default_factory=lambda: dict(KEYWORD_WEIGHTS))
    code_weights: dict = field(default_factory=lambda: dict(CODE_WEIGHTS))
    # held as exact decimals (one decimal place), so weighted sums are exact
    type_weights: dict = field(default_factory=lambda: {k: Decimal(str(v)) for k, v in INSPECTION_TYPE_WEIGHTS.items()})
    type_weight_default: Decimal = Decimal(str(INSPECTION_TYPE_WEIGHT_DEFAULT))
    risk_weights: dict = field(default_factory=lambda: dict(RISK_SCORE_WEIGHTS))
    trend_window: int = TREND_WINDOW
    trend_min_inspections: int = TREND_MIN_INSPECTIONS
    half_life_days: float = RECENCY_HALF_LIFE_DAYS
    recency_decay: float = RECENCY_DECAY
    severity_scale: float = SEVERITY_CURVE_SCALE

    @property
    def usable_results(self) -> list[str]:
        return [k for k, v in self.result_scores.items() if v is not None]


DEFAULT_CONFIG = ScoringConfig()
