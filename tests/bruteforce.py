"""Independent per-group scorer in plain Python (the slow, obvious way) for small fixtures."""

from __future__ import annotations

import math
from collections import defaultdict
from fractions import Fraction

import numpy as np

WEIGHTS = {"suspect food poisoning": 2.0, "complaint": 1.5, "task-force": 1.3,
           "canvass re-inspection": 1.1, "canvass": 1.0, "license": 0.8, "consultation": 0.5}


def exact(values) -> float:
    """Sum of short decimals without rounding on the way (six decimals are enough for all of them)."""
    return float(sum(Fraction(round(v * 10**6), 10**6) for v in values))


def r1(x: float) -> float:
    return float(np.round(x, 1))


def score_groups(rows: list[dict], as_of) -> dict[str, dict]:
    groups = defaultdict(list)
    for r in rows:
        groups[r["establishment_id"]].append(r)
    out = {}
    for key, g in groups.items():
        g = sorted(g, key=lambda r: (r["inspection_date"], r["inspection_id"]))
        w = [WEIGHTS.get(r["inspection_type"], 1.0) for r in g]
        fr = exact(r["result_score"] * wi for r, wi in zip(g, w)) / exact(w) * 100
        fails = [r["inspection_date"] for r in g if r["result_score"] > 0]
        if fails:
            days = math.floor((as_of - max(fails)).total_seconds() / 86400)
            rec = 100.0 * math.exp(-0.693 * days / 180)
        else:
            rec = 0.0
        sev = exact(r["violation_severity"] for r in g) / len(g)
        if len(g) >= 3:
            recent = exact(r["result_score"] for r in g[-5:]) / len(g[-5:])
            overall = exact(r["result_score"] for r in g) / len(g)
            tr = max(0.0, min(100.0, 50 + (recent - overall) * 50))
        else:
            tr = 50.0
        comp = 0.25 * fr + 0.25 * rec + 0.30 * sev + 0.20 * tr
        out[key] = {"n": len(g), "failure_rate_score": r1(fr), "recency_score": r1(rec),
                    "violation_severity_score": r1(sev), "trend_score": r1(tr),
                    "dynamic_risk_score": r1(max(0.0, min(100.0, comp))),
                    "last_result": g[-1]["results"], "dba_name": g[-1]["dba_name"]}
    return out
