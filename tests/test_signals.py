"""Hand goldens for the violation-text signals (codes, tiers, keywords, severity)."""

import pytest

from conftest import raw_rows, record
from hazardlens.operators.signals import parse_violations, severity_stats, signal_totals

CASES = [
    ("32. FOO - Comments: mice near wall | 33. BAR", [32, 33], (0, 0, 2), ["mice", "wall"], (1, 0, 1), 25.92),
    ("5. X| 70. Y|99. Z|45. W|7.x", [5, 70], (1, 0, 1), [], (0, 0, 0), 18.13),
    ("70.", [], (0, 0, 0), [], (0, 0, 0), 0.0),
    ("3. a | 3. b", [3, 3], (2, 0, 0), [], (0, 0, 0), 25.92),
    ("High TEMPERATURE", [], (0, 0, 0), ["rat", "temperature"], (1, 1, 0), 22.12),
    ("pesticide", [], (0, 0, 0), ["pesticide", "pest"], (0, 2, 0), 18.13),
    ("cockroaches", [], (0, 0, 0), ["roach", "roaches", "cockroach", "cockroaches"], (4, 0, 0), 45.12),
    ("", [], (0, 0, 0), [], (0, 0, 0), 0.0),
    (None, [], (0, 0, 0), [], (0, 0, 0), 0.0),
]


@pytest.mark.parametrize("text,codes,tiers,found,kw,sev", CASES)
def test_signal_goldens(spark, text, codes, tiers, found, kw, sev):
    df = parse_violations(raw_rows(spark, [record(violations=text)]))
    r = df.collect()[0]
    assert r.violation_codes == codes
    assert (r.n_critical, r.n_serious, r.n_minor) == tiers
    assert r.kw_found == found
    assert (r.kw_critical, r.kw_major, r.kw_minor) == kw
    assert r.violation_severity == pytest.approx(sev, abs=1e-9)


def test_multiline_and_unicode_whitespace(spark):
    # A code right after a pipe on a new line, and a non-breaking space after the dot.
    text = "1. A\n| 15. B | 44. C"
    r = parse_violations(raw_rows(spark, [record(violations=text)])).collect()[0]
    assert r.violation_codes == [1, 15, 44]


def test_severity_never_falls_when_keyword_appended(spark):
    base = "32. FOO - Comments: clean"
    rows = [record(inspection_id="a", violations=base), record(inspection_id="b", violations=base + " mouse")]
    out = {r.inspection_id: r.violation_severity for r in parse_violations(raw_rows(spark, rows)).collect()}
    assert out["b"] > out["a"]


def test_totals_and_stats(spark):
    rows = [record(inspection_id=str(i), violations=t) for i, (t, *_rest) in enumerate(CASES)]
    df = parse_violations(raw_rows(spark, rows))
    tot = signal_totals(df).collect()[0]
    assert tot.total_codes == sum(len(c[1]) for c in CASES)
    assert tot.total_keyword_hits == sum(len(c[3]) for c in CASES)
    st = severity_stats(df).collect()[0]
    sevs = sorted(c[5] for c in CASES)
    assert st.max_severity == pytest.approx(45.1)
    assert st.median_severity == pytest.approx(round(sevs[len(sevs) // 2], 1))


def test_no_python_udf_in_plan(spark):
    df = parse_violations(raw_rows(spark, [record(violations="1. x")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_strip_matches_python(spark):
    from hazardlens.functions.text import strip
    samples = ["  a b  ", "\x1c\x1dx\x1e\x1f", " y　", "\t\n\x0b\x0cz\r", "", "   ", "​q​"]
    df = spark.createDataFrame([(s,) for s in samples] + [(None,)], "t string")
    got = [r.s for r in df.select(strip("t").alias("s")).collect()]
    assert got == [s.strip() for s in samples] + [None]
