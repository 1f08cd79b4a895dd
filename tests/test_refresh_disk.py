"""What a refresh leaves on disk while it runs: no shuffled rows of an earlier step, no stored raw records."""

import glob
import json
import re
import time

import pytest

from conftest import AS_OF, SF_SMALL
from hazardlens.operators import clean as C
from hazardlens.operators.scoring import risk_scores
from hazardlens.plans import registry
from hazardlens.schemas import INSPECTIONS
from hazardlens.session import DROP_SHUFFLES, checkpoint_root, shuffles_dropped
from hazardlens.sinks import snapshots as S
from hazardlens.streaming import incremental as I
from hazardlens.streaming import refresh as R
from test_registry_plans import executed_plans

ROWS = re.compile(r"Exchange\nInput \[\d+\]: \[[^\]]*\bviolations#[^\]]*\]\nArguments: ([^\n]*)")


def _rows(df):
    return sorted(map(repr, df.collect()))


def _folders(spark):
    return set(glob.glob(re.sub("^file:/*", "/", checkpoint_root(spark)) + "/stage-*"))


def _shuffles(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {b for b in (blocks.apply(i).name() for i in range(blocks.size())) if b.startswith("shuffle_")}


def _run(spark, name):
    """Plans, new folders and new shuffle files of a query, when those that it drops are gone."""
    folders, shuffles = _folders(spark), _shuffles(spark)
    with executed_plans(spark) as plans:
        registry.queries()[name](spark, SF_SMALL).collect()
    for _ in range(50):                                        # they go in the background
        if not (left := _shuffles(spark) - shuffles):
            break
        time.sleep(0.2)
    return [p for p in plans if "isFinalPlan=true" in p], _folders(spark) - folders, left


@pytest.mark.parametrize("name", ["incremental_refresh", "streaming_refresh"])
def test_a_refresh_keeps_no_step_behind(spark, name):
    """raw records go when they have landed, shuffle files with their query."""
    plans, folders, left = _run(spark, name)
    assert not left
    kinds = sorted(re.sub(".*/stage-(.*)-[0-9a-f]{12}$", r"\1", f) for f in folders)
    short = name[:3] if name.startswith("inc") else "stream"
    assert kinds == sorted(["landing", f"{short}-raw", f"{short}-out", f"{short}-ckpt"])
    pages = [f for d in folders if "stage-landing" in d for f in glob.glob(f"{d}/**/part-*", recursive=True)]
    assert pages and all(f.endswith(".json.gz") for f in pages)
    dealt = [a for p in plans for a in ROWS.findall(p)]
    assert dealt and not [a for a in dealt if "inspection_id" in a and not a.startswith("rangepartitioning")]


def test_shuffle_files_are_kept_as_before_outside(spark):
    before = spark.conf.get(DROP_SHUFFLES, None)
    with pytest.raises(ValueError), shuffles_dropped(spark):
        assert spark.conf.get(DROP_SHUFFLES) == "true"
        raise ValueError
    assert spark.conf.get(DROP_SHUFFLES, None) == before


def test_halves_are_the_whole_in_order(spark):
    """null keys and one row alone, too."""
    rows = [(i, s) for i in [None, "", "a", "b10", "b9", "c"] for s in (None, 0, 1)]
    for some in (rows, rows[:3], rows[4:5], []):
        df = spark.createDataFrame(some, "inspection_id string, ingest_seq long")
        key = lambda r: ((r[0] is not None, r[0] or ""), (r[1] is not None, r[1] or 0))
        parts = [sorted(map(tuple, h.collect()), key=key) for h in registry._halves(df)]
        assert [r for p in parts for r in p] == sorted(some, key=key)


def _page(i, result, licence):
    return {"inspection_id": i, "dba_name": "n", "address": "a", "license_": licence, "inspection_date": f"2001-01-{(int(i or 0)) % 28 + 1:02d}",
            "inspection_type": "Canvass", "results": result, "violations": "1. RATS"}


@pytest.mark.parametrize("buckets", [None, 5])
def test_parts_of_a_refresh_are_the_whole(spark, tmp_path, monkeypatch, buckets):
    """rewritten in many parts or at once, sent to tasks or shuffled, the tables are the same."""
    first = [_page(str(i), "Fail" if i % 3 else "Pass", f"L{i % 40}") for i in [*range(300), *range(50)]] + [_page(None, "Pass", "L1")]
    second = [_page(str(i), "Pass", f"L{i % 7}") for i in range(0, 60, 2)] + [_page(None, "Fail", "L2"), _page("900", "Fail", "new")]
    got = {}
    for kind, limits in (("whole", {}), ("parts", {"TURN_ROWS": 20, "TOUCHED_IDS": 10}), ("shuffled", {"TURN_ROWS": 20, "TOUCHED_IDS": 1})):
        with monkeypatch.context() as m:
            for k, v in limits.items():
                m.setattr(I, k, v)
            if kind == "shuffled":
                m.setattr(C, "REPEATED_IDS", -1)
            top = tmp_path / kind
            (top / "landing").mkdir(parents=True)
            for n, records in enumerate((first, second)):
                (top / "landing" / f"d{n}.json").write_text("\n".join(map(json.dumps, records)) + "\n")
                R.start_refresh(spark, f"{top}/landing", f"{top}/raw", f"{top}/out", f"{top}/ckpt", AS_OF, buckets=buckets).awaitTermination(300)
            inspections, scores = R.latest_output(spark, f"{top}/out")
            got[kind] = _rows(inspections.select(INSPECTIONS.fieldNames())), _rows(scores)
            assert got[kind][1] == _rows(risk_scores(inspections, AS_OF).select(scores.columns))
    assert len(got["whole"][0]) == 302 and got["whole"] == got["parts"] == got["shuffled"]


def test_a_failed_batch_leaves_no_rows(spark, tmp_path):
    """parts that a batch had written before it failed are written anew."""
    values = dict.fromkeys(INSPECTIONS.fieldNames())
    rows = [{**values, "inspection_id": str(i), "establishment_id": f"E{i}", "result_score": 1.0, "violation_severity": 1.0} for i in range(9)]
    parsed = spark.createDataFrame(rows, INSPECTIONS)
    I.refresh(spark, parsed, str(tmp_path), AS_OF, 1, 4)
    for f in (tmp_path / S.COMMITS).iterdir():
        f.unlink()
    I.refresh(spark, parsed, str(tmp_path), AS_OF, 1, 4)
    inspections, scores = R.latest_output(spark, str(tmp_path))
    assert (inspections.count(), scores.count()) == (9, 9)
