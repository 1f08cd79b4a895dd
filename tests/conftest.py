import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from hazardlens.schemas import RAW  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
AS_OF = "2001-09-01 12:00:00"
EVENTS = tempfile.mkdtemp(prefix="hazardlens-events-")      # the plans that tests look at


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"file://{EVENTS}")
         .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


def raw_rows(spark, rows):
    """Raw frame from dicts; absent keys are null, ingest_seq defaults to the row position."""
    full = []
    for i, r in enumerate(rows):
        base = {f.name: None for f in RAW.fields}
        base["ingest_seq"] = i
        base.update(r)
        full.append(tuple(base[f.name] for f in RAW.fields))
    return spark.createDataFrame(full, RAW)


def record(**kw):
    """A usable raw record with sensible defaults."""
    base = {"inspection_id": "1", "dba_name": "Joe's", "address": "1 N ST", "license_": "L1",
            "inspection_date": "2001-08-01", "inspection_type": "Canvass", "results": "Pass",
            "violations": ""}
    base.update(kw)
    return base
