"""CLI: python tests/run_oracle.py [sf_dir] [query ...]"""
import json
import sys

sys.path.insert(0, "/root/repo")
sys.path.insert(0, "/root/repo/tests")
from oracle_compare import compare  # noqa: E402

from hazardlens.session import build_session  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session()
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if not v.get("values_match", False)]
    print(json.dumps({"n": len(res), "bad": bad}))
