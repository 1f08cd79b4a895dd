"""Command line: the same steps as the original scripts, run as Spark jobs.

    python -m hazardlens profile   --raw PAGES_DIR
    python -m hazardlens store     --raw PAGES_DIR --out RAW_CSV_DIR
    python -m hazardlens transform --raw PAGES_DIR --out TABLES_DIR --as-of "2024-06-01 00:00:00" [--explore]
    python -m hazardlens load      --tables TABLES_DIR (--jdbc-url URL [--truncate] | --to DIR)
    python -m hazardlens verify    --tables TABLES_DIR
    python -m hazardlens query     NAME --sf-dir /root/testdata/sf0.01 [--show 20]

``--raw`` accepts landed pages (default: one JSON array per line), raw API
responses saved one array per file (``--raw-format json-files``) or a CSV
export (``--raw-format csv``, columns by header). Every landed column passes through, renamed where it
would clash. ``--input-bytes`` sizes the shuffles of a cluster job. Results are written by Spark; only
small reports (``show``) reach the console.
"""

from __future__ import annotations

import argparse
import sys



def _read_raw(spark, path: str, fmt: str):
    if fmt == "csv":
        from .sources.files import read_raw_csv
        return read_raw_csv(spark, path)
    from .sources.landed import read_all_keys
    return read_all_keys(spark, path, fmt == "json-files")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="hazardlens")
    sub = p.add_subparsers(dest="cmd", required=True)
    pr = sub.add_parser("profile", help="Q1-Q4 over landed raw records")
    tr = sub.add_parser("transform", help="clean -> signals -> scores, write both tables")
    st = sub.add_parser("store", help="store the raw pull as CSV")
    st.add_argument("--out", required=True)
    for a in (pr, tr, st):
        a.add_argument("--raw", required=True)
        a.add_argument("--raw-format", choices=["json", "json-files", "csv"], default="json",
                       help="json: one page array per line; json-files: one array per file; csv: by header")
    tr.add_argument("--out")
    tr.add_argument("--as-of", required=True)
    tr.add_argument("--explore", action="store_true", help="show the 5-sample parser report instead")
    ld = sub.add_parser("load", help="refresh the tables of a database (or copy them with sink types)")
    ld.add_argument("--tables", required=True)
    ld.add_argument("--jdbc-url")
    ld.add_argument("--truncate", action="store_true", help="empty the tables instead of dropping them")
    ld.add_argument("--to")
    ld.add_argument("--snapshots", action="store_true", help="with --to: both tables as one new snapshot")
    vf = sub.add_parser("verify", help="L1 row counts and L2 top-5")
    vf.add_argument("--tables", required=True)
    qy = sub.add_parser("query", help="run one registered query")
    qy.add_argument("name")
    qy.add_argument("--sf-dir", required=True)
    qy.add_argument("--show", type=int, default=20)
    for a in (pr, tr, st, ld, vf, qy):
        a.add_argument("--master", default=None)
        a.add_argument("--input-bytes", type=int, help="size of the input, from which the shuffle partitions follow")
    args = p.parse_args(argv)

    from .session import job_session
    spark = job_session(args.master, input_bytes=args.input_bytes)

    if args.cmd == "profile":
        from .operators import profiling as P
        raw = _read_raw(spark, args.raw, args.raw_format)
        for df in (P.raw_shape(raw), P.raw_date_range(raw), P.distinct_licenses(raw), P.result_distribution(raw)):
            df.show(50, truncate=False)
    elif args.cmd == "store":
        from .sinks.writers import write_csv
        write_csv(_read_raw(spark, args.raw, args.raw_format), args.out)
    elif args.cmd == "transform":
        from .operators.clean import clean_report
        from .operators.scoring import score_distribution, top_riskiest
        from .plans.batch import run_transform
        raw = _read_raw(spark, args.raw, args.raw_format)
        if args.explore or not args.out:
            clean_report(raw).show(truncate=False)
        res = run_transform(spark, raw, args.as_of, out_dir=args.out,
                            mode="explore" if args.explore else "score")
        if res.counters:   # row-drop counters observed during the write job itself
            for k, v in res.counters.items():
                print(f"{k:>18s}: {v if v is None else format(v, ',')}")
        if args.explore:
            res.report.show(truncate=False, vertical=True)
        else:
            score_distribution(res.scores).show()
            top_riskiest(res.scores, 10).show(truncate=False)
    elif args.cmd == "load":
        from .sinks import writers as K
        base = args.tables.rstrip("/")
        insp = K.inspections_for_load(spark.read.parquet(f"{base}/inspections"))
        scores = K.scores_for_load(spark.read.parquet(f"{base}/risk_scores"))
        if args.jdbc_url:
            K.refresh_jdbc(insp, scores, args.jdbc_url, truncate=args.truncate)
        elif args.to and args.snapshots:
            from .sinks.snapshots import publish
            publish(insp, scores, args.to)
        elif args.to:
            K.refresh_tables(insp, scores, f"{args.to.rstrip('/')}/inspections", f"{args.to.rstrip('/')}/risk_scores")
        else:
            p.error("load needs --jdbc-url or --to")
    elif args.cmd == "verify":
        from .operators import profiling as P
        from .sinks.snapshots import current
        base = args.tables.rstrip("/")
        held = current(spark, base)
        inspections, scores = (held.read(spark, t) if held else spark.read.parquet(f"{base}/{t}")
                               for t in ("inspections", "risk_scores"))
        P.verify_counts(inspections, scores).show()
        P.verify_top(scores, 5).show(truncate=False)
    elif args.cmd == "query":
        from .plans.registry import queries
        qs = queries()
        if args.name not in qs:
            p.error(f"unknown query {args.name!r}; known: {', '.join(sorted(qs))}")
        qs[args.name](spark, args.sf_dir).show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
