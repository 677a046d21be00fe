"""Command line: the three steps of the original workflow.

    python -m rulebeam profile --train T.csv --test E.csv
    python -m rulebeam mine    --train T.csv --test E.csv --out RESULTS_DIR
    python -m rulebeam report  --out RESULTS_DIR

Uses the session the environment provides (``spark-submit`` / cluster
defaults); intermediate tables go to ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime

from pyspark.sql import SparkSession


def _show(title: str, df, rows: int, order=()) -> None:
    """Print a table in a fixed order; a cut at ``rows`` rows is said."""
    print(f"\n== {title}")
    df = df.orderBy(*order) if order else df
    found = df.limit(rows + 1).collect()
    widths = [max([len(c), *(len(str(r[i])) for r in found[:rows])]) for i, c in enumerate(df.columns)]
    for values in [df.columns, *found[:rows]]:
        print("  ".join(str(v).ljust(w) for v, w in zip(values, widths)).rstrip())
    if len(found) > rows:
        print(f"... the first {rows} of {df.count()} rows; --rows sets how many, --out writes all")


def _profile(spark, args) -> None:
    from .plans.eda import profile_run
    from .plans.mining import run_from_files
    from .sinks.writers import new_run_id, write_result

    r = run_from_files(spark, args.train, args.test, fmt=args.format, max_rejected=args.max_rejected)
    r.observe = True  # one scan for the whole profile
    try:
        p = profile_run(r)
        orders = {"shape": ["split"], "nulls": ["split", "column"], "class_balance": ["split"], "composition": ["split"],
                  "rates": ["feature", "split", "value"], "comparison": ["dataset"], "rate_by_time_period": ["value"],
                  "rate_by_amount": []}
        run_id = new_run_id()
        for name, order in orders.items():
            df = getattr(p, name)
            order = [c for c in order if c in df.columns]
            if args.out:
                write_result(df.orderBy(*order) if order else df, args.out, f"profile_{name}", run_id, args.format)
            if name == "rates":
                for (feature,) in sorted(df.select("feature").distinct().collect()):
                    _show(f"rates: {feature}", df.where(df["feature"] == feature), args.rows, order)
            else:
                _show(name, df, args.rows, order)
    finally:
        r.release()


def _mine(spark, args) -> None:
    from .operators.report import pattern_counts, report_table
    from .plans.mining import export, run_from_files

    r = run_from_files(spark, args.train, args.test, fmt=args.format, max_rejected=args.max_rejected)
    try:
        run_id = export(r, args.out, fmt=args.format)
        _show("patterns per level", pattern_counts(r.patterns), args.rows, ["level"])
        _show("top patterns", report_table(r.patterns), args.rows, ["rank"])
        _show("validation", r.validated.select("rank", "pattern_name", "status"), args.rows, ["rank"])
        print(f"\nresults written under {args.out} (run_id={run_id})")
    finally:
        r.release()  # intermediate tables; the exported results stay


def _report(spark, args) -> None:
    from .plans.reporting import report
    from .sinks.writers import new_run_id, write_summary_text

    rep = report(spark, args.out, generated=datetime.now().strftime("%Y-%m-%d %H:%M:%S"), fmt=args.format)
    if rep.top_patterns is None:
        print("no confidence column: counts only")
    else:
        _show("top patterns", rep.top_patterns, args.rows, ["rank"])
    if rep.pattern_types is not None:
        _show("pattern types", rep.pattern_types, args.rows)
    _show("summary", rep.summary, args.rows)
    if rep.text is not None:
        for row in rep.text.orderBy("line_no").collect():  # a few lines for each of the top patterns
            print(row.line)
        print("text written to", write_summary_text(rep.text, args.out, new_run_id()))


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="rulebeam")
    ap.add_argument("step", choices=["profile", "mine", "report"])
    ap.add_argument("--train")
    ap.add_argument("--test")
    ap.add_argument("--out", help="results folder (profile, mine: written, report: read, text written)")
    ap.add_argument("--format", default="csv", help="input/output format (csv, parquet, ...)")
    ap.add_argument("--max-rejected", type=float, default=None,
                    help="share of bad CSV records to leave out; without it the first one is an error")
    ap.add_argument("--rows", type=int, default=50, help="rows printed of each table")
    args = ap.parse_args(argv)
    if args.step in ("profile", "mine") and not (args.train and args.test):
        ap.error("--train and --test are required")
    if args.step in ("mine", "report") and not args.out:
        ap.error("--out is required")
    spark = SparkSession.builder.appName(f"rulebeam-{args.step}").getOrCreate()
    {"profile": _profile, "mine": _mine, "report": _report}[args.step](spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
