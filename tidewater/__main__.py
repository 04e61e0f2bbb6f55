"""Command line: run one pipeline increment or a report on a warehouse root.

    python -m tidewater run --root ROOT --customers P --products P --sales P \\
        [--day YYYY-MM-DD] [--ts 'YYYY-MM-DD HH:MM:SS']
    python -m tidewater report --root ROOT --start D --end D --out PATH
    python -m tidewater metrics --root ROOT [--ts T] --out PATH

Sources are Parquet folders with the operational schemas (customers: id,
name, country, created_at, updated_at; products: id, name, group_name,
created_at, updated_at; sales: id, customer_id, product_id, qty,
transaction_date, created_at).  Each ``run`` continues from the last
committed run under ROOT.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tidewater")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run")
    r.add_argument("--root", required=True)
    for name in ("customers", "products", "sales"):
        r.add_argument(f"--{name}", required=True)
    r.add_argument("--day", default=None)
    r.add_argument("--ts", default=None)
    rep = sub.add_parser("report")
    rep.add_argument("--root", required=True)
    rep.add_argument("--start", required=True)
    rep.add_argument("--end", required=True)
    rep.add_argument("--out", required=True)
    met = sub.add_parser("metrics")
    met.add_argument("--root", required=True)
    met.add_argument("--ts", default=None)
    met.add_argument("--out", required=True)
    args = ap.parse_args(argv)

    from tidewater.plans.pipeline import Run, open_warehouse, run_until_committed
    from tidewater.session import build_session
    spark = build_session()
    wh = open_warehouse(spark, args.root)
    if args.cmd == "run":
        now = dt.datetime.now().replace(microsecond=0)
        day = dt.date.fromisoformat(args.day) if args.day else now.date()
        ts = args.ts or now.isoformat(sep=" ")
        sources = {n: spark.read.parquet(getattr(args, n))
                   for n in ("customers", "products", "sales")}
        wh = run_until_committed(spark, args.root, lambda n: Run(n, day, ts, sources))
        last = max(wh.runs)
        print(json.dumps({"run": last, "rows": wh.rows, "marks": wh.runs[last]["marks"]}, default=str))
    elif args.cmd == "report":
        from tidewater.plans.procedures import aggregate_sales_report
        df = aggregate_sales_report(wh, dt.date.fromisoformat(args.start),
                                    dt.date.fromisoformat(args.end))
        df.write.parquet(args.out)
    else:
        from tidewater.plans.procedures import refresh_customer_metrics
        ts = args.ts or dt.datetime.now().replace(microsecond=0).isoformat(sep=" ")
        refresh_customer_metrics(wh, ts).write.parquet(args.out)
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
