"""Command line: run the pipeline layers.

    python -m strata hr   --landing DIR --warehouse DIR [--gold] [--country GB]
                          [--rehire] [--same-day fail|last] [--holiday-countries GB,US]
                          [--calendar-lo DAY --calendar-hi DAY]
                          [--snapshot-lo DAY --snapshot-hi DAY] [--input-gb N]
    python -m strata gold --sf DIR --warehouse DIR [--input-gb N]

Master, memory and every other setting come from the launcher (``spark-submit``); on a
cluster, shuffles are sized from ``--input-gb`` and the cores unless configured.

Paths may be any URI Spark can read and write. Prints the written tables as JSON.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="strata")
    sub = ap.add_subparsers(dest="cmd", required=True)
    hr_p = sub.add_parser("hr", help="landing -> bronze -> silver (-> gold)")
    hr_p.add_argument("--landing", required=True)
    hr_p.add_argument("--warehouse", required=True)
    hr_p.add_argument("--gold", action="store_true")
    hr_p.add_argument("--country", default="GB")
    hr_p.add_argument("--rehire", action="store_true")
    hr_p.add_argument("--same-day", default="fail", choices=["fail", "last"])
    hr_p.add_argument("--holiday-countries", default="")
    g_p = sub.add_parser("gold", help="gold tables over the TPC-H-shaped input tables")
    g_p.add_argument("--sf", required=True)
    g_p.add_argument("--warehouse", required=True)
    for p in (hr_p, g_p):
        p.add_argument("--input-gb", type=float, default=0.0,
                       help="input size, from which a cluster session sizes its shuffles")
    for name, what in (("calendar-lo", "first"), ("calendar-hi", "last")):
        hr_p.add_argument(f"--{name}", type=dt.date.fromisoformat, help=f"{what} holiday kept")
    for name, what in (("snapshot-lo", "first"), ("snapshot-hi", "last")):
        hr_p.add_argument(f"--{name}", type=dt.date.fromisoformat,
                          help=f"{what} day of the Gold dates and snapshot")
    a = ap.parse_args(argv)

    from strata.session import apply_settings, get_session, is_one_machine, scale_settings
    spark = get_session()
    if not is_one_machine(spark):
        apply_settings(spark, scale_settings(int(a.input_gb * (1 << 30)),
                                             spark.sparkContext.defaultParallelism))
    if a.cmd == "hr":
        from strata.plans import hr
        countries = [c for c in a.holiday_countries.split(",") if c]
        paths = hr.run(spark, a.landing, a.warehouse, rehire=a.rehire, same_day=a.same_day,
                       holiday_countries=countries, calendar_lo=a.calendar_lo or hr.CALENDAR_LO,
                       calendar_hi=a.calendar_hi or hr.CALENDAR_HI)
        if a.gold:
            paths.update(hr.gold(spark, paths, a.warehouse, country=a.country,
                                 lo=a.snapshot_lo or hr.SNAPSHOT_LO, hi=a.snapshot_hi or hr.SNAPSHOT_HI))
    else:
        from strata.plans import gold
        paths = gold.build(spark, a.sf, a.warehouse)
    print(json.dumps(paths, indent=2))


if __name__ == "__main__":
    main()
