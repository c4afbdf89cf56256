"""Command line for the four stages (thin job parameters only).

    python -m panelkit.plans.cli ipos     --names N [N ...] --company C --link L --start S --end E \
                                          [--exchange X] --out O
    python -m panelkit.plans.cli delists  --events D [D ...] --names N [N ...] --start S --end E \
                                          [--exchange X] --out O
    python -m panelkit.plans.cli panel    --ipo I --ratios R [R ...] --link L --funda F [F ...] \
                                          --fundq Q [Q ...] [--annual_linked M] --msf S [S ...] --out O
    python -m panelkit.plans.cli match    --ipo I --delist D [--years 5] --out O
    python -m panelkit.plans.cli clean    --panel P [P ...] --matched M --out O
    python -m panelkit.plans.cli train    --data D [--cutoff-month M] [--C 1.0] [--max-iter 1000] \
                                          [--features a,b] [--save-model PATH] [--train-ratio 0.7] \
                                          [--val-ratio 0.15] [--test-ratio 0.15] [--no-next-year] \
                                          [--label-col Y] [--group-col G] [--time-col T] --out O

Inputs are table paths (the extension picks the reader: .parquet / .csv / .json); every
output is written with ``write_table`` (many files per dataset). Several paths of one option
are ranked sources: names, events and ratios come from the first that gives rows, statements
and stock files from the first per firm. ``train`` writes the metrics, and beside them the
class counts and the weights.
"""

from __future__ import annotations

import argparse
import os
import sys

from panelkit.operators import ml as ML
from panelkit.operators.panel import FactSources
from panelkit.plans import stages
from panelkit.plans.resume import Resumable
from panelkit.session import get_session
from panelkit.sources.io import first_nonempty_source, read_table, write_table


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="panelkit")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ipos")
    a.add_argument("--names", nargs="+", required=True)
    for k in ("company", "link", "start", "end", "out"):
        a.add_argument(f"--{k}", required=k not in ("company", "link"))
    a.add_argument("--exchange", default="NYSE")
    a.add_argument("--limit", type=int)
    a = sub.add_parser("delists")
    for k in ("events", "names"):
        a.add_argument(f"--{k}", nargs="+", required=True)
    for k in ("start", "end", "out"):
        a.add_argument(f"--{k}", required=True)
    a.add_argument("--exchange", default="NYSE")
    a.add_argument("--limit", type=int)
    a = sub.add_parser("panel")
    for k in ("ratios", "funda", "fundq", "msf"):
        a.add_argument(f"--{k}", nargs="+", required=True)
    for k in ("ipo", "link", "out"):
        a.add_argument(f"--{k}", required=True)
    a.add_argument("--annual_linked")
    a = sub.add_parser("match")
    for k in ("ipo", "delist", "out"):
        a.add_argument(f"--{k}", required=True)
    a.add_argument("--years", type=int, default=5)
    a = sub.add_parser("clean")
    a.add_argument("--panel", nargs="+", required=True)
    a.add_argument("--matched", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--direction", choices=["both", "forward"], default="both")
    a = sub.add_parser("train")
    a.add_argument("--data", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--cutoff-month", type=int)
    a.add_argument("--C", type=float, default=1.0)
    a.add_argument("--max-iter", type=int, default=1000)
    a.add_argument("--features")
    a.add_argument("--drop-zero-variance", action="store_true")
    a.add_argument("--save-model")
    a.add_argument("--resume", metavar="FOLDER", help="keep finished stages there and go on from them")
    for k, v in (("train", 0.7), ("val", 0.15), ("test", 0.15)):
        a.add_argument(f"--{k}-ratio", type=float, default=v)
    a.add_argument("--no-next-year", action="store_true", help="train on the rows as they are")
    a.add_argument("--label-col", default="delist")
    a.add_argument("--group-col", default="permno")
    a.add_argument("--time-col", default="public_year")
    return p


def _report(res: stages.TrainResult) -> str:
    r = res.report()
    lines = [f"{split}: " + ", ".join(f"{c}={n}" for (s, c), n in sorted(r["classes"].items()) if s == split)
             for split in ("train", "val", "test")]
    if r["moved_firm"] is not None:
        lines.append(f"moved into training: {r['moved_firm']}")
    lines += [f"parameters: {r['parameters']}", f"features: {', '.join(r['features'])}", f"intercept: {r['intercept']:.6f}"]
    return "\n".join(lines + [f"  {name}: {weight:.6f}" for name, weight in r["weights"]])


def _beside(path: str, what: str) -> str:
    base, ext = os.path.splitext(path.rstrip("/"))
    return f"{base}_{what}{ext}"


def run(argv: list[str], spark=None) -> str:
    """Run one stage; returns the written path."""
    args = _parser().parse_args(argv)
    spark = spark or get_session()

    def rd(path):
        return read_table(spark, path) if path else None

    if args.cmd == "ipos":
        df, _ = stages.fetch_ipos_ranked(spark, args.names, args.start, args.end, args.exchange,
                                         company=rd(args.company), link=rd(args.link), limit=args.limit)
    elif args.cmd == "delists":
        df, _ = stages.fetch_delists_ranked(spark, args.events, args.names, args.start, args.end,
                                            args.exchange, limit=args.limit)
    elif args.cmd == "panel":
        ratios, _ = first_nonempty_source(spark, [(p, p) for p in args.ratios])
        funda = [rd(p) for p in args.funda]
        src = FactSources(
            ratios=ratios, link=rd(args.link), assets=funda,
            revenue=[rd(p) for p in args.fundq], liabilities=funda,
            shares=[rd(p) for p in args.msf],
            price=([(rd(args.annual_linked), False)] if args.annual_linked else []) + [(f, True) for f in funda])
        df = stages.fetch_panel(rd(args.ipo), src)
    elif args.cmd == "match":
        df = stages.match_delistings(rd(args.ipo), rd(args.delist), args.years)
    elif args.cmd == "clean":
        matched = rd(args.matched)
        df = stages.merge_parts([stages.label_exchange(rd(p), matched) for p in args.panel],
                                args.direction)
    else:
        cfg = ML.build_model_config("logistic_regression", {"C": args.C, "max_iter": args.max_iter})
        res = stages.train_and_evaluate(rd(args.data), cfg, features=args.features,
                                        cutoff_month=args.cutoff_month,
                                        drop_zero_variance=args.drop_zero_variance,
                                        save_path=args.save_model,
                                        ratios=(args.train_ratio, args.val_ratio, args.test_ratio),
                                        predict_next_year=not args.no_next_year, label=args.label_col,
                                        group=args.group_col, time=args.time_col,
                                        resume=Resumable(spark, args.resume, [args.data]) if args.resume else None)
        df = res.metrics
        write_table(res.class_distribution, _beside(args.out, "classes"))
        weights = res.model.weights() + [("intercept", res.model.intercept())]
        write_table(spark.createDataFrame(weights, "feature string, coef double"), _beside(args.out, "weights"))
        print(_report(res))
    return write_table(df, args.out)


def main() -> None:
    print(run(sys.argv[1:]))


if __name__ == "__main__":
    main()
