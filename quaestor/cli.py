"""Command line: ``python -m quaestor.cli build|supplement|cleanup|score``."""

from __future__ import annotations

import argparse

from quaestor.operators.report import shares, totals
from quaestor.operators.sections import SECTION_NAMES
from quaestor.options import Options
from quaestor.plans import build as bd
from quaestor.plans import maintain as mt
from quaestor.schemas import DIFFICULTIES, QUESTION_TYPES
from quaestor.session import build_session
from quaestor.sources import filings as fl
from quaestor.sources.providers import OfflineProvider, provider_from_env
from quaestor.sources.stages import load_stage


def _parser() -> argparse.ArgumentParser:
    defaults = Options()
    parser = argparse.ArgumentParser(prog="quaestor")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("build", "supplement"):
        sub = commands.add_parser(name)
        sub.add_argument("--filings", help="folder or pattern of HTML filings; without it those of --cik are looked up or downloaded")
        sub.add_argument("--data-dir", default=defaults.data_dir, help="where downloaded filings are kept")
        sub.add_argument("--cik", default=defaults.cik, help="company number, several with commas")
        sub.add_argument("--min-pairs", type=int, default=defaults.min_qa_pairs)
        sub.add_argument("--stages", default=defaults.checkpoint_dir)
        sub.add_argument("--output", default=defaults.dataset_dir)
        sub.add_argument("--resume", action="store_true", help="go on with stored stages")
        sub.add_argument("--offline", action="store_true", help="use the offline provider")
        sub.add_argument("--provider-tasks", type=int, default=1)
        sub.add_argument("--request-waves", type=int, default=1, help="parts in which requests are sent and stored")
        sub.add_argument("--single-file", action="store_true", help="one file per output")
        sub.add_argument("--plain-sentences", action="store_true", help="end sentences at every end mark, learn nothing from the filings")
        if name == "supplement":
            sub.add_argument("--earlier-stages", required=True)
    sub = commands.add_parser("cleanup")
    sub.add_argument("--dataset", required=True)
    sub.add_argument("--output", required=True)
    sub.add_argument("--stages", default=defaults.checkpoint_dir)
    sub = commands.add_parser("score")
    sub.add_argument("--predictions", required=True)
    sub.add_argument("--dataset", default=f"{defaults.dataset_dir}/qa_pairs.csv")
    sub.add_argument("--infer-types", action="store_true", help="read predicted answers by the type that their whole column has")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session()
    if args.command == "score":
        print("Matched %d / %d" % mt.match_counts(spark, args.dataset, args.predictions))
        print(mt.format_scores(mt.score_files(spark, args.dataset, args.predictions, args.infer_types)))
        return
    if args.command == "cleanup":
        print(mt.cleanup_dataset(spark, args.dataset, args.output, args.stages))
        return
    options = Options(cik=args.cik, min_qa_pairs=args.min_pairs)
    provider = OfflineProvider if args.offline else lambda: provider_from_env(options)
    run = bd.Run(args.stages, args.output, provider, options, args.resume,
                 None if args.offline else args.provider_tasks, args.request_waves, args.single_file, not args.plain_sentences)
    if args.filings:
        filings = fl.read_filings(spark, args.filings)
    else:
        companies = spark.createDataFrame([(c.strip(),) for c in args.cik.split(",")], "cik string")
        for row in fl.download(spark, args.data_dir, companies, options).collect():
            print(f"{row['cik']}: {row['error']}")
        filings = fl.stored_filings(spark, args.data_dir, companies)
    result = (bd.build_dataset(spark, filings, run) if args.command == "build"
              else bd.supplement_dataset(spark, filings, run, args.earlier_stages))
    print(result)
    if not result["enough"]:
        print(f"Only {result['final']} pairs, {options.min_qa_pairs} were asked for.")
    final = load_stage(spark, run.stage_dir, "final")
    row = totals(final).first()
    for name, values in (("type", QUESTION_TYPES), ("level", DIFFICULTIES), ("place", SECTION_NAMES)):
        for value, count, label, bar in shares(row, name, values):
            print(f"{value:36s} {count:8d} {label:>6s} {bar}")


if __name__ == "__main__":
    main()
