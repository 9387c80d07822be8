"""Run a batch job: ``python -m tastegrid JOB --out DIR [--ratings …]``.

The arguments of each job are those of its function; ``JOB --help`` lists them.
"""

from __future__ import annotations

import argparse
import inspect
import re

from tastegrid.plans import jobs
from tastegrid.session import build_session

JOBS = {
    "average-ratings": jobs.average_ratings,
    "user-tables": jobs.user_tables,
    "recommendations": jobs.recommendations,
    "exclusions": jobs.exclusions,
    "rating-matrix": jobs.rating_matrix,
    "cohort-summaries": jobs.cohort_summaries,
    "splits": jobs.evaluation_splits,
}
LOOKUPS = {"recommendations": jobs.show_profiles, "documents": jobs.show_documents, "rows": jobs.show_rows}


def _range(text: str) -> tuple[int, int]:
    found = re.fullmatch(r"(\d+)-(\d+)", text)
    if not found:
        raise argparse.ArgumentTypeError(f"not a range such as 1-10: {text}")
    return int(found[1]), int(found[2])


def _add_arguments(command: argparse.ArgumentParser, function) -> None:
    for name, parameter in list(inspect.signature(function).parameters.items())[1:]:
        option = f"--{name.replace('_', '-')}"
        if parameter.default is inspect.Parameter.empty:
            command.add_argument(option, required=True)
        elif isinstance(parameter.default, tuple):
            command.add_argument(option, type=_range, nargs="+", default=parameter.default)
        else:
            command.add_argument(option, type=type(parameter.default), default=parameter.default)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tastegrid", description=__doc__)
    commands = parser.add_subparsers(dest="job", required=True)
    for name, function in JOBS.items():
        _add_arguments(commands.add_parser(name, help=function.__doc__), function)
    show = commands.add_parser("lookup", help="Show what a table holds for some users.")
    show.add_argument("--table", required=True)
    show.add_argument("--kind", choices=LOOKUPS, default="recommendations")
    show.add_argument("user_ids", type=int, nargs="+")
    args = vars(parser.parse_args(argv))

    job = args.pop("job")
    spark = build_session(f"tastegrid-{job}")
    if job == "lookup":
        found = LOOKUPS[args["kind"]](spark, args["table"], args["user_ids"])
        found.show(found.count(), truncate=False)
        return
    for name, path in JOBS[job](spark, **args).items():
        print(f"{name}: {path}")


if __name__ == "__main__":
    main()
