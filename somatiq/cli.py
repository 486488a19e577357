"""Command line: python -m somatiq.cli flows list | info NAME | run NAME key=value ..., and version."""

from __future__ import annotations

import argparse
import inspect
import sys

from . import __version__
from .operators.metadata import FAILED
from .plans.flows import FLOWS


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="somatiq")
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("version")
    flows = sub.add_parser("flows").add_subparsers(dest="action", required=True)
    flows.add_parser("list")
    flows.add_parser("info").add_argument("name", choices=sorted(FLOWS))
    run = flows.add_parser("run")
    run.add_argument("name", choices=sorted(FLOWS))
    run.add_argument("options", nargs="*", help="key=value")
    run.add_argument("--force", action="store_true")
    run.add_argument("--allow-flow-failure", action="store_true")
    run.add_argument("--master", default=None)
    told = parser.parse_args(argv)
    if told.command == "version":
        print(__version__)
    elif told.action == "list":
        print("\n".join(sorted(FLOWS)))
    elif told.action == "info":
        f = FLOWS[told.name]
        print(f"{told.name}{inspect.signature(f)}\n{inspect.getdoc(f) or ''}")
    else:
        return _run(told)
    return 0


def _run(told: argparse.Namespace) -> int:
    from .session import make_session

    spark = make_session("somatiq", **({"spark.master": told.master} if told.master else {}))
    options: dict = dict(o.split("=", 1) for o in told.options)
    for k, v in options.items():
        if v.isdigit():
            options[k] = int(v)
    if told.force and "forced" in inspect.signature(FLOWS[told.name]).parameters:
        options["forced"] = True
    result = FLOWS[told.name](spark, **options)
    failed = isinstance(result, list) and any(status == FAILED for _, status, _ in result)
    for line in result if isinstance(result, list) else [result]:
        print(line)
    return 1 if failed and not told.allow_flow_failure else 0


if __name__ == "__main__":
    sys.exit(main())
