"""`python -m mercastar SOURCES TARGET`: run everything and print the checks."""

from __future__ import annotations

import argparse

from mercastar.plans.run import run
from mercastar.session import get_session


def main() -> int:
    parser = argparse.ArgumentParser(prog="mercastar", description=__doc__)
    parser.add_argument("sources", help="folder with the raw CSV files")
    parser.add_argument("target", help="folder for raw, staging and warehouse tables")
    arguments = parser.parse_args()
    result = run(get_session(), arguments.sources, arguments.target)
    for text in result.warnings:
        print(f"warning: {text}")
    for row in result.checks.collect():  # 24 rows
        print(f"{row['status']}  {row['check_name']}: {row['detail']}")
    return 0 if result.success else 1


if __name__ == "__main__":
    raise SystemExit(main())
