"""Load, check, analyse and export from the command line.

    spark-submit --py-files stockrecon.zip stockrecon/__main__.py SOURCE TARGET [options]
    python -m stockrecon SOURCE TARGET --known-issues PATH
"""

import argparse

from stockrecon.plans.analysis import run
from stockrecon.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="stockrecon", description=__doc__.splitlines()[0])
    parser.add_argument("source", help="folder with the eight input tables")
    parser.add_argument("target", help="folder for the results")
    parser.add_argument("--source-format", default="csv")
    parser.add_argument("--target-format", default="csv")
    parser.add_argument("--known-issues", help="labels for the validation summary")
    options = parser.parse_args()
    spark = build_session()
    counts = run(
        spark,
        options.source,
        options.target,
        options.source_format,
        options.target_format,
        options.known_issues,
    )
    counts.show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
