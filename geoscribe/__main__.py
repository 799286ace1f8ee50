"""Command line.

    python -m geoscribe phase1   <posts.tsv> <stop_words.txt> <out_dir>
    python -m geoscribe classify <posts.tsv> <query.txt> <out_path> [--all-lines]
    python -m geoscribe profile  <posts.tsv> [<sample fraction>]

Uses the active SparkSession when submitted with ``spark-submit``; otherwise
starts a local one.
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from geoscribe.operators.sample import sample_lines
from geoscribe.plans.tasks import run_classifier, run_phase1, task1_profile
from geoscribe.session import build_session
from geoscribe.sources import parse_fields, scan_delimited

USAGE = __doc__
SAMPLE_SEED = 5
ALL_LINES = "--all-lines"


def _profile(spark, path: str, fraction: float | None) -> list[tuple[str, float]]:
    """The eleven metrics, optionally of a Bernoulli sample of the lines with a
    fixed seed (drawn by file and line number, so copies of a line are drawn apart)."""
    posts = scan_delimited(spark, path) if fraction is None else parse_fields(
        sample_lines(spark, path, fraction, SAMPLE_SEED))
    # Eleven rows: the one place a result is brought to the driver, to print it.
    return [(r.metric, r.value) for r in task1_profile(posts).orderBy("ord").collect()]


def main(argv: list[str]) -> int:
    all_lines = argv[:1] == ["classify"] and ALL_LINES in argv
    argv = [a for a in argv if not (all_lines and a == ALL_LINES)]
    ok = (len(argv) == 4 and argv[0] in ("phase1", "classify")) or (argv[:1] == ["profile"] and len(argv) in (2, 3))
    if not ok:
        print(USAGE, file=sys.stderr)
        return 2
    spark = SparkSession.getActiveSession() or build_session()
    if argv[0] == "profile":
        for metric, value in _profile(spark, argv[1], float(argv[2]) if len(argv) == 3 else None):
            print(f"{metric}\t{value}")
    elif argv[0] == "phase1":
        for name, path in run_phase1(spark, argv[1], argv[2], argv[3]).items():
            print(f"{name}\t{path}")
    else:
        print(run_classifier(spark, argv[1], argv[2], argv[3], all_lines))
    return 0


def cli() -> None:
    """Console-script entry point (``geoscribe ...`` after installation)."""
    sys.exit(main(sys.argv[1:]))


if __name__ == "__main__":
    cli()
