"""spark-submit jobs/run_sql.py <file.sql>: run one SQL statement from a file."""

from __future__ import annotations

from pathlib import Path

from jobs.common import parser, run
from tidemark.sources import run_sql


def main(argv, spark) -> None:
    options = parser(__doc__, "sql_file").parse_args(argv)
    run_sql(spark, Path(options.sql_file).read_text(encoding="utf-8")).show(truncate=False)


if __name__ == "__main__":
    run(main, "run-sql")
