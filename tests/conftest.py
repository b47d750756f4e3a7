import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tarifold.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Apply a column function to rows of string arguments."""

    def run(function, *rows):
        rows = [r if isinstance(r, tuple) else (r,) for r in rows]
        names = [f"a{i}" for i in range(len(rows[0]))]
        numbered = [(n, *r) for n, r in enumerate(rows)]
        df = spark.createDataFrame(numbered, "n int, " + ", ".join(f"{x} string" for x in names))
        out = df.select("n", function(*[df[x] for x in names]).alias("r")).orderBy("n")
        return [r["r"] for r in out.collect()]

    return run
