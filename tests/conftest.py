import os
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

import pytest  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g"}
    session = SparkSession.builder.master("local[4]").appName("tests").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    """Rows of SQL over the tables of a size, columns in order of name."""
    import duckdb

    def run(size: str, sql: str):
        con = duckdb.connect()
        for p in Path(DATA, size).glob("*.parquet"):
            con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
        found = con.execute(sql)
        names = [x[0] for x in found.description]
        order = sorted(range(len(names)), key=names.__getitem__)
        return sorted(names), sorted(repr(tuple(r[i] for i in order)) for r in found.fetchall())

    return run
