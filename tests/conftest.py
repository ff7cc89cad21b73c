import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    top = tmp_path_factory.mktemp("spark")
    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"{top}/shared",
        "spark.sql.warehouse.dir": f"{top}/warehouse", "spark.ui.showConsoleProgress": "false",
    }
    made = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck():
    """Runs SQL over the supplied tables of a folder."""
    import duckdb

    tables = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

    def run(sf_dir, sql):
        con = duckdb.connect()
        for t in tables:
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
        return con.sql(sql).df()

    return run
