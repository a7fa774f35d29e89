import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from listingflow.session import get_spark
    import tempfile
    s = get_spark("local[4]", 8, app_name="listingflow-tests",
                  extra={"spark.driver.memory": "4g",
                         "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="listingflow-wh-")})
    yield s
    s.stop()


def eval_rows(spark, schema, rows, *cols):
    """Evaluate Column expressions over literal rows; returns a list of tuples in input order."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    out = df.select("i", *cols).orderBy("i").collect()
    return [tuple(r)[1:] for r in out]
