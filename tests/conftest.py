import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tieproof.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", 4)


@pytest.fixture
def value(spark):
    """Evaluate one column expression over one row of string cells."""
    from pyspark.sql import functions as F

    def run(fn, *cells):
        df = spark.createDataFrame([tuple(cells) + (1,)], ", ".join(f"c{i} string" for i in range(len(cells))) + ", one int")
        out = df.select(fn(*[F.col(f"c{i}") for i in range(len(cells))]).alias("v")).first()["v"]
        return out.asDict(recursive=True) if hasattr(out, "asDict") else out

    return run
