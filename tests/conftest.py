import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from panelyze.session import SESSION_DEFAULTS

    b = (
        SparkSession.builder.master("local[*]")
        .appName("panelyze-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="panelyze-test-wh-"))
    )
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, order=None):
    """Collect as a list of dicts, sorted by ``order`` columns if given."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    if order:
        out.sort(key=lambda d: tuple((d[c] is None, d[c]) for c in order))
    return out
