import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from mapflow.session import build_session

    s = build_session("local[*]", app_name="mapflow-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="mapflow-test-wh-")})
    # Tests run without a cluster: give them their own checkpoint folder.
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="mapflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def store(spark):
    from mapflow import TableStore
    from mapflow.session import scratch_dir

    return TableStore(spark, scratch_dir(spark, "test-tables"))


@pytest.fixture()
def registry(spark, store):
    from mapflow import TableRegistry

    return TableRegistry(spark, store).register_parquet_dir(
        SF001, ["region", "nation", "customer", "supplier", "orders", "lineitem", "events"], schema="testdata")


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def plan_text(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()
