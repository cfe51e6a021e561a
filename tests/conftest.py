import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from odpanel.session import build_session
    wh = tempfile.mkdtemp(prefix="odpanel-wh-")
    s = build_session("local[4]", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": wh,
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="odpanel-ck-")})
    yield s
    s.stop()


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
