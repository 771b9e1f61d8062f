import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from driftwood.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = build_session(master="local[4]", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


def rows(df, *cols):
    """Collect as a sorted list of tuples (None sorts first)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))


def plan_text(df) -> str:
    """Executed plan text; for an adaptive plan only its final part."""
    t = df._jdf.queryExecution().executedPlan().toString()
    return t.split("== Initial Plan ==")[0]
