import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parent.parent
sys.path.insert(0, str(ROOT))
os.environ.setdefault("GRIDWEAVE_DRIVER_MEMORY", "4g")


@pytest.fixture(scope="session")
def spark():
    from gridweave.session import build_session

    s = build_session(4, "tests", **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def make_hot(monkeypatch):
    """Make every key with at least `least` rows hot in a module."""

    def patch(module, least=3):
        from gridweave.operators import skew

        monkeypatch.setattr(module, "hot_keys", lambda rows, key, weight=None, **_: skew.hot_keys(rows, key, weight, share=0.001, least=least))

    return patch
