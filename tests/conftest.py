import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from gristmill.session import build, ready_for_python

    s = build("tests", "4", 4)
    s.sparkContext.setLogLevel("ERROR")
    ready_for_python(s)
    yield s
    s.stop()
