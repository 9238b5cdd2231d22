import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{ROOT}/tests:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from factloom.session import local_session, ship

    s = local_session("4", 4, spark__ui__showConsoleProgress="false", spark__driver__memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    return s


@pytest.fixture(scope="session")
def tiny():
    path = Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("the given tables are not here")
    return str(path)
