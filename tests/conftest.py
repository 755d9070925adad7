import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from larder.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g", spark__ui__enabled="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="larder-"),
        # Tiny inputs: compiling a stage costs far more than running it.
        spark__sql__codegen__wholeStage="false",
        spark__python__sql__dataFrameDebugging__enabled="false",
        spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
