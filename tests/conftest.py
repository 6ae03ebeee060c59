import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chalkline.session import local_session, prefer_compiled_methods  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, memory="4g", name="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield prefer_compiled_methods(session)
    session.stop()
