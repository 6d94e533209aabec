import pytest

import __spark_entry__  # noqa: F401  (ships the helpers to the tasks, as the driver does)
from lakeproof.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests")
