import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidegate.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4)


@pytest.fixture
def fresh(tmp_path):
    """A folder, and a name for databases that no other test uses."""
    return str(tmp_path), "t" + uuid.uuid4().hex[:10]
