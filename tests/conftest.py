import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import Scratch, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", shuffle_partitions=4, app="strata-tests")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def stored_tables_are_released(monkeypatch):
    """What a test stores goes with the test, whatever it fits and forgets."""
    made, create = [], Scratch.__init__

    def noted(self, *args, **kwargs):
        create(self, *args, **kwargs)
        made.append(self)

    monkeypatch.setattr(Scratch, "__init__", noted)
    yield
    for scratch in made:
        scratch.release()
