from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from ledgerloom.session import local_session

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tests", "4g")


@pytest.fixture(scope="session")
def folder():
    return FOLDER
