from __future__ import annotations

import pytest

from convlens.llm.queries import importable


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    importable(spark)
