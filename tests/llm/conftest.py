from __future__ import annotations

import pytest

from rollbook.llm.storage import importable


@pytest.fixture(scope="session")
def spark(spark):
    importable(spark)
    return spark
