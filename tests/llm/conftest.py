import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], sys.path[1], os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def docs(spark):
    from helpers_llm import documents

    return documents(spark).cache()
