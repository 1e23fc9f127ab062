import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def docs(spark):
    from .helpers import awkward_docs
    return awkward_docs(spark).repartition(5, "doc_id").cache()
