import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
sys.path.insert(0, os.path.dirname(__file__))

from exonloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(memory="6g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(params=["small", "large"])
def path(request, spark):
    """Runs a test once with plain windows and once with the slab path."""
    if request.param == "large":
        spark.conf.set("spark.exonloom.smallRows", "0")
    yield request.param
    spark.conf.unset("spark.exonloom.smallRows")


@pytest.fixture
def tmpdir_spark(tmp_path_factory):
    return str(tmp_path_factory.mktemp("spark-"))
