import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

# Scale of the oracle and plan tests; TESSERA_TEST_SF=/root/testdata/sf0.01 runs them at the driver's gate scale.
SF_SMALL = os.environ.get("TESSERA_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session
    s = get_session("local[4]", 8, app="tessera-tests",
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tessera-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
