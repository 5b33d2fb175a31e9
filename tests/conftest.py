import json
import os
import re
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = os.environ.get("LINKLOOM_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from linkloom.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g",
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="linkloom-test-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


def fixture_block(heading_prefix: str):
    """The first ```json block after the FIXTURES.md heading starting with ``heading_prefix``."""
    text = open(os.path.join(ROOT, "FIXTURES.md"), encoding="utf-8").read()
    idx = text.index("\n## " + heading_prefix)
    m = re.search(r"```json\n(.*?)\n```", text[idx:], re.S)
    return json.loads(m.group(1))
