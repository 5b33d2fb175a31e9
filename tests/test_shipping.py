import subprocess
import sys

from pyspark import cloudpickle

import linkloom  # noqa: F401  (registers by-value pickling)
from linkloom.functions.html import anchors_of
from linkloom.functions.prompts import parse_label


def test_udf_code_loads_without_the_package():
    payload = cloudpickle.dumps((anchors_of, parse_label))
    code = ("import pickle, sys; a, p = pickle.loads(sys.stdin.buffer.read()); "
            "print(len(a('<a href=\"/x\">y</a>')), p('{\"label\":\"brand\"}', ['brand']))")
    out = subprocess.run([sys.executable, "-c", code], input=payload, capture_output=True,
                         cwd="/", env={"PATH": "/usr/bin:/bin"}, timeout=120)
    assert out.returncode == 0, out.stderr.decode()
    assert out.stdout.decode().split() == ["1", "brand"]
