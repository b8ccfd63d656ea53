"""What Python workers are sent must load where this package is not installed."""

import base64
import subprocess
import sys

import pytest
from pyspark import cloudpickle

from millwright.streaming import stateful


@pytest.mark.parametrize(
    "sent",
    [
        stateful.Dedup("execution", "string", ["execution"]), stateful.Runs(), stateful.PartPrograms(),
        stateful.Sessions(300_000, tag=True),
    ],
    ids=lambda s: getattr(s, "__name__", type(s).__name__),
)
def test_loads_without_the_package(sent, tmp_path):
    data = base64.b64encode(cloudpickle.dumps(sent)).decode()
    code = f"import base64, pickle, sys; pickle.loads(base64.b64decode('{data}')); assert 'millwright' not in sys.modules"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=60)
