"""Functions that run in Python workers load where the package is not installed."""

import subprocess
import sys

import pytest
from pyspark import cloudpickle

from sluice.operators import throttle
from sluice.streaming import sinks

LOAD = """
import pickle, sys
with open(sys.argv[1], "rb") as stored:
    pickle.load(stored)
assert not any(name.startswith("sluice") for name in sys.modules)
"""


@pytest.mark.parametrize(
    "function",
    [
        throttle._span_pairs(10),
        throttle._linked(10),
        throttle._span_saves(10),
        sinks._print_lines,
    ],
)
def test_loads_without_the_package(tmp_path, function):
    stored = tmp_path / "function.pickle"
    stored.write_bytes(cloudpickle.dumps(function))
    subprocess.run([sys.executable, "-c", LOAD, str(stored)], cwd=tmp_path, check=True)
