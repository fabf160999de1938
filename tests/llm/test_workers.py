"""Operators that broadcast a model run where Python workers can't import this package."""

import os
import subprocess
import sys

import pytest

from tests.conftest import ROOT

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from fulltime.session import local_session
spark = local_session(2, 2, app="workers")
from pyspark.sql import functions as F
seen = spark.range(1).mapInPandas(lambda it: (b.assign(id=__import__("importlib").util.find_spec("fulltime") is not None) for b in it), "id boolean").first()[0]
assert not seen, "workers can import the package"
from fulltime.llm import queries
print("ROWS", queries.QUERIES[{name!r}](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.parametrize("name", ["op2_forest", "op6_pitman_yor", "op7_ppm", "op13_recompression"])
def test_workers_need_no_copy_of_the_package(tmp_path, name):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    if "PYTHONPATH" in os.environ:
        env["PYTHONPATH"] = os.pathsep.join(p for p in os.environ["PYTHONPATH"].split(os.pathsep) if os.path.abspath(p or ".") != ROOT)
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT, name=name)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
