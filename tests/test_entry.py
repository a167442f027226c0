"""The entry module as a deployment loads it."""

import glob
import os
import subprocess
import sys

import pyspark

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_import_from_the_zip_without_a_session():
    lib = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib")
    path = [*glob.glob(f"{lib}/pyspark.zip"), *glob.glob(f"{lib}/py4j-*.zip"), ROOT]
    code = "import pyspark, __spark_entry__ as e; assert '.zip' in pyspark.__file__; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd="/", env=os.environ | {"PYTHONPATH": os.pathsep.join(path)},
                         capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    n, n_sql = map(int, out.stdout.split()[-2:])
    assert n >= 67 and n_sql >= 59
