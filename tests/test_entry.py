import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.abspath(entry.__file__))


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_flagship(spark):
    row = entry.entry(spark).collect()
    assert len(row) == 1 and row[0].valid_catalog >= row[0].valid_matched > 0


def test_works_without_training_data_operators(tmp_path):
    for name in os.listdir(ROOT):
        if name in ("loomspark", "__spark_entry__.py"):
            subprocess.run(["cp", "-r", f"{ROOT}/{name}", str(tmp_path)], check=True)
    subprocess.run(["rm", "-rf", str(tmp_path / "loomspark/llm")], check=True)
    code = "import __spark_entry__ as e; q = e.queries(); e.oracle_sql(); assert len(q) > 90 and not any(n.startswith('op4') or n == 'pipeline' for n in q)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)
