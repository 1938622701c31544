"""Workers that do not have the package, and an entry without its optional parts."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import pyarrow as pa, pyarrow.parquet as pq
from tickweave.session import local_session, ship_package
from tickweave.sources import footers
spark = local_session(2, memory="1g")
pq.write_table(pa.table({{"a": [1, 2]}}), "t.parquet")
ship_package(spark)
files = spark.createDataFrame([("file://{folder}/t.parquet",)], "path string")
print("rows", footers.footers(files).first().n_rows)
"""


def run(folder, script):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", script], cwd=folder, env=env, capture_output=True, text=True, timeout=200)


def test_workers_elsewhere(tmp_path):
    done = run(tmp_path, SCRIPT.format(repo=REPO, folder=tmp_path))
    assert "rows 2" in done.stdout, done.stderr[-2000:]


def test_entry_without_optional_parts(tmp_path):
    shutil.copytree(f"{REPO}/tickweave", tmp_path / "tickweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    done = run(tmp_path, "import warnings; warnings.simplefilter('error'); import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))")
    assert done.returncode == 0, done.stderr[-2000:]
    queries, oracles = map(int, done.stdout.split())
    assert queries == oracles > 80


def test_a_broken_part_is_told(tmp_path):
    shutil.copytree(f"{REPO}/tickweave", tmp_path / "tickweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    (tmp_path / "tickweave" / "llm").mkdir()
    (tmp_path / "tickweave" / "llm" / "queries.py").write_text("import no_such_module_here\n")
    done = run(tmp_path, "import __spark_entry__ as e; print(len(e.queries()))")
    assert done.returncode == 0 and "not registered" in done.stderr and "no_such_module_here" in done.stderr
