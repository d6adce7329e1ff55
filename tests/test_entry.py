"""The entry point without the training-data subpackage."""

import json
import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_queries_without_the_training_data_subpackage(tmp_path):
    """A copy without its folders, with and without corpus_pipeline.py, lists all other queries."""
    import __spark_entry__ as E
    from clickflow.plans.catalog import batch_queries, io_queries

    own = sorted({**batch_queries(), **io_queries()})
    assert set(own) <= set(E.queries())
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache"))
    code = "import json, __spark_entry__ as E; print(json.dumps([sorted(E.queries()), sorted(E.oracle_sql())]))"
    for name in (None, "corpus_pipeline.py"):
        if name and (copy / name).exists():
            (copy / name).unlink()
        out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120,
                             env={**os.environ, "PYTHONPATH": str(copy)})
        assert out.returncode == 0, out.stderr
        queries, sql = json.loads(out.stdout.splitlines()[-1])
        assert queries == own and set(sql) <= set(own)
