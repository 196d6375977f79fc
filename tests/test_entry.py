"""The registry without the parts that may be taken away, and the package as workers get it."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def copied(tmp_path):
    to = tmp_path / "copy"
    shutil.copytree(ROOT, to, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "tests", "*.json"))
    return to


def test_queries_without_the_pipeline_parts(tmp_path):
    code = ("import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert 'pretrain_examples' in q and set(o) <= set(q); "
            "assert not any(n.startswith('op1') or n == 'pipeline' for n in q); print(len(q))")
    done = subprocess.run([sys.executable, "-c", code], cwd=copied(tmp_path), capture_output=True, text=True, timeout=120,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert done.returncode == 0 and int(done.stdout) > 80, done.stderr


def test_workers_get_the_package(spark):
    from textforge import shipping

    shipping.ship(spark)
    here = spark.sparkContext.listFiles if hasattr(spark.sparkContext, "listFiles") else []
    assert any("textforge" in str(f) for f in here)

    def found(batches):
        import textforge

        for frame in batches:
            yield frame.assign(name=textforge.__name__)

    assert spark.range(2).mapInPandas(found, "id long, name string").first()["name"] == "textforge"
