"""The entry points without the optional parts."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAYS = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sorted(n for n in e.queries() if n.startswith('op')), 'pipeline' in e.queries())"


def copy_without(tmp_path, *absent):
    where = tmp_path / "copy"
    shutil.copytree(ROOT, where, ignore=shutil.ignore_patterns(".git", "__pycache__", "tests", "spark-warehouse", "*.json"))
    for name in absent:
        place = where / name
        if place.is_dir():
            shutil.rmtree(place)
        elif place.exists():
            place.unlink()
    return where


def said_by(where):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONDONTWRITEBYTECODE": "1"}
    return subprocess.run([sys.executable, "-c", SAYS], cwd=where, env=env, capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("absent", [("millrace/llm",), ("millrace/llm", "corpus_pipeline.py")])
def test_import_without_text_preparation(tmp_path, absent):
    done = said_by(copy_without(tmp_path, *absent))
    assert done.returncode == 0, done.stderr
    assert done.stdout.endswith("[] False\n")
    assert int(done.stdout.split()[0]) > 80


def test_folder_left_empty_counts_as_absent(tmp_path):
    where = copy_without(tmp_path, "millrace/llm", "corpus_pipeline.py")
    (where / "millrace" / "llm" / "__pycache__").mkdir(parents=True)
    assert said_by(where).stdout.endswith("[] False\n")


def test_other_failures_are_not_hidden(tmp_path):
    where = copy_without(tmp_path, "millrace/llm", "corpus_pipeline.py")
    package = where / "millrace" / "llm"
    package.mkdir()
    (package / "__init__.py").write_text("")
    (package / "queries.py").write_text("import no_such_module\n")
    done = said_by(where)
    assert done.returncode != 0
    assert "no_such_module" in done.stderr
