"""Scratch tables and the entry module's guard."""

import os
import subprocess
import sys
from pathlib import Path

from leadgrade.plans.sizing import release, scope, written

ROOT = Path(__file__).resolve().parent.parent


def test_released_tables_leave_the_shared_folder(spark):
    table = written(spark.range(10).toDF("id"), "gone")
    path = table._scratch
    derived = table.where("id > 3")
    assert os.path.isdir(path) and derived.count() == 6
    release(derived)  # no table of its own
    assert os.path.isdir(path)
    release(table)
    assert not os.path.exists(path)
    release(table)


def imported(tmp_path, name, body):
    """What the entry module says when ``name`` is replaced by ``body``."""
    code = (
        "import sys, importlib.abc, importlib.machinery\n"
        f"name = {name!r}\n"
        "class Finder(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, full, path, target=None):\n"
        f"        if full == name: raise ModuleNotFoundError(full, name={body!r})\n"
        "sys.meta_path.insert(0, Finder())\n"
        "import __spark_entry__ as e\n"
        "print(sum(n.startswith('op') for n in e.queries()))\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    return done.returncode, done.stdout.strip()


def test_only_the_missing_part_itself_is_optional(tmp_path):
    assert imported(tmp_path, "leadgrade.llm", "leadgrade.llm") == (0, "0")
    if (ROOT / "leadgrade/llm/queries.py").exists():
        code, _ = imported(tmp_path, "leadgrade.llm.queries", "some_package")
        assert code != 0


def test_a_scope_keeps_what_it_is_told_to(spark):
    with scope() as outer:
        with scope() as inner:
            gone = written(spark.range(3).toDF("id"), "gone")._scratch
            kept = inner.keep(written(spark.range(4).toDF("id"), "kept"))
        at = kept._scratch
        assert not os.path.exists(gone) and kept.count() == 4 and outer.tables == [kept]
    assert not os.path.exists(at)
