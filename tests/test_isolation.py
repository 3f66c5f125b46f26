"""The library without the training-data subpackage."""

import subprocess
import sys

HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:2] == ["tidemark", "llm"] or name == {also!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as e
names = set(e.queries())
assert not any(n.startswith("op") and n[2:3].isdigit() for n in names) and "pipeline" not in names, names
assert "cdc_merge" in names and set(e.oracle_sql()) <= names
print(len(names))
"""


def run(code):
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=__file__.rsplit("/", 2)[0])
    assert done.returncode == 0, done.stderr[-2000:]
    return int(done.stdout)


def test_queries_without_the_subpackage():
    from tidemark.suite import QUERIES
    assert run(HIDE.format(also="tidemark.llm")) == len(QUERIES)


def test_queries_without_the_pipeline_file_either():
    from tidemark.suite import QUERIES
    assert run(HIDE.format(also="corpus_pipeline")) == len(QUERIES)


def test_nothing_outside_imports_the_subpackage():
    import pathlib
    import re
    root = pathlib.Path(__file__).parent.parent / "tidemark"
    users = [p for p in root.rglob("*.py") if root / "llm" not in p.parents and re.search(r"^\s*(from|import) tidemark\.llm|from tidemark import .*\bllm\b", p.read_text(), re.M)]
    assert users == []
