"""The driver's contract, also where the training-data operators cannot be imported."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent

LIST = "import __spark_entry__ as e; q = e.queries(); print(len(q), all(k in q for k in e.oracle_sql()), 'pipeline' in q)"


def listed(folder, before=""):
    code = f"import sys; sys.path.insert(0, {str(folder)!r})\n{before}\n{LIST}"
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=folder)
    assert run.returncode == 0, run.stderr
    return run.stdout.split()


@pytest.fixture(scope="module")
def plain(tmp_path_factory):
    """A copy without the training-data operators."""
    import shutil

    folder = tmp_path_factory.mktemp("plain")
    shutil.copytree(ROOT / "runlens", folder / "runlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", folder)
    return folder


def test_without_the_subpackage(plain):
    n, known, pipeline = listed(plain)
    assert int(n) >= 67 and known == "True" and pipeline == "False"


def test_with_an_empty_folder_left(plain):
    (plain / "runlens" / "llm" / "__pycache__").mkdir(parents=True)
    assert listed(plain)[0] == listed(plain)[0] and int(listed(plain)[0]) >= 67


@pytest.mark.parametrize("package", ["zstandard", "tiktoken", "xxhash", "public_tokenizers"])
def test_with_a_missing_package(plain, package):
    """Every other query stays where a package of the operators is missing."""
    n, known, _ = listed(ROOT, f"sys.modules[{package!r}] = None")
    assert int(n) >= int(listed(plain)[0]) and known == "True"
