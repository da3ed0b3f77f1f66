"""The entry file works with and without the optional training-data part."""
import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_the_optional_part(tmp_path):
    for name in ("tradewind", "__spark_entry__.py"):
        source = os.path.join(ROOT, name)
        copy = shutil.copytree if os.path.isdir(source) else shutil.copy
        copy(source, tmp_path / name, **({"ignore": shutil.ignore_patterns("llm", "__pycache__")} if os.path.isdir(source) else {}))
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), set(q) == set(o), any(n.startswith('op') for n in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120,
                         env={**os.environ, "PYTHONPATH": ""})
    assert out.returncode == 0, out.stderr
    n, same, optional = out.stdout.split()
    assert int(n) >= 48 and same == "True" and optional == "False"
