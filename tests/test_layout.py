"""The engine must not need the llm subpackage."""

import ast
import os
import pathlib
import shutil
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parents[1]


def test_nothing_else_imports_llm():
    for path in (ROOT / "tessera").rglob("*.py"):
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            where = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in w for w in where), path


def test_entry_without_llm(tmp_path):
    shutil.copytree(ROOT / "tessera", tmp_path / "tessera", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(ROOT / "jobs", tmp_path / "jobs", ignore=shutil.ignore_patterns("__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'tier_joint_counts' in q and not any(n.startswith('op1_') for n in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)}, timeout=120)
