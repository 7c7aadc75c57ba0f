"""Every registered query that has SQL agrees with DuckDB; the others keep their properties."""

import math
import os

import pytest

from trailforge.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    import duckdb

    c = duckdb.connect()
    for name in os.listdir(SF):
        c.execute(f"create view {name.split('.')[0]} as select * from read_parquet('{SF}/{name}')")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, list | tuple):
        return [plain(x) for x in v]
    return v


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_against_sql(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    found = con.execute(registry.ORACLE[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    want = sorted(str([plain(r[columns.index(c)]) for c in order]) for r in found.fetchall())
    assert sorted(str([plain(r[c]) for c in order]) for r in df.collect()) == want


def test_length_batches(spark):
    rows = registry.QUERIES["length_batches"](spark, SF).collect()
    batches = {}
    for r in rows:
        batches.setdefault((r.chunk, r.batch), []).append(r.length)
    assert len({r.id for r in rows}) == len(rows) == 200
    assert all(len(b) <= 8 and max(b) <= 4 * min(b) for b in batches.values())


def test_truncate_text(spark):
    assert all(len(r.shown) <= 2000 for r in registry.QUERIES["truncate_text"](spark, SF).collect())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1
    assert set(registry.QUERIES) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def run_alone(code, folder):
    """A script of its own in a fresh interpreter that knows the repository only by sys.path."""
    import subprocess
    import sys
    from pathlib import Path

    head = f"import sys; sys.path.insert(0, {str(Path(registry.__file__).parents[2])!r})\n"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", head + code], cwd=folder, env=env, capture_output=True, text=True, timeout=300, check=False)


def test_a_missing_library_costs_the_optional_parts_only(tmp_path):
    code = """
class Blocked:
    def find_spec(self, name, *_):
        if name in ("xxhash", "zstandard", "public_tokenizers"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__
from trailforge.plans import registry
assert set(__spark_entry__.queries()) == set(registry.QUERIES)
"""
    done = run_alone(code, tmp_path)
    assert done.returncode == 0, done.stderr


def test_core_stands_alone():
    """Nothing outside the optional subpackage imports it."""
    import re
    from pathlib import Path

    root = Path(registry.__file__).parents[1]
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert not re.search(r"^\s*(from|import)\s[^#\n]*\bllm\b", path.read_text(), re.M), path


def test_plans(spark):
    """Pruned scans; no Python and no unneeded shuffle in the relational queries."""
    plan = lambda n: registry.QUERIES[n](spark, SF)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<text:string,lang:string,source:string>" in plan("code_measure") or "doc_id" not in plan("code_repo_counts").split("ReadSchema")[1][:60]
    for name in ("code_measure", "traj_rebuild", "traj_refusals", "preference_pairs", "corpus_measure", "fingerprint_keys", "conv_validate"):
        assert "Python" not in plan(name) and "CartesianProduct" not in plan(name)
