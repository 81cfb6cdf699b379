import pytest
from oracle import connect, rows_of, sql_rows

from docloom.plans.queries import SQL, queries

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, data, duck, name):
    names, rows = rows_of(queries()[name](spark, data))
    if name in SQL:
        assert (names, rows) == sql_rows(duck, SQL[name])


def test_entry(spark, data):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_the_library_does_without_llm():
    import ast
    from pathlib import Path

    root = Path(__file__).parent.parent / "docloom"
    for path in root.rglob("*.py"):
        if "llm" in path.relative_to(root).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), path
