import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marginloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """make("a STRING, b DATE", [("x", "2024-01-01")]): a table from texts, cast to the given types."""

    def build(ddl, rows):
        fields = []
        for part in ddl.replace("DECIMAL(18,4)", "DECIMAL(18;4)").replace("DECIMAL(18,6)", "DECIMAL(18;6)").split(","):
            name, kind = part.strip().split(" ", 1)
            fields.append((name, kind.replace(";", ",")))
        texts = ", ".join(f"{name} STRING" for name, _ in fields)
        data = [tuple(None if v is None else str(v) for v in row) for row in rows]
        raw = spark.createDataFrame(data, texts)
        return raw.selectExpr(*[f"CAST({name} AS {kind}) AS {name}" for name, kind in fields])

    return build


@pytest.fixture(scope="session")
def source(make):
    """source("invoices", [{"invoice_id": "1"}]): a source table, unnamed columns NULL."""
    from marginloom.sources import SCHEMAS

    def build(name, rows):
        ddl = SCHEMAS[name]
        columns = [p.strip().split(" ")[0] for p in ddl.replace("(18,", "(18;").split(",")]
        return make(ddl, [tuple(row.get(c) for c in columns) for row in rows])

    return build


@pytest.fixture(scope="session")
def got():
    """Rows of a DataFrame as sorted tuples of the given columns, decimals as floats."""
    from decimal import Decimal

    def plain(value):
        return float(value) if isinstance(value, Decimal) else value

    def collect(df, *columns):
        rows = [tuple(plain(v) for v in r) for r in df.select(*(columns or df.columns)).collect()]
        return sorted(rows, key=lambda r: [(v is not None, str(v)) for v in r])

    return collect
