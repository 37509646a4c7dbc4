import duckdb
import pytest


@pytest.fixture
def twin(sf_dir):
    """Rows of a SQL twin over given frames, or over the small tables."""

    def run(sql, **tables):
        connection = duckdb.connect()
        for name, rows in tables.items():
            connection.register(name, rows)
        return sorted(connection.execute(sql).fetchall(), key=str)

    return run
