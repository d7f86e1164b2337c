import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strandline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "strandline-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "3",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # names hold colons, which the checksum files of the default local file system cannot
            "spark.hadoop.fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def put(folder):
    """Write a file below the test's folder; objects become indented JSON."""

    def write(path, value):
        full = os.path.join(folder, path)
        os.makedirs(os.path.dirname(full), exist_ok=True)
        with open(full, "w", encoding="utf-8") as out:
            out.write(value if isinstance(value, str) else json.dumps(value, indent=2, ensure_ascii=False))
        return full

    return write


def values(frame, *columns):
    """Rows as a sorted list of tuples."""
    rows = [tuple(row) for row in (frame.select(*columns) if columns else frame).collect()]
    return sorted(rows, key=lambda row: tuple((v is not None, str(v)) for v in row))
