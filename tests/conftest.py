from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Not UTC on purpose: results must not depend on the zone of the session.
        .config("spark.sql.session.timeZone", "America/New_York")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def warehouse(tmp_path):
    return str(tmp_path / "warehouse")


@pytest.fixture
def write_lines(tmp_path):
    """Write message lines to a file of the input folder; dicts are dumped."""

    def write(lines, name="input.txt"):
        folder = tmp_path / "in"
        folder.mkdir(exist_ok=True)
        text = "\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines)
        (folder / name).write_text(text + "\n")
        return str(folder / name)

    return write
