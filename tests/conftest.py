import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from taxaflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "taxaflow-tests",
        **{
            "spark.master": "local[4]",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.session.timeZone": "UTC",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    names = ["ash", "birch", "cedar", "elm", "fir", "hazel", "larch", "oak"]
    return [{"sample_id": n, "text_window": f"About the {n} tree", "raw_windowed": True} for n in names]


@pytest.fixture
def source(tmp_path, rows):
    path = tmp_path / "input.jsonl"
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    return path
