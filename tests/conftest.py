from __future__ import annotations

import sys
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from orderloom.plans.workspace import Workspace  # noqa: E402
from orderloom.session import local_session  # noqa: E402
from orderloom.sources.stage import Stage  # noqa: E402

ABORTS = (PySparkException, Py4JJavaError)  # what a failing Spark job raises
HEADER = "Customer,Order date,Delivery date,Baked good type,Quantity"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8", 4, "6g", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))})
    yield session
    session.stop()


@pytest.fixture
def workspace(spark, tmp_path):
    return Workspace(str(tmp_path / "workspace")).create(spark)


@pytest.fixture
def stage(tmp_path):
    (tmp_path / "stage").mkdir()
    return Stage(str(tmp_path / "stage"))


def deliver(stage: Stage, name: str, *lines: str, header: str | None = HEADER) -> None:
    """Write a delivered CSV file; as in the samples the last line has no end."""
    path = Path(stage.root) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(([header] if header else []) + list(lines)))


def deliver_text(stage: Stage, name: str, text: str) -> None:
    path = Path(stage.root) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def rows(frame, *columns):
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=repr)
