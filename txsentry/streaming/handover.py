"""Handing a newly trained model to a running stream.

A folder holds one saved model per version and a list of publications, empty files whose
names are a running number and the version; the newest one is current. Creating such a file
is one atomic step on any store, so a reader sees the old version or the new one.

A stream reads the current version once per epoch and notes it beside the folder's other
versions (``pins/<query>/epoch=N-<version>``), so an epoch that is replayed after a failure
is scored with the version that it began with, whatever has been published since.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from txsentry.session import list_names, mark_path

Scorer = Callable[[SparkSession, int], tuple[PipelineModel, str]]


def publish(spark: SparkSession, root: str, model: PipelineModel, version: str) -> None:
    """Save ``model`` as ``version`` (a new name) and make it the current one."""
    if not version or "/" in version:
        raise ValueError(f"not a version name: {version!r}")
    root = root.rstrip("/")
    model.write().save(f"{root}/models/{version}")  # fails if the version exists
    make_current(spark, root, version)


def make_current(spark: SparkSession, root: str, version: str) -> None:
    """Make a saved version the current one (also an older one, to go back)."""
    root = root.rstrip("/")
    if version not in list_names(spark, f"{root}/models"):
        raise ValueError(f"no such version: {version}")
    number = 1 + max([int(n.split("-", 1)[0]) for n in list_names(spark, f"{root}/current")], default=0)
    mark_path(spark, f"{root}/current/{number:09d}-{version}")


def current_version(spark: SparkSession, root: str) -> str:
    names = sorted(list_names(spark, f"{root.rstrip('/')}/current"))
    if not names:
        raise ValueError(f"{root}: no model has been published")
    return names[-1].split("-", 1)[1]


def current_model(root: str, query: str) -> Scorer:
    """For ``score_stream``: the model and version of an epoch of the stream ``query``."""
    root, held = root.rstrip("/"), {}

    def of(spark: SparkSession, epoch: int) -> tuple[PipelineModel, str]:
        pins = f"{root}/pins/{query}"
        head = f"epoch={epoch}-"
        version = next((n[len(head) :] for n in list_names(spark, pins) if n.startswith(head)), None)
        if version is None:
            version = current_version(spark, root)
            mark_path(spark, f"{pins}/{head}{version}")
        if version not in held:
            held.clear()  # one model at a time
            held[version] = PipelineModel.load(f"{root}/models/{version}")
        return held[version], version

    return of
