"""Running this library's Python steps on workers that do not have it installed."""

from __future__ import annotations

import importlib
import pickle
from typing import Any

from pyspark import Broadcast, cloudpickle
from pyspark.sql import SparkSession


def send_by_value(*packages: str) -> None:
    """Send functions of these packages (this one by default) to the workers with their code.

    For sessions that were started without ``--py-files``; needs no file on any machine.
    """
    for package in packages or ("replyforge",):
        cloudpickle.register_pickle_by_value(importlib.import_module(package))


def broadcast(spark: SparkSession, value: Any) -> Broadcast:
    """A broadcast whose objects carry their code along, for packages that are sent by value; read with :func:`opened`."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def opened(sent: Broadcast) -> Any:
    """Task side: what :func:`broadcast` has sent, unpacked once per worker."""
    if "_opened" not in sent.__dict__:
        sent.__dict__["_opened"] = pickle.loads(sent.value)
    return sent.__dict__["_opened"]
