"""Sending the package to the Python workers of the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once per application, let Spark distribute a zip of this package to every worker.

    The zip is written on the driver and fetched from it by the executors.
    """
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="textforge-"), "textforge.zip")
    here = os.path.dirname(os.path.abspath(__file__))
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as made:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    made.write(full, os.path.relpath(full, os.path.dirname(here)))
    context.addPyFile(path)
    _SENT.add(context.applicationId)
