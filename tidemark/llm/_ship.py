"""Make this package importable in Spark's Python workers.

Where the workers already have it (PYTHONPATH, an installed package) this
changes nothing; elsewhere the package goes out once per Spark context with
``addPyFile``, as ``spark-submit --py-files`` would send it.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_sent: set[str] = set()


def ready(spark: SparkSession) -> SparkSession:
    sc = spark.sparkContext
    if sc.applicationId in _sent:
        return spark
    path = os.path.join(tempfile.mkdtemp(prefix="py-"), f"{os.path.basename(_PACKAGE)}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(_PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    sc.addPyFile(path)
    _sent.add(sc.applicationId)
    return spark
