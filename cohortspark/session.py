"""Session settings the library is tuned for; all of them are optional."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Wide coercions make long generated methods, and the JVM does not compile
#: methods beyond 8000 bytes: split them instead of running them interpreted.
_LONGEST_METHOD = ("spark.sql.codegen.hugeMethodLimit", "8000")

SETTINGS = {
    _LONGEST_METHOD[0]: _LONGEST_METHOD[1],
    # Recording a Python call site for every column operation costs seconds on
    # plans of this width; errors still name the failing operation.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Quarters and years of the tests do not depend on a machine's zone.
    "spark.sql.session.timeZone": "UTC",
}


def configure(builder):
    """A session builder with the settings applied."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def compilable(spark: SparkSession) -> SparkSession:
    """The session, in which wide plans are split into methods that the JVM compiles.

    Interpreted ones take three times as long. A limit the session already has is kept.
    """
    name, limit = _LONGEST_METHOD
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, limit)
    return spark


def ship(spark: SparkSession) -> None:
    """Gives this package to the executors' Python workers, once for each session."""
    context = spark.sparkContext
    if getattr(context, "_cohortspark_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="code-")) / "cohortspark_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._cohortspark_shipped = True
