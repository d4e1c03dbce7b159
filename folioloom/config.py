"""Settings on the driver: paths with variables, and the execution options that become Spark settings."""

from __future__ import annotations

import os
from collections.abc import Mapping
from pathlib import PurePosixPath

from pyspark.sql import SparkSession

#: Option: its default, and the Spark setting that it becomes.
EXECUTION = {"num_workers": (1, "spark.sql.shuffle.partitions"), "worker_batch_size": (256, "spark.sql.execution.arrow.maxRecordsPerBatch"), "schema_sample_size": (4096, None)}


def expanded(value: str, variables: Mapping[str, str] | None = None) -> str:
    """value with $NAME and ${NAME} replaced; a name that isn't set raises."""
    known = os.environ if variables is None else variables
    out, at = "", 0
    while (start := value.find("$", at)) >= 0:
        out += value[at:start]
        braced = value[start + 1 : start + 2] == "{"
        stop = value.find("}", start) if braced else start + 1
        if braced and stop < 0:
            raise ValueError(f"no end of a variable in {value!r}")
        while not braced and stop < len(value) and (value[stop].isalnum() or value[stop] == "_"):
            stop += 1
        name = value[start + 2 : stop] if braced else value[start + 1 : stop]
        if name not in known:
            raise KeyError(f"{name} isn't set")
        out, at = out + known[name], stop + braced
    return out + value[at:]


def under(root: str, path: str, variables: Mapping[str, str] | None = None) -> str:
    """An absolute path or URI as it is, any other below the root."""
    path = expanded(path, variables)
    return path if path.startswith("/") or "://" in path else f"{root.rstrip('/')}/{path}"


def relative(root: str, path: str) -> str:
    """The path from the root on, or as it is if it is elsewhere."""
    try:
        return str(PurePosixPath(path).relative_to(root))
    except ValueError:
        return path


def execution(*layers: Mapping[str, object] | None) -> dict[str, int]:
    """Options from layers, the first that has one counts: command line, view, processing, defaults."""
    out = {}
    for name, (default, _) in EXECUTION.items():
        value = next((layer[name] for layer in layers if layer and layer.get(name) is not None), default)
        out[name] = int(value)
        if out[name] < 1:
            raise ValueError(f"{name} must be 1 at least")
    return out


def apply(spark: SparkSession, *layers: Mapping[str, object] | None) -> None:
    """Sets what some layer names; what none names stays as the session has it, and doesn't become the default."""
    named = {name for layer in layers if layer for name, value in layer.items() if value is not None}
    for name, value in execution(*layers).items():
        if name in named and (key := EXECUTION[name][1]) is not None:
            spark.conf.set(key, str(value))
