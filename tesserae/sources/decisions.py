"""What people have decided, from YAML files: overrides, name aliases, attested recodes, reviewed conflicts. Problems are collected, then stop the build once."""

from __future__ import annotations

import json
import logging
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import BuildError
from ..operators.gates import validate_overrides


def read_yaml(path: str, root: str, needed: tuple[str, ...]) -> list[dict]:
    """The entries under ``root``; each must have what is needed, as text or as a mapping. A file without the root is an error, an empty list is not."""
    import yaml

    with open(path, encoding="utf-8") as f:
        content = yaml.safe_load(f) or {}
    if not isinstance(content, dict) or not isinstance(content.get(root), list):
        raise BuildError("VALIDATION_FAILED", f"{path} has no list {root}")
    problems = [f"entry {i}: {k} is missing" for i, e in enumerate(content[root]) for k in needed if not isinstance(e, dict) or e.get(k) in (None, "")]
    if problems:
        raise BuildError("VALIDATION_FAILED", f"{path} is not valid", problems=problems)
    return content[root]


def overrides(path: str, bridges: set[str]) -> list[dict]:
    found = read_yaml(path, "overrides", ())
    validate_overrides(found, bridges)
    return found


def decided_table(spark: SparkSession, path: str, root: str, columns: list[str]) -> DataFrame:
    """Entries as a table of text: aliases for ``judge_aliases``, recodes for ``resolve_identity``, reviewed conflicts for ``split_conflicts``."""
    rows = [tuple(None if e.get(c) is None else str(e[c]) for c in columns) for e in read_yaml(path, root, ())]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))


def split_conflicts(df: DataFrame, key: list[str], reviewed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of unique keys, rows of keys that occur more than once). All conflicting rows are kept, in the second table; keys that nobody has reviewed are an error."""
    counts = df.groupBy(*key).agg(F.count("*").alias("the count"))
    repeated = counts.filter("`the count` > 1").select(*key)
    unknown = repeated.join(reviewed.select(*key).distinct(), key, "left_anti").limit(5).collect()
    if unknown:
        raise BuildError("DUPLICATE_KEY_ANOMALY", "keys repeat, and nobody has reviewed them", samples=[r.asDict() for r in unknown])
    return df.join(repeated, key, "left_anti"), df.join(repeated, key, "left_semi")


class JsonLines(logging.Formatter):
    """A record as one line of JSON with sorted keys; ``extra={"context": {...}}`` adds to it."""

    def format(self, record):
        line = {"level": record.levelname, "logger": record.name, "message": record.getMessage(), **getattr(record, "context", {})}
        if record.exc_info:
            line["error"] = self.formatException(record.exc_info)
        return json.dumps(line, ensure_ascii=False, sort_keys=True, default=str)


def log_as_json(name: str = "tesserae", level: int = logging.INFO) -> logging.Logger:
    """A logger that writes lines of JSON to standard error, never to standard output."""
    logger = logging.getLogger(name)
    handler = logging.StreamHandler(sys.stderr)
    handler.setFormatter(JsonLines())
    logger.handlers, logger.propagate = [handler], False
    logger.setLevel(level)
    return logger
