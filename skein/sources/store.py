"""Stored models and the experiment log."""

from __future__ import annotations

import csv
import os
import subprocess
from datetime import datetime

from pyspark.sql import SparkSession


def stored_models(spark: SparkSession, folder: str) -> list[str]:
    """Paths of saved models, sorted, in any store that Spark reads."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(status.getPath().toString() for status in files.listStatus(path))


def log_experiment(path: str, description: str, oof: float | None = None, loco: float | None = None, board: float | None = None) -> None:
    """Append a line: time, commit, description, scores."""
    commit = subprocess.run(["git", "rev-parse", "--short", "HEAD"], capture_output=True, text=True).stdout.strip()
    new = not os.path.exists(path)
    with open(path, "a", newline="") as out:
        rows = csv.writer(out)
        if new:
            rows.writerow(["timestamp", "git_hash", "description", "oof_f05", "loco_f05", "lb"])
        rows.writerow([datetime.now().isoformat(timespec="seconds"), commit, description, oof, loco, board])
