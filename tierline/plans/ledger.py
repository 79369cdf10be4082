"""What of a flow is done: one small file per finished step, written after the step's table.

A record holds a digest of what the step read (files, or the records of the
steps before it) and the folder that its table was published at. A step is done
if its record fits both, so a flow that is started again goes on at the first
step that failed, was never reached, or has new input.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from tierline.session import files_of, read_text, write_text


class Ledger:
    """Records below ``folder``, which all runs of the flow share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _record(self, step: str) -> dict | None:
        text = read_text(self.spark, f"{self.folder}/{step}.json")
        try:
            return json.loads(text) if text else None
        except json.JSONDecodeError:  # the run died while writing it
            return None

    def _place(self, table: str) -> str | None:
        if not self.spark.catalog.tableExists(table):
            return None
        return self.spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]

    def of_files(self, path: str) -> str:
        """Digest of the files below a path: names, lengths, times."""
        return hashlib.sha256(files_of(self.spark, path).encode()).hexdigest()

    def of_steps(self, *steps: str) -> str:
        """Digest of what earlier steps have published."""
        return hashlib.sha256(json.dumps([self._record(s) for s in steps], sort_keys=True).encode()).hexdigest()

    def run(self, step: str, inputs: str, make: Callable[[], str]) -> str:
        """The step's table, made only if the record doesn't say that it is there already."""
        told = self._record(step)
        if told and told["inputs"] == inputs and told["place"] == self._place(told["table"]):
            return told["table"]
        table = make()
        record = {"inputs": inputs, "table": table, "place": self._place(table)}
        write_text(self.spark, f"{self.folder}/{step}.json", json.dumps(record), overwrite=True)
        return table
