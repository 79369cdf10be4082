"""Tables under a stable name, whose columns may change without the name ever being absent.

The name is a view over one version: a table of its own, written once. A new
version is written aside and then published by a single ``ALTER VIEW .. AS``,
one change of a catalog entry whatever the columns (``CREATE OR REPLACE VIEW``
drops and creates), so a reader resolves the name to the old version or to the new one. Rows are inserted into the version below.

A writer that says which version it read can't undo another's work unseen: the
right to follow a version goes to whoever first creates one small file beside
it, and everyone else gets :class:`LostUpdate`.
"""

from __future__ import annotations

import re
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from tierline.operators.sinks import DEFAULT_FORMAT, insert_by_name, name_parts, new_version, point_at, quoted, write_version
from tierline.session import file_system, read_text, write_text

#: ``based_on`` of a writer that replaces whatever is there.
ANY = object()


class LostUpdate(RuntimeError):
    """Another writer has published a version since the one that this write is based on."""


def _table_of(name: str, version: str) -> str:
    *where, last = name_parts(name)
    return ".".join(map(quoted, [*where, f"{last}__{version}"]))


def current_version(spark: SparkSession, name: str) -> str | None:
    """The version that the name stands for; None if there is none yet."""
    if not spark.catalog.tableExists(name):
        return None
    text = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'View Text'").first()
    found = re.search(r"__([0-9a-f]{32})`?$", text["data_type"]) if text else None
    if found is None:
        raise ValueError(f"{name} is a table of its own, not the name of versions")
    return found[1]


def _claim(spark: SparkSession, name: str, based_on: str | None) -> str:
    return f"{new_version(spark, name).rpartition('/')[0]}/_after-{based_on or 'nothing'}"


def _show(spark: SparkSession, name: str, version: str) -> None:
    how = "ALTER VIEW" if spark.catalog.tableExists(name) else "CREATE VIEW"
    spark.sql(f"{how} {name} AS SELECT * FROM {_table_of(name, version)}")


def publish(df: DataFrame, name: str, fmt: str = DEFAULT_FORMAT, based_on: object = ANY) -> str:
    """Make ``df``, whatever its columns, what ``name`` stands for; returns the version.

    ``based_on`` is the version that ``df`` was made from (:func:`current_version`,
    None: there was none). If another writer has followed that version already,
    :class:`LostUpdate` is raised and nothing changes. Writers of one name should all
    give it, or none; without it the last one wins. ``df`` may read the name itself. A job that
    fails changes nothing.
    """
    spark = df.sparkSession
    if based_on is not ANY and current_version(spark, name) != based_on:
        raise LostUpdate(f"{name} is no longer at version {based_on}")
    version = uuid.uuid4().hex
    path = new_version(spark, name)
    write_version(df, path, fmt, ())
    point_at(spark, _table_of(name, version), df.schema, path, fmt)
    if based_on is not ANY:
        try:
            write_text(spark, _claim(spark, name, based_on), version, overwrite=False)
        except Py4JJavaError as taken:
            spark.sql(f"DROP TABLE {_table_of(name, version)}")
            if "FileAlreadyExists" not in str(taken.java_exception):
                raise
            raise LostUpdate(f"another writer has followed version {based_on} of {name}") from None
    _show(spark, name, version)
    return version


def settle(spark: SparkSession, name: str) -> str | None:
    """Publish what a writer claimed but, having died, didn't publish; returns the version the name now has."""
    version = current_version(spark, name)
    while (claimed := read_text(spark, _claim(spark, name, version))) and spark.catalog.tableExists(_table_of(name, claimed)):
        _show(spark, name, claimed)
        version = claimed
    return version


def insert_current(df: DataFrame, name: str) -> str:
    """Append rows, matched by name, to the version that ``name`` stands for.

    If another version is published meanwhile, the rows aren't in it:
    :class:`LostUpdate` says so, and the call may be repeated.
    """
    spark = df.sparkSession
    version = current_version(spark, name)
    if version is None:
        raise ValueError(f"{name} has no version yet")
    insert_by_name(df, _table_of(name, version))
    if current_version(spark, name) != version:
        raise LostUpdate(f"{name} was published anew while rows went into version {version}")
    return name


def drop_old(spark: SparkSession, name: str, older_than_hours: float = 168) -> list[str]:
    """Drop the versions of ``name``, their files and claims, that were written before that; never the current one."""
    now, limit, gone = current_version(spark, name), (time.time() - older_than_hours * 3600) * 1000, []
    *where, last = name_parts(name)
    for t in spark.catalog.listTables(".".join(map(quoted, where)) or None):
        version = t.name.removeprefix(f"{last.lower()}__") if t.name.startswith(f"{last.lower()}__") else now
        if version == now:
            continue
        table = _table_of(name, version)
        location = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]
        fs, path = file_system(spark, location)
        if fs.exists(path) and fs.getFileStatus(path).getModificationTime() >= limit:
            continue
        spark.sql(f"DROP TABLE {table}")
        fs.delete(path, True)
        fs.delete(file_system(spark, _claim(spark, name, version))[1], False)
        gone.append(version)
    return gone
