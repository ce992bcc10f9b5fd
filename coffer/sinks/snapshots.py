"""Versioned tables.

A table is a directory of version directories.  A refresh reads version n and
writes version n+1, so a plan never overwrites what it reads, readers keep a
complete version while the next one is written, and a lost job leaves nothing
visible.  A version counts once its marker file exists.  The marker records the
schema, so an empty table keeps its types, and in which version directories the
rows are stored: replacing some clients or appending rows writes only these, and
points to the files that are already there for the rest.  One writer at a time.
"""

import json
import re
from contextlib import contextmanager

from pyspark.sql import functions as F
from pyspark.sql import types as T

from coffer.schemas import CLIENT
from coffer.sources.catalog import file_system

MARKER = "_COMPLETE"
VERSION = "version"
# Up to so many clients, tasks write what they hold: at most this many files each, and no row moves for it.
FEW_CLIENTS = 16
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark):
    """While a table is written: the shuffle files of its job go once it is there, else they pile up step by step."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def layer_path(root, layer, table):
    """Place of a table in its layer: ``staging``, ``core`` or ``marts``."""
    if layer not in ("staging", "core", "marts"):
        raise ValueError(f"unknown layer {layer!r}")
    return f"{root}/layer={layer}/{table}"


def versions(spark, path, complete=True):
    """Version numbers under ``path``, ascending."""
    system, location = file_system(spark, path)
    if not system.exists(location):
        return []
    found = []
    for status in system.listStatus(location):
        match = re.fullmatch(rf"{VERSION}=(\d+)", status.getPath().getName())
        if match is None:
            continue
        number = int(match.group(1))
        marker = file_system(spark, f"{version_path(path, number)}/{MARKER}")[1]
        if not complete or system.exists(marker):
            found.append(number)
    return sorted(found)


def version_path(path, version):
    return f"{path}/{VERSION}={version:08d}"


def latest_version(spark, path):
    return max(versions(spark, path), default=None)


def _read_marker(spark, path, version):
    """Schema of a version and its stored parts: version directory to clients, None for all of them."""
    system, marker = file_system(spark, f"{version_path(path, version)}/{MARKER}")
    stream = system.open(marker)
    try:
        content = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    parts = {int(number): clients for number, clients in content["parts"].items()}
    return T.StructType.fromJson(content["schema"]), parts


def _write_marker(spark, path, version, schema, parts):
    system, marker = file_system(spark, f"{version_path(path, version)}/{MARKER}")
    content = json.dumps({"schema": schema.jsonValue(), "parts": parts})
    stream = system.create(marker, False)
    try:
        stream.write(bytearray(content, "utf-8"))
    finally:
        stream.close()


def read_snapshot(spark, path, version=None):
    """Frame of a version, the latest by default; None if there is none.

    Versions and clients are partition columns: what a version does not use is not read.
    """
    if version is None:
        version = latest_version(spark, path)
    if version is None:
        return None
    schema, parts = _read_marker(spark, path, version)
    used = [number for number, clients in parts.items() if clients is None or clients]
    if not used:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField(VERSION, T.IntegerType())])
    frame = spark.read.schema(stored).option("basePath", path)
    frame = frame.parquet(*[version_path(path, number) for number in used])
    if any(parts[number] is not None for number in used):
        frame = frame.filter(_any_of([_is_part(number, parts[number]) for number in used]))
    return frame.select(*schema.names)


def _any_of(conditions):
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result


def _is_part(number, clients):
    here = F.col(VERSION) == number
    if clients is None:
        return here
    # Named clients, and the client without a name, are told apart by partition.
    kinds = [F.col(CLIENT).isin(*[c for c in clients if c is not None])] if any(c is not None for c in clients) else []
    if None in clients:
        kinds.append(F.col(CLIENT).isNull())
    return here & _any_of(kinds)


def _evened(df, partition_by):
    """Rows to be written as even files.

    The rebalance hint lets the adaptive planner cut a large client into several
    even files and merge small ones, instead of one task per client.  It deals out
    every row once more, which rows of few clients can do without.
    """
    by = [c for c in partition_by if c in df.columns]
    return df.hint("rebalance", *by) if by else df


def _write_rows(df, path, partition_by):
    """Rows of ``df`` in the next version directory; invisible until its marker is written."""
    version = max(versions(df.sparkSession, path, complete=False), default=0) + 1
    by = [c for c in partition_by if c in df.columns]
    writer = df.write.option("compression", "zstd")
    if by:
        writer = writer.partitionBy(*by)
    with shuffles_released(df.sparkSession):
        writer.parquet(version_path(path, version))
    return version


def write_snapshot(df, path, partition_by=(CLIENT,), even=True):
    """Replace a table by ``df``: write the next version, then mark it complete.

    ``even=False`` writes a file per task and client, for rows that are of few clients.
    """
    version = _write_rows(_evened(df, partition_by) if even else df, path, partition_by)
    _write_marker(df.sparkSession, path, version, df.schema, {version: None})
    return version


def _continued(df, path):
    """Parts of the latest version, which a version with the schema of ``df`` can keep."""
    spark = df.sparkSession
    before = latest_version(spark, path)
    if before is None:
        return {}
    schema, parts = _read_marker(spark, path, before)
    types = lambda s: [(f.name, f.dataType.simpleString()) for f in s]
    if types(schema) != types(df.schema):
        raise ValueError(f"columns of {path} changed from {types(schema)} to {types(df.schema)}: replace the whole table")
    return parts


def append_snapshot(df, path, partition_by=(CLIENT,)):
    """Next version: all rows of the latest one, whose files stay where they are, and those of ``df``."""
    parts = _continued(df, path)
    version = _write_rows(_evened(df, partition_by), path, partition_by)
    _write_marker(df.sparkSession, path, version, df.schema, parts | {version: None})
    return version


def write_clients(df, path, clients):
    """Next version: rows of ``df`` for the given clients, and the latest version's rows of all others.

    Only the given clients' files are written; the others' stay as they are and
    are pointed to.  A given client without a row in ``df`` has none afterwards.
    ``df`` must hold rows of given clients only; None names the client without a name.
    """
    spark = df.sparkSession
    parts = _continued(df, path)
    given = sorted(set(clients), key=lambda c: (c is not None, c))
    kept = {}
    for number, named in parts.items():
        if named is None:
            stored = spark.read.schema(T.StructType().add(CLIENT, "string")).parquet(version_path(path, number))
            named = [row[0] for row in stored.distinct().collect()]
        kept[number] = sorted(set(named) - set(given), key=lambda c: (c is not None, c))
    version = _write_rows(_evened(df, (CLIENT,)) if len(given) > FEW_CLIENTS else df, path, (CLIENT,))
    _write_marker(spark, path, version, df.schema, {n: c for n, c in kept.items() if c} | {version: given})
    return version


def stored_parts(spark, path):
    """Version directories that hold the latest version's rows, with their clients; None for all of one."""
    latest = latest_version(spark, path)
    return {} if latest is None else _read_marker(spark, path, latest)[1]


def current_versions(spark, path):
    """Where each client's rows are stored, for a table whose clients change one by one: client and version."""
    rows = [(c, number) for number, clients in stored_parts(spark, path).items() for c in clients or ()]
    return spark.createDataFrame(rows, f"{CLIENT} string, {VERSION} int")


def compact_snapshot(spark, path):
    """Rewrite the latest version as one part of even files; its number, or that of the latest if it has one part."""
    if len(stored_parts(spark, path)) < 2:
        return latest_version(spark, path)
    return write_snapshot(read_snapshot(spark, path), path)


def expire_snapshots(spark, path, keep=2):
    """Delete all but the newest ``keep`` complete versions; returns those deleted.

    Files that a kept version still points to stay, and go once no version needs them.
    """
    complete = versions(spark, path)
    expired = complete[:-keep] if keep > 0 else []
    if not expired:
        return expired
    used = {}
    for version in complete[-keep:]:
        for number, clients in _read_marker(spark, path, version)[1].items():
            used.setdefault(number, []).append(clients)
    for version in expired:
        # Without its marker a version is gone for readers; what is left of it are parts.
        system, marker = file_system(spark, f"{version_path(path, version)}/{MARKER}")
        system.delete(marker, False)
    for version in versions(spark, path, complete=False):
        if version > complete[-1] or version in complete[-keep:]:
            continue
        target = file_system(spark, version_path(path, version))[1]
        if version not in used:
            system.delete(target, True)
        elif None not in used[version]:
            needed = {c for clients in used[version] for c in clients}
            for status in system.listStatus(target):
                if _client_of(spark, status.getPath().getName()) not in needed | {_NO_CLIENT}:
                    system.delete(status.getPath(), True)
    return expired


_NO_CLIENT = object()


def _client_of(spark, directory):
    """Client of a partition directory; a marker for anything else."""
    prefix = f"{CLIENT}="
    if not directory.startswith(prefix):
        return _NO_CLIENT
    name = directory.removeprefix(prefix)
    if name == "__HIVE_DEFAULT_PARTITION__":
        return None
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name)
