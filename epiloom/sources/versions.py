"""Tables that are replaced id by id, in versions: a reader sees all of a replacement or nothing of it.

Below the path of a table lie folders of rows and manifests:

    run=<name>/cohort_definition_id=<id>/...    the rows that one run wrote
    _versions/<number>.json                     for each id, the run that holds its rows

Rows are written first, to a folder that no reader knows. The replacement takes place when the next
manifest gets its name by a rename, which is one step and fails if another run took the number
before. A run that stops earlier leaves a folder that nothing refers to, and the table as it was. A
reader holds on to the version it began with; `clear_versions` removes what only older ones need.

Ids without rows have no folder and no entry. A path without manifests holds one folder per id, as
tables were kept before; its first replacement takes the other rows over.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID = "cohort_definition_id"
_VERSIONS = "_versions"


class ConcurrentReplacement(RuntimeError):
    """Another run replaced rows of this table in the meantime. The replacement can be repeated."""


def file_system(spark: SparkSession, path: str):
    """The file system that holds a path, and the path for it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = file_system(spark, path)
    return files.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    files, target = file_system(spark, path)
    files.delete(target, True)


def _names(spark: SparkSession, path: str) -> list[str]:
    files, target = file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the versions there are, oldest first."""
    stems = (n.removesuffix(".json") for n in _names(spark, f"{path}/{_VERSIONS}") if n.endswith(".json"))
    return sorted(int(s) for s in stems if s.isdigit())


def _manifest(path: str, number: int) -> str:
    return f"{path}/{_VERSIONS}/{number:012d}.json"


def runs_of_ids(spark: SparkSession, path: str, version: int | None = None) -> dict[int, str]:
    """For each id with rows, the run that holds them, in the latest version or a given one; empty without any."""
    known = versions(spark, path)
    if not known:
        return {}
    files, target = file_system(spark, _manifest(path, known[-1] if version is None else version))
    stream = files.open(target)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {int(i): run for i, run in json.loads(text)["runs"].items()}


def commit(spark: SparkSession, path: str, number: int, runs: dict[int, str]) -> None:
    """Make version `number`, unless there is one: written under another name, then renamed."""
    files, final = file_system(spark, _manifest(path, number))
    draft = file_system(spark, f"{path}/{_VERSIONS}/.draft-{uuid.uuid4().hex}")[1]
    out = files.create(draft, False)
    try:
        out.write(bytearray(json.dumps({"runs": {str(i): r for i, r in sorted(runs.items())}}).encode()))
    finally:
        out.close()
    # Local files would be overwritten by a rename, others refuse it.
    if files.exists(final) or not files.rename(draft, final):
        files.delete(draft, False)
        raise ConcurrentReplacement(f"version {number} of {path} is there already")


def replace_ids(rows: DataFrame, ids: Iterable[int], path: str) -> int:
    """Replace whatever the table holds of `ids` by `rows`, in one step; returns the number of the new version.

    Rows of other ids, or without one, are refused, and the table stays as it was. An id without rows
    is gone afterwards. A run that is repeated leaves the same table.
    """
    ids = sorted(set(ids))
    spark = rows.sparkSession
    known = versions(spark, path)
    before = runs_of_ids(spark, path, known[-1]) if known else {}
    own = F.when(F.col(ID).isin(ids), F.col(ID)).otherwise(F.raise_error(F.lit("a row of a cohort that is not replaced")))
    named = rows.withColumn(ID, own)
    if not known and any(n.startswith(f"{ID}=") for n in _names(spark, path)):
        plain = spark.read.schema(rows.schema).parquet(path)
        named = named.unionByName(plain.where(~F.col(ID).isin(ids)))
    run = uuid.uuid4().hex
    folder = f"{path}/run={run}"
    try:
        named.write.partitionBy(ID).parquet(folder)
    except Exception:
        remove(spark, folder)
        raise
    written = {int(n.split("=")[1]) for n in _names(spark, folder) if n.startswith(f"{ID}=")}
    runs = {i: r for i, r in before.items() if i not in ids} | dict.fromkeys(written, run)
    number = known[-1] + 1 if known else 1
    commit(spark, path, number, runs)
    return number


def read_ids(spark: SparkSession, path: str, layout: T.StructType | None = None, version: int | None = None) -> DataFrame:
    """All rows of the latest version, or a given one, as `layout` names and orders them, else as the files do.

    With a layout the table may hold no rows. The ids stand in folder names, so a filter on them reads only their folders.
    """
    reader = spark.read if layout is None else spark.read.schema(T.StructType([T.StructField(f.name, f.dataType) for f in layout]))
    if not versions(spark, path):
        rows = reader.parquet(path)
    else:
        runs = runs_of_ids(spark, path, version)
        folders = [f"{path}/run={run}/{ID}={i}" for i, run in sorted(runs.items())]
        if not folders and layout is None:
            raise ValueError(f"{path} holds no rows, so that its layout must be given")
        rows = reader.option("basePath", path).parquet(*folders) if folders else spark.createDataFrame([], layout)
    if layout is None:
        return rows.drop("run").withColumn(ID, F.col(ID).cast("long"))
    return rows.select([F.col(f.name).cast(f.dataType) for f in layout])


def clear_versions(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Remove all but the `keep` latest versions, and rows that none of these refers to.

    To be called while no other run replaces rows of the table and no reader is at an older version.
    """
    if keep < 1:
        raise ValueError("the latest version can't be removed")
    known = versions(spark, path)
    if not known:
        return
    needed = {(run, i) for v in known[-keep:] for i, run in runs_of_ids(spark, path, v).items()}
    for v in known[:-keep]:
        remove(spark, _manifest(path, v))
    for name in _names(spark, path):
        if name.startswith(f"{ID}="):  # from before there were versions
            remove(spark, f"{path}/{name}")
        elif name.startswith("run="):
            run = name.removeprefix("run=")
            parts = [n for n in _names(spark, f"{path}/{name}") if n.startswith(f"{ID}=")]
            unused = [n for n in parts if (run, int(n.split("=")[1])) not in needed]
            for n in [""] if len(unused) == len(parts) else unused:
                remove(spark, f"{path}/{name}/{n}".rstrip("/"))
