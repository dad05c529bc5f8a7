"""Parquet tables on a shared file system: appends, versioned snapshots, staged partitions.

Bronze and silver only grow: plain appends, partitioned by the run that wrote them, then by
batch date. The dimension and the reports are small and written whole, each time as a new version
folder ``_v000001``, ``_v000002``, ...; readers take the newest whose write committed (has
``_SUCCESS``). Of the large gold tables an upsert replaces some partitions: their rows are set
apart first (``stage_partitions``) and then moved into the place of the old ones (``finish_stage``).

File-system calls go through Hadoop's ``FileSystem`` of the session, so the same code
works on local disk, HDFS or an object store.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION_PREFIX = "_v"
#: Partitions moved at a time, as each waits for the file system.
MOVE_THREADS = 16


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def move(spark: SparkSession, src: str, dst: str) -> None:
    fs, s, jvm = _fs(spark, src)
    d = jvm.org.apache.hadoop.fs.Path(dst)
    fs.mkdirs(d.getParent())
    if fs.exists(d):
        fs.delete(d, True)  # a delivery may be a folder
    if not fs.rename(s, d):
        raise OSError(f"could not move {src} to {dst}")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder (e.g. one table partition) if it exists."""
    fs, p, _ = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def list_files(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    """Data files directly inside ``folder`` (no hidden or marker files)."""
    fs, p, _ = _fs(spark, folder)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isFile() and not name.startswith(("_", ".")) and name.endswith(suffix):
            out.append(st.getPath().toString())
    return sorted(out)


def list_folders(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    """Folders directly inside ``folder``, none that is hidden."""
    fs, p, _ = _fs(spark, folder)
    found = [st.getPath() for st in fs.listStatus(p) if st.isDirectory()] if fs.exists(p) else []
    return sorted(f.toString() for f in found if not f.getName().startswith(("_", ".")) and f.getName().endswith(suffix))


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet table at ``path``, or None when no row was written there yet.

    An append of zero rows leaves a folder without data files; it reads as None too.
    """
    if not exists(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the first partition level, from a listing of its folders."""
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [f.getName() for f in jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.listStatus(p))]
    return sorted(n.partition("=")[2] for n in names if n.startswith(f"{column}="))


def _versions(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    fs, p, jvm = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(VERSION_PREFIX) and name[len(VERSION_PREFIX):].isdigit():
            committed = fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))
            if committed:
                out.append((int(name[len(VERSION_PREFIX):]), st.getPath().toString()))
    return sorted(out)


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    """Newest committed version of a versioned table, or None."""
    vs = _versions(spark, root)
    return spark.read.parquet(vs[-1][1]) if vs else None


def write_version(df: DataFrame, root: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as the next version of the table at ``root``; returns its path."""
    spark = df.sparkSession
    fs, p, jvm = _fs(spark, root)
    highest = -1
    if fs.exists(p):
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith(VERSION_PREFIX) and name[len(VERSION_PREFIX):].isdigit():
                highest = max(highest, int(name[len(VERSION_PREFIX):]))
    path = f"{root.rstrip('/')}/{VERSION_PREFIX}{highest + 1:06d}"
    w = for_partitioned_write(df, partition_by).write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def prune_versions(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove all but the newest committed versions; a reader may still hold the one before."""
    for _, path in _versions(spark, root)[:-keep]:
        delete(spark, path)


def read_partitions(spark: SparkSession, path: str, column: str, values: list[str] | None = None) -> DataFrame | None:
    """The given partitions of a table (all of them by default), read by folder: a filter would
    list every other folder too. None where none is stored."""
    stored = partition_values(spark, path, column)
    wanted = stored if values is None else sorted(set(stored) & set(values))
    if not wanted:
        return None
    return spark.read.option("basePath", path).parquet(*[f"{path}/{column}={v}" for v in wanted])


def _folds(spark: SparkSession, path: str) -> dict[str, str]:
    rows = read_or_none(spark, path)
    return {} if rows is None else {r["old"]: r["new"] for r in rows.collect()}  # a row per folded run


def folded_into(spark: SparkSession, path: str, runs: list[str]) -> list[str]:
    """The runs that hold the rows of ``runs`` now, by the folds committed at ``path``."""
    to, out = _folds(spark, path), set()
    for run in runs:
        while run in to:
            run = to[run]
        out.add(run)
    return sorted(out)


def fold(spark: SparkSession, path: str, column: str, runs: list[str], stored: dict[str, str], by: dict[str, list[str]],
         least: int, keep: DataFrame | None = None) -> int:
    """Merge the folders ``column=run`` of the given runs in each table of ``stored`` into those of a
    new run, committed at ``path``; how many folders' runs were merged (0 if fewer than ``least``).
    ``keep(file_name, column)`` names the rows that count, where not all do."""
    to = _folds(spark, path)
    for table in stored.values():
        for run in partition_values(spark, table, column):
            if run in to:  # committed, but not deleted
                delete(spark, f"{table}/{column}={run}")
    now = folded_into(spark, path, runs)
    if len(now) < max(least, 2):
        return 0
    new = f"fold-{uuid.uuid4().hex}"
    for name, table in stored.items():
        rows = read_partitions(spark, table, column, now)
        if rows is None:
            continue
        if keep is not None:
            # rows of an earlier fold are those that count
            rows = rows.withColumn("_run", F.col(column)).join(keep.withColumnRenamed(column, "_run"), ["file_name", "_run"], "left_semi").unionByName(
                rows.where(F.col(column).startswith("fold-")).withColumn("_run", F.col(column))).drop("_run")
        append(rows.withColumn(column, F.lit(new)), table, [column, *by[name]])
    spark.createDataFrame([(r, new) for r in now], "old string, new string").coalesce(1).write.mode("append").parquet(path)
    for table in stored.values():
        for run in now:
            delete(spark, f"{table}/{column}={run}")
    return len(now)


def stage_partitions(rows: DataFrame, stage: str, name: str, part: str | None = None) -> None:
    """Set apart the new rows of some partitions of the table ``name``. With their column ``part`` they
    are written as the partitions that they will be, which are then moved and not written again."""
    writer = for_partitioned_write(rows, [part] if part else None).write
    (writer.partitionBy(part) if part else writer).parquet(f"{stage}/{name}")


def close_stage(spark: SparkSession, stage: str, touched: list[tuple]) -> None:
    """All is set apart: ``touched`` lists (table, its path, partition column, partition date) of
    every partition that is replaced. From here on the change will be finished. ``filled`` tells whether
    a partition set apart as such has rows, as it is there no longer once it is moved; it is null for
    rows that are set apart as one table."""
    found = {}
    for name, part in {(t[0], t[2]) for t in touched}:
        as_one = list_files(spark, f"{stage}/{name}")
        found[name] = None if as_one else set(partition_values(spark, f"{stage}/{name}", part))
    rows = [(*t, None if found[t[0]] is None else t[3].isoformat() in found[t[0]]) for t in touched]
    listed = spark.createDataFrame(rows, "name string, path string, part string, value date, filled boolean")
    listed.coalesce(1).write.parquet(f"{stage}/ready")


def stage_ready(spark: SparkSession, stage: str) -> list:
    """What a closed stage replaces: one row per partition; nothing where no stage is closed."""
    if not exists(spark, f"{stage}/ready/_SUCCESS"):
        return []
    return spark.read.parquet(f"{stage}/ready").collect()


def finish_stage(spark: SparkSession, stage: str) -> None:
    """Replace the partitions by their rows set apart, if the stage is closed; doing so twice, or
    again after a run that died, changes nothing. A partition without rows is deleted."""
    listed = stage_ready(spark, stage)
    moved = [r for r in listed if r["filled"] is not None]
    with ThreadPoolExecutor(MOVE_THREADS) as pool:
        list(pool.map(lambda r: _replace(spark, stage, r), moved))
    listed = [r for r in listed if r["filled"] is None]
    for name, path, part in sorted({(r["name"], r["path"], r["part"]) for r in listed}):
        ready = spark.read.parquet(f"{stage}/{name}")
        writer = for_partitioned_write(ready, [part]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(part).parquet(path)
        filled = {r[0] for r in ready.select(part).distinct().collect()}
        for r in listed:
            if r["name"] == name and r["value"] not in filled:
                delete(spark, f"{path}/{part}={r['value'].isoformat()}")
    delete(spark, stage)


def _replace(spark: SparkSession, stage: str, r) -> None:
    """Put a partition set apart in the place of the old one, unless an earlier try has."""
    folder = f"{r['part']}={r['value'].isoformat()}"
    source, target = f"{stage}/{r['name']}/{folder}", f"{r['path']}/{folder}"
    if not r["filled"]:
        delete(spark, target)
    elif exists(spark, source):
        move(spark, source, target)


def read_staged(spark: SparkSession, stage: str, name: str, path: str) -> DataFrame | None:
    """The table as it is or, while a closed stage waits to be finished, as it will be."""
    listed = [r for r in stage_ready(spark, stage) if r["name"] == name]
    if not listed:
        return read_or_none(spark, path)
    part, replaced = listed[0]["part"], {r["value"].isoformat() for r in listed}
    if listed[0]["filled"] is None:
        ready = spark.read.parquet(f"{stage}/{name}")
    else:
        # those that are moved already are in their place
        filled = {r["value"].isoformat() for r in listed if r["filled"]}
        waiting = filled & set(partition_values(spark, f"{stage}/{name}", part))
        replaced -= filled - waiting
        ready = read_partitions(spark, f"{stage}/{name}", part, sorted(waiting))
    if ready is None:
        return read_partitions(spark, path, part, [v for v in partition_values(spark, path, part) if v not in replaced])
    kept = read_partitions(spark, path, part, [v for v in partition_values(spark, path, part) if v not in replaced])
    return ready if kept is None else kept.select(*ready.columns).unionByName(ready)


def for_partitioned_write(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """Group rows by output partition before a partitioned write.

    Without it every task writes a file into every partition it meets (tasks x dates
    small files). ``rebalance`` is sized at run time by AQE: small partitions are
    merged into one file, a partition holding a third of all rows is split over many
    tasks, so no single task writes a hot date alone.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = for_partitioned_write(df, partition_by).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
