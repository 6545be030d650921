"""Compaction of a stored table in place, by bin packing.

Files below the target size are packed, first fit by decreasing size, into bins
of at most the target, for each directory (partition) apart; the names of the
directories are never parsed, so any partition value goes, NULL included.  Only
bins of two files or more are rewritten, one new file each; all other files
stay as they are.

1. The new files are written to a hidden folder beside the data, and read back:
   row count and content hash must be those of the files that they replace
   (which the write itself has observed).
2. The list of replaced files is written beside them.  From here on the
   compaction will be completed: ``finish`` moves the new files into their
   directories and deletes the replaced ones.  A job that fails before leaves
   the table alone, one that fails later is finished by the next call.

Files are moved one by one, so a reader during ``finish`` may see rows twice.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimweave.operators.layout import file_listing, plain_path, row_fingerprint, row_fingerprint_of

#: Files of one directory that are packed together; a directory with more is
#: dealt by the hash of the names.
FILES_AT_ONCE = 50_000
#: Tasks that write at most; a task may write several files.
MAX_TASKS = 20_000
HIDDEN = "_compacted-"
_SLOT = "slot__"


def first_fit_decreasing(sizes: list[int], target: int) -> list[int]:
    """The bin of each size: by decreasing size, the first bin with room left.

    A tree over the bins holds the most room below each node, so a search
    takes as many steps as the tree has levels."""
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    room = [target] * (2 * leaves)
    out = [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        node = 1
        while node < leaves:
            node = 2 * node if room[2 * node] >= sizes[k] else 2 * node + 1
        out[k] = node - leaves
        room[node] -= sizes[k]
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return out


def packing(files: DataFrame, target_bytes: int) -> DataFrame:
    """(file_path, directory, slot) of the files (file_path, file_size) to be
    rewritten; the files of one directory and slot become one."""
    small = files.where(F.col("file_size") < target_bytes).withColumn("directory", F.regexp_extract("file_path", "^(.*)/", 1))
    many = small.groupBy("directory").agg(F.ceil(F.count(F.lit(1)) / FILES_AT_ONCE).alias("parts"))
    dealt = small.join(many, "directory").withColumn("part", F.pmod(F.xxhash64("file_path"), F.col("parts")))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("file_path")  # the same bins whatever the order of arrival
        bins = pd.Series(first_fit_decreasing(rows["file_size"].tolist(), target_bytes), index=rows.index)
        rows = rows.assign(slot=rows["part"].astype(str) + "-" + bins.astype(str))
        return rows[bins.duplicated(keep=False)][["file_path", "directory", "slot"]]

    return dealt.groupBy("directory", "part").applyInPandas(pack, "file_path string, directory string, slot string")


def _fs(spark: SparkSession, path: str):
    """A path's file system and a maker of its paths (from URIs, as the listing gives them)."""
    jvm = spark.sparkContext._jvm
    here = jvm.org.apache.hadoop.fs.Path(path)
    return here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), lambda uri: jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))


def finish(spark: SparkSession, path: str) -> None:
    """Complete the compactions of the table at ``path`` whose list of replaced
    files was written, and drop what others have left."""
    fs, at = _fs(spark, path)
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    for found in fs.listStatus(root) if fs.exists(root) else []:
        staged = found.getPath()
        if not staged.getName().startswith(HIDDEN):
            continue
        listed = staged.suffix("/_replaced")
        if fs.exists(listed.suffix("/_SUCCESS")):
            uri = staged.toUri().toString()
            if fs.exists(staged.suffix("/data")):
                base = plain(f"{uri}/data")
                for row in file_listing(spark, staged.suffix("/data").toString()).toLocalIterator():
                    directory, name = row["file_path"].rsplit("/", 1)
                    directory, slot = directory.rsplit(f"/{_SLOT}=", 1)
                    target = at(plain(root.toUri().toString()) + directory[len(base):])
                    fs.mkdirs(target)
                    fs.rename(at(row["file_path"]), target.suffix(f"/part-{slot}-{name.removeprefix('part-')}"))
            for row in spark.read.text(listed.toString()).toLocalIterator():
                fs.delete(at(row["value"]), False)
        fs.delete(staged, True)


def plain(uri: str) -> str:
    """file:///x as file:/x, as in the listing."""
    scheme, _, rest = uri.partition(":/")
    return f"{scheme}:/{rest.lstrip('/')}" if scheme == "file" else uri


def compact_files(spark: SparkSession, path: str, target_bytes: int, partition_cols: list[str] | None = None) -> DataFrame:
    """Compact the table at ``path``, partitioned by ``partition_cols``, to files
    of about ``target_bytes``.  Returns one report row: files before and after,
    files replaced and made, rows before and after, and whether the rewritten
    rows were read back with the same content (else the error is raised and the
    table left alone)."""
    finish(spark, path)
    cols = list(partition_cols or [])
    files = file_listing(spark, path)
    n_before, rows_before = files.count(), spark.read.parquet(path).count()
    plan = packing(files, target_bytes).checkpoint()
    n_slots, n_files = plan.agg(F.count_distinct("directory", "slot"), F.count(F.lit(1))).first()
    if n_slots:
        staged = f"{path}/{HIDDEN}{uuid.uuid4().hex[:12]}"
        # The size is known from the listing, so large files are not even opened.
        rows = spark.read.parquet(path).where(F.col("_metadata.file_size") < target_bytes)
        names = rows.columns
        rows = rows.withColumn("file_path", plain_path(F.col("_metadata.file_path"))).join(plan, "file_path").withColumnRenamed("slot", _SLOT)
        seen = Observation()
        rows = rows.repartition(min(n_slots, MAX_TASKS), "directory", _SLOT).observe(seen, *row_fingerprint_of(names))  # in the writing tasks
        rows.select(*names, _SLOT).write.partitionBy(*cols, _SLOT).parquet(f"{staged}/data")
        found = row_fingerprint(spark.read.schema(spark.read.parquet(path).select(*names).schema).parquet(f"{staged}/data").select(*names)).first()
        if found.asDict() != seen.get:
            raise AssertionError(f"compaction of {path}: wrote {found.asDict()}, read {seen.get}")
        plan.select("file_path").write.text(f"{staged}/_replaced")
        finish(spark, path)
    after = spark.read.parquet(path)
    return spark.createDataFrame(
        [(n_before, file_listing(spark, path).count(), n_files, n_slots, rows_before, after.count(), True)],
        "files_before long, files_after long, files_replaced long, files_made long, rows_before long, rows_after long, content_equal boolean")
