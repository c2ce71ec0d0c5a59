"""Raw table scans with row lineage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.contracts import SourceContract
from tidemark.functions.scalars import quoted
from tidemark.session import staged


class ContractError(ValueError):
    """A source lacks fields its contract requires."""


def require_fields(df: DataFrame, contract: SourceContract) -> DataFrame:
    absent = sorted(set(contract.required) - set(df.columns))
    if absent:
        raise ContractError(f"{contract.name}: missing configured fields: {absent}")
    return df


def _plain_path(spark: SparkSession, path: str) -> str:
    """The path of a root without scheme and authority, absolute, not percent-encoded."""
    held = spark._jvm.org.apache.hadoop.fs.Path(path)
    held = held.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(held)
    return held.toUri().getPath().rstrip("/")


def _relative(uri: str, plain_root: str) -> str:
    """SQL text: a file URI's path below the root. Only the leading root is taken off; percent
    signs are decoded, a plus sign stands for itself."""
    path = (f"url_decode(replace(regexp_replace({uri}, '^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?', ''), "
            "'+', '%2B'))")
    prefix = quoted(plain_root + "/")
    return f"if(startswith({path}, {prefix}), substr({path}, length({prefix}) + 1), {path})"


def scan_parquet(
    spark: SparkSession, root: str, pattern: str, contract: SourceContract | None = None
) -> DataFrame:
    """All files under ``root/pattern`` as one table, columns unioned by name.

    ``_source_file`` (relative) and ``_source_row`` come from file metadata, so they cost no
    shuffle and column pruning still reaches the scan. Directory names are not columns.
    """
    if ".." in pattern.split("/"):
        raise ContractError(f"input path escapes the raw root: {pattern}")
    df = (
        spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true")
        .parquet(f"{root.rstrip('/')}/{pattern}")
    )
    df = df.selectExpr(
        "*", f"{_relative('_metadata.file_path', _plain_path(spark, root))} as _source_file",
        "_metadata.row_index as _source_row",
    )
    return require_fields(df, contract) if contract else df


def scan_csv(
    spark: SparkSession, root: str, pattern: str, contract: SourceContract | None = None
) -> DataFrame:
    """Header CSV files, every column text, empty text NULL; large files are read by many tasks.

    CSV carries no row index. Rows of a split follow each other, so a first pass counts the rows of
    every split, and a row's number is its place in the split plus the rows of the splits before.
    What is ordered and joined is one row per split. A line break inside quotes is not supported.
    """
    read = spark.read.option("header", "true").option("inferSchema", "false").csv(
        f"{root.rstrip('/')}/{pattern}"
    )
    placed = read.selectExpr(
        "*", f"{_relative('_metadata.file_path', _plain_path(spark, root))} as _source_file",
        "_metadata.file_path as _path", "_metadata.file_block_start as _split",
        "monotonically_increasing_id() as _order",
    )
    splits = placed.groupBy("_path", "_split").agg(
        F.expr("min(_order) as _first"), F.expr("count(*) as _rows")
    ).selectExpr(
        "_path", "_split", "_first",
        "coalesce(sum(_rows) over (partition by _path order by _split "
        "rows between unbounded preceding and 1 preceding), 0) as _before",
    )
    numbered = placed.join(splits, ["_path", "_split"]).selectExpr(
        *[f"`{c}`" for c in read.columns], "_source_file",
        "cast(_order - _first + _before as bigint) as _source_row",
    )
    return require_fields(numbered, contract) if contract else numbered


class FileChangedError(ValueError):
    """A file was no longer what it was when its hash was begun."""


_FOUND = "path string, size bigint, mtime timestamp, is_folder boolean"
#: Bytes read of a file at a time.
CHUNK = 8 << 20
#: Bytes of files that one task hashes on average.
TASK_BYTES = 1 << 30


def _file_system(spark: SparkSession, root: str) -> str:
    """Scheme and authority of a root's file system, by which tasks open it."""
    held = spark._jvm.org.apache.hadoop.fs.Path(root)
    uri = held.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(held).toUri()
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}"


def _lister(system: str):
    """Function of Arrow batches: what lies directly in each folder, files and folders."""

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs

        client = fs.LocalFileSystem() if system.startswith("file:") else fs.FileSystem.from_uri(system + "/")[0]
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                found = client.get_file_info(fs.FileSelector(folder))  # an unreadable folder fails
                yield pa.RecordBatch.from_arrays([
                    pa.array([x.path for x in found], pa.string()),
                    pa.array([None if x.type == fs.FileType.Directory else x.size for x in found], pa.int64()),
                    pa.array([x.mtime_ns // 1000 for x in found], pa.timestamp("us", "UTC")),
                    pa.array([x.type == fs.FileType.Directory for x in found], pa.bool_()),
                ], ["path", "size", "mtime", "is_folder"])

    return run


def _hasher(system: str, chunk: int):
    """Function of Arrow batches: SHA-256 and length of each file, read piece by piece."""

    def run(batches):
        import hashlib

        import pyarrow as pa
        from pyarrow import fs

        client = fs.LocalFileSystem() if system.startswith("file:") else fs.FileSystem.from_uri(system + "/")[0]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                digest, length = hashlib.sha256(), 0
                with client.open_input_stream(path) as source:
                    while piece := source.read(chunk):
                        digest.update(piece)
                        length += len(piece)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([digest.hexdigest()]), pa.array([length])],
                    ["path", "sha256", "read_size"])

    return run


def _listing(spark: SparkSession, root: str) -> DataFrame:
    """Staged (path, size, mtime), absolute, of every file under ``root``, hidden and empty ones
    included, which Spark's readers leave out.

    Tasks list folders, one job for each level of folders; names never pass through the driver.
    """
    run = _lister(_file_system(spark, root))
    folders = spark.createDataFrame([(_plain_path(spark, root) or "/",)], "path string")
    levels = []
    while True:
        found = staged(folders.mapInArrow(run, _FOUND))
        levels.append(found.filter("not is_folder").select("path", "size", "mtime"))
        folders = found.filter("is_folder").select("path").repartition(
            spark.sparkContext.defaultParallelism)
        if found.filter("is_folder").isEmpty():
            return reduce(DataFrame.unionByName, levels)


def _hashed(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """(path, sha256, read_size), each file hashed in one task, files dealt out over tasks."""
    total = files.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, total // TASK_BYTES)
    return files.select("path").repartition(tasks).mapInArrow(
        _hasher(_file_system(spark, root), CHUNK), "path string, sha256 string, read_size bigint")


def file_inventory(spark: SparkSession, root: str, checksums: bool = False) -> DataFrame:
    """(path, size, mtime[, sha256]) of every file under ``root``, paths relative to it.

    Without checksums no file content is read. With them tasks hash files of any size in pieces;
    the listing is then taken again, and a file whose size or time differs, or that came or went,
    fails the inventory. The file system must be one that pyarrow can open from a task.
    """
    before = _listing(spark, root)
    top = _plain_path(spark, root) + "/"
    relative = f"substr(path, {len(top) + 1}) as path"
    if not checksums:
        return before.selectExpr(relative, "size", "mtime")
    hashed = staged(_hashed(spark, root, before))
    again = _listing(spark, root)
    changed = before.exceptAll(again).unionByName(again.exceptAll(before))
    short = before.join(hashed, "path", "left").filter("read_size is distinct from size")
    lost = changed.select("path").union(short.select("path")).limit(5).collect()
    if lost:
        raise FileChangedError(f"changed while being read: {sorted({r.path for r in lost})}")
    return before.join(hashed.select("path", "sha256"), "path").selectExpr(
        relative, "size", "mtime", "sha256")


def readability(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """One row: file count, first file and its row count, and the field names of a table."""
    df = scan_parquet(spark, root, pattern)
    fields = ",".join(c for c in df.columns if not c.startswith("_source_"))
    per_file = df.groupBy("_source_file").agg(F.expr("count(*) as n"))
    return per_file.groupBy().agg(
        F.expr("count(*) as file_count"),
        F.expr("min(_source_file) as sample_file"),
        F.expr("min_by(n, _source_file) as sample_rows"),
        F.lit(fields).alias("fields"),
    )


def source_signature(files: DataFrame) -> DataFrame:
    """One row identifying a set of files by path, size and time: equal sets, equal signature."""
    hashed = files.selectExpr("size", "xxhash64(path, size, mtime) as h")
    return hashed.groupBy().agg(
        F.expr("count(*) as file_count"), F.expr("coalesce(sum(size), 0) as total_bytes"),
        F.expr("cast(coalesce(sum(cast(h as decimal(38,0))), 0) as string) as hash_sum"),
        F.expr("cast(coalesce(bit_xor(h), 0) as string) as hash_xor"),
    )
