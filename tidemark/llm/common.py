"""Texts, words and keys shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words between white space, and words of ASCII letters, digits and all other code points.
SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(x: str) -> str:
    """SQL text: A-Z in lower case, every other character as it is."""
    return f"translate({x}, '{UPPER}', '{LOWER}')"


def words_of(x: str, pattern: str) -> str:
    """SQL text: array of words; empty for null."""
    return f"regexp_extract_all(coalesce({x}, ''), r'{pattern}', 0)"


def keyed(docs: DataFrame, *extra: str) -> DataFrame:
    """(doc_id, text, _id, _th, extra...): a key without nulls by which results meet their rows.

    Rows equal in id and text share a key; as results depend on these two only, each such row gets
    the result of its key. Input columns of other names are left out, so they cannot clash.
    """
    return docs.selectExpr(
        "doc_id", "text", "coalesce(doc_id, -9223372036854775808) as _id",
        "xxhash64(doc_id is null, coalesce(text, '')) as _th", *extra,
    )


def fresh(df: DataFrame, *names: str) -> DataFrame:
    """Without columns of these names, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def release(spark: SparkSession) -> None:
    """Ask the JVM to collect garbage: only that lets Spark remove the shuffle files of finished
    plans, which would otherwise pile up through an operator of many steps."""
    spark.sparkContext._jvm.System.gc()


def stage(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder and read back, so that lineage ends here."""
    out = staged(df)
    release(df.sparkSession)
    return out


def drop_stage(*tables: DataFrame) -> None:
    """Delete tables made by :func:`stage` once all that reads them has been staged itself."""
    for table in tables:
        spark = table.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
