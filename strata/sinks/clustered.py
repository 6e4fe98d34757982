"""Range-clustered writes: an order that survives the write.

Rows are range-partitioned and sorted by the clustering columns before they are written, so
files, and the row groups in them, cover narrow ranges. Parquet keeps the least and greatest
value of every row group; a reader that filters on the leading column skips the others. Rows
of one hot value spread over several files, since the columns after it split them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_clustered(df: DataFrame, path: str, by: Sequence[str], *, files: int | None = None,
                    row_group_bytes: int | None = None) -> None:
    """Parquet ordered by ``by`` within and across files (about ``files`` of them; by default as many
    as the session has shuffle partitions, merged by their size)."""
    ranged = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    writer = ranged.sortWithinPartitions(*by).write
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def row_groups(spark: SparkSession, path: str, column: str, low, high) -> tuple[int, int]:
    """(row groups that may hold a number of the column in [low, high], all row groups), from the
    files' footers. Groups without statistics count as read, groups of nulls alone do not."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    listing = where.getFileSystem(conf).listFiles(where, True)
    touched = total = 0
    while listing.hasNext():
        file = listing.next().getPath()
        if not file.getName().endswith(".parquet"):
            continue
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(file, conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            for group in reader.getFooter().getBlocks():
                total += 1
                for chunk in group.getColumns():
                    if chunk.getPath().toDotString() != column:
                        continue
                    known = chunk.getStatistics()
                    if known is None or known.isEmpty():
                        touched += 1
                    elif known.hasNonNullValue() and known.genericGetMax() >= low and known.genericGetMin() <= high:
                        touched += 1
        finally:
            reader.close()
    return touched, total
