"""Writing tables, wave partitions, catalog entries and CSV exports."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BYTE_ORDER_MARK = "\ufeff"


def write_table(df: DataFrame, path: str) -> None:
    """Replace a dataset; as many files as there are partitions."""
    df.write.mode("overwrite").parquet(path)


def write_wave(df: DataFrame, path: str, wave: str, partition: str = "edition") -> None:
    """Replace the partition of one wave, by nothing if ``df`` is empty, and no other."""
    folder = quote(f"{partition}={wave}", safe="= -_.")
    df.drop(partition).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{folder}")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def register_table(df: DataFrame, name: str, path: str, partition_by: Sequence[str] = ()) -> None:
    """Create the catalog entry for files already written, or bring it up to date in place.

    ``df`` only gives the schema, so partition columns keep their types. An entry that
    is there already gets new columns and partitions and stays readable throughout, with
    its comment and grants. Only where a column went away or changed its type, or the
    partitioning or place differs, is it made anew.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(name) and _brought_up_to_date(df, name, path, partition_by):
        return
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema)
    parts = f" PARTITIONED BY ({', '.join(map(_quoted, partition_by))})" if partition_by else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{parts} LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def _brought_up_to_date(df: DataFrame, name: str, path: str, partition_by: Sequence[str]) -> bool:
    """Alter an entry to the schema of ``df``; False if that takes a new one."""
    spark = df.sparkSession
    now = {f.name: f.dataType for f in spark.table(name).schema}
    wanted = {f.name: f.dataType for f in df.schema}
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    place = (facts.get("Location") or "").removeprefix("file:").rstrip("/")
    if place != path.removeprefix("file:").rstrip("/") or parts != list(partition_by):
        return False
    if any(wanted.get(column) != kind for column, kind in now.items()):
        return False
    new = [f"{_quoted(c)} {kind.simpleString()}" for c, kind in wanted.items() if c not in now]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return True


def export_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """One CSV file with a header and the rows in order, in a folder of its own.

    For results: tables with a few rows per wave and label. The rows are brought into
    one task after all work on them is done, in their order.
    """
    _one_task(df).write.mode("overwrite").options(header=True, sep=sep, encoding="UTF-8").csv(path)


def _one_task(df: DataFrame) -> DataFrame:
    """``df`` in one partition by an exchange, numbered first so that its order stays."""
    order = "__order"
    numbered = df.withColumn(order, F.monotonically_increasing_id())
    return numbered.repartition(1).sortWithinPartitions(order).drop(order)


def export_file(df: DataFrame, path: str, sep: str = ";", mark: bool = True) -> None:
    """One CSV file called exactly ``path``, by default with ``;`` and a byte-order mark.

    The mark is what spreadsheet programs tell UTF-8 by. For results only, as
    ``export_csv``. The file is written beside its place and then takes it.
    """
    spark = df.sparkSession
    folder = f"{path}.parts-{uuid.uuid4().hex}"
    names = [f"{BYTE_ORDER_MARK}{c}" if mark and i == 0 else c for i, c in enumerate(df.columns)]
    export_csv(df.toDF(*names), folder, sep)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{folder}/part-*"))
    files.delete(place, False)
    files.rename(parts[0].getPath(), place)
    files.delete(jvm.org.apache.hadoop.fs.Path(folder), True)
