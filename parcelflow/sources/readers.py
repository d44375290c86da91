"""Readers: CSV folders as named tables, catalog or path tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from . import versions

# --- fixed values -------------------------------------------------------------------------
# Options of the operational CSV exports: comma separated, header line, single-quote quoting,
# ``\N`` for NULL.
CSV_OPTIONS = {"delimiter": ",", "header": "true", "quote": "'", "nullValue": "\\N"}
# ------------------------------------------------------------------------------------------


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, **options) -> DataFrame:
    """One CSV file or folder.  With a schema nothing is inferred (no extra pass over the data)."""
    reader = spark.read.options(**{**CSV_OPTIONS, **options})
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def _list_dir(spark: SparkSession, path: str) -> list[str]:
    """Child entry names of a folder on any Hadoop-compatible file system (metadata only)."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(st.getPath().getName() for st in fs.listStatus(hpath))


def read_dir(spark: SparkSession, path: str, fmt: str = "csv", schemas: dict | None = None,
             **options) -> dict[str, DataFrame]:
    """Every entry of a folder as a table named by its file-name stem (``x.csv`` -> ``x``,
    ``x_clean.csv/`` -> ``x_clean``); hidden entries (``_``/``.``) are skipped."""
    schemas = schemas or {}
    out = {}
    for name in _list_dir(spark, path):
        if name.startswith(("_", ".")):
            continue
        stem = name.rsplit(".", 1)[0] if "." in name else name
        full = f"{path.rstrip('/')}/{name}"
        if fmt == "csv":
            out[stem] = read_csv(spark, full, schemas.get(stem), **options)
        else:
            reader = spark.read.format(fmt).options(**options)
            if stem in schemas:
                reader = reader.schema(schemas[stem])
            out[stem] = reader.load(full)
    return out


def read_table(spark: SparkSession, name_or_path: str, fmt: str | None = None) -> DataFrame:
    """A catalog table by name, or a path in ``fmt`` (parquet, orc, csv …); of a path that
    ``sinks.write_table`` loads, the rows of the last whole load."""
    if fmt is None:
        return spark.table(name_or_path)
    if fmt == "csv":
        return read_csv(spark, name_or_path)
    if versions.is_versioned(spark, name_or_path):
        return versions.read(spark, name_or_path)
    return spark.read.format(fmt).load(name_or_path)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Expose frames to SQL users under their names (session-scoped temp views)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)

