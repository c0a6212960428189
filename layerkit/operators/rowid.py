"""A stable identity for each stored row."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerkit.sources.scratch import settle

ROW_ID = "__row"
SPREAD_ROWS = 10_000_000


def with_row_id(df: DataFrame, from_files: bool = False) -> DataFrame:
    """Add a struct of file and position that names each row in every pass.

    ``from_files`` says that ``df`` only projects or filters a Parquet scan.
    Anything else is written first: numbers handed out while a shuffle is
    recomputed, or split differently, could change from pass to pass.
    """
    if not from_files:
        return with_row_id(settle(df)[0], from_files=True)
    file = F.xxhash64("_metadata.file_path").alias("file")
    try:
        return df.withColumn(ROW_ID, F.struct(file, F.col("_metadata.row_index").alias("at")))
    except AnalysisException:  # not Parquet after all
        return with_row_id(df)


def in_place(df: DataFrame) -> DataFrame:
    """``df`` itself where it only projects or filters a Parquet scan, or else written once.

    For those who name rows by file and position in more than one pass. The
    plan is asked, since a join may show the file and position of one side for
    several rows.
    """
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias") and node.deterministic():
        node = node.children().head()
    if node.nodeName() == "LogicalRelation" and node.relation().toString().lower() == "parquet":
        return df
    return settle(df)[0]


def spread(df: DataFrame) -> DataFrame:
    """Redistribute a scan that has fewer splits than the cluster has cores.

    A file with few row groups would keep all later work on few cores. Up to
    ``SPREAD_ROWS`` rows one shuffle is cheap; larger scans are returned as is.
    Rows are placed by their position, which is even whatever their values.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores or df.count() > SPREAD_ROWS:
        return df
    named = df if ROW_ID in df.columns else with_row_id(df, from_files=True)
    return named.repartition(cores, ROW_ID).select(*df.columns)
