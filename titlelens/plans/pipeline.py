"""Raw files to a stored clean catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from titlelens.operators.clean import clean
from titlelens.sources.records import read_records
from titlelens.sources.tables import save_clean


def run_pipeline(spark: SparkSession, raw_path: str, out_path: str, multi_line: bool = True,
                 single_csv: bool = False) -> DataFrame:
    """Read, clean and save; the returned frame reads the stored Parquet."""
    return save_clean(clean(read_records(spark, raw_path, multi_line=multi_line)), out_path,
                      single_csv)
