"""Raw JSON-lines ingestion with explicit schemas (no inference job)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.schemas import CORRUPT, RAW, with_corrupt_column

ENTITIES = tuple(RAW)


def read_json_lines(spark: SparkSession, path: str, schema, *,
                    keep_corrupt: bool = True) -> DataFrame:
    """Typed read. A field absent from the file is NULL; an empty file is an
    empty typed DataFrame; a line that does not parse keeps its text in
    ``_corrupt_record`` (all other fields NULL). JSON lines are splittable
    (uncompressed or splittable codecs), so input splits follow
    ``spark.sql.files.maxPartitionBytes``."""
    reader = spark.read.option("mode", "PERMISSIVE")
    if keep_corrupt:
        schema = with_corrupt_column(schema)
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).json(path)


def entity_path(input_path: str, entity: str) -> str:
    """Layout of the raw zone: ``<input>/<entity>/<entity>.jsonl``."""
    return f"{input_path.rstrip('/')}/{entity}/{entity}.jsonl"


def load_raw(spark: SparkSession, input_path: str, path_for=entity_path) -> dict[str, DataFrame]:
    """The five raw entities, keyed by name (customers, accounts,
    transactions, deposits, loans)."""
    return {e: read_json_lines(spark, path_for(input_path, e), RAW[e]) for e in ENTITIES}
