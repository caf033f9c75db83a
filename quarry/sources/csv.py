"""CSV edges of the pipeline.

Reads always take an explicit schema (no inference pass).  The lossless
options survive nulls, empty strings, padding, quotes, backslashes and
multi-line values in a write -> read round trip; ``DROPMALFORMED`` drops rows
whose field count differs from the schema (with column pruning of the CSV
parser switched off, so the whole row is checked - trap T2).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: fixed values: the lossless CSV dialect (writer and reader must agree)
LOSSLESS_WRITE = {
    "header": "true", "quote": '"', "escape": '"', "quoteAll": "true",
    "nullValue": "\\N", "emptyValue": "", "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
LOSSLESS_READ = {
    "header": "true", "quote": '"', "escape": '"', "multiLine": "true",
    "nullValue": "\\N", "emptyValue": "", "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path, schema: T.StructType, mode: str = "PERMISSIVE",
             lossless: bool = True, glob: str | None = None, multi_line: bool = True, **options) -> DataFrame:
    """Read CSV file(s) with an explicit schema.

    ``multi_line``: values may hold line breaks.  A file is then one task, so
    a dump must come in files of a bounded size (some 256 MB); a dump whose
    values hold no line breaks is read with ``multi_line=False``, and its
    files are split.

    ``path`` may be a list and may contain glob patterns; ``glob`` filters file
    names (``pathGlobFilter``).  ``mode='DROPMALFORMED'`` drops rows with a
    wrong field count or an unparseable value.
    """
    opts = dict(LOSSLESS_READ) if lossless else {"header": "true"}
    opts["multiLine"] = str(bool(multi_line and lossless)).lower()
    opts.update(options)
    opts["mode"] = mode
    if glob:
        opts["pathGlobFilter"] = glob
    if mode.upper() == "DROPMALFORMED":
        opts["columnPruning"] = "false"  # check whole lines, not only the columns in use
    reader = spark.read.schema(schema).options(**opts)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", partitions: int | None = None,
              lossless: bool = True, partition_by: str | None = None, **options) -> None:
    """Write ``df`` as CSV; ``mode='overwrite'`` replaces the output (no
    hand-written delete).  ``partitions`` sets the file count (default: as
    computed, AQE-coalesced), ``partition_by`` names a column whose values get
    a folder each."""
    opts = dict(LOSSLESS_WRITE) if lossless else {"header": "true", "quote": '"', "escape": '"'}
    opts.update(options)
    out = df.repartition(partitions) if partitions else df
    writer = out.write.mode(mode).options(**opts)
    (writer.partitionBy(partition_by) if partition_by else writer).csv(path)


def write_lines(df: DataFrame, header: str, path: str) -> None:
    """Write the one text column of ``df`` as lines, as they are, each file
    below the line ``header``."""
    df.toDF(header).write.mode("overwrite").options(
        header="true", sep="\u0001", quote="", escapeQuotes="false").csv(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a
    machine-local temp folder on a cluster)."""
    from quarry.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"
