"""Names for the rows of a stored table that are the same in every job that reads it.

A number that Spark hands out while it scans depends on how files were split, and that on
the cores at hand when the job began. So a row is known by its file and its place in it, which
are facts of the table. Files are known by a 64-bit digest of their path: among n of them two
meet with a chance of about n * n / 2**65.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlake.session import cut_lineage

FILE, ROW = "__file", "__row"
PLACE = (FILE, ROW)


def with_place(docs: DataFrame) -> DataFrame:
    """The table with ``__file`` and ``__row``: its order is that of the two.

    ``docs`` is a Parquet table or some of its columns or rows; anything else must be stored first,
    and a frame that comes from no file is stored here.
    """
    try:
        return _located(docs)
    except AnalysisException:
        return _located(cut_lineage(docs, "rows"))


def _located(docs: DataFrame) -> DataFrame:
    return docs.withColumns({FILE: F.xxhash64("_metadata.file_path"), ROW: F.col("_metadata.row_index")})
