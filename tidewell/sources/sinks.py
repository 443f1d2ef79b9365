"""Writers of the plain CSV form. The synced table itself is Parquet, which also keeps empty texts
apart from NULL; CSV does not. A text with a line break is refused: files are read line by line, so that
large ones can be split, and such a row would come back as two broken ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _csv(df: DataFrame, mode: str):
    for field in df.schema:
        if isinstance(field.dataType, StringType):
            column = F.col(field.name)
            error = F.raise_error(F.lit(f"line break in column {field.name}: CSV can't hold it"))
            df = df.withColumn(field.name, F.when(column.rlike(r"[\r\n]"), error).otherwise(column))
    # Without these two options the writer would trim blanks off names.
    return df.write.mode(mode).options(ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")


def write_state_csv(state: DataFrame, path: str) -> None:
    """Headerless CSV, in place of what was there. ``path`` must not be an input of ``state``."""
    _csv(state, "overwrite").csv(path)


def write_features_csv(features: DataFrame, path: str) -> None:
    """Headerless CSV into a new path; fails if it exists."""
    _csv(features, "errorifexists").csv(path)
