"""Column layouts of the snapshot and change files (headerless, positional)."""

from __future__ import annotations

USERS_DDL = "user_id INT, name STRING, city STRING, last_login DATE"

# Order of a change: the name its file was delivered under, then the file (its folder, its number if it is
# one part of many, its own name), then the block of the file, then the row within the block.
SEQ_DDL = "STRUCT<file: STRING, folder: STRING, part: DECIMAL(38,0), base: STRING, block: BIGINT, row: BIGINT>"
# What a file is known by: two files of one name in different folders are two files.
FILE_ID = ["folder", "base"]


def changes_ddl(ddl: str) -> str:
    """Layout of the changes of a table: the action, then the whole row."""
    return f"action STRING, {ddl}"
