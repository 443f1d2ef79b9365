"""Small helpers: frames from literals, rows of a frame, and replay one change at a time."""

import datetime as dt

from tidewell.schemas import USERS_DDL

LOG_DDL = f"seq BIGINT, action STRING, {USERS_DDL}"


def day(text):
    return None if text is None else dt.date.fromisoformat(text)


def base_frame(spark, rows):
    return spark.createDataFrame([tuple(row) for row in rows], USERS_DDL)


def log_frame(spark, changes):
    """``changes`` are (action, user_id, name, city, last_login), numbered in their order."""
    return spark.createDataFrame([(i, *change) for i, change in enumerate(changes)], LOG_DDL)


def in_order(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def fold(rows, changes):
    """The expected state: apply each change in turn to a list of rows."""
    state = list(rows)
    for action, key, *image in changes:
        if key is None:
            continue
        if action == "I":
            state.append((key, *image))
        elif action == "U":
            state = [(key, *image) if row[0] == key else row for row in state]
        elif action == "D":
            state = [row for row in state if row[0] != key]
    return sorted(state, key=repr)


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
