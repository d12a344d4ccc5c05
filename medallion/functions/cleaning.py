"""Column expressions of the silver layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions.casting import soft_cast

RESCUED = "_rescued_data"

# The text format of dates in the raw files.
DATE_FORMAT = "MM-dd-yyyy HH:mm:ss"


def anonymised(column: str) -> Column:
    """40 hex digits that stand for the text; NULL stays NULL."""
    return F.sha1(F.col(column))


def capitalised(column: str) -> Column:
    return F.initcap(F.col(column))


def parsed_time(column: str, pattern: str = DATE_FORMAT) -> Column:
    """A timestamp, NULL where the text does not match ``pattern``."""
    return F.try_to_timestamp(F.col(column), F.lit(pattern))


def label_for(code: Column, labels: dict[str, str], prefix: str = "cluster_") -> Column:
    """Look up ``prefix`` + ``code`` in ``labels``; NULL where there is no such label."""
    pairs = [F.lit(part) for pair in labels.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), F.concat(F.lit(prefix), code.cast("string")))


def file_of_row() -> Column:
    """Name of the file a row was scanned from."""
    return F.col("_metadata.file_name")


def clean_users(users: DataFrame, capitalise: bool, cast_id: bool, drop_rescued: bool = True) -> DataFrame:
    """Bronze users to silver, for batch and stream.

    ``capitalise`` and no ``cast_id`` is the notebook flow, the opposite is the
    declarative flow, which also lists its columns in an order of its own.
    """
    replaced = {
        "email": anonymised("email"),
        "creation_date": parsed_time("creation_date"),
        "last_activity_date": parsed_time("last_activity_date"),
    }
    if capitalise:
        replaced |= {name: capitalised(name) for name in ("firstname", "lastname")}
    if cast_id:
        replaced["id"] = soft_cast(F.col("id"), "int")
    cleaned = users.withColumns(replaced)
    return cleaned.drop(RESCUED) if drop_rescued else cleaned


# Column order of the declarative silver table.
DECLARATIVE_COLUMNS = [
    "id",
    "email",
    "creation_date",
    "last_activity_date",
    "firstname",
    "lastname",
    "address",
    "city",
    "last_ip",
    "postcode",
]


def clean_users_declared(users: DataFrame) -> DataFrame:
    return clean_users(users, capitalise=False, cast_id=True).select(*DECLARATIVE_COLUMNS)
