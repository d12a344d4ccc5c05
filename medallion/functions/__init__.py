from medallion.functions.casting import soft_cast
from medallion.functions.cleaning import (
    DATE_FORMAT,
    anonymised,
    capitalised,
    clean_users,
    file_of_row,
    label_for,
    parsed_time,
)

__all__ = [
    "DATE_FORMAT",
    "anonymised",
    "capitalised",
    "clean_users",
    "file_of_row",
    "label_for",
    "parsed_time",
    "soft_cast",
]
