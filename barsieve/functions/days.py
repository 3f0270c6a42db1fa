"""Date texts used in folder and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day folders of snapshot files, and the name of a day's bar archive.
DAY_FOLDER_PATTERN = "MMMMddyyyy"
DAY_FOLDER_REGEX = r"([A-Z][a-z]+\d{6})"
ARCHIVE_PREFIX = "cm"
ARCHIVE_SUFFIX = "bhav.csv.zip"


def day_folder(day: Column) -> Column:
    """Folder name of a day, such as August282023."""
    return F.date_format(day, DAY_FOLDER_PATTERN)


def month_text(day: Column) -> Column:
    """First three letters of the month, upper case."""
    return F.upper(F.date_format(day, "MMM"))


def archive_name(day: Column) -> Column:
    """File name of the day's bar archive."""
    return F.concat(
        F.lit(ARCHIVE_PREFIX),
        F.date_format(day, "dd"),
        month_text(day),
        F.date_format(day, "yyyy"),
        F.lit(ARCHIVE_SUFFIX),
    )


def archive_location(day: Column, base: str) -> Column:
    """Location of the day's bar archive below a base folder or address, by year and month."""
    return F.concat_ws("/", F.lit(base.rstrip("/")), F.date_format(day, "yyyy"), month_text(day), archive_name(day))


def day_in_path(path: Column) -> Column:
    """The trading day named by a folder of the path, or null."""
    text = F.regexp_extract(path, "/(?:[^/=]+=)?" + DAY_FOLDER_REGEX + "/", 1)
    return F.try_to_date(F.nullif(text, F.lit("")), DAY_FOLDER_PATTERN)


def file_in_path(path: Column) -> Column:
    """The last element of a path."""
    return F.substring_index(path, "/", -1)


def named_folder_in_path(path: Column, name: str) -> Column:
    """The value of the folder `<name>=<value>` of a path, or null."""
    return F.nullif(F.regexp_extract(path, f"/{name}=([^/]+)/", 1), F.lit(""))
