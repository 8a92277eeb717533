"""Image references as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prefixes of references that are not local, and decodable extensions.
REMOTE = ("http://", "https://", "data:", "mailto:", "ftp://", "ftps://", "/", "#")
EXTENSIONS = ("png", "jpg", "jpeg", "webp", "gif", "bmp", "tif", "tiff")

_REMOTE = "^(" + "|".join(REMOTE) + ")"
_TITLED = r"^(\S.*?)\s+[\"']([^\"']*)[\"']$"


def without_title(dest: Column) -> Column:
    """A destination without its trailing quoted title."""
    titled = F.regexp_extract(dest, _TITLED, 1)
    return F.btrim(F.when(titled == "", dest).otherwise(titled), F.lit(" \t\n\r\u000b\u000c"))


def in_scope(ref: Column) -> Column:
    """Whether a reference is relative and local."""
    return (ref != "") & ~ref.rlike(_REMOTE) & ~ref.rlike(r"\{\{.*?\}\}")


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"[^/]\.([^./]*)$", 1))


def supported(path: Column) -> Column:
    return extension(path).isin(*EXTENSIONS)


def resolved(directory: Column, ref: Column) -> Column:
    """The path of a relative reference, its ``.`` and ``..`` steps taken (an array fold; never above the root)."""
    steps = F.filter(F.split(F.concat_ws("/", F.nullif(directory, F.lit("")), ref), "/"), lambda s: (s != "") & (s != "."))
    none = F.array().cast("array<string>")
    taken = F.aggregate(steps, none, lambda own, s: F.when(s == "..", F.slice(own, F.lit(1), F.greatest(F.size(own) - 1, F.lit(0)))).otherwise(F.concat(own, F.array(s))))
    return F.array_join(taken, "/")
