"""File names relative to their stage."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def relative_file_name(file_path: Column, root: str, delivery: str | None = None, origins: Iterable[str] = ()) -> Column:
    """Path below the stage root, decoded.

    Files come as ``_metadata.file_path``, an encoded URI in which only ``+`` is left as it is; the root is the encoded
    path of the stage. Scheme and host are cut off, as they are spelt in more than one way. ``delivery`` is a pattern
    for stages where one delivered file is a folder of part files; its match is the name then.

    This is worked out for each row of a scan, so what most paths don't need is left out for them: with ``origins``, the
    usual spellings of scheme and host, what a path begins with is cut off by searching bytes, as substrings count
    characters, and only names with a ``%`` are decoded.
    """
    folder = root.rstrip("/") + "/"
    path = F.regexp_replace(file_path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    below = F.substring(path, len(folder) + 1, 1 << 30)
    for origin in origins:
        begin = F.lit(origin + folder)
        usual = F.replace(file_path, begin, F.lit(""))
        once = F.octet_length(usual) + F.octet_length(begin) == F.octet_length(file_path)
        below = F.when(F.startswith(file_path, begin) & once, usual).otherwise(below)
    decoded = F.url_decode(F.replace(below, F.lit("+"), F.lit("%2B")))
    name = F.when(F.contains(below, F.lit("%")), decoded).otherwise(below)
    return name if delivery is None else F.regexp_extract(name, delivery, 0)


def relative_file_name_sql(file_path: str, root: str, delivery: str | None = None) -> str:
    """The same as SQL, for views."""
    below = f"substring(regexp_replace({file_path}, '^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?', ''), {len(root.rstrip('/')) + 2})"
    name = f"url_decode(replace({below}, '+', '%2B'))"
    return name if delivery is None else f"regexp_extract({name}, r'{delivery}', 0)"
