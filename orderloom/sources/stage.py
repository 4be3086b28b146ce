"""A stage: a folder that customers deliver files to."""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import storage
from orderloom.functions.lineage import relative_file_name


LEVELS = 4
LINEAGE = ["source_file_name", "file_path", "file_size", "file_modification_time"]


@dataclass(frozen=True)
class Stage:
    """``pattern`` is a glob on file names, for folders that hold several formats.

    ``delivery`` is a regular expression for stages whose delivered files are folders of part files, as Spark
    writes them: the matched part of the path is then the source file name.
    """

    root: str
    pattern: str = "*"
    delivery: str | None = None

    def location(self, spark: SparkSession, prefix: str | None = None) -> str | None:
        """Path to read: the whole stage, or what starts with the prefix. None if nothing does.

        Spark passes over files whose names begin with ``_`` or ``.``. A stage that holds a delivered file of such a name
        is refused, to LEVELS levels of folders.
        """
        hidden = storage.hidden_files(spark, self.root, self.pattern, LEVELS)
        if hidden:
            raise ValueError(f"files that would be passed over in {self.root}: {', '.join(hidden)}")
        if not prefix:
            return self.root
        path = f"{self.root.rstrip('/')}/{prefix}" + ("" if prefix.endswith("/") else "*")
        return path if storage.glob_matches(spark, path) else None

    @staticmethod
    def readable(paths: list[str]) -> list[str]:
        """File URIs, as ``_metadata.file_path`` has them, as paths to read: decoded, and not taken for patterns."""
        return [re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(path)) for path in paths]

    def options(self) -> dict[str, str]:
        """Reader options: every level of the folder, and no columns made up from folder names."""
        return {"recursiveFileLookup": "true", "pathGlobFilter": self.pattern}

    def source_file_name(self, spark: SparkSession, file_path: Column | None = None) -> Column:
        path = F.col("_metadata.file_path") if file_path is None else file_path
        return relative_file_name(path, storage.encoded_path(spark, self.root), self.delivery, storage.origins(spark, self.root))

    def lineage(self, spark: SparkSession) -> list[Column]:
        return [
            self.source_file_name(spark).alias("source_file_name"),
            *(F.col(f"_metadata.{name}").alias(name) for name in LINEAGE[1:]),
        ]


def empty_scan(spark: SparkSession, columns: str) -> DataFrame:
    return spark.createDataFrame(
        [], f"{columns}, source_file_name string, file_path string, file_size long, file_modification_time timestamp"
    )
