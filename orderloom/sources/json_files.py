"""JSON document scan into a variant column, or into a known struct."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.schema import DOCUMENT, FILE_FIELDS, ORDERS, with_fields
from orderloom.sources.json_cut import cut_documents
from orderloom.sources.stage import LINEAGE, Stage, empty_scan

DOCUMENT_PER_FILE = "document"
DOCUMENT_PER_LINE = "lines"
DOCUMENT_CUT = "cut"  # a document per file, cut into one for each of its orders' days


def scan_json(
    spark: SparkSession,
    stage: Stage,
    layout: str = DOCUMENT_PER_FILE,
    prefix: str | None = None,
    streaming: bool = False,
    paths: list[str] | None = None,
    **extra: str,
) -> DataFrame:
    """One variant row ``customer_orders`` per document; malformed text aborts.

    A file holding one document is read whole by one task, which a variant's size limit bounds. Large deliveries
    should be written one document per line, as such files are split, or be read with ``DOCUMENT_CUT``, which gives a
    document for each delivery day, that flatten to the same rows (batches only). ``paths``, file URIs, read only some of
    the stage's files.
    """
    if layout not in (DOCUMENT_PER_FILE, DOCUMENT_PER_LINE, DOCUMENT_CUT):
        raise ValueError(f"unknown layout {layout!r}")
    if streaming and layout == DOCUMENT_CUT:
        raise ValueError("a stream does not cut documents")
    location = stage.location(spark, prefix) if paths is None else stage.readable(paths)
    if not location:
        return empty_scan(spark, "customer_orders variant")
    if layout == DOCUMENT_CUT:
        text, lineage = cut_documents(spark, stage, location), LINEAGE
    else:
        reader = spark.readStream if streaming else spark.read
        whole = str(layout == DOCUMENT_PER_FILE).lower()
        text = reader.format("text").options(**stage.options(), wholetext=whole, **extra).load(location)
        lineage = stage.lineage(spark)
    # The parser stops after the first value, so what follows would be lost unseen. The text is parsed as one of two
    # fields, the other being the text's hash, which no text can hold itself: if the text ends its value early, the object
    # has no such field, or other fields.
    parsed = text.filter(F.col("value").rlike(r"\S")).select(
        F.parse_json(
            F.concat(F.lit('{"document":'), "value", F.lit(',"end":"'), F.sha2("value", 256), F.lit('"}'))
        ).alias("framed"),
        F.sha2("value", 256).alias("end"),
        *lineage,
    )
    fields = F.map_keys(F.variant_get(F.col("framed"), "$", "map<string,variant>"))
    whole_text = (F.size(fields) == 2) & F.try_variant_get(F.col("framed"), "$.end", "string").eqNullSafe(F.col("end"))
    document = F.when(whole_text, F.variant_get(F.col("framed"), "$.document", "variant")).otherwise(
        F.raise_error(F.concat(F.lit("more than one document in "), "file_path")).cast("variant")
    )
    return parsed.select(document.alias("customer_orders"), *LINEAGE)


def scan_json_typed(
    spark: SparkSession, stage: Stage, layout: str = DOCUMENT_PER_FILE, prefix: str | None = None
) -> DataFrame:
    """The same documents read into the known struct: no variant, and unread fields are never parsed."""
    location = stage.location(spark, prefix)
    if location is None:
        return spark.createDataFrame([], with_fields(DOCUMENT, ORDERS["source_file_name"], *FILE_FIELDS))
    whole = layout == DOCUMENT_PER_FILE
    rows = spark.read.schema(DOCUMENT).options(**stage.options(), mode="FAILFAST", multiLine=whole, dateFormat="yyyy-MM-dd").json(location)
    return rows.select(*DOCUMENT.fieldNames(), *stage.lineage(spark))
