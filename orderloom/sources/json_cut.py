"""A JSON document cut at the elements of an array, so that one large document is read by many tasks.

Spark's text reader splits files at ``}``, which valid JSON has at the end of every object. What a fragment does to the
state of the reading (inside a string or not, depth of brackets) is known for both states that it may begin in. These
changes are added up within each block of a file, then over the few blocks of the file, which tells where the array's
elements end. Each element then becomes a document of its own, with all that stands around the array, and is parsed.
Rows have no more than the path of their file on the way; its name, size and time join them at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom import storage
from orderloom.session import at_most, configured, partitions_for, scratch, stored, stored_at
from orderloom.sources.stage import LINEAGE, Stage

# Text without brackets but for those in strings, which are whole.
BARE = r'[^"{}\[\]]*+(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"[^"{}\[\]]*+)*+'
BLOCK = ["file_path", "block"]
# Text per block, and shuffled bytes per task: a fragment is a row with its lineage, ten times its text, and is sorted.
BLOCK_BYTES = 4 << 20
ELEMENT_DEPTH = 2  # brackets around an element: the document's and the array's


def _count(text: Column, sign: str) -> Column:
    # By replacement, which searches bytes; translate looks up each character.
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(sign), F.lit("")))


def _net(text: Column) -> Column:
    """Brackets opened less brackets closed."""
    opened, closed = (sum(_count(text, bracket) for bracket in brackets) for brackets in ("[{", "]}"))
    return opened - closed


def _sum_before(value: Column, window) -> Column:
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _fragments(text: DataFrame) -> DataFrame:
    """Per fragment: ``quotes`` (odd or not) and its changes of depth, its ``}`` included, if it begins outside of a string
    (``outside``) or within one (``inside``)."""
    # A backslash can't stand before a fragment's end: it would escape the bracket, which JSON does not allow.
    escapes = F.contains("value", F.lit("\\"))
    plain = text.withColumn("plain", F.when(escapes, F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value")))
    quoted = r'"[^"]*+(?:"|\z)'
    counted = plain.select(
        *text.columns,
        (_count(F.col("plain"), '"') % 2).alias("quotes"),
        _net(F.regexp_replace("plain", quoted, "")).alias("outside"),
        _net(F.regexp_replace(F.concat(F.lit('"'), "plain"), quoted, "")).alias("inside"),
    )
    return counted.withColumns(
        {
            "outside": F.col("outside") - F.when(F.col("quotes") == 0, 1).otherwise(0),
            "inside": F.col("inside") - F.when(F.col("quotes") == 1, 1).otherwise(0),
        }
    )


def _blocks(fragments: DataFrame) -> DataFrame:
    """``enter`` (whether a block begins in a string) and ``start`` (depth before it). Only numbers are shuffled."""
    in_block = Window.partitionBy(*BLOCK).orderBy("id")
    numbers = fragments.select(*BLOCK, "id", "quotes", "outside", "inside")
    opened = numbers.withColumn("open", _sum_before(F.col("quotes"), in_block) % 2)
    # For a block that begins outside (0) or inside (1) a string.
    steps = {
        "step0": F.when(F.col("open") == 0, F.col("outside")).otherwise(F.col("inside")),
        "step1": F.when(F.col("open") == 0, F.col("inside")).otherwise(F.col("outside")),
    }
    sums = opened.groupBy(*BLOCK).agg(
        (F.sum("quotes") % 2).alias("quotes"), *(F.sum(step).alias(name) for name, step in steps.items())
    )
    of_file = Window.partitionBy("file_path").orderBy("block")  # a row for each block
    entered = sums.withColumn("enter", _sum_before(F.col("quotes"), of_file) % 2)
    entered = entered.withColumn("step", F.when(F.col("enter") == 0, F.col("step0")).otherwise(F.col("step1")))
    return entered.select(*BLOCK, "enter", _sum_before(F.col("step"), of_file).alias("start"))


def _pieces(fragments: DataFrame, blocks: DataFrame) -> DataFrame:
    """What a block has of each element (or of what is behind the elements): ``inner`` (number in the block), ``text`` (NULL
    if there is nothing), ``depth`` before it, ``end`` (depth behind it), ``closes`` (whether the element ends here), and the
    ``octets`` and ``blanks`` of its fragments. The text is shuffled once, by block."""
    in_block = Window.partitionBy(*BLOCK).orderBy("id")
    rows = fragments.join(blocks, BLOCK).withColumn(
        "in_string", (F.col("enter") + _sum_before(F.col("quotes"), in_block)) % 2
    )
    step = F.when(F.col("in_string") == 0, F.col("outside")).otherwise(F.col("inside"))
    rows = rows.withColumn("step", step).withColumn("depth", F.col("start") + _sum_before(F.col("step"), in_block))
    blank = (F.col("in_string") == 0) & (F.col("depth") == 0) & F.col("value").rlike(r"^\s*+\z")  # nothing, behind the document
    in_string_after = (F.col("in_string") + F.col("quotes")) % 2
    end = F.col("depth") + F.col("step")
    rows = rows.withColumns({"end": end, "blank": blank})
    # An element or the document ends, or it is neither.
    closes = ~F.col("blank") & (in_string_after == 0) & (F.col("end") <= ELEMENT_DEPTH)
    rows = rows.withColumn("closes", closes.cast("int"))
    part = F.when(~F.col("blank"), F.struct("id", "value", "depth", "end"))
    pieces = (
        rows.withColumn("inner", _sum_before(F.col("closes"), in_block))
        .groupBy(*BLOCK, "inner")
        .agg(
            F.sort_array(F.collect_list(part)).alias("parts"),  # the fragments of one element
            F.sum("closes").alias("closes"),
            F.sum(F.octet_length("value") + 1).alias("octets"),
            F.count_if("blank").alias("blanks"),
        )
    )
    return pieces.select(
        *BLOCK,
        "inner",
        F.when(F.size("parts") > 0, F.array_join("parts.value", "}")).alias("text"),
        F.get("parts", F.lit(0))["depth"].alias("depth"),
        F.get("parts", F.size("parts") - 1)["end"].alias("end"),
        "closes",
        "octets",
        "blanks",
    )


def _units(pieces: DataFrame) -> DataFrame:
    """``unit`` (number in the file), ``text``, ``depth`` and ``end`` of what lies between two closing fragments. Only the
    first and the last piece of a block can belong to a longer one, so that no others are shuffled."""
    counts = pieces.groupBy(*BLOCK).agg(F.sum("closes").alias("all_closes"))
    of_file = Window.partitionBy("file_path").orderBy("block")
    offsets = stored(counts.select(*BLOCK, "all_closes", _sum_before(F.col("all_closes"), of_file).alias("offset")), "units")
    numbered = (
        pieces.where(F.col("text").isNotNull())
        .join(offsets, BLOCK)
        .withColumn("unit", F.col("offset") + F.col("inner"))
        .withColumn("edge", (F.col("inner") == 0) | (F.col("inner") == F.col("all_closes")))
    )
    part = F.struct("block", "text", "depth", "end")
    joined = numbered.where("edge").groupBy("file_path", "unit").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    columns = ["file_path", "unit", "text", "depth", "end"]
    units = numbered.where("not edge").select(*columns).unionByName(
        joined.select(
            "file_path",
            "unit",
            F.array_join("parts.text", "}").alias("text"),
            F.get("parts", F.lit(0))["depth"].alias("depth"),
            F.element_at("parts", -1)["end"].alias("end"),
        )
    )
    return units.withColumn("text", F.concat("text", F.lit("}")))


def cut_documents(spark: SparkSession, stage: Stage, location: str | list[str], array: str = "Orders") -> DataFrame:
    """Text ``value`` of one document for each element of the array of a file's document, or the document as it is if it
    has no objects in it; and the file's lineage.

    Elements are objects, and the document's other fields scalars; anything else aborts, as do cut-off files and text
    behind the document. A block of a file (BLOCK_BYTES) and an element are each one task's.
    """
    text = spark.read.format("text").options(**stage.options(), lineSep="}").load(location)
    with configured(
        spark,
        files_maxPartitionBytes=at_most(spark, BLOCK_BYTES),
        shuffle_partitions=str(partitions_for(spark, text, each=BLOCK_BYTES)),
        adaptive_advisoryPartitionSizeInBytes=str(BLOCK_BYTES),
    ):
        return _cut(spark, stage, text, array)


def _cut(spark: SparkSession, stage: Stage, text: DataFrame, array: str) -> DataFrame:
    # Stored, as the ids are those of one reading.
    path = scratch(spark, "fragments")
    fragments = stored_at(
        _fragments(
            text.select(
                "value",
                F.monotonically_increasing_id().alias("id"),
                F.col("_metadata.file_block_start").alias("block"),
                *stage.lineage(spark),
            )
        ),
        path,
    )
    # A file has one name, size and time.
    files = stored(fragments.groupBy("file_path").agg(*(F.max(c).alias(c) for c in LINEAGE if c != "file_path")), "files")
    blocks = stored(_blocks(fragments), "blocks")
    pieces = stored(_pieces(fragments.drop(*(c for c in LINEAGE if c != "file_path")), blocks), "pieces")
    storage.delete(spark, path)
    units = _units(pieces)
    first, last = F.col("unit") == 0, F.col("end") == 0
    header = rf'(?s)^(\s*+\{{{BARE}\[\s*+)(\{{.*+)\z'
    # A file that does not end with a bracket has as many bytes as if it did, less one, and a blank end.
    sizes = pieces.groupBy("file_path").agg(F.sum("octets").alias("octets"), F.sum("blanks").alias("blanks"))
    files = files.join(sizes, "file_path").withColumn("beyond", F.col("octets") - F.col("file_size"))
    around = units.groupBy("file_path").agg(
        F.max(F.when(first & ~last, F.regexp_extract("text", header, 1))).alias("head"),
        F.max(F.when(last & ~first, F.col("text"))).alias("tail"),
        F.count_if(last).alias("ends"),
    )
    named = rf'"\Q{array}\E"\s*+:\s*+\[\s*+\z'
    sound = (
        (F.col("beyond") == F.col("blanks"))
        & (F.col("ends") == 1)
        & (F.col("head").isNull() | F.col("head").rlike(named))
        & (F.col("tail").isNull() | F.col("tail").rlike(rf"(?s)^\s*+\]{BARE}\}}\z"))
    )
    frames = stored(around.join(files, "file_path").select(*LINEAGE, "head", "tail", sound.alias("sound")), "frames")
    element = (
        F.when(first, F.regexp_extract("text", header, 2))
        .when(F.col("depth") == ELEMENT_DEPTH, F.regexp_extract("text", r"(?s)^\s*+,\s*+(\{.*+)\z", 1))
        .otherwise(F.lit(""))
    )
    # The tail is part of the others. It is blank before it is dropped, as filters may be taken in any order.
    tail = F.col("sound") & last & ~first
    value = F.when(tail, F.lit("")).when(first & last, F.col("text")).otherwise(F.concat("head", "element", "tail"))
    refused = F.raise_error(F.concat(F.lit("cannot be cut into documents: "), "file_path")).cast("string")
    fits = F.col("sound") & (last | (F.col("element") != ""))
    return (
        units.withColumn("element", element)
        .join(frames, "file_path")
        .where(~tail)
        .select(F.when(fits, value).otherwise(refused).alias("value"), *LINEAGE)
    )
