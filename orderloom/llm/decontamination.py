"""Find benchmark passages in documents by a prefix-filtered set join. Built-in functions only.

An item's windows (13 consecutive words, or the whole of a shorter item) are sets of word shingles. A window occurs whole
or not at all, so the necessary prefix of its shingles, ordered by rarity in the documents, is the rarest alone. The
document positions that hold a shingle of any item are found first, and counted; then only the rarest shingle of each
window is joined with them, positions at which the window would not fit are left out, and the words are compared.

Shingles are hashed from words with A-Z lower-cased, and so is the final comparison made, which is exact: ``lower`` would
fold a capital sigma by what stands around it, beyond separators too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import public_id, row_key, set_aside, sized_for, stored, stored_with

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # of texts before lower-casing; the words keep A-Z
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 13
SHINGLE = 4
MOST_SENT = 1 << 20  # shingles that are broadcast at most, some 30 MB in a task's memory


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN_WORDS), "")


def _shingle(hashes: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *(F.get(hashes, at + j) for j in range(size)))


def _every_shingle(hashes: str, size: int) -> Column:
    return F.transform(hashes, lambda _, i: _shingle(F.col(hashes), i, size))


def _windows(items: DataFrame) -> DataFrame:
    """``item_id``, ``window`` (its words joined by a blank), ``n`` words and ``shingles`` (offset, shingle)."""
    words = items.select("item_id", _words(F.translate("text", UPPER, LOWER)).alias("words")).where("size(words) > 0")
    sized = words.select("item_id", "words", F.least(F.size("words"), F.lit(WINDOW)).alias("n"))
    starts = sized.select("item_id", "words", "n", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("n") + 1)).alias("s"))
    cut = starts.select("item_id", "n", F.slice("words", F.col("s"), F.col("n")).alias("words"))
    return cut.select("item_id", "n", F.array_join("words", " ").alias("window"), "words").distinct()


def _shingled(windows: DataFrame) -> DataFrame:
    """``window``, ``n``, ``size``, ``offset`` and ``shingle``: every shingle of every different window."""
    different = windows.select("window", "n", "words").distinct()
    hashed = different.select(
        "window", "n", F.least("n", F.lit(SHINGLE)).alias("size"), F.transform("words", lambda w: F.xxhash64(w)).alias("h")
    )
    rows = hashed.select("window", "n", "size", "h", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("size"))).alias("offset"))
    shingle = F.lit(None).cast("long")
    for size in range(1, SHINGLE + 1):
        shingle = F.when(F.col("size") == size, _shingle(F.col("h"), F.col("offset"), size)).otherwise(shingle)
    return rows.select("window", "n", "size", "offset", shingle.alias("shingle"))


def _spots(docs: DataFrame, shingled: DataFrame) -> DataFrame:
    """Document positions that hold a shingle of the benchmark, with the words around them.

    Up to MOST_SENT shingles are sent to all tasks, and the words stay where they are. Beyond that positions and shingles
    are shuffled, without words, which are joined with the positions found.
    """
    shingles, seen = stored_with(shingled.select("shingle").distinct(), "benchmark", n=F.count(F.lit(1)))
    sizes = sorted(row["size"] for row in shingled.select("size").distinct().collect())  # SHINGLE rows at most
    reach = WINDOW - 1
    worded = docs.select(*row_key(), _words(F.translate("text", UPPER, LOWER)).alias("words"))
    hashed = worded.select("doc_id", "text_hash", "words", F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    # A list of shingles for each size, one behind the other, all as long as the text. Not filtered before it is exploded:
    # that would be pushed down, and the words cut twice.
    every = F.concat(*(_every_shingle("h", size) for size in sizes or [SHINGLE]))
    listed = hashed.select("doc_id", "text_hash", "words", F.size("words").alias("n_words"), every.alias("every"))
    places = listed.select(
        "doc_id", "text_hash", "words", "n_words", F.posexplode_outer("every").alias("place", "shingle")
    )
    if seen["n"] <= MOST_SENT:
        spots = places.join(F.broadcast(shingles), "shingle", "left_semi")
    else:
        slim = places.select("doc_id", "text_hash", "place", "shingle").join(shingles, "shingle", "left_semi")
        texts = worded.select("doc_id", "text_hash", "words", F.size("words").alias("n_words"))
        spots = stored(slim.distinct(), "positions").join(texts, ["doc_id", "text_hash"])
    position = F.col("place") % F.col("n_words")
    first = F.greatest(position - reach, F.lit(0))
    return spots.select(
        "doc_id",
        "text_hash",
        position.alias("position"),
        "shingle",
        "n_words",
        first.alias("first"),
        F.slice("words", first + 1, F.lit(2 * reach + 1)).alias("around"),
    )


def window_hits(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Occurrences (``doc_id``, ``text_hash``, ``start``, ``n``, ``window``), and the windows of each item."""
    sized_for(docs)
    windows = stored(_windows(items), "windows")
    shingled = stored(_shingled(windows), "shingles")
    spots = stored(_spots(docs, shingled), "spots")
    rarity = spots.groupBy("shingle").agg(F.count(F.lit(1)).alias("n_spots"))
    # A shingle without a spot is the rarest, and its window occurs nowhere.
    rarest = (
        shingled.join(rarity, "shingle", "left")
        .groupBy("window", "n")
        .agg(F.min(F.struct(F.coalesce("n_spots", F.lit(0)).alias("n_spots"), "offset", "shingle")).alias("prefix"))
        .where("prefix.n_spots > 0")
        .select("window", "n", "prefix.offset", "prefix.shingle")
    )
    start = F.col("position") - F.col("offset")
    same = F.array_join(F.slice("around", F.col("start") - F.col("first") + 1, F.col("n")), " ")
    hits = (
        spots.join(rarest, "shingle")
        .withColumn("start", start)
        .where("start >= 0 and start + n <= n_words")
        .where(same == F.col("window"))
        .select("doc_id", "text_hash", "start", "n", "window")
        .distinct()
    )
    return stored(hits, "hits"), windows.select("item_id", "window")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: key, ``n_words``, ``n_hit``, ``n_items``, ``items`` (ids as strings, sorted) and ``contaminated``.

    A document is contaminated if words of it are hit, and these are a twentieth of its words or more. Null and empty
    texts have no words; items without words have no window; items with a null id hit words, but are not counted.
    """
    hits, windows = window_hits(docs, items)
    covered = F.flatten(F.transform("spans", lambda x: F.sequence(x["start"], x["start"] + x["n"] - 1)))
    hit_words = (
        hits.groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("start", "n")).alias("spans"))
        .select("doc_id", "text_hash", F.size(F.array_distinct(covered)).cast("long").alias("hit"))
    )
    found_items = (
        hits.select("doc_id", "text_hash", "window")
        .distinct()
        .join(windows.where("item_id is not null"), "window")
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("found_items"))
    )
    n_words = docs.select(*row_key(), F.size(_words(F.col("text"))).cast("long").alias("n_words"))
    n_hit = F.coalesce("hit", F.lit(0))
    return (
        n_words.join(hit_words, ["doc_id", "text_hash"], "left")
        .join(found_items, ["doc_id", "text_hash"], "left")
        .select(
            "doc_id",
            "text_hash",
            "n_words",
            n_hit.cast("long").alias("n_hit"),
            F.coalesce("found_items", F.array().cast("array<string>")).alias("items"),
            ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )


def contamination_digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``."""
    return contamination(docs, items).select(
        public_id().alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated."""
    docs, back = set_aside(docs, "_gone_id", "_gone_hash")
    found = contamination(docs, items).where("contaminated").select(
        F.col("doc_id").alias("_gone_id"), F.col("text_hash").alias("_gone_hash")
    )
    doc_id, text_hash = row_key()
    gone = (doc_id == F.col("_gone_id")) & (text_hash == F.col("_gone_hash"))
    return docs.join(found.distinct(), gone, "left_anti").withColumnsRenamed(back)
