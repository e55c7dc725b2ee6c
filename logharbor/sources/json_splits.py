"""JSON objects that are larger than a task should read: arrays of records split at byte ranges.

The text source cuts a file at every closing brace, and reads byte ranges of it in many tasks. What a
piece means depends on what comes before it: whether it begins inside a string, and how deep. Both are
running sums over the pieces of a file, quotation marks first and brackets outside strings after that, so
they are taken slice by slice (functions.blocks). A record of the array ends where the depth is back at one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logharbor.functions.blocks import AT, Blocks
from logharbor.functions.variants import parse_strict
from logharbor.session import cut_lineage
from logharbor.sources.json_logs import explode_json_objects
from logharbor.sources.lines import file_options, read_lines, read_objects

#: Files from this size on are read in pieces; the whole text of smaller ones is one row.
LARGE = 32 << 20


def read_pieces(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """Pieces of uncompressed files: path, block and row (their order), piece, closed (a brace followed).

    The brace itself is left out of the piece. Whether one ends the file shows in the file's size.
    """
    raw = spark.read.options(lineSep="}", **file_options(glob, None)).text(folder)
    meta = F.col("_metadata")
    pieces = raw.select(
        meta["file_path"].alias("path"),
        meta["file_size"].alias("size"),
        meta["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.octet_length("value").cast("bigint").alias("bytes"),
        F.make_valid_utf8("value").alias("piece"),
    )
    return cut_lineage(pieces)


def _count(text: Column, kind: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{kind}]", "")).cast("bigint")


def _outside_strings(piece: Column, inside: Column) -> Column:
    """The piece without the strings in it; escapes are gone already."""
    rest = F.when(inside, F.regexp_replace(piece, r'(?s)^[^"]*("|$)', "")).otherwise(piece)
    return F.regexp_replace(rest, r'(?s)"[^"]*("|$)', "")


def array_records(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Elements of the files that are arrays (path, record), and the paths of all others, which are not JSON arrays.

    A file is an array if it begins with a bracket, every element is JSON, elements are parted by single
    commas, and nothing follows the end. Records may be of any kind; those between two objects are parsed
    with the second.
    """
    sizes = pieces.groupBy("path").agg(
        F.max("size").alias("size"), (F.sum("bytes") + F.count(F.lit(1))).alias("read"), F.max(F.struct("block", "row")).alias("end")
    )
    # a file that does not end in a brace is one byte shorter than its pieces with a brace each
    ends = sizes.select("path", "end", (F.col("read") <= F.col("size")).alias("braced"))
    placed = pieces.join(ends, "path")
    last = (F.col("block") == F.col("end.block")) & (F.col("row") == F.col("end.row"))
    placed = placed.withColumns({"last": last, "closed": ~last | F.col("braced")}).drop("end", "braced", "size", "bytes")
    bare = F.regexp_replace("piece", r"(?s)\\.", "")
    blocks = Blocks(cut_lineage(placed.withColumns({"bare": bare, "quotes": _count(bare, '"')})), ["path"], ["block", "row"])

    df = blocks.carried(blocks.df, {"_s": F.sum("quotes")}, {"_b": F.coalesce(F.sum("_s").over(blocks.earlier), F.lit(0))})
    after = F.sum("quotes").over(blocks.running) + F.col("_b")
    df = df.withColumn("inside", (after - F.col("quotes")) % 2 == 1).withColumn("open", after % 2 == 1)
    outside = _outside_strings(F.col("bare"), F.col("inside"))
    closing = F.when(F.col("closed") & ~F.col("open"), 1).otherwise(0)
    df = df.withColumn("turn", _count(outside, r"\[{") - _count(outside, r"\]}") - closing)
    df = cut_lineage(df.select(AT, "path", "block", "row", "piece", "last", "closed", "open", "turn"))

    df = blocks.carried(df, {"_s": F.sum("turn")}, {"_b": F.coalesce(F.sum("_s").over(blocks.earlier), F.lit(0))})
    df = df.withColumn("depth", F.sum("turn").over(blocks.running) + F.col("_b"))
    ends_record = F.col("closed") & ~F.col("open") & (F.col("depth") == 1)
    df = df.withColumn("ends", ends_record.cast("int"))
    df = cut_lineage(df.select(AT, "path", "block", "row", "piece", "last", "closed", "depth", "ends"))

    df = blocks.carried(df, {"_s": F.sum("ends")}, {"_b": F.coalesce(F.sum("_s").over(blocks.earlier), F.lit(0))})
    df = df.withColumn("nth", F.sum("ends").over(blocks.running) + F.col("_b") - F.col("ends"))
    piece = F.struct("block", "row", F.concat("piece", F.when(F.col("closed"), "}").otherwise("")).alias("text"))
    chunks = df.groupBy("path", "nth").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["text"]), "").alias("text"),
        F.max("last").alias("last"),
        F.count_if((F.col("depth") <= 0) & ~F.col("last")).alias("early"),
        F.max(F.when(F.col("last"), F.col("depth"))).alias("depth"),
    )
    space = r"[ \t\r\n]*"
    begun = F.when(F.col("nth") == 0, rf"(?s)^{space}\[").otherwise(rf"(?s)^{space},")
    ended = F.col("last") & F.col("text").rlike(rf"(?s)\]{space}$")
    body = F.when(ended, F.regexp_replace("text", rf"(?s)\]{space}$", "")).otherwise(F.col("text"))
    nothing = F.col("last") & (F.col("nth") > 0) & F.trim(F.translate(body, "\t\r\n", "   ")).eqNullSafe("")
    inner = F.regexp_replace(body, begun, "")
    blank = F.trim(F.translate(inner, "\t\r\n", "   ")) == ""
    array = F.when(nothing, F.lit("[]")).otherwise(F.concat(F.lit("["), inner, F.lit("]")))
    right = nothing | (F.regexp_like(body, begun) & ~(blank & (F.col("nth") > 0)))
    right = right & (F.col("early") == 0) & F.when(F.col("last"), ended & (F.col("depth") == 0)).otherwise(F.lit(True))
    parsed = chunks.select("path", right.alias("right"), F.try_variant_get(parse_strict(array), "$", "array<variant>").alias("records"))
    parsed = cut_lineage(parsed)
    wrong = parsed.where(~F.col("right") | F.col("records").isNull()).select("path").distinct()
    records = parsed.join(wrong, "path", "left_anti").select("path", F.explode("records").alias("record"))
    return records, wrong


def read_json_objects(spark: SparkSession, folder: str, glob: str | None = None, large: int = LARGE) -> DataFrame:
    """Records (`path`, `record`) of a folder of JSON objects of any size: arrays, single values, a value per line.

    Objects under `large` bytes, and compressed ones, which cannot be split, are parsed whole. Larger
    arrays are read in pieces by many tasks, and so are larger objects with a value per line, whose lines
    that do not parse are skipped.
    """
    size = F.col("size") < large
    packed = F.col("path").rlike(r"\.(gz|bz2|zst|lz4|snappy|deflate)$")
    whole = explode_json_objects(read_objects(spark, folder, glob).where(size | packed)).select("path", "record")
    pieces = read_pieces(spark, folder, glob).where(~size & ~packed)
    records, others = array_records(pieces)
    lines = read_lines(spark, folder, glob).where(~size & ~packed).join(others, "path", "left_semi")
    by_line = lines.select("path", parse_strict(F.col("line")).alias("record")).where(F.col("record").isNotNull())
    return whole.unionByName(records).unionByName(by_line)
