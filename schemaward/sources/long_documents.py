"""JSON documents of any size, read in blocks: no task and no cell ever holds a whole document.

The text reader splits files at double quotes, so a token is a string, a part of one that holds escaped quotes, or what
stands between two strings. Whether a token is inside a string and how deep it stands follows from running sums inside
a block of the file plus one carried-over number per block; commas at depth one end the entries. Tokens are shuffled
once, by file and block, and once more to put each entry together. Blocks hold up to RUN tokens and tasks about
TASK_BYTES of text: a token becomes rows many times its size, of which the adaptive planner sees only what compresses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_BLANKS = " \t\r\n"
_MARKS = r"(?<=[\[\]{},])|(?=[\[\]{},])"  # both sides of every mark
_BLOCK = ["path", "start", "run"]
RUN = 1 << 16         # tokens of a block at most; the reader's splits may hold more
TASK_BYTES = 1 << 20  # text that a task is given


def _sums_before(counts: DataFrame, columns: list[str]) -> DataFrame:
    """(path, start, run, columns): the sums over all earlier blocks of the same file; one row per block."""
    earlier = Window.partitionBy("path").orderBy("start", "run").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*_BLOCK, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in columns])


def _carried(rows: DataFrame, **adds: Column) -> DataFrame:
    """``rows`` with the sum of each of ``adds`` over all earlier blocks of their file under its name."""
    sums = rows.groupBy(*_BLOCK).agg(*[F.sum(add).alias(name) for name, add in adds.items()])
    return rows.join(_sums_before(sums, list(adds)).hint("merge"), _BLOCK)


def _tasks(spark: SparkSession, path: str) -> int:
    """Tasks for the text of all documents; only the files' lengths are read."""
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))


def _parts(spark: SparkSession, path: str, tasks: int) -> DataFrame:
    """(path, start, run, seq, pos, part, inside, step, depth, cut, entry): the pieces of all documents and where they stand."""
    read = spark.read.text(path, lineSep='"').select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("seq"), "value").withColumn("run", F.floor(F.col("seq") / RUN)).repartition(tasks, *_BLOCK)
    in_block = Window.partitionBy(*_BLOCK).orderBy("seq")
    open_end = (F.length("value") - F.length(F.rtrim("value", F.lit("\\")))) % 2 == 1  # the quote behind it is escaped
    tokens = (read.withColumn("ends", F.when(open_end, 0).otherwise(1)).withColumn("nth", F.row_number().over(in_block))
              .withColumn("quotes", F.sum("ends").over(in_block) - F.col("ends")))
    tokens = _carried(tokens, quotes_before=F.col("ends"), tokens_before=F.lit(1))
    inside = (F.col("quotes") + F.col("quotes_before")) % 2 == 1
    first = (F.col("tokens_before") == 0) & (F.col("nth") == 1)
    text = F.when(first, F.col("value")).otherwise(F.concat(F.lit('"'), "value"))
    pieces = tokens.select(*_BLOCK, "seq", inside.alias("inside"), F.posexplode(F.when(inside, F.array(text)).otherwise(F.split(text, _MARKS))).alias("pos", "part"))
    step = F.when(F.col("inside"), 0).when(F.col("part").isin("[", "{"), 1).when(F.col("part").isin("]", "}"), -1).otherwise(0)
    in_order = Window.partitionBy(*_BLOCK).orderBy("seq", "pos").rowsBetween(Window.unboundedPreceding, 0)
    pieces = pieces.withColumn("step", step).withColumn("depth_here", F.sum("step").over(in_order))
    pieces = _carried(pieces, depth_before=F.col("step")).withColumn("depth", F.col("depth_here") + F.col("depth_before"))
    cut = ~F.col("inside") & (F.col("part") == ",") & (F.col("depth") == 1)
    pieces = pieces.withColumn("cut", cut.cast("int")).withColumn("cuts_here", F.sum("cut").over(in_order))
    pieces = _carried(pieces, cuts_before=F.col("cut"))
    return pieces.select(*_BLOCK, "seq", "pos", "part", "inside", "step", "depth", "cut", (F.col("cuts_here") + F.col("cuts_before")).alias("entry"))


def _frame() -> Column:
    """The bracket that opens or closes the document itself."""
    return ((F.col("step") == 1) & (F.col("depth") == 1)) | ((F.col("step") == -1) & (F.col("depth") == 0))


def _entry_texts(parts: DataFrame, tasks: int) -> DataFrame:
    """(path, entry, text) with blank entries left out."""
    held = parts.where((F.col("depth") >= 1) & ~_frame() & (F.col("cut") == 0)).select("path", "entry", "start", "seq", "pos", "part").repartition(tasks, "path", "entry")
    ordered = F.array_sort(F.collect_list(F.struct("start", "seq", "pos", "part")))
    texts = held.groupBy("path", "entry").agg(F.array_join(F.transform(ordered, lambda p: p["part"]), "").alias("text"))
    return texts.where(F.trim(F.col("text"), F.lit(_BLANKS)) != "")


def _judged(spark: SparkSession, path: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """The entries (path, entry, text) of all documents, and (path, reason) for every document, null where it is sound."""
    tasks = _tasks(spark, path)
    parts = _parts(spark, path, tasks)
    bare = (F.col("depth") <= 0) & ~_frame() & (F.trim(F.col("part"), F.lit(_BLANKS)) != "")
    at = F.struct("start", "seq", "pos")
    shape = parts.groupBy("path").agg(
        F.sum("step").alias("left_open"), F.min("depth").alias("lowest"), F.max_by("inside", at).alias("in_string"), F.max(bare).alias("bare"),
        F.sum(F.when(_frame() & (F.col("step") == 1), 1).otherwise(0)).alias("opened"), F.max(F.when(_frame() & (F.col("step") == 1), F.col("part"))).alias("opener"),
        F.max(F.when(_frame() & (F.col("step") == -1), F.col("part"))).alias("closer"), F.sum("cut").alias("cuts"))
    entries = _entry_texts(parts, tasks)
    is_list = F.col("opener") == "["
    # read as an entry of a list and of an object, so that texts need not meet their document in one task
    broken = lambda left, right: F.sum(F.try_parse_json(F.concat(F.lit(left), "text", F.lit(right))).isNull().cast("int"))
    counts = entries.groupBy("path").agg(F.count(F.lit(1)).alias("entries"), broken("[", "]").alias("bad_list"), broken("{", "}").alias("bad_object"))
    all_docs = shape.join(counts.hint("merge"), "path", "left").withColumn("bad", F.when(is_list, F.col("bad_list")).otherwise(F.col("bad_object")))
    held = F.coalesce("entries", F.lit(0))
    closed = is_list & (F.col("closer") == "]") | (F.col("opener") == "{") & (F.col("closer") == "}")
    sound = (F.col("left_open") == 0) & (F.col("lowest") >= 0) & ~F.col("in_string") & ~F.col("bare") & (F.col("opened") == 1) & closed
    sound &= (F.coalesce("bad", F.lit(0)) == 0) & ((held == F.col("cuts") + 1) | (held + F.col("cuts") == 0))
    wanted = F.col("opener") == ("[" if kind == "list" else "{")
    reason = (F.when(F.col("opener").isNull(), f"not a JSON {kind}").when(~F.coalesce(sound, F.lit(False)), "not JSON")
              .when(~wanted, f"not a JSON {kind}"))
    return entries, all_docs.select("path", reason.alias("reason"))


def document_entries(spark: SparkSession, path: str, kind: str = "object") -> DataFrame:
    """(path, entry_ord, text) of the top-level entries of all sound documents of that ``kind`` ("object" or "list").

    ``text`` is the entry as written, key included. Every value in a document stays whole, so a single entry or a run of
    numbers without any string must fit a cell; the number of entries is not bounded. Documents with faults give none.
    """
    entries, judged = _judged(spark, path, kind)
    good = judged.where("reason is null").select("path")
    return entries.join(good.hint("merge"), "path", "left_semi").select("path", F.col("entry").cast("long").alias("entry_ord"), "text")


def document_faults(spark: SparkSession, path: str, kind: str = "object") -> DataFrame:
    """(path, reason) of documents that cannot be used: not JSON, or no ``kind``; one that opens no bracket is no ``kind``.

    A file of no bytes has no row, as Spark's readers skip it.
    """
    return _judged(spark, path, kind)[1].where("reason is not null")


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """S1 for documents of any size: (path, ord, given_title)."""
    title = F.from_json(F.concat(F.lit("["), "text", F.lit("]")), "array<string>")[0]
    return document_entries(spark, path, "list").select("path", F.col("entry_ord").alias("ord"), title.alias("given_title"))


def read_resolver_raw(spark: SparkSession, path: str) -> DataFrame:
    """S4 for documents of any size: (path, entry_ord, entry_key, entry_json); a string entry keeps its quotes."""
    whole = F.concat(F.lit("{"), "text", F.lit("}"))
    rows = document_entries(spark, path).select("path", "entry_ord", F.map_entries(F.from_json(whole, "map<string,string>"))[0].alias("e"),
                                                F.map_entries(F.from_json(whole, "map<string,variant>"))[0].alias("v"))
    quoted = F.to_json(F.array("e.value"))
    value = F.when(F.schema_of_variant("v.value") == "STRING", quoted.substr(F.lit(2), F.length(quoted) - 2)).otherwise(F.col("e.value"))
    return rows.select("path", "entry_ord", F.col("e.key").alias("entry_key"), value.alias("entry_json"))


def read_type_map_raw(spark: SparkSession, path: str) -> DataFrame:
    """S5 for documents of any size, unvalidated: (path, entry_ord, map_key, map_value) as written."""
    e = F.map_entries(F.from_json(F.concat(F.lit("{"), "text", F.lit("}")), "map<string,string>"))[0]
    return document_entries(spark, path).select("path", "entry_ord", e.alias("e")).select(
        "path", "entry_ord", F.col("e.key").alias("map_key"), F.col("e.value").alias("map_value"))
