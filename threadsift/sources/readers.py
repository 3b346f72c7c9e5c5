"""Post readers (A1-A5, E6) and the page-unit scan (A10).

Total input order ``seq`` is a struct ``(file_key, block, line, pos)``: the file's
name, path or modification time, the byte offset of the split, the line's place in the
split, and the post's place in a line's ``posts`` array (batched files).  It is computed without any driver round-trip or global
window, so it scales with the number of files and splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadsift import schema as S
from threadsift.functions.html import page_parts
from threadsift.functions.text import py_strip


def _file_key(order: str):
    if order == "name":
        return F.col("_metadata.file_name")
    if order == "path":
        return F.col("_metadata.file_path")
    if order == "mtime":
        # modification time first, name breaks ties
        return F.concat(F.lpad(F.unix_micros(F.col("_metadata.file_modification_time")).cast("string"), 20, "0"),
                        F.lit("/"), F.col("_metadata.file_name"))
    raise ValueError(order)


def file_order(spark: SparkSession, path, glob: str | None = None, order: str = "mtime") -> DataFrame:
    """A5: (place, file_path, file_name, modified, bytes), a row per file, in reading order from 0.

    A listing: no content is read.  The window without a key runs over files, not over rows."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.load(path).select(F.col("path").alias("file_path"), F.element_at(F.split("path", "/"), -1).alias("file_name"),
                                F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))
    by = {"mtime": ["modified", "file_name"], "name": ["file_name"], "path": ["file_path"]}[order]
    return files.select((F.row_number().over(Window.orderBy(*by)) - 1).cast("long").alias("place"), "*")


def left_out(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    """A3: (file_name, bytes) of each file of one document that ``read_batched(skip_unreadable=True)`` leaves out:
    the listing without the files that gave their document.  Empty files hold none and are not listed."""
    r = spark.read.option("wholetext", True).option("ignoreCorruptFiles", True).option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    whole = r.text(path).select(F.col("_metadata.file_name").alias("file_name")).distinct()
    files = file_order(spark, path, glob).filter("bytes > 0").select("file_name", "bytes")
    return files.join(whole, "file_name", "left_anti")


def _rest(value: str):
    """The fields of a JSON object that the post schema does not know, as JSON text with their types; NULL where there are none.

    They are parsed as VARIANT, so numbers stay numbers and nested values stay whole."""
    known = ", ".join(f"'{f.name}'" for f in S.POST_FIELDS)
    return F.expr(f"nullif(to_json(map_filter(from_json({value}, 'map<string,variant>'), (k, v) -> k NOT IN ({known}))), '{{}}')")


def read_jsonl(spark: SparkSession, path, glob: str | None = None, order: str = "name", skip_unreadable: bool = False,
               rest: str | None = None) -> tuple[DataFrame, DataFrame]:
    """A2: JSON lines with an explicit schema. Returns ``(posts, quarantine)``.

    Lines are scanned as text and parsed with ``from_json`` (PERMISSIVE): blank
    lines are skipped, malformed lines land in the quarantine table with their
    raw text instead of failing the job, and both outputs can be queried
    independently (no restriction on corrupt-record-only queries).  A read error fails the
    job and its message names the file; with ``skip_unreadable`` the rest of that file is left out without a trace.
    ``rest`` names a column for the fields outside the schema (JSON text, NULL without any), which
    ``sinks.append_jsonl`` writes back beside the known ones.
    """
    r = spark.read.option("ignoreCorruptFiles", skip_unreadable)
    if glob:
        r = r.option("pathGlobFilter", glob)
    raw = r.text(path)
    raw = raw.select(
        "value",
        F.struct(_file_key(order).alias("file_key"), F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("line"), F.lit(0).cast("long").alias("pos")).alias("seq"),
        F.col("_metadata.file_name").alias("file_name"))
    raw = raw.filter(py_strip(F.col("value")) != "")
    parsed = raw.select("seq", "file_name", "value", F.from_json("value", S.POST_WITH_CORRUPT, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    good = (parsed.filter(F.col("r._corrupt_record").isNull() & F.col("r").isNotNull())
            .select("seq", *[F.col(f"r.{f.name}").alias(f.name) for f in S.POST_FIELDS], *([_rest("value").alias(rest)] if rest else [])))
    bad = (parsed.filter(F.col("r").isNull() | F.col("r._corrupt_record").isNotNull())
           .select("seq", "file_name", F.col("value").alias("_corrupt_record")))
    return good, bad


def read_batched(spark: SparkSession, path, glob: str | None = None, order: str = "name", lines: bool = False,
                 skip_unreadable: bool = False) -> tuple[DataFrame, DataFrame]:
    """A1: batched files ``{"posts": [...]}``; returns ``(posts, quarantine)``.

    Each file is one JSON document (read whole), or with ``lines`` each line is one, so
    that many wrappers share a file.  Parsed with ``from_json`` in PERMISSIVE mode: a
    document without ``posts`` yields no rows, a malformed one is quarantined and the
    others still load (A3).  With ``skip_unreadable`` a file that cannot be read to its end is left out whole, as its
    document is broken, and stands in the quarantine by name with a NULL record; with ``lines`` as in ``read_jsonl``.
    """
    r = spark.read.option("wholetext", not lines).option("ignoreCorruptFiles", skip_unreadable)
    if glob:
        r = r.option("pathGlobFilter", glob)
    raw = r.text(path).select("value", _file_key(order).alias("file_key"), F.col("_metadata.file_name").alias("file_name"),
                              F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    raw = raw.filter(py_strip(F.col("value")) != "")
    parsed = raw.select("file_key", "file_name", "block", "line", "value", F.from_json("value", S.WRAPPER, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("w"))
    ok = F.col("w").isNotNull() & F.col("w._corrupt_record").isNull()
    bad = (parsed.filter(~ok)
           .select(F.struct("file_key", "block", "line", F.lit(-1).cast("long").alias("pos")).alias("seq"),
                   "file_name", F.col("value").alias("_corrupt_record")))
    if skip_unreadable and not lines:
        key = parsed.schema["file_key"].dataType.simpleString()
        bad = bad.unionByName(left_out(spark, path, glob).select(
            F.struct(F.lit(None).cast(key).alias("file_key"), F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("line"), F.lit(-1).cast("long").alias("pos")).alias("seq"),
            "file_name", F.lit(None).cast("string").alias("_corrupt_record")))
    good = (parsed.filter(ok)
            .select("file_key", "block", "line", F.posexplode("w.posts").alias("pos", "post"))
            .select(F.struct("file_key", "block", "line", F.col("pos").cast("long").alias("pos")).alias("seq"), "post.*"))
    return good, bad


def read_posts(spark: SparkSession, jsonl_path=None, batched_path=None, order: str = "name", glob: str | None = None,
               lines: bool = False, skip_unreadable: bool = False) -> tuple[DataFrame, DataFrame]:
    """JSON lines plus legacy batched files, unioned by name (bag)."""
    parts, bads = [], []
    if jsonl_path:
        g, b = read_jsonl(spark, jsonl_path, glob, order, skip_unreadable)
        parts.append(g); bads.append(b)
    if batched_path:
        g, b = read_batched(spark, batched_path, glob, order, lines, skip_unreadable)
        parts.append(g); bads.append(b)
    if not parts:
        raise ValueError("no input path")
    good = parts[0]
    for p in parts[1:]:
        good = good.unionByName(p, allowMissingColumns=True)
    bad = bads[0]
    for b in bads[1:]:
        bad = bad.unionByName(b, allowMissingColumns=True)
    return good, bad


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """B1: replace NULL (missing or JSON null) by the consumer's default."""
    return df.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in defaults.items() if k in df.columns})


def page_units(pages: DataFrame) -> DataFrame:
    """A10: the feed units (direct children of ``role="feed"``) and the article elements of each page, with
    their position among their kind and their inner markup."""
    return pages.select("page_id", F.inline(F.expr(page_parts()))).select("page_id", "unit_pos", "kind", "html")
