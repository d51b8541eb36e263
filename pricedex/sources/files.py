"""Readers for the raw formats (S01-S06) and sinks.

All readers use explicit string schemas where the reference infers types (inference loses leading zeros and
costs an extra pass over the data); typing happens in the cleaning jobs with ``try_cast``.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricedex.operators.cleaning import LONG_CSV_COLUMNS
from pricedex.session import parallelism
from pricedex.sources.store import written


# ------------------------------------------------------------------------------------------------ S01 wide bulk
def read_wide_tsv(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Tab-separated wide file with header; ':' is null. Gzip is read natively (not splittable: one task per
    file), so the rows are spread again before the unpivot."""
    df = (spark.read.option("sep", "\t").option("header", True).option("nullValue", ":")
          .option("encoding", "UTF-8").csv(path))
    df = df.toDF(*[c.strip() for c in df.columns])
    return df.repartition(partitions or parallelism(spark))


# ------------------------------------------------------------------------------------------------ S02 long CSV
#: Columns a line must name to be a file's header.
HEADER_MARKS = ("TIME_PERIOD", "OBS_VALUE")
FIELD = r';("(?:[^"]|"")*"|[^;]*)'  # of a line with a separator put before it
CP1252 = bytes(b for b in range(0x80, 0xA0)).decode("cp1252", "replace")


def _text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, raw): every line's bytes as they are, with its file."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"),
                                        F.regexp_replace(F.col("value"), "\r$", "").alias("text"),
                                        F.col("value").cast("binary").alias("raw"), F.is_valid_utf8("value").alias("valid"))


def decoded(raw, is_utf8) -> F.Column:
    """Bytes to text: UTF-8, else windows-1252 (as ISO-8859-1 with the 0x80-0x9F range put right)."""
    latin = F.translate(F.decode(raw, "ISO-8859-1"), "".join(map(chr, range(0x80, 0xA0))), CP1252)
    return F.when(is_utf8, raw.cast("string")).otherwise(latin)


def file_headers(lines: DataFrame) -> DataFrame:
    """(file, is_utf8, header): per file whether all its lines are UTF-8, and its header line. One pass, one row a file."""
    marks = F.lit(True)
    for m in HEADER_MARKS:
        marks = marks & F.col("text").contains(m)
    return lines.groupBy("file").agg(
        F.min("valid").alias("is_utf8"), F.min(F.when(marks, F.col("text"))).alias("header_line"))


def read_long_csv(spark: SparkSession, path: str) -> DataFrame:
    """';'-separated files with a header each: columns by name, all strings, plus ``_present`` (the file's columns).

    Every file is decoded by itself: UTF-8 if all its lines are, else windows-1252. Lines with more fields than the
    header are skipped, shorter ones padded with nulls; both whatever columns a query selects. A header may have any
    number of columns; a column that a file lacks is null; a file without a header gives no rows.
    """
    lines = _text_lines(spark, path)
    headers = file_headers(lines).where("header_line is not null")
    clean = F.regexp_replace(F.regexp_replace("header_line", "^\ufeff", ""), '"', "")
    headers = headers.withColumn("_present", F.transform(F.split(clean, ";"), lambda c: F.upper(F.trim(c))))
    # where each column of the job stands in the file (0: nowhere), found once per file
    headers = headers.withColumn("places", F.array(*[F.array_position("_present", c) for c in LONG_CSV_COLUMNS]))
    rows = lines.join(headers, "file").where((F.col("text") != F.col("header_line")) & (F.trim("text") != ""))
    line = F.regexp_replace(decoded(F.col("raw"), F.col("is_utf8")), "\r$", "")
    # explode of one value: a line is cut into fields once and not once for each column
    fields = F.regexp_extract_all(F.concat(F.lit(";"), line), F.lit(FIELD), 1)
    rows = rows.select("_present", "places", F.explode(F.array(fields)).alias("fields")).where(
        F.size("fields") <= F.size("_present"))
    return rows.select(*[_field(F.col("places")[i]).alias(c) for i, c in enumerate(LONG_CSV_COLUMNS)], "_present")


def _field(place: Column) -> Column:
    """The field at a place: without its quotes (two inside stand for one); null if it is empty or not there."""
    raw = F.get("fields", (place - 1).cast("int"))
    quoted = F.regexp_replace(F.regexp_replace(raw, '^"|"$', ""), '""', '"')
    return F.when((place > 0) & (raw != ""), F.when(raw.startswith('"'), quoted).otherwise(raw))


# ------------------------------------------------------------------------------------------------ S03 series CSV
def read_series_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV read as strings (no inference: codes keep their leading zeros if present)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


# ------------------------------------------------------------------------------------------------ S04 SDMX XML
OBS_TYPE = T.StructType([
    T.StructField("_TIME_PERIOD", T.StringType()), T.StructField("_OBS_VALUE", T.StringType()),
    T.StructField("_OBS_STATUS", T.StringType())])
SERIES_XML_SCHEMA = T.StructType([
    T.StructField("_IDBANK", T.StringType()), T.StructField("_FREQ", T.StringType()),
    T.StructField("_TITLE_FR", T.StringType()), T.StructField("_REF_AREA", T.StringType()),
    T.StructField("Obs", T.ArrayType(OBS_TYPE))])


def read_sdmx_xml(spark: SparkSession, path: str) -> DataFrame:
    """One row per <Series>: series_id, title, area, obs array<struct<period, value, status>>.

    Element names may carry a namespace prefix (``<m:Series>``): the prefixes of the files are looked up first (one
    aggregate, a handful of values), and each is read with its own row tag.
    """
    tags = spark.read.text(path).select(F.explode(F.regexp_extract_all("value", F.lit(r"<([A-Za-z_][\w.-]*:)?Series[\s>/]")))
                                        .alias("prefix")).distinct().collect()
    df = None
    for prefix in sorted(r.prefix or "" for r in tags) or [""]:
        obs = T.StructType([T.StructField(prefix + f.name if f.name == "Obs" else f.name, f.dataType)
                            for f in SERIES_XML_SCHEMA.fields])
        part = (spark.read.format("xml").option("rowTag", prefix + "Series").option("ignoreNamespace", False)
                .schema(obs).load(path).withColumnRenamed(prefix + "Obs", "Obs"))
        df = part if df is None else df.unionByName(part)
    obs = F.transform("Obs", lambda o: F.struct(o["_TIME_PERIOD"].alias("period"), o["_OBS_VALUE"].alias("value"),
                                                o["_OBS_STATUS"].alias("status")))
    return df.select(F.col("_IDBANK").alias("series_id"), F.col("_TITLE_FR").alias("title"),
                     F.col("_REF_AREA").alias("area"), F.coalesce(obs, F.array()).alias("obs"))


# ------------------------------------------------------------------------------------------------ S05 price JSON
PRICE_ITEM_SCHEMA = ("id long, product_code string, product_name string, category_tag string, price string, "
                     "currency string, location_osm_id long, date string")


#: Up to the first brace outside strings; the rest from that brace on.
TO_BRACE = r"""(?s)^(?:[^{"]++|"(?:\\.|[^"\\]++)*+")*+(\{.*)$"""


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The files cut behind every closing brace, as a table: file, block (where the split starts), id (order inside), text.

    The text source splits a large file at the brace as it would at line ends, so that one file on one line feeds many
    tasks."""
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.regexp_replace("value", "^\ufeff", "").alias("text"))
    return written(pieces, "json-pieces")


def _before(rows: DataFrame, value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over the file's pieces before each one: sums inside a split (one task's share of a
    file), and of the splits before it (one row a split)."""
    inside = Window.partitionBy("file", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("file", "block").agg(F.sum(value).alias("n"))
    offsets = totals.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return rows.join(offsets, ["file", "block"]).withColumn(
        name, F.col("offset") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("offset")


def _count(text, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def json_items(spark: SparkSession, path: str) -> DataFrame:
    """(file, item): the JSON text of every item of the files below ``path``.

    A file holds items one after the other (one a line), an array of items, or pages ``{"items": [...]}``; which, its first
    piece says. Whether a piece begins inside a string, and how deep in braces, are sums over the pieces before it: of
    quotes, then of braces outside strings. An item ends with the brace that brings the depth back to the list's; most items
    are one piece, and only the pieces of others are put together.
    """
    rows = _pieces(spark, path)
    bare = F.regexp_replace("text", r"(?s)\\.", "")  # without escaped characters every quote is one
    first = rows.groupBy("file").agg(F.min_by("text", F.struct("block", "id")).alias("head"))
    kinds = first.select("file", F.when(F.col("head").rlike(r'^\s*\{[^\[{]*"items"\s*:\s*\['), 1).otherwise(0).alias("base"))
    rows = _before(rows.withColumns({"bare": bare, "quotes": _count(bare, '"')}), "quotes", "quotes_before")
    within = F.col("quotes_before") % 2 == 1
    open_ = F.when(within, F.regexp_replace("bare", '^[^"]*("|$)', "")).otherwise(F.col("bare"))
    outside = F.regexp_replace(open_, '"[^"]*("|$)', "")
    closes = (F.col("quotes_before") + F.col("quotes")) % 2 == 0  # the brace behind the piece is no part of a string
    rows = rows.withColumns({"outside": outside, "closes": closes}).drop("bare", "quotes", "quotes_before")
    rows = rows.withColumn("rise", _count(F.col("outside"), "{") - _count(F.col("outside"), "}") - F.col("closes").cast("int"))
    rows = _before(rows, "rise", "depth").join(kinds, "file")
    base, depth, after = F.col("base"), F.col("depth"), F.col("depth") + F.col("rise")
    starts = (depth <= base) & (depth + _count(F.col("outside"), "{") > base)
    rows = rows.withColumns({"starts": starts, "ends": F.col("closes") & (after == base) & (starts | (depth > base))})
    # a page's first item stands behind the page's own brace
    body = F.regexp_extract("text", TO_BRACE, 1)
    inner = F.regexp_extract(F.substr(body, F.lit(2)), TO_BRACE, 1)
    opened = F.when((base == 1) & (depth == 0), inner).otherwise(body)
    named = F.col("outside").rlike(r":\s*\{[^{]*$") & (base == 1) & (depth == 1)  # an object of the page, not of its list
    part = F.concat(F.when(F.col("starts"), opened).otherwise(F.col("text")), F.lit("}"))
    rows = rows.select("file", "block", "id", "starts", "ends", part.alias("part"), (named & starts).alias("named"),
                       ((depth > base) | F.col("starts")).alias("inside"), F.col("ends").cast("int").alias("ended"))
    whole = rows.where("starts AND ends AND NOT named").select("file", F.col("part").alias("item"))
    split = _before(rows, "ended", "number").where("inside AND NOT (starts AND ends)")
    joined = split.groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct("block", "id", "part"))).alias("parts"), F.max("named").alias("named"),
        F.max("ends").alias("ended")).where("ended AND NOT named")  # the pieces of one item
    return whole.unionByName(joined.select("file", F.array_join(F.transform("parts", lambda p: p["part"]), "").alias("item")))


def read_price_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON price items; missing fields become null. Files may hold one item per line, an array of items (on one line or
    indented), or pages ``{"items": [...]}``; a file of any size is read by as many tasks as it has splits."""
    return json_items(spark, path).select(F.from_json("item", PRICE_ITEM_SCHEMA).alias("i")).select("i.*")


# ------------------------------------------------------------------------------------------------ S06 HTML pages
#: The named references that HTML pages must escape, "&" last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&amp;", "&"))


#: Comments, elements whose content is no markup, tags with their quoted attributes, text, and a lone "<".
HTML_TOKEN = (r"""(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|title)\b.*?(?:</\1\s*>|\z)"""
              r"""|</?[a-z][^\s/>]*(?:"[^"]*"|'[^']*'|[^"'>]++)*+>|[^<]++|<""")
ATTRIBUTE = r"""([^\s"'=<>/]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def html_tokens(html) -> Column:
    """The page cut into comments, tags and text, in order; nothing is lost."""
    return F.regexp_extract_all(html, F.lit(HTML_TOKEN), 0)


def _has_word(tag, attr: str, word: str) -> Column:
    """Whether the attribute of a tag, whatever its quotes and letter case, has the word among its words."""
    names = F.transform(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), 1), lambda n: F.lower(n))
    value = F.get(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), 2), (F.array_position(names, attr) - 1).cast("int"))
    words = F.split(F.regexp_replace(value, "^[\"']|[\"']$", ""), r"\s+")
    return F.coalesce(F.array_contains(words, word) & (F.array_position(names, attr) > 0), F.lit(False))


def _element_text(tokens, tag: str, attr: str | None, value: str | None):
    """Text of the first ``tag`` element (with the word ``value`` in ``attr`` when given): its tokens folded by depth."""
    opened = rf"(?i)^<{tag}(?=[\s/>])"
    closed = rf"(?i)^</{tag}(?=[\s/>])"

    def step(s: Column, token: Column) -> Column:
        starts = token.rlike(opened)
        wanted = starts & _has_word(token, attr, value) if attr else starts
        depth = (F.when(s["done"], F.lit(0)).when(s["depth"] == 0, F.when(wanted, F.lit(1)).otherwise(F.lit(0)))
                 .when(starts, s["depth"] + 1).when(token.rlike(closed), s["depth"] - 1).otherwise(s["depth"]))
        done = s["done"] | ((s["depth"] > 0) & (depth == 0))
        text = F.when((s["depth"] > 0) & ~s["done"] & (~token.startswith("<") | (token == "<")), F.concat(s["text"], token))
        return F.struct(depth.alias("depth"), F.coalesce(text, s["text"]).alias("text"), done.alias("done"))

    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("text"), F.lit(False).alias("done"))
    text = F.trim(F.aggregate(tokens, start, step)["text"])
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.when(text == "", F.lit(None)).otherwise(text)


def extract_product(pages: DataFrame, h1_class: str | None = "title-1") -> DataFrame:
    """Product name (first <h1>, with class ``h1_class`` when given) and categories (<p id="categories">) per
    page; no match -> null. Letter case and quotes of tags do not matter, inner elements' text counts, and what stands in
    comments and scripts does not. An element that is not closed reaches to the page's end. Native, no parser in Python."""
    cut = pages.select("page_id", "url", F.explode(F.array(html_tokens(F.coalesce("html", F.lit(""))))).alias("tokens"))
    name = _element_text(F.col("tokens"), "h1", "class" if h1_class else None, h1_class)
    cats = _element_text(F.col("tokens"), "p", "id", "categories")
    return cut.select("page_id", "url", name.alias("product_name"), cats.alias("categories"))


# ------------------------------------------------------------------------------------------------ sinks
def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                dynamic: bool = False, sort_within: list[str] | None = None) -> None:
    """Overwrite a table written by the executors (no driver collect). ``dynamic`` replaces only the
    partitions present in ``df`` (rebuild one source without touching the others)."""
    w = (df.sortWithinPartitions(*sort_within) if sort_within else df).write.mode("overwrite").format(fmt)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_ordered(df: DataFrame, path: str, order: list, files: int | None = None) -> None:
    """A table in one global order over several files: ranges of the order are dealt to the files, each is sorted, and
    every row keeps its file's number (``part``) and its place in it. No task sees more than its range."""
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.spark_partition_id()
    place = F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)  # the rest of the id counts a partition's rows
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged.withColumns({"part": part, "place": place}).write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``write_ordered`` with each row's ``position`` from 0: its place after the rows of the files before."""
    rows = spark.read.parquet(path)
    sizes = rows.groupBy("part").agg(F.count("*").alias("n"))  # one row a file
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return rows.join(F.broadcast(offsets), "part").withColumn("position", F.col("before") + F.col("place")).drop(
        "part", "place", "before")


def load_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Truncate-and-load, then verify: the written table must have the rows that were counted on the way in."""
    seen = Observation()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("n")), path, partition_by=partition_by)
    found = df.sparkSession.read.parquet(path).count()
    if found != seen.get["n"]:
        raise RuntimeError(f"{path}: {found} rows written, {seen.get['n']} expected")
    return found


class PublishError(RuntimeError):
    """A load did not have the rows it should; the version before it stays published."""


MANIFEST_SCHEMA = "version int, folder string, n_rows long"


def publish(df: DataFrame, root: str, partition_by: list[str] | None = None, expected: int | None = None) -> int:
    """Load a table as a new version and publish it only once it is verified.

    The rows are counted on their way into a folder of the version's own, and again as read back; both, and ``expected``
    where given, must agree. Only then a manifest of the new version is written, to a folder that appears as a whole with
    its success mark. Readers go by the highest manifest, so they see the old version until then, whole.
    """
    spark = df.sparkSession
    version = published_version(spark, root) + 1
    folder, seen = f"{root}/data/{uuid.uuid4().hex}", Observation()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("n")), folder, partition_by=partition_by)
    found = spark.read.schema(df.schema).parquet(folder).count()
    if not found == seen.get["n"] == (found if expected is None else expected):
        raise PublishError(f"{root}: {found} rows written, {seen.get['n']} read, {expected} expected")
    spark.createDataFrame([(version, folder, found)], MANIFEST_SCHEMA).coalesce(1).write.json(f"{root}/manifests/version={version}")
    return version


def _manifest(spark: SparkSession, root: str):
    """The row of the highest version, or None; one small file a version is read."""
    try:
        rows = spark.read.schema(MANIFEST_SCHEMA).json(f"{root}/manifests")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.orderBy(F.desc("version")).first()


def published_version(spark: SparkSession, root: str) -> int:
    """Number of the published version; 0 before the first."""
    found = _manifest(spark, root)
    return found.version if found else 0


def published(spark: SparkSession, root: str) -> DataFrame:
    """The published version of a table."""
    found = _manifest(spark, root)
    if found is None:
        raise PublishError(f"{root}: nothing published")
    return spark.read.parquet(found.folder)


def keep_payload(spark: SparkSession, files: str, path: str) -> DataFrame:
    """Copy the incoming files' bytes unchanged before any cleaning: rows (file, length, sha256, content) as Parquet.

    One row per landed file; a file is one row of at most 2 GB, the limit of the binary source."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(files)
    raw.select(F.element_at(F.split("path", "/"), -1).alias("file"), "length", F.sha2("content", 256).alias("sha256"),
               "content").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Per-category forecast metrics as JSON lines."""
    metrics.write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("category string, mae double, rmse double, mape_pct double, n_train long, "
                             "n_eval long").json(path)
