"""What is written: texts, images, files by name, and pages to read in a browser."""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliomend.operators.blocks import PROTECT, lex_blocks

# Fixed value: the frame of a page, around title, table of contents and body.
PAGE = ('<!DOCTYPE html>\n<html>\n<head><meta charset="utf-8"><title>', "</title></head>\n<body>\n<nav>\n<ul>\n", "\n</ul>\n</nav>\n<main>\n", "\n</main>\n</body>\n</html>\n")


def write_texts(docs: DataFrame, path: str, name_col: str = "doc", text_col: str = "md") -> None:
    """name and text of each document as Parquet: as many files as the data has partitions, however many documents."""
    docs.select(F.col(name_col).alias("name"), F.col(text_col).alias("text")).write.mode("overwrite").parquet(path)


def write_images(images: DataFrame, path: str) -> None:
    """doc, rel_path and bytes of decoded images as Parquet."""
    images.where("bytes IS NOT NULL").select("doc", "rel_path", "bytes").write.mode("overwrite").parquet(path)


def address(spark: SparkSession, folder: str) -> str:
    """A folder's full address: a relative one is below the working folder of the default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    full = path.makeQualified(files.getUri(), files.getWorkingDirectory()).toString()
    return re.sub("^file:/+", "file:///", full).rstrip("/")


class Folder:
    """A folder that a task writes to, by its address. A file appears whole or not at all."""

    def __init__(self, root: str):
        from pyarrow import fs

        if root.startswith("file://"):
            self.files, self.root = fs.LocalFileSystem(), root.removeprefix("file://")
        else:
            self.files, self.root = fs.FileSystem.from_uri(root)
        self.root, self.known = self.root.rstrip("/"), set()

    def put(self, path: str, content: bytes) -> None:
        target = f"{self.root}/{path}"
        parent, _, name = target.rpartition("/")
        if parent not in self.known:
            self.files.create_dir(parent, recursive=True)
            self.known.add(parent)
        draft = f"{parent}/.{name[:100]}.{uuid.uuid4().hex}"
        with self.files.open_output_stream(draft) as out:
            out.write(content)
        self.files.move(draft, target)

    def get(self, paths: list[str]) -> list[bytes | None]:
        """The contents of files, None where there is none."""
        from pyarrow import fs

        out = []
        for info in self.files.get_file_info([f"{self.root}/{p}" for p in paths]):
            out.append(None if info.type == fs.FileType.NotFound else self.files.open_input_stream(info.path).readall())
        return out


#: Bytes of files in an archive, from which on the next one begins.
ARCHIVE = 32 << 20


class Archives:
    """Files of a task in zip archives of a folder, many to one. An archive appears whole or not at all."""

    def __init__(self, out: Folder):
        self.out, self.name = out, None

    def put(self, path: str, content: bytes) -> str:
        """The name of the archive that takes the file."""
        if self.name is None:
            self.name, self.held, self.size = f"archives/{uuid.uuid4().hex}.zip", io.BytesIO(), 0
            self.zip = zipfile.ZipFile(self.held, "w", zipfile.ZIP_DEFLATED, compresslevel=1)
        name = self.name
        self.zip.writestr(zipfile.ZipInfo(path), content, zipfile.ZIP_DEFLATED, 1)
        self.size += len(content)
        if self.size >= ARCHIVE:
            self.close()
        return name

    def close(self) -> None:
        if self.name is not None:
            self.zip.close()
            self.out.put(self.name, self.held.getbuffer())
            self.name = None


def unarchived(content: bytes, below: str) -> Iterator[tuple[str, bytes]]:
    """(path, content) of an archive's files whose path begins so."""
    with zipfile.ZipFile(io.BytesIO(content)) as found:
        for info in found.infolist():
            if info.filename.startswith(below):
                yield info.filename, found.read(info)


#: Below a folder that is written to: a table for each finished run, of the files it wrote.
MANIFEST = "_manifest"


def write_files(rows: DataFrame, folder: str, archived: bool = False) -> None:
    """One file for each row (path below folder, content as string or binary), written by the tasks.

    folder: a path or address that all machines reach; a relative one is resolved here, once. A file
    appears whole or not at all, so that a task that runs again does no harm; files that are there
    already are replaced, others are left alone. Rows with a null path or content, or a path that leaves
    the folder, are passed over. When all are written, and only then, the run's manifest appears: path,
    bytes and the other columns of rows.

    archived: the files go into zip archives, which the manifest names in archive: a small file by itself takes
    a whole block of the disk and an entry of its folder. Runs into one folder must then write different paths.
    """
    spark = rows.sparkSession
    root = address(spark, folder)
    more = [c for c in rows.columns if c not in ("path", "content")]
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("bytes", T.LongType()), *([T.StructField("archive", T.StringType())] if archived else []), *(rows.schema[c] for c in more)])
    names = [f.name for f in schema.fields]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Folder(root)
        archives = Archives(out) if archived else None
        for batch in batches:
            done, sizes, places = [], [], []
            for k, (path, content) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                parts = (path or "").split("/")
                if content is None or "" in parts or ".." in parts or parts[0] == MANIFEST:
                    continue
                content = content.encode() if isinstance(content, str) else bytes(content)
                if archives:
                    places.append(archives.put(path, content))
                else:
                    out.put(path, content)
                done.append(k)
                sizes.append(len(content))
            kept = batch.take(pa.array(done, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column(0), pa.array(sizes, pa.int64()), *([pa.array(places, pa.string())] if archives else []), *kept.columns[2:]], names)
        if archives:
            archives.close()

    rows.select("path", "content", *more).mapInArrow(write, schema).write.parquet(f"{root}/{MANIFEST}/{uuid.uuid4().hex}")


def manifest(spark: SparkSession, folder: str, schema: str = "path string, bytes long") -> DataFrame:
    """What the finished runs have written to a folder; no rows if there is none. There is one entry of a run to look for, not of a file."""
    root = address(spark, folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{MANIFEST}/*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    runs = [x.getPath().getParent().toString() for x in found or []]
    return spark.read.schema(schema).parquet(*runs) if runs else spark.createDataFrame([], schema)


def checked_names(names: DataFrame, name_col: str = "name") -> DataFrame:
    """names, if no two rows have the same one: their files would replace each other."""
    twice = [r[0] for r in names.groupBy(name_col).count().where("count > 1").select(name_col).limit(5).collect()]
    if twice:
        raise ValueError(f"several inputs would be written as {', '.join(map(str, twice))}")
    return names


def rendered(docs: DataFrame, render: Callable[[str], str], text_col: str = "md") -> DataFrame:
    """docs with html: each text through a converter from outside, called in the tasks, batch by batch. A null text gives null."""
    schema = f"{docs.drop('html')._jdf.schema().toDDL()}, html string"
    names = [*docs.drop("html").columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(names.index(text_col)).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([None if t is None else render(t) for t in texts], pa.string())], [*names, "html"])

    return docs.drop("html").mapInArrow(run, schema)


def escaped(s: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


# What a plain line is on a page, and marks inside a line, each with what takes its place.
HTML_HEADING, HTML_ITEM, HTML_NUMBER = r"^\s{0,3}(#{1,6})\s+(.*?)\s*#*\s*$", r"^\s{0,3}[-*+]\s+", r"^\s{0,3}\d{1,9}\.\s+"
CODE_SPAN = r"`[^`\n]+`"
INLINE_MARKS = [
    (r"!\[([^\]]*)\]\(([^()\s]*)\)", '<img src="{2}" alt="{1}">'),
    (r"\[([^\]]*)\]\(([^()\s]*)\)", '<a href="{2}">{1}</a>'),
    (r"\*\*([^*]+)\*\*", "<strong>{1}</strong>"),
    (r"\*([^*\s][^*]*)\*", "<em>{1}</em>"),
]
CODE_OPEN, CODE_CLOSE = r"^[^\n]*\n?", r"(^|\n)\s*(`{3,}|~{3,})[^\n]*$"


def inline_html(s: Column) -> Column:
    """The text of a line with its marks as elements; what is in code spans stays as it is."""

    def marked(x: Column) -> Column:
        for pattern, put in INLINE_MARKS:
            x = F.regexp_replace(x, pattern, put.replace("{1}", "$1").replace("{2}", "$2"))
        return x

    def cut(x: Column) -> Column:
        codes = F.transform(F.regexp_extract_all(x, F.lit(CODE_SPAN), F.lit(0)), lambda c: F.concat(F.lit("<code>"), F.substring(c, F.lit(2), F.length(c) - 2), F.lit("</code>")))
        return F.array_join(F.zip_with(F.split(x, CODE_SPAN, -1), codes, lambda rest, code: F.concat(marked(rest), F.coalesce(code, F.lit("")))), "")

    return F.get(F.transform(F.array(escaped(s)), cut), F.lit(0))


def html_elements(blocks: DataFrame) -> DataFrame:
    """doc_id, place, kind, entry, html: the blocks of documents, as lexed for protection with blank lines kept, as elements.

    Lines of text in a row are a paragraph, items in a row a list. Headings get the anchor h and their
    number, entry. HTML stays as it is; all else is escaped. blocks: doc_id, block, kind, text.
    """
    text = F.col("text")
    plain = F.when(text.rlike(r"^\s*$"), "blank").when(text.rlike(HTML_HEADING), "heading").when(text.rlike(HTML_ITEM), "item").when(text.rlike(HTML_NUMBER), "number").otherwise("text")
    order = Window.partitionBy("doc_id").orderBy("block")
    rows = blocks.select("doc_id", "block", "text", F.when(F.col("kind") == "plain", plain).otherwise(F.lower("kind")).alias("kind"))
    goes_on = F.col("kind").isin("text", "item", "number") & F.coalesce(F.lag("kind").over(order) == F.col("kind"), F.lit(False))
    placed = rows.select("*", F.when(goes_on, 0).otherwise(1).alias("fresh"))
    placed = placed.select("*", F.sum("fresh").over(order).alias("place"), F.sum(F.when(F.col("kind") == "heading", 1).otherwise(0)).over(order).alias("entry")).where("kind <> 'blank'")
    grouped = placed.groupBy("doc_id", "place", "kind").agg(F.max("entry").alias("entry"), F.array_sort(F.collect_list(F.struct("block", "text"))).alias("rows"))
    grouped = grouped.select("doc_id", "place", "kind", "entry", F.transform("rows", lambda r: r["text"]).alias("lines"))
    one, lines = F.col("lines")[0], F.col("lines")
    around = lambda tag, x: F.concat(F.lit(f"<{tag}>"), x, F.lit(f"</{tag.split()[0]}>"))
    items = lambda mark: F.array_join(F.transform(lines, lambda x: around("li", inline_html(F.regexp_replace(x, mark, "")))), "\n")
    level = F.length(F.regexp_extract(one, HTML_HEADING, 1)).cast("string")
    heading = F.concat(F.lit("<h"), level, F.lit(' id="h'), F.col("entry").cast("string"), F.lit('">'), inline_html(F.regexp_extract(one, HTML_HEADING, 2)), F.lit("</h"), level, F.lit(">"))
    code = around("pre", around("code", escaped(F.regexp_replace(F.regexp_replace(one, CODE_OPEN, ""), CODE_CLOSE, ""))))
    cells = lambda x, tag: around("tr", F.array_join(F.transform(F.split(F.regexp_replace(F.trim(x), r"^\||\|$", ""), r"\|"), lambda c: around(tag, inline_html(F.trim(c)))), ""))
    rows_of = F.split(one, "\n")
    table = around("table", F.concat(F.lit("\n"), cells(rows_of[0], "th"), F.lit("\n"), F.array_join(F.transform(F.slice(rows_of, 3, F.size(rows_of)), lambda x: F.concat(cells(x, "td"), F.lit("\n"))), "")))
    kind = F.col("kind")
    html = (
        F.when(kind == "text", around("p", F.array_join(F.transform(lines, inline_html), "\n"))).when(kind == "item", around("ul", items(HTML_ITEM))).when(kind == "number", around("ol", items(HTML_NUMBER))).when(kind == "heading", heading)
        .when(kind == "codefence", code).when(kind == "indentcode", around("pre", around("code", escaped(one)))).when(kind == "mathblock", around('div class="math"', escaped(one))).when(kind == "table", table).when(kind == "htmlblock", one).otherwise(around('p class="note"', inline_html(one)))
    )
    title = F.when(kind == "heading", F.format_string('<li class="toc-%s"><a href="#h%d">%s</a></li>', level, "entry", escaped(F.regexp_extract(one, HTML_HEADING, 2))))
    return grouped.select("doc_id", "place", "kind", "entry", html.alias("html"), title.alias("item"))


def html_pages(docs: DataFrame, title: Column) -> DataFrame:
    """doc_id, html: each document (doc_id, md) as a page with its contents, whose links lead to its headings."""
    blocks = lex_blocks(docs.select("doc_id", F.lit(0).alias("page"), F.col("md").alias("text")), PROTECT, "plain", keep_blank=True)
    parts = html_elements(blocks).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("place", "html", "item"))).alias("parts"))
    rows = docs.select("doc_id", title.alias("title")).join(parts, "doc_id", "left")
    joined = lambda name: F.coalesce(F.array_join(F.transform("parts", lambda r: r[name]), "\n"), F.lit(""))
    frame = [F.lit(x) for x in PAGE]
    return rows.select("doc_id", F.concat(frame[0], escaped(F.col("title")), frame[1], joined("item"), frame[2], joined("html"), frame[3]).alias("html"))
