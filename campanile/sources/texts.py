"""Whole-text files and files of blocks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from campanile.functions import xyz


def read_texts(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(job_dir, name, text, mtime, size), a row for each file; ``.gz`` is unpacked, bad UTF-8 replaced."""
    reader = spark.read.option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    df = reader.text(path, wholetext=True).select("value", "_metadata.file_path", "_metadata.file_modification_time", "_metadata.file_size")
    return df.select(_folder(F.col("file_path")).alias("job_dir"), F.substring_index("file_path", "/", -1).alias("name"), F.col("value").alias("text"), F.col("file_modification_time").alias("mtime"), F.col("file_size").alias("size"))


def _folder(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, r"/[^/]*$", ""), r"^file:(//)?", "")


def unpacked(raw: bytes, piece: int = 1 << 12) -> tuple[bytes, bool]:
    """(all that a gzip file holds, member after member, up to where it is damaged or cut off; whether it is whole).

    Zeros after a member are padding, anything else is damage.
    """
    out, at, ok = [], 0, False
    while at < len(raw):
        unpack = zlib.decompressobj(31)
        try:
            while at < len(raw) and not unpack.eof:
                out.append(unpack.decompress(raw[at : at + piece]))
                at += min(piece, len(raw) - at)
        except zlib.error:
            return b"".join(out), False
        ok = unpack.eof
        rest = unpack.unused_data + raw[at:]
        at = len(raw) - len(rest.lstrip(b"\0"))
    return b"".join(out), ok


def read_zipped(spark: SparkSession, path: str, glob: str = "*.gz") -> DataFrame:
    """As read_texts for gzip files, of one member or several, of which some may be damaged or cut off: these give the text up to there, and ``whole`` is false.

    Files of no bytes at all are passed over by the reader.
    """
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    rows = df.select(_folder(F.col("path")).alias("job_dir"), F.substring_index("path", "/", -1).alias("name"), F.col("modificationTime").alias("mtime"), F.col("length").alias("size"), "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, whole = [], []
            for raw in pdf["content"]:
                data, ok = unpacked(raw)
                texts.append(data.decode("utf-8", "replace"))
                whole.append(ok)
            yield pdf.drop(columns="content").assign(text=texts, whole=whole)

    return rows.mapInPandas(run, "job_dir string, name string, mtime timestamp, size long, text string, whole boolean")


def numbered_lines(texts: DataFrame, by: str = "path") -> DataFrame:
    """(by, line_no, line) of texts (by, text)."""
    return texts.select(by, F.posexplode(F.split("text", "\r?\n")).alias("line_no", "line"))


def forward_filled(lines: DataFrame, header: str, name: str, by: str = "path") -> DataFrame:
    """Lines under the last header before them: header is a pattern whose first group is the name; header lines go."""
    w = Window.partitionBy(by).orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = F.nullif(F.regexp_extract("line", header, 1), F.lit(""))
    return lines.withColumn("_h", found).withColumn(name, F.last("_h", ignorenulls=True).over(w)).where("_h is null").drop("_h")


def geometry_blocks(texts: DataFrame, by: str = "path") -> DataFrame:
    """(by, molecule, atoms) of files of ``Geometry for NAME`` blocks."""
    lines = forward_filled(numbered_lines(texts, by), r"^\s*Geometry for\s+(.*?):?\s*$", "molecule", by)
    body = lines.where("molecule is not null").groupBy(by, "molecule").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda s: s["line"]), "\n").alias("text"))
    rows = F.filter(F.transform(xyz.lines(F.col("text")), xyz.tokens), lambda t: (F.size(t) >= 4) & F.try_element_at(t, F.lit(2)).try_cast("double").isNotNull())
    return body.select(by, "molecule", F.transform(rows, xyz._atom).alias("atoms"))


def multiplicities(texts: DataFrame, by: str = "path") -> DataFrame:
    """(molecule, charge, mults) of lines ``name, charge=0, mult=1``; several lines of a name make a list."""
    lines = numbered_lines(texts, by)
    get = lambda k: F.regexp_extract("line", rf"{k}\s*=\s*(-?\d+)", 1).try_cast("int")
    rows = lines.select(F.trim(F.substring_index("line", ",", 1)).alias("molecule"), get("charge").alias("charge"), get("mult").alias("mult"), "line_no").where("mult is not null")
    return rows.groupBy("molecule").agg(F.min_by("charge", "line_no").alias("charge"), F.transform(F.array_sort(F.collect_list(F.struct("line_no", "mult"))), lambda s: s["mult"]).alias("mults"))


def continued(texts: DataFrame, by: str = "path") -> DataFrame:
    """(by, molecule, zpve, multiplicity) where a line without a comma goes on from the one before."""
    lines = numbered_lines(texts, by).where(F.col("line").rlike(r"\S"))
    w = Window.partitionBy(by).orderBy("line_no")
    lines = lines.withColumn("_g", F.sum(F.col("line").contains(",").cast("int")).over(w))
    joined = lines.groupBy(by, "_g").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda s: F.trim(s["line"])), "").alias("line"))
    part = lambda i: F.trim(F.try_element_at(F.split("line", ","), F.lit(i)))
    return joined.select(by, part(1).alias("molecule"), part(2).try_cast("double").alias("zpve"), part(3).alias("multiplicity"))


def reset_list(texts: DataFrame, by: str = "path") -> DataFrame:
    """(section, job) of a list with ``# name (n jobs)`` headers and comma-separated items."""
    lines = forward_filled(numbered_lines(texts, by), r"^#\s*(.*?)\s*(?:\(\d+ jobs?\))?\s*$", "section", by)
    return lines.select("section", F.explode(F.split("line", ",")).alias("job")).select("section", F.trim("job").alias("job")).where("job <> ''")
