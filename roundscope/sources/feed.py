"""Feed of match bundles: URL manifest, payload triage and match slugs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import url_slug

# Leading bytes of archive kinds, in hex.
ARCHIVE_PREFIXES = [("zip", "504B0304"), ("rar", "52617221"), ("7z", "377ABCAF271C"), ("bzip2", "425A68")]
MIN_BYTES = 50_000

_MARKUP = r"(?is)^[\s﻿]*(<!doctype\s+html|<html|<head|<body|<title|<!--)"


def url_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One URL per line with its file slug; empty lines are skipped."""
    lines = spark.read.text(path).filter(F.col("value") != "")
    return lines.select(F.col("value").alias("url"), url_slug("value").alias("slug"))


def payload_kind(content: Column) -> Column:
    """zip, rar, 7z or bzip2 by the leading bytes, else raw."""
    head = F.hex(F.substring(content.cast("binary"), 1, 6))
    out = F.lit("raw")
    for kind, prefix in reversed(ARCHIVE_PREFIXES):
        out = F.when(head.startswith(prefix), F.lit(kind)).otherwise(out)
    return out


def looks_like_text(content: Column) -> Column:
    """Markup, or nothing but printable ASCII and blanks."""
    text = content.cast("string")
    return text.rlike(_MARKUP) | ~text.rlike(r"[^\t\n\f\r\x20-\x7E]")


def triage(df: DataFrame, content: str = "content", length: str | None = None, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Add length, kind, is_text and accepted. Too short payloads and text are not accepted."""
    body = F.col(content)
    size = F.col(length) if length else F.octet_length(body)
    out = df.withColumn("length", size.cast("bigint"))
    out = out.withColumns({"kind": payload_kind(body), "is_text": F.coalesce(looks_like_text(body), F.lit(True))})
    long_enough = F.coalesce(F.col("length") >= min_bytes, F.lit(False))
    return out.withColumn("accepted", long_enough & ~F.col("is_text"))


def find_files(spark: SparkSession, root: str, suffix: str = ".dem") -> DataFrame:
    """Paths below ``root`` whose name ends in the suffix, in any letter case; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return found.select("path", "length").filter(F.lower("path").endswith(suffix.lower()))


def match_slug(entries: DataFrame, url: str = "url", top_dir: str = "top_dir") -> DataFrame:
    """One slug per URL: the only top-level folder of its archive, else the URL itself.

    ``top_dir`` is NULL for entries that are not inside a folder.
    """
    grouped = entries.groupBy(url).agg(F.min(top_dir).alias("_least"), F.max(top_dir).alias("_greatest"))
    only = F.col("_least") == F.col("_greatest")
    return grouped.select(url, F.when(only, url_slug("_least")).otherwise(url_slug(url)).alias("slug"))
