"""Rows and brute-force helpers that the operators' tests share."""

from __future__ import annotations

import re
import zlib

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# nulls in any column, empty and blank texts, a very long one, ties and repeated rows
EDGE_TEXTS = [None, "", " \n\t ", "one", "one two three four five six", "ÉTÉ über İstanbul ΣΑΣ 日本語 😀", "x" * 50_000, "word " * 30_000]


def edge_rows():
    rows = [(k, text, "en", f"src{k % 3}", len(text or "")) for k, text in enumerate(EDGE_TEXTS)]
    rows += [(None, "one two three four five six", None, None, None), (3, "one", "en", "src0", 3), (3, "one", "en", "src0", 3)]
    return rows


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df):
    """``df`` with further columns that clash with its own and with operators' names."""
    from pyspark.sql import functions as F

    extra = ["TEXT", "Doc_Id", "size", "score", "fp", "id", "t", "n", "row", "spans", "base", "_text", "position"]
    return df.select("*", *(F.lit(k).alias(name) for k, name in enumerate(extra)))


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fold(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5
