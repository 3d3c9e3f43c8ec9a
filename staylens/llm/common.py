"""Small helpers that the operators share: words, ids and staged tables."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def runs_in_tasks(module: str) -> None:
    """Send the functions of ``module`` to Python tasks by value, so that executors need not have
    this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


runs_in_tasks(__name__)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, _UPPER, _UPPER.lower())


def cut_at_spaces(text: Column) -> Column:
    """The text cut at each space and control 9 to 13; neighbouring ones leave empty strings. Replacing
    and cutting at one plain character takes half the time of cutting at a pattern."""
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.split(text, " ")


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(cut_at_spaces(text), "")


def let(value: Column, body) -> Column:
    """``body`` applied to ``value``, which is evaluated once per row however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def id_crc32(col: str = "doc_id") -> Column:
    """crc32 of an id as text; NULL for a NULL id."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def bytes_words(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8. ``bytes.split`` splits at exactly the characters that end a word."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def sorted_distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values. By a plain sort, which takes a small part of np.unique's time."""
    s = np.sort(values)
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session. Only a
    local master may go without it and then gets a temporary folder."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not re.match(r"local(\[|$)", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="staylens-"))
    return sc.getCheckpointDir().rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: computed once, its lineage cut,
    and safe from lost executors. The files go when the application ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staylens/{uuid.uuid4().hex}-{name}"
    df.write.parquet(path)
    goes_with_application(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def goes_with_application(spark: SparkSession, path: str) -> None:
    """Delete a folder when the application ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


def unique_name(taken: list[str], name: str) -> str:
    """``name``, with underscores in front until no column of ``taken`` has it (case apart)."""
    low = {x.lower() for x in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def rows_that_pass(docs: DataFrame, results: list[str], judge) -> DataFrame:
    """Rows of ``docs``, with its own columns, that ``judge`` keeps. Columns of ``docs`` named like
    one of the ``results`` that judge adds are put aside meanwhile."""
    taken = {r.lower() for r in results}
    aside = {c: unique_name([*docs.columns, *results], c) for c in docs.columns if c.lower() in taken}
    kept = judge(docs.withColumnsRenamed(aside))
    return kept.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])
