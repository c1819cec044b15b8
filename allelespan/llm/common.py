"""Words, shingle hashes and staged tables shared by the operators."""

from __future__ import annotations

import io
import re
import zipfile
from pathlib import Path

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelespan.session import new_path

WORD = r"[^\x20\x09-\x0D]+"
find_words = re.compile(r"[^ \t-\r]+").findall
SHINGLE = 5
#: Bytes of rows that a Python worker gets at a time.
BATCH_BYTES = 4 << 20
#: Rows that a Parquet reader decodes at a time; texts are long, the usual 4,096 of them are large arrays.
READ_ROWS = 512
_SIZES = {"spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES, "spark.sql.parquet.columnarReaderBatchSize": READ_ROWS}
_MULT = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_columns(*more: str) -> list[Column]:
    """``doc_id`` with 0 for null, ``no_id`` and ``more``: pandas would make numbers of 53 bits of a column with nulls."""
    return [F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), *map(F.col, more)]


def ids_of(frame: pd.DataFrame) -> pd.arrays.IntegerArray:
    return pd.arrays.IntegerArray(frame.doc_id.to_numpy(np.int64), frame.no_id.to_numpy(bool))


class Stage:
    """Tables written to the shared folder of ``spark.checkpoint.dir`` so that a lost executor costs
    a re-read, not a re-run. ``drop`` deletes those that nothing reads any more."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, name)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            self._delete(self.paths.pop(id(df)))

    def drop_others(self, *frames: DataFrame) -> None:
        """Delete all tables written here but those of ``frames``."""
        kept = {self.paths[id(df)] for df in frames}
        for key, path in list(self.paths.items()):
            if path not in kept:
                del self.paths[key]
                self._delete(path)

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class WordHashes(dict):
    """64-bit hash by word (its UTF-8 bytes), remembered for up to ``limit`` words."""

    limit = 50_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


HASHES = WordHashes()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values (multiply and xor-shift rounds)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of ``text``, A-Z lower-cased.

    With fewer than ``size`` words the whole sequence is one shingle; without words none.
    """
    # of bytes, lower() changes A-Z only and split() parts at the six white space characters of WORD
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - size + 1)
    acc = np.full(n, np.uint64(len(words) if len(words) < size else size))
    for k in range(min(size, len(h))):
        acc = mix64(acc * _MULT + h[k : k + n])
    return np.unique(acc)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, through the shared folder.

    Functions that run in tasks are imported by name there. They get rows in batches of about
    ``BATCH_BYTES``, however long the texts are, and files are read ``READ_ROWS`` rows at a time, unless
    the application sets sizes of its own.
    """
    context = spark.sparkContext
    for name, value in _SIZES.items():
        if not context.getConf().contains(name):
            spark.conf.set(name, value)
    if getattr(context, "_allelespan_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, f"{root.name}/{file.relative_to(root)}")
    path = f"{new_path(spark, root.name)}.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    stream.write(bytearray(data.getvalue()))
    stream.close()
    context.addPyFile(path)
    context._allelespan_shipped = True
