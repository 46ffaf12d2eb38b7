"""Words, batches and digests shared by the text operators."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

import starwise

SLICE = 256

# A word is a run of digits, ASCII letters and code points beyond ASCII; A-Z are lower-cased.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text; a null text has none."""
    return text.translate(_WORD_BYTES).split() if text else []


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    context = spark.sparkContext
    if getattr(context, "_starwise_shipped", None) is None:
        package = Path(starwise.__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="starwise-")  # only read by the driver, which serves the file
        archive = Path(folder) / "starwise.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        context._starwise_shipped = archive


_FORGET: dict[str, Callable[[], None]] = {}


def keep(owner: str, forget: Callable[[], None]) -> None:
    """Say how to drop what the module ``owner`` keeps in a worker between its tasks."""
    _FORGET[owner] = forget


def begin_task(owner: str) -> None:
    """Workers are used again by other operators: drop what those before this one have kept."""
    for name, forget in _FORGET.items():
        if name != owner:
            forget()


def end_task() -> None:
    """Give memory that is free again back to the system, as the next task may be another worker's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_batches(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType, owner: str = ""
) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors.

    ``owner`` is the operator's module; a worker keeps only what that one keeps.
    """
    ship(df.sparkSession)
    owner = owner or run.__module__

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task(owner)
        yield from run(batches)
        end_task()

    return df.mapInArrow(task, schema)


def map_slices(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType) -> DataFrame:
    """Run ``work`` over slices of at most 256 rows, so that long texts do not pile up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                yield work(batch.slice(start, SLICE))

    return map_batches(df, run, schema, work.__module__)


def row_schema(df: DataFrame, key: str, rest: str) -> StructType:
    """The key column as it is in ``df``, then the columns of a DDL string."""
    return StructType([df.schema[key], *StructType.fromDDL(rest).fields])


def held_out(doc_id: int | None) -> bool:
    """True for the fifth of the rows that no classifier learns from."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 0


class WordHashes(dict):
    """64-bit hash per word, kept for the words met so far; ``trim`` bounds what is kept."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def trim(self, most: int = 400_000) -> None:
        if len(self) > most:
            self.clear()

    def array(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


WORD_HASHES = WordHashes()
keep("starwise.llm.ngram_join", WORD_HASHES.clear)
