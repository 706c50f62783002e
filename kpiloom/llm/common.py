"""What several operators share: reading, shared tables, words and hashes."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Documents worked on at a time inside a task.
SLICE = 256
#: Bytes up to which a table is broadcast.
SMALL = 48 << 20
#: Words whose hash a task remembers.
REMEMBERED = 300_000

MIX_A = np.uint64(0x9E3779B97F4A7C15)
MIX_B = np.uint64(0xBF58476D1CE4E5B9)
MIX_C = np.uint64(0x94D049BB133111EB)
#: Odd multiplier of the rolling hash over words, modulo 2**64.
BASE = 0xD1342543DE82EF95


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, and where that
    is unset a folder in the warehouse, which they share as well."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    return (base or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared").rstrip("/")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read again. Cuts lineage, and
    a lost executor costs no more than the tasks it was running."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{purpose}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def beside(docs: DataFrame, found: DataFrame, items: str, how: str = "inner") -> DataFrame:
    """``docs`` joined by ``row`` with what was found in them, an array a row.

    What was found is written first, so that its size is known: if it is within
    ``SMALL`` bytes it is broadcast and the texts stay where they are, otherwise
    both sides are shuffled by row."""
    found = stored(found, "found")
    width = 16 if "struct" in dict(found.dtypes)[items] else 8
    size = found.agg(F.coalesce(F.sum(16 + width * F.size(items)), F.lit(0))).first()[0]
    return docs.join(F.broadcast(found) if size <= SMALL else found, "row", how)


def narrow(found: DataFrame, purpose: str) -> DataFrame:
    """Rows of a few numbers, written, and broadcast by the next join if they are
    within ``SMALL`` bytes."""
    found = stored(found, purpose)
    return F.broadcast(found) if found.count() * 8 * len(found.columns) <= SMALL else found


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once for the row, however often
    the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


class WordHashes(dict):
    """64-bit hashes by word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = value
        return value


_HASHES = WordHashes()


def words_of(text: str | None, lower: bool) -> list[bytes]:
    """Words between ASCII white space (0x09-0x0D, 0x20) as UTF-8; only A-Z are
    lower-cased. A null text has none."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    z = values + MIX_A
    z = (z ^ (z >> np.uint64(30))) * MIX_B
    z = (z ^ (z >> np.uint64(27))) * MIX_C
    return z ^ (z >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    # Doubling: the hash of a run of 2k words comes from two runs of k.
    done, at, power = None, 0, BASE
    block, size = hashes, 1
    left = width
    while left:
        if left & 1:
            part = block[at : at + n]
            done = part.copy() if done is None else done * np.uint64(power) + part
            at += size
        left >>= 1
        if left:
            block = block[:-size] * np.uint64(power) + block[size:]
            size *= 2
            power = power * power % 2**64
    return mixed(done)


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in small parts, so that a task holds few texts at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


def ragged(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """An Arrow list array from one numpy array per row."""
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    flat = np.concatenate(parts) if parts else np.empty(0)
    if flat.dtype == np.uint64:
        flat = flat.view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))
