"""What several operators need: intermediate tables in the shared folder, words of a text."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which the driver and all executors see.

    A local session without that setting gets a temporary folder. On a cluster a missing setting is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", "") or context.getConf().get("spark.checkpoint.dir", "")
    folder = folder or context.getCheckpointDir() or ""
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _LOCAL.setdefault(context.applicationId, tempfile.mkdtemp(prefix="natalis-shared-"))


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/natalis-{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of at most 8 MB, so that a worker holds little beside its own tables.

    This is a setting of the session and does not change results. A smaller number that the session has set stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def remainder_of_id(column: str | Column = "doc_id", modulus: int = 5) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``. A NULL id counts as the empty text."""
    column = F.col(column) if isinstance(column, str) else column
    text = F.coalesce(column.cast("string"), F.lit(""))
    return F.crc32(text) % modulus


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 bytes of the words, split at space, tab, newline, vertical tab, form feed and return."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lowered_words_of(text: str | None) -> list[bytes]:
    """As ``words_of`` with A-Z, and only these, in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordCodes(dict):
    """64-bit codes of words; those of short words are kept, a bounded number of them."""

    WORDS, BYTES = 200_000, 64

    def __missing__(self, word: bytes) -> int:
        code = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= self.BYTES:
            if len(self) >= self.WORDS:
                self.clear()
            self[word] = code
        return code


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers, each bit of the result depending on all bits."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))
