"""Helpers the operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from martflow.session import configure

# A key above this share of all rows is hot. At most 1 / share keys can be,
# which bounds the broadcast of their lookup rows.
HOT_KEYS = 256

# A written list of ids, or of a few numbers per id, up to this many rows is
# broadcast; a longer one is joined by shuffle. Both give the same rows.
BROADCAST_IDS = 1_000_000

WORD = re.compile(r"\w+")


def join_per_key(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], weight: str, total: int
) -> DataFrame:
    """Left join to a table with one row per key, with no task holding a hot key.

    ``weight`` is a lookup column with the number of ``rows`` of that key and
    ``total`` the number of all rows. Keys with more than ``total / HOT_KEYS``
    rows, ``HOT_KEYS`` at most, are joined by broadcast; the others by shuffle,
    where none can be large. Keys must not be null.
    """
    hot = lookup.filter(F.col(weight) * HOT_KEYS > total)
    cold = lookup.filter(F.col(weight) * HOT_KEYS <= total)
    keys = list(keys)
    marked = rows.join(F.broadcast(hot.select(*keys, F.lit(True).alias("_hot"))), keys, "left")
    of_hot = marked.filter(F.col("_hot")).drop("_hot").join(F.broadcast(hot), keys)
    of_cold = marked.filter(F.col("_hot").isNull()).drop("_hot").join(cold, keys, "left")
    return of_hot.unionByName(of_cold)


def by_ids(docs: DataFrame, ids: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Join ``docs`` to ``ids``, a written table, on ``key``: by broadcast while
    that has at most ``BROADCAST_IDS`` rows, else by shuffle. Rows are the same."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, key, how)


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id's text leaves 2 on division by 4.

    A null id has no text and is never held out.
    """
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))




def map_batches(rows: DataFrame, make: Callable, schema: str) -> DataFrame:
    """Apply Arrow-batched Python to ``rows``.

    ``make()`` runs once per task and returns a function from a dict of column
    lists to a dict of column lists, or an iterator of such dicts. If that
    function has an attribute ``last``, its dict is sent at the task's end.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        work = make()
        for batch in batches:
            made = work(batch.to_pydict())
            for columns in [made] if isinstance(made, dict) else made:
                yield pa.RecordBatch.from_pydict(columns, schema=arrow)
        if hasattr(work, "last"):
            yield pa.RecordBatch.from_pydict(work.last(), schema=arrow)

    return rows.mapInArrow(run, schema)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators: small Arrow batches, as texts may be long."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return spark


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))
