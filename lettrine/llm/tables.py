"""Reading tables, cutting lineage and walking Arrow batches in bounded slices."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; only where that is unset (as in tests) a folder beside the warehouse."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def settled(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder, so that a lost executor costs no recomputation."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table of the shared folder; its column files are smaller than a checkpoint's rows.

    The table stays until the folder is cleared, as other jobs' checkpoints do.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def given_back() -> None:
    """Memory that a worker has freed goes back to the system: Spark keeps workers, and the next task may be another's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not the GNU library
        pass


def lean(run: Callable) -> Callable:
    """The same function over batches; at its end the task's memory is given back."""

    def inner(batches):
        try:
            yield from run(batches)
        finally:
            given_back()

    return inner


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or one like it, that no column of the table has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


#: Keys that hold more than one row in HOT are fewer than HOT; their rows are dealt to SALTS tasks.
HOT, SALTS = 256, 64


def with_totals(rows: DataFrame, totals: DataFrame, key: str, spread: str) -> DataFrame:
    """``rows`` with the other columns of ``totals``, which has one row a key and ``n``, the key's number of rows; NULL where it has none.

    Nulls are a key as any other. The frequent keys, fewer than HOT, are sent to all
    tasks as names only; their rows are dealt by ``spread`` too, and their totals
    repeated for each share. Neither side is broadcast, as both may grow.
    """
    totals = settled(totals)
    count = totals.agg(F.sum("n")).first()[0] or 0
    hot = totals.where(F.col("n") * HOT > count).select(F.col(key).alias("_k"), F.lit(True).alias("_hot"))
    dealt = rows.join(F.broadcast(hot), rows[key].eqNullSafe(hot["_k"]), "left")
    dealt = dealt.withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(SALTS))).otherwise(0).cast("int"))
    names = [c for c in totals.columns if c not in (key, "n")]
    shares = F.when(F.col("n") * HOT > count, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    spread_out = totals.select(F.col(key).alias("_key"), *names, F.explode(shares).alias("_share")).hint("merge")
    return dealt.join(spread_out, dealt[key].eqNullSafe(spread_out["_key"]) & (dealt["_salt"] == spread_out["_share"]), "left").select(*rows.columns, *names)


def slot_of(key: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots))


def bitmap(keys: DataFrame, key: str, slots: int, given: bool = False) -> bytes:
    """A bit for each slot that a key has, or is if ``given``: ``slots`` / 8 bytes, built by Spark in pieces of 4 KB."""
    slot = (F.col(key) if given else slot_of(F.col(key), slots)) + 1
    out = np.zeros(slots // 8, np.uint8)
    for r in keys.groupBy(F.bitmap_bucket_number(slot).alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).toLocalIterator():
        piece = np.frombuffer(r["bits"], np.uint8)
        out[(r["n"] - 1) * len(piece) :][: len(piece)] |= piece
    return out.tobytes()


def set_bits(bits: bytes, slots: np.ndarray) -> np.ndarray:
    return (np.frombuffer(bits, np.uint8)[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 > 0


def slices(batches, names: list[str], chars: int = 1 << 18) -> Iterator[list[list]]:
    """Columns of the Arrow batches as lists, in slices of about ``chars`` characters of the last named column.

    A slice holds at least one row, so a single very long text makes a slice
    of its own.
    """
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
        size, start = 0, 0
        lengths = columns[-1].nbytes // max(1, batch.num_rows)
        step = max(1, min(batch.num_rows or 1, 64, chars // max(1, lengths)))
        at = 0
        while at < batch.num_rows:
            n = min(step, batch.num_rows - at)
            size += columns[-1].slice(at, n).nbytes
            at += n
            if size >= chars or at == batch.num_rows:
                yield [c.slice(start, at - start).to_pylist() for c in columns]
                size, start = 0, at
