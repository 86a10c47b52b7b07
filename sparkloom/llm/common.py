"""What the operators of this folder share: reading tables, mapping texts in Arrow batches, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import scratch_path

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_MEMORIES: list[tuple[str, dict]] = []


def memory(operator: str) -> dict:
    """A dictionary in which an operator keeps what it has worked out, for the next tasks of its Python worker."""
    _MEMORIES.append((operator, {}))
    return _MEMORIES[-1][1]


def forget_others(operator: str) -> None:
    """Empty the memories of all other operators: workers live on from one operator to the next."""
    for name, held in _MEMORIES:
        if name != operator:
            held.clear()


def map_texts(df: DataFrame, columns: list[str], schema: T.StructType,
              rows: Callable[[list[pa.Array], list], list], operator: str = "") -> DataFrame:
    """Apply ``rows(kept columns, texts)`` to Arrow batches; ``operator`` is the one whose memories it uses.

    The last of ``columns`` is the text. ``rows`` gets an Arrow array per other
    column and the list of texts (None for null) and returns a list or an Arrow
    array per output column.
    """
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(operator)
        for batch in batches:
            if batch.num_rows:
                kept = [batch.column(i) for i in range(batch.num_columns - 1)]
                made = rows(kept, batch.column(batch.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [(x if x.type == f.type else x.cast(f.type)) if isinstance(x, pa.Array) else pa.array(x, f.type)
                     for x, f in zip(made, out, strict=True)], schema=out)

    return df.select(*[df[c] for c in columns]).mapInArrow(run, schema)


def filter_texts(df: DataFrame, text_col: str, keep: Callable[[list], list[bool]], operator: str = "") -> DataFrame:
    """The rows whose text ``keep`` marks, all columns as they were; decided in the scan, nothing is shuffled."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(operator)
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(keep(batch.column(at).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, which cuts its lineage.

    The plan that made it is garbage afterwards; a collection lets Spark's cleaner
    remove its shuffle files before the next step writes its own.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    spark.sparkContext._jvm.System.gc()
    return out


def discard(*frames: DataFrame) -> None:
    """Delete stored frames that no later step reads."""
    for frame in frames:
        jvm, context = frame.sparkSession.sparkContext._jvm, frame.sparkSession.sparkContext._jsc
        path = jvm.org.apache.hadoop.fs.Path(frame._stored_at)
        path.getFileSystem(context.hadoopConfiguration()).delete(path, True)


#: Words of 64 bits in which ``likely`` marks keys: 16.8 million bits, whatever the number of keys.
MARK_WORDS = 1 << 18


def likely(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose key is in ``wanted``, and by chance a few others; only marks are sent, nothing is shuffled.

    Meant for rows that are long or many before a join on the key. A bit stands for
    all keys of one hash, so n keys let n / 16.8 million of the other rows pass.
    """
    spot = F.xxhash64(key)
    word, bit = spot.bitwiseAND(MARK_WORDS - 1), F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(xxhash64(`{key}`), 58) AS INT))")
    marks = wanted.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    spotted = df.withColumns({"__word": word, "__bit": bit})
    found = (F.col("__word") == F.col("_word")) & (F.col("_bits").bitwiseAND(F.col("__bit")) != 0)
    return spotted.join(F.broadcast(marks), found, "left_semi").drop("__word", "__bit")


def components(edges: DataFrame, label: str, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs, a != b): rows (node, root), root the smallest node.

    Alternates the star contractions of Kiveris et al. (2014). Each round is
    written to the shared folder, so lineage stays short and lost executors cost
    one round at most. A node with many neighbours is pre-aggregated by the
    group-by and split by the skew join. Nodes without an edge do not occur.
    """
    now = store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .where("a <> b").distinct(), label)
    before = None
    for _ in range(rounds):
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small, "a")
        step = (joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                .union(small.select("a", F.col("m").alias("b"))).distinct())
        last, now = now, store(step, label)
        discard(last)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before:
            break
        before = seen
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
