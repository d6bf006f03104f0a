r"""Line deduplication over levelled sorted runs of line hashes.

The store keeps each known line key once, as a 128-bit hash with its first
owner, in runs that are bucketed and sorted by the hash.  Batches arrive in the
order of their ids.  A batch reduces its lines to one row per key (the smallest
id), merge-anti-joins every run (runs are bucketed by the join's key, so that they
need not be shuffled), and adds what is left as a new run of level 0.  ``fan_in`` runs
of a level are compacted into one of the next, so there are logarithmically many
runs to join.  A line stays where its document owns its key.

Hot lines are harmless: keys are reduced by a partial aggregate, and the
remaining join has one row per key on the run's side.  Only hashes and places
move by key; the texts are joined once, by document, with the lines they lose.

Rows: one result row per row of the documents (a null or empty text is one empty
line; rows that repeat an id are one document).  A null id counts as larger than
any other, and all rows with a null id as one document.  Lines whose key is
shorter than ``min_chars`` always stay.  Ids may be numbers, texts or days: batches are
ranges of their order.  Texts of any length are split whole.  An empty table gives an empty
result.  Extra columns, whatever their names, are ignored by ``line_dedup`` and carried
along by ``without_repeated_lines``.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.native import BLANKS, ascii_lower, let
from tidemark.llm.store import stored
from tidemark.session import shared_dir

MIN_CHARS = 10
BATCHES = 4
FAN_IN = 2
HASH = ["h1", "h2"]


class LineRuns:
    """The levelled store of line hashes: (h1, h2, owner), each key once."""

    def __init__(self, spark: SparkSession, fan_in: int = FAN_IN, buckets: int | None = None):
        self.spark, self.fan_in = spark, fan_in
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.path = shared_dir(spark, "line-runs")
        self.levels: list[list[str]] = []
        self.names: list[str] = []

    def forget(self) -> None:
        """Take the runs out of the session's catalog; their files stay below ``path``."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _write(self, keys: DataFrame, level: int) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.names.append(name)
        keys.repartition(self.buckets, *HASH).write.bucketBy(self.buckets, *HASH).sortBy(*HASH) \
            .option("path", f"{self.path}/level-{level}/{name}").format("parquet").saveAsTable(name)
        return name

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch of (h1, h2, owner) rows; returns the keys that it owns, its new run."""
        fresh = lines.groupBy(*HASH).agg(F.min("owner").alias("owner"))
        for name in self.runs():
            fresh = fresh.join(self.spark.table(name).select(*HASH).hint("merge"), HASH, "left_anti")
        own = self._write(fresh, 0)
        result = self.spark.table(own)
        self._file(own, 0)
        return result

    def _file(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fan_in:
            merged = self.spark.table(self.levels[level][0])
            for other in self.levels[level][1:]:
                merged = merged.union(self.spark.table(other))
            compact = self._write(merged, level + 1)
            self.levels[level] = []
            self._file(compact, level + 1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _owner() -> Column:
    """Orders documents by id, null last."""
    return F.struct(F.col("id").isNull().alias("unknown"), F.col("id").alias("id"))


def _lines(documents: DataFrame, min_chars: int) -> DataFrame:
    split = documents.select("id", F.xxhash64("text").alias("text_hash"),
                             F.posexplode_outer(F.split("text", "\n")).alias("at", "line"))
    keyed = split.select("id", "text_hash", "at", line_key(F.col("line")).alias("key")) \
        .where(F.length("key") >= min_chars)
    return keyed.select(_owner().alias("owner"), "text_hash", "at", F.xxhash64("key").alias("h1"),
                        F.xxhash64(F.length("key"), F.reverse("key")).alias("h2"))


def _rank_of(ids: DataFrame) -> Column:
    """A number that ascends with the id: the id itself or, for one that is no number, the
    seven bytes of its text behind what the smallest and the largest id begin with alike."""
    if isinstance(ids.schema["id"].dataType, T.NumericType):
        return F.col("id")
    ends = ids.agg(F.min("id").cast("string"), F.max("id").cast("string")).first()
    shared = len(os.path.commonprefix([e.encode() for e in ends])) if ends[0] is not None else 0
    part = F.substring(F.encode(F.col("id").cast("string"), "utf-8"), shared + 1, 7)
    return F.conv(F.rpad(F.hex(part), 14, "0"), 16, 10).cast("bigint")


def _batch_of(documents: DataFrame, batches: int) -> Column:
    """The batch of a row: ranges of ids of about equal numbers of rows, in ascending
    order.  Equal ids are in one batch."""
    bounds, rank = [], F.lit(0)
    if batches > 1:
        rank = _rank_of(documents)
        shares = F.array(*(F.lit(k / batches) for k in range(1, batches)))
        bounds = documents.agg(F.percentile_approx(rank, shares, 1000)).first()[0] or []
    number = F.lit(0)
    for bound in sorted(set(bounds)):
        number = number + F.when(rank > bound, 1).otherwise(0)
    return F.when(F.col("id").isNull(), len(set(bounds))).otherwise(number)


def dropped_lines(documents: DataFrame, min_chars: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """(id, text_hash, dropped): the sorted positions of the lines that each text loses."""
    spark = documents.sparkSession
    lines = stored(_lines(documents, min_chars).withColumn("id", F.col("owner.id"))
                   .withColumn("batch", _batch_of(documents, batches)).drop("id"), "line-hashes")
    store, lost = LineRuns(spark), None
    try:
        for number in range(batches):
            batch = lines.where(F.col("batch") == number)
            own = store.add(batch.select(*HASH, "owner"))
            kept = own.select(*HASH, F.struct(F.col("owner.unknown"), F.col("owner.id")).alias("owner"))
            out = batch.join(kept.hint("merge"), [*HASH, "owner"], "left_anti").select("owner", "text_hash", "at")
            lost = out if lost is None else lost.union(out)
        lost = stored(lost, "lines-lost")
    finally:
        store.forget()
    places = lost.distinct().groupBy("owner", "text_hash").agg(F.sort_array(F.collect_list("at")).alias("dropped"))
    return places.select(F.col("owner.id").alias("id"), "text_hash", "dropped")


def _kept(text: Column, dropped: Column) -> Column:
    """The text without the lines at the (sorted) positions ``dropped``."""
    flags = let(dropped, lambda d: F.flatten(F.transform(d, lambda p, i: F.concat(
        F.array_repeat(F.lit(False), p - F.coalesce(F.get(d, i - 1), F.lit(-1)) - 1), F.array(F.lit(True))))))
    return F.when(dropped.isNull(), text).otherwise(let(flags, lambda f: F.array_join(F.filter(
        F.split(text, "\n"), lambda line, i: ~F.coalesce(F.get(f, i), F.lit(False))), "\n")))


def _joined(rows: DataFrame, min_chars: int, batches: int) -> DataFrame:
    """``rows`` (with id and text, never null) and the positions that each text loses."""
    lost = dropped_lines(rows.select("id", "text"), min_chars, batches) \
        .select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("dropped").alias("_dropped"))
    return rows.join(lost, F.col("id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left")


def line_dedup(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
               batches: int = BATCHES) -> DataFrame:
    """Per row: ``n_lines``, ``n_dropped`` and the ``kept`` text."""
    rows = documents.select(F.col(id_col).alias("id"),
                            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    joined = _joined(rows, min_chars, batches)
    return joined.select(F.col("id").alias(id_col), F.size(F.split("text", "\n")).cast("long").alias("n_lines"),
                         F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                         _kept(F.col("text"), F.col("_dropped")).alias("kept"))


def without_repeated_lines(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           chars_col: str | None = "n_chars", min_chars: int = MIN_CHARS,
                           batches: int = BATCHES) -> DataFrame:
    """The documents, in all their columns, without the lines that another one owns;
    a document that loses all its words to others goes."""
    columns = documents.columns
    rows = documents.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_row")) \
        .select("_row", F.col("_row")[id_col].alias("id"),
                F.coalesce(F.col("_row")[text_col].cast("string"), F.lit("")).alias("text"))
    left = F.struct(F.col("_dropped").isNull().alias("whole"), _kept(F.col("text"), F.col("_dropped")).alias("text"))
    some = F.filter(F.array(left), lambda x: x["whole"] | x["text"].rlike(r"[^\x20\x09-\x0D]"))
    kept = _joined(rows, min_chars, batches).select("_row", F.explode_outer(some).alias("_left")) \
        .where(F.col("_left").isNotNull()).select("_row", F.col("_left.text").alias("_kept"))
    new = {text_col: F.col("_kept")}
    if chars_col in columns:
        new[chars_col] = F.length("_kept").cast(documents.schema[chars_col].dataType)
    return kept.select(*(new.get(c, F.col("_row")[c]).alias(c) for c in columns))
