"""Removal of passages that a document with a smaller id has already.

A window is ``window`` consecutive words of one document.  Every window gets a
Rabin-Karp hash (a polynomial over 64-bit word hashes, from prefix sums), and Spark
counts them: a window whose words also start in a document with a smaller id is
removed, and removed windows that touch or overlap merge into maximal intervals.

What is shuffled.  A window's *anchor* is the smallest hash of the ``GRAM``-word
pieces inside it.  Equal windows have equal anchors, and neighbouring windows mostly
share theirs, so a run of windows travels as one row: anchor, document, first place
and the hashes, close to eight bytes a window.  Rows meet by anchor; those whose
anchor only one document has are dropped before the windows are unpacked.  Two windows
count as equal if both the anchor and the hash are equal, 128 bits in all.

Hot passages.  Inside a block of texts, a window is settled at once for all documents
but the smallest: their rows are marked and spread, so that a passage that a third of
all documents hold sends one row a block to its anchor.  Anchors that hold over one
part in ``SHARES`` of all rows (a common phrase in ever other surroundings) are found
beforehand, at most ``SHARES`` of them; their windows travel one by one, by their own
hash.

Rows: one per row of the input.  A null text has no words.  A row with a null id
stays whole and removes nothing.  Rows that repeat an id are one document to each
other: they remove nothing from one another and the same from all later ones.  Texts
of fewer words than a window stay whole; a text is processed whole, whatever its
length.  An empty table gives an empty result.  Only the id and the text column are
read, so other columns may have any name; ``without_repeated_passages`` keeps them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.store import ship_package, stored
from tidemark.llm.textblocks import SPACED, blocks, hashes, mix, raw, strings, words

WINDOW = 50
#: Words of the pieces that anchors are taken from.
GRAM = 16
#: An anchor with more than this part of all rows is hot.
SHARES = 4096
#: Windows in one row at most (a text that repeats one line has very long runs).
RUN = 4096
#: Text that is hashed at once.
BLOCK_BYTES = 5 << 20
_BASE = 0xD1342543DE82EF95
_U = np.uint64


def rolling(values: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hashes, modulo 2^64, of all runs of ``size`` values."""
    n = len(values)
    if n < size:
        return np.zeros(0, _U)
    # values times ascending powers, summed; a window's difference is scaled to one power
    up = np.cumprod(np.concatenate([[_U(1)], np.full(n - 1, _BASE, _U)]), dtype=_U)
    sums = np.concatenate([[_U(0)], np.cumsum(values * up, dtype=_U)])
    down = np.cumprod(np.concatenate([[_U(1)], np.full(n - size, pow(_BASE, -1, 1 << 64), _U)]), dtype=_U)
    return mix((sums[size:] - sums[:-size]) * down)


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of every ``size`` consecutive values."""
    reach = 1
    while 2 * reach <= size:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = size - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _windows(texts: pa.StringArray, window: int, gram: int):
    """(place in the block, document, hash, anchor) of all windows inside a document,
    and the start of each document."""
    flat, offsets = words(texts, SPACED)
    own = hashes(flat)
    offsets = offsets.astype(np.int64)
    if len(own) < window:
        none = np.zeros(0, np.int64)
        return none, none, none.view(_U), none.view(_U), offsets
    hashed = rolling(own, window)
    anchor = sliding_min(rolling(own, gram), window - gram + 1)
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    inside = np.flatnonzero(doc[:len(hashed)] == doc[window - 1:])
    return inside, doc[inside], hashed[inside], anchor[inside], offsets


def _ranks(column: pa.Array) -> np.ndarray:
    """Dense ranks of the ids of a block; equal ids are equal."""
    return pc.rank(column, sort_keys="ascending", tiebreaker="dense").to_numpy().astype(np.int64)


def _common_anchors(documents: DataFrame, window: int, gram: int) -> np.ndarray:
    """Anchors of more than one part in ``SHARES`` of all runs, at most ``SHARES``.
    A block reports those that two or more of its documents hold and its number of runs."""

    def run(batches):
        for batch in batches:
            for part in blocks(batch, 1, BLOCK_BYTES):
                _, doc, _, anchor, _ = _windows(strings(part.column(1)), window, gram)
                if not len(anchor):
                    continue
                fresh = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]))
                keys, counts = np.unique(anchor[fresh], return_counts=True)
                keep = counts > 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(keys[keep].view(np.int64), 0)), pa.array(np.append(counts[keep], 0)),
                     pa.array(np.append(np.zeros(keep.sum(), np.int64), len(fresh)))], names=["key", "n", "runs"])

    counted = stored(documents.mapInArrow(run, "key bigint, n bigint, runs bigint")
                     .groupBy("key").agg(F.sum("n").alias("n"), F.sum("runs").alias("runs")), "anchors")
    total = counted.agg(F.sum("runs")).first()[0] or 0
    hot = counted.where(F.col("n") * SHARES > total).select("key").collect()  # at most SHARES rows
    return np.sort(np.array([r["key"] for r in hot], np.int64).view(_U))


def _runs(part: pa.RecordBatch, window: int, gram: int, hot: np.ndarray) -> pa.RecordBatch:
    """The windows of a block as rows (key, settled, id, text_key, first, hashes).  Of rows
    that are equal in id and text, one speaks for all."""
    text_key = part.column(2).to_numpy()
    part = part.take(pa.array(np.unique(text_key, return_index=True)[1]))
    text_key = part.column(2).to_numpy()
    place, doc, hashed, anchor, offsets = _windows(strings(part.column(1)), window, gram)
    key = anchor.copy()
    single = np.zeros(len(key), bool)
    if len(hot) and len(key):
        at = np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)
        single = hot[at] == anchor
        key[single] = mix(anchor[single] ^ hashed[single])
    settled = np.zeros(len(key), bool)
    if len(key):
        # documents in order of ids: all but the smallest id of a window are settled here
        rank = _ranks(part.column(0))[doc]
        whole = mix(anchor ^ mix(hashed))
        order = np.lexsort((rank, whole))
        first = np.concatenate([[True], whole[order][1:] != whole[order][:-1]])
        least = rank[order][np.flatnonzero(first)][np.cumsum(first) - 1]
        settled[order] = rank[order] > least
    # a settled row only needs to reach its document
    key = np.where(settled, mix(text_key[doc].view(_U) ^ place.view(_U) // _U(RUN)), key)
    index = np.arange(len(key))
    cut = np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | (settled[1:] != settled[:-1])]) \
        if len(key) else np.zeros(0, bool)
    start = np.flatnonzero(cut)
    since = index - np.repeat(start, np.diff(np.append(start, len(key))))
    start = np.flatnonzero(cut | (since % RUN == 0))
    lists = pa.ListArray.from_arrays(pa.array(np.append(start, len(key)), pa.int32()), pa.array(hashed.view(np.int64)))
    return pa.RecordBatch.from_arrays(
        [pa.array(key[start].view(np.int64)), pa.array(settled[start]), part.column(0).take(pa.array(doc[start])),
         pa.array(text_key[doc[start]]), pa.array(place[start] - offsets[doc[start]]), lists],
        names=["key", "settled", "id", "text_key", "first", "hashes"])


def _merged(window: int):
    """Sorted window places of a document -> maximal intervals of its words."""

    def run(batches):
        spans = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64())]))
        for batch in batches:
            lists = batch.column(2)
            places = lists.flatten().to_numpy()
            sizes = np.diff(lists.offsets.to_numpy())
            doc = np.repeat(np.arange(len(sizes)), sizes)
            opens = np.ones(len(places), bool)
            opens[1:] = (doc[1:] != doc[:-1]) | (places[1:] > places[:-1] + window)
            closes = np.append(opens[1:], True) if len(opens) else opens
            counts = np.bincount(doc[opens], minlength=len(sizes))
            struct = pa.StructArray.from_arrays([pa.array(places[opens]), pa.array(places[closes] + window)],
                                                names=["first_word", "end_word"])
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, struct).cast(spans)],
                names=["id", "text_key", "spans"])

    return run


SPANS = "array<struct<first_word:bigint,end_word:bigint>>"


def repeated_passages(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                      gram: int = GRAM) -> DataFrame:
    """Per document with something to remove (id, text_key = xxhash64 of id and text): the
    maximal ``spans`` of words, ascending, first word included and end word not."""
    if not 1 <= gram <= window:
        raise ValueError("gram must lie between 1 and window")
    spark = documents.sparkSession
    ship_package(spark)
    source = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
        .where("id IS NOT NULL AND text IS NOT NULL").withColumn("text_key", F.xxhash64("id", "text"))
    id_type = source.schema["id"].dataType
    hot = _common_anchors(source, window, gram)

    def run(batches):
        for batch in batches:
            for part in blocks(batch, 1, BLOCK_BYTES):
                yield _runs(part, window, gram, hot)

    schema = T.StructType([
        T.StructField("key", T.LongType()), T.StructField("settled", T.BooleanType()), T.StructField("id", id_type),
        T.StructField("text_key", T.LongType()), T.StructField("first", T.LongType()),
        T.StructField("hashes", T.ArrayType(T.LongType()))])
    by_key, by_window = Window.partitionBy("key"), Window.partitionBy("key", "settled", "hash")
    shared = source.mapInArrow(run, schema).repartition("key") \
        .withColumn("low", F.min("id").over(by_key)).withColumn("high", F.max("id").over(by_key)) \
        .where("settled OR low < high")
    each = shared.select("key", "settled", "id", "text_key", "first", F.posexplode("hashes").alias("k", "hash")) \
        .withColumn("least", F.min("id").over(by_window)).where("settled OR least < id")
    places = each.groupBy("id", "text_key").agg(F.sort_array(F.collect_set(F.col("first") + F.col("k"))).alias("places"))
    merged = T.StructType([T.StructField("id", id_type), T.StructField("text_key", T.LongType()),
                           T.StructField("spans", T._parse_datatype_string(SPANS))])
    return stored(places.mapInArrow(_merged(window), merged), "passages")


def _marked(texts: pa.StringArray, spans: pa.Array) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """(all words, each document's offsets, whether a word is removed)."""
    flat, offsets = words(texts, SPACED)
    lists = spans.flatten()
    sizes = np.diff(spans.offsets.to_numpy()) if len(spans) else np.zeros(0, np.int64)
    base = np.repeat(offsets[:-1], sizes)
    change = np.zeros(len(flat) + 1, np.int64)
    np.add.at(change, base + lists.field(0).to_numpy(), 1)
    np.add.at(change, base + lists.field(1).to_numpy(), -1)
    return flat, offsets, np.cumsum(change[:-1]) > 0


def _joined(flat: pa.StringArray, offsets: np.ndarray, gone: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The words of each document that stay, joined by one space, and their number."""
    left = flat.filter(pa.array(~gone))
    before = np.concatenate([[0], np.cumsum(~gone)])[offsets]
    starts, data = raw(left)
    spaced = np.full(len(data) + len(left), 0x20, np.uint8)
    if len(data):
        spaced[np.arange(len(data)) + np.repeat(np.arange(len(left)), np.diff(starts))] = data
    at = starts[before].astype(np.int64) + before
    view = spaced.tobytes()
    return [view[a:max(a, b - 1)] for a, b in zip(at[:-1].tolist(), at[1:].tolist())], np.diff(before)


def _applied(documents: DataFrame, id_col: str, text_col: str, window: int, gram: int) -> DataFrame:
    """(_id, _text, _row, _spans) of every row; spans are an empty list where none."""
    spans = repeated_passages(documents, id_col, text_col, window, gram)
    rows = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("_row"))
    rows = rows.select("_row", F.col("_row")[id_col].alias("id"), F.col("_row")[text_col].cast("string").alias("_text"))
    # one plan at every size: the table of spans grows with the documents
    return rows.withColumn("text_key", F.xxhash64("id", "_text")).join(spans.hint("merge"), ["id", "text_key"], "left") \
        .select("_row", F.col("id").alias("_id"), "_text",
                F.coalesce("spans", F.array().cast(SPANS)).alias("_spans"))


def passage_dedup(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                  gram: int = GRAM) -> DataFrame:
    """Per document: ``n_words``, ``n_removed``, ``kept_sha256`` (of the kept words, joined
    by one space, in UTF-8) and the removal ``spans``."""
    spans_type = T._parse_datatype_string(SPANS)
    schema = T.StructType([
        T.StructField(id_col, documents.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType()),
        T.StructField("spans", spans_type)])
    rows = _applied(documents.select(id_col, text_col), id_col, text_col, window, gram).select("_id", "_text", "_spans")

    def run(batches):
        for batch in batches:
            for part in blocks(batch, 1):
                flat, offsets, gone = _marked(strings(part.column(1)), part.column(2))
                texts, left = _joined(flat, offsets, gone)
                n = np.diff(offsets)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(n - left, pa.int64()),
                     pa.array([hashlib.sha256(t).hexdigest() for t in texts]), part.column(2)],
                    names=[f.name for f in schema])

    return rows.mapInArrow(run, schema)


def without_repeated_passages(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                              window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The documents, in all their columns; a text that loses words becomes its other
    words, joined by one space, and any other text stays as it is."""
    columns = documents.columns
    rows = _applied(documents, id_col, text_col, window, gram).select("_row", "_text", "_spans")
    schema = T.StructType([rows.schema["_row"], T.StructField("_new", T.StringType())])

    def run(batches):
        for batch in batches:
            for part in blocks(batch, 1):
                flat, offsets, gone = _marked(strings(part.column(1)), part.column(2))
                texts, left = _joined(flat, offsets, gone)
                new = [t.decode() if some else None for t, some in zip(texts, (left < np.diff(offsets)).tolist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(new, pa.string())], names=["_row", "_new"])

    out = rows.mapInArrow(run, schema)
    kind = documents.schema[text_col].dataType
    return out.select(*(F.coalesce(F.col("_new").cast(kind), F.col("_row")[c]).alias(c) if c == text_col
                        else F.col("_row")[c].alias(c) for c in columns))
