"""Near-duplicate documents by a multi-index Hamming join over b-bit signatures.

A document's set holds its distinct word shingles.  Its signature has ``SLOTS``
min-hash values of 16 bits.  The slots are split into ``CHUNKS`` chunks, and one
wrong slot is allowed in a chunk: each chunk gives one key per left-out slot.
Two signatures that differ in at most ``2 * CHUNKS - 1`` slots have a chunk with
at most one wrong slot (pigeonhole), so they share a key: no pair under that
distance is missed.  With 96 slots in 16 chunks a pair of similarity 0.8, whose
distance is 19 on average, shares a key but for a chance of 4e-8.

Links are confirmed on the full sets.  Documents with equal sets form a class,
represented by its smallest id and numbered; only representatives are joined.  First every
representative is held against the smallest one that shares a bucket with it.
Buckets that then still hold several components are worked off in blocks of
bounded size: a task compares two blocks with matrix operations and returns a
spanning forest of what is close, never all pairs.  Close signatures gather the
members into families, and in a family every member outside the largest
component is held, on full sets and again block by block, against all members.
So no link between different texts is lost, no group is expanded into its pairs,
and no task holds more than two blocks.

Rows: one result row per row of the documents.  A document without words (null,
empty or blank text) has an empty set and is linked with nothing; so is a row
with a null id (``component_id`` null, ``kept`` true).  Rows that repeat an id
are one document and share its component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.store import looked_up, ship_package, stored
from tidemark.llm.textblocks import SPACED_LOWER, blocks, hashes, mix, strings, words
from tidemark.operators.ordering import with_row_index

SLOTS, CHUNKS = 96, 16
CHUNK = SLOTS // CHUNKS
#: Pairs whose signatures differ in more slots are not confirmed: a pair of
#: similarity 0.8 gets there with a chance below 1e-9 (6.7 standard deviations).
FAR_APART = 45
#: Members of a bucket in a block, shingles of a family's members in a block, and
#: members of a family in a block: texts may be short, a block pair is a dense matrix.
BUCKET_BLOCK, FAMILY_BLOCK, FAMILY_MEMBERS = 1024, 100_000, 1000
_PART, _COLUMNS = 1 << 15, 1 << 13
#: Text whose sets are in memory at once.
BLOCK_BYTES = 4 << 20


def _multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def shingle_sets(texts: pa.StringArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and each text's offsets.  A text
    with fewer than ``size`` words, but not none, is one shingle."""
    flat, offsets = words(texts, SPACED_LOWER)
    word = hashes(flat)
    del flat
    counts = np.diff(offsets)
    weights = _multipliers(size)
    long = max(0, len(word) - size + 1)
    rolled = np.zeros(long, np.uint64)
    for k in range(size):
        rolled += word[k:k + long] * weights[k]
    rolled = mix(rolled)
    sets, ends = [], np.zeros(len(counts) + 1, np.int64)
    for doc, (first, n) in enumerate(zip(offsets[:-1].tolist(), counts.tolist())):
        if n >= size:
            own = np.sort(rolled[first:first + n - size + 1])
            if len(own) > 1:
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif n:
            own = mix((word[first:first + n] * weights[:n]).sum(dtype=np.uint64, keepdims=True) + np.uint64(n))
        else:
            own = word[:0]
        sets.append(own)
        ends[doc + 1] = ends[doc] + len(own)
    return (np.concatenate(sets) if sets else word[:0]), ends


def signatures(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """16-bit min-hash values, one row per set (zeros for an empty set)."""
    out = np.zeros((len(ends) - 1, SLOTS), np.uint16)
    filled = np.flatnonzero(np.diff(ends))
    weights = _multipliers(SLOTS + 64)[64:]
    first = 0
    while first < len(filled):
        start = ends[filled[first]]
        last = max(first + 1, int(np.searchsorted(ends[filled], start + _PART)))
        rows = filled[first:last]
        part, starts = values[start:ends[rows[-1] + 1]], ends[rows] - start
        lowest = np.empty((SLOTS, len(rows)), np.uint64)
        scratch = np.empty_like(part)
        for k in range(SLOTS):
            np.multiply(part, weights[k], out=scratch)
            np.minimum.reduceat(scratch, starts, out=lowest[k])
        out[rows] = (mix(lowest) >> np.uint64(48)).T.astype(np.uint16)
        first = last
    return out


def chunk_keys(signature: np.ndarray) -> np.ndarray:
    """All keys of each signature: every chunk without one of its slots."""
    chunk = signature.reshape(-1, CHUNKS, CHUNK).astype(np.uint64)
    weights = _multipliers(SLOTS + 200)[200:].reshape(CHUNKS, CHUNK)
    terms = mix(chunk * weights + weights)
    total = terms.sum(axis=2, keepdims=True, dtype=np.uint64)
    place = np.arange(SLOTS, dtype=np.uint64).reshape(CHUNKS, CHUNK) * np.uint64(0x9E3779B97F4A7C15)
    return mix(total - terms + place).reshape(-1, SLOTS)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _binary_rows(column: pa.Array) -> np.ndarray:
    data = np.frombuffer(b"".join(column.to_pylist()), np.uint16)
    return data.reshape(-1, SLOTS)


def _digests(documents: DataFrame, shingle: int) -> DataFrame:
    """(id, text_key, n_shingles, digest of the set, signature) of every row (id, text, text_key)."""
    id_type = documents.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in blocks(batch, 1, BLOCK_BYTES):
                values, ends = shingle_sets(strings(part.column(1)), shingle)
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(values ^ np.uint64(salt)), dtype=np.uint64)])
                        for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(np.diff(ends), pa.int64()),
                     *(_signed(s[ends[1:]] - s[ends[:-1]]) for s in sums),
                     pa.array([x.tobytes() for x in signatures(values, ends)], pa.binary())],
                    names=["id", "text_key", "n_shingles", "digest_a", "digest_b", "signature"])

    return documents.mapInArrow(
        run, f"id {id_type}, text_key bigint, n_shingles bigint, digest_a bigint, digest_b bigint, signature binary")


def _keyed(representatives: DataFrame) -> DataFrame:
    """(key, id): the chunk keys of every signature."""
    id_type = representatives.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 2000):
                part = batch.slice(first, 2000)
                keys = chunk_keys(_binary_rows(part.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [_signed(keys.reshape(-1)), part.column(0).take(pa.array(np.repeat(np.arange(len(keys)), SLOTS)))],
                    names=["key", "id"])

    return representatives.select("id", "signature").mapInArrow(run, f"key bigint, id {id_type}")


def _close(pairs: DataFrame, representatives: DataFrame) -> DataFrame:
    """The candidate pairs (a, b) whose signatures differ in at most FAR_APART slots."""
    id_type = pairs.schema["a"].dataType.simpleString()
    sides = pairs.join(representatives.select(F.col("id").alias("a"), F.col("signature").alias("x")), "a") \
        .join(representatives.select(F.col("id").alias("b"), F.col("signature").alias("y")), "b")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                differ = (_binary_rows(batch.column(2)) != _binary_rows(batch.column(3))).sum(axis=1)
                kept = pa.array(differ <= FAR_APART)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)],
                                                 names=["a", "b"])

    return sides.select("a", "b", "x", "y").mapInArrow(run, f"a {id_type}, b {id_type}")


def _sets(documents: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(id, set) of the wanted texts (id, text_key, node), from their whole texts; the node
    is the set's id."""

    def run(batches):
        for batch in batches:
            for part in blocks(batch, 1, BLOCK_BYTES):
                values, ends = shingle_sets(strings(part.column(1)), shingle)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(values))],
                    names=["id", "set"])

    return documents.join(wanted, ["id", "text_key"]).select("node", "text") \
        .mapInArrow(run, "id bigint, set array<bigint>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union, counted on the full sets."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a") \
        .join(sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    counted = both.select("a", "b", common.alias("common"), (F.size("x") + F.size("y")).alias("total"))
    return counted.where(100 * F.col("common") >= percent * (F.col("total") - F.col("common"))).select("a", "b")


def _links(near: np.ndarray, ids: pa.Array) -> pa.RecordBatch:
    """Links (a, b) of a spanning forest of the graph between the rows and the columns
    of ``near``; ``ids`` names first the rows and then the columns.  Every node is
    linked to the smallest id of its tree, so other blocks give the same links."""
    rows, columns = near.shape
    order = pc.array_sort_indices(ids).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    own = place.copy()
    left, right = place[:rows], place[rows:]
    far = rows + columns
    while True:
        new = np.minimum(left, np.where(near, right[None, :], far).min(axis=1, initial=far))
        right = np.minimum(right, np.where(near, new[:, None], far).min(axis=0, initial=far))
        if (new == left).all():
            break
        left = new
    label = np.concatenate([left, right])
    node = np.flatnonzero(label != own)
    return pa.RecordBatch.from_arrays([ids.take(pa.array(order[label[node]])), ids.take(pa.array(node))],
                                      names=["a", "b"])


def _block_pairs(blocks_of: DataFrame, group: str) -> DataFrame:
    """All pairs of blocks of a group of which one is a query block, each once: ``x`` and
    ``y`` hold their members.  The first ``queries`` of a group's ``blocks`` are query
    blocks.  A block goes to every pair it takes part in, and each pair has its own key."""
    n, last = F.col("block"), F.when(F.col("block") < F.col("queries"), F.col("blocks")).otherwise(F.col("queries")) - 1
    other = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    dealt = blocks_of.select(group, "block", "members", F.explode(other).alias("other"))
    x = dealt.where(n <= F.col("other")).select(group, n.alias("i"), F.col("other").alias("j"), F.col("members").alias("x"))
    y = dealt.where(n >= F.col("other")).select(group, F.col("other").alias("i"), n.alias("j"), F.col("members").alias("y"))
    # blocks of like members shrink when shuffled: a side that looks small isn't
    return x.join(y.hint("merge"), [group, "i", "j"]).select("x", "y")


def _close_forest(members: DataFrame, representatives: DataFrame) -> DataFrame:
    """Links (a, b) that connect the members of a bucket whose signatures differ in
    at most FAR_APART slots; members: key, id, blocks (into how many to cut the bucket)."""
    id_type = members.schema["id"].dataType.simpleString()
    signed = members.join(representatives, "id") \
        .groupBy("key", "blocks", F.pmod(F.hash("id"), "blocks").alias("block")) \
        .agg(F.collect_list(F.struct("id", "signature")).alias("members")).withColumn("queries", F.col("blocks"))

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                x, y = batch.column(0)[k].values, batch.column(1)[k].values
                ids = pa.concat_arrays([x.field(0), y.field(0)])
                left, right = _binary_rows(x.field(1)), _binary_rows(y.field(1))
                near = np.empty((len(left), len(right)), bool)
                for r in range(len(left)):
                    near[r] = (left[r] != right).sum(axis=1) <= FAR_APART
                yield _links(near, ids)

    return _block_pairs(signed, "key").mapInArrow(run, f"a {id_type}, b {id_type}").where("a != b").distinct()


def _common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all sets of ``x`` with all of ``y``."""
    a, b = np.concatenate(x), np.concatenate(y)
    shared = np.intersect1d(a, b)
    out = np.zeros((len(x), len(y)), np.float32)

    def places(sets, values):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(shared, values), max(len(shared) - 1, 0))
        hit = shared[at] == values if len(shared) else np.zeros(len(values), bool)
        return owner[hit], at[hit]

    (own_a, at_a), (own_b, at_b) = places(x, a), places(y, b)
    for first in range(0, len(shared), _COLUMNS):
        left, right = (np.zeros((len(s), min(_COLUMNS, len(shared) - first)), np.float32) for s in (x, y))
        for matrix, own, at in ((left, own_a, at_a), (right, own_b, at_b)):
            part = (at >= first) & (at < first + _COLUMNS)
            matrix[own[part], at[part] - first] = 1
        out += left @ right.T
    return out


def _family_links(families: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the components of each family, from the full sets."""
    id_type = families.schema["id"].dataType.simpleString()
    members = stored(families.join(labels.withColumnRenamed("node", "id"), "id", "left")
                     .select("family", "id", F.coalesce("component", "id").alias("component")), "family-members")
    total = members.count()
    sized = stored(members.groupBy("family", "component").agg(F.count("*").alias("n"))
                   .groupBy("family").agg(F.max_by("component", F.struct("n", "component")).alias("largest"),
                                          F.count("*").alias("parts"), F.sum("n").alias("rows"))
                   .where("parts > 1").select("family", "largest", "rows"), "families")
    members = looked_up(members, sized, ["family"], total) \
        .withColumn("query", F.col("component") != F.col("largest")).join(sets, "id")
    members = stored(members.select("family", "id", "query", "set"), "family-sets")
    cut = members.groupBy("family", "query").agg(F.sum(F.size("set")).alias("total"), F.count("*").alias("n")) \
        .select("family", "query", "n", F.ceil(F.greatest(F.col("total") / FAMILY_BLOCK, F.col("n") / FAMILY_MEMBERS))
                .cast("int").alias("own"))
    each = [F.coalesce(F.max(F.when(side, F.col("own"))), F.lit(0)) for side in (F.col("query"), ~F.col("query"))]
    cut = stored(cut.groupBy("family").agg(each[0].alias("queries"), each[1].alias("others"), F.sum("n").alias("rows")),
                 "family-blocks")
    place = F.when(F.col("query"), F.pmod(F.hash("id"), "queries")) \
        .otherwise(F.col("queries") + F.pmod(F.hash("id"), "others"))
    # dealt out by block: a family may hold a third of all rows
    blocked = looked_up(members, cut, ["family"], total) \
        .select("family", "id", "set", "queries", (F.col("queries") + F.col("others")).alias("blocks"), place.alias("block")) \
        .repartition("family", "block").groupBy("family", "block", "queries", "blocks") \
        .agg(F.collect_list(F.struct("id", "set")).alias("members"))

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                x, y = batch.column(0)[k].values, batch.column(1)[k].values
                ids = pa.concat_arrays([x.field(0), y.field(0)])
                left, right = ([np.asarray(s) for s in side.field(1).to_numpy(zero_copy_only=False)] for side in (x, y))
                common = _common(left, right)
                total = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])
                common = common.astype(np.int64)
                yield _links(100 * common >= percent * (total - common), ids)

    return _block_pairs(blocked, "family").mapInArrow(run, f"a {id_type}, b {id_type}").where("a != b").distinct()


_SET = ["digest_a", "digest_b", "n_shingles"]


class _Clusters:
    """The classes of equal sets of a table, numbered, and the links between them.

    ``digests`` has a row per document, ``twice`` the (id, text_key) of rows that are equal
    in both.  ``classes`` has a row per set: the smallest id that has it, the key of a text
    of that id with it, how many rows have it, its signature and its ``node``.  Nodes are
    numbered in order of ids, so a component's smallest node has its smallest id.  Two
    classes may share an id, where rows repeat it with different texts, but no node."""

    def __init__(self, documents: DataFrame, id_col: str, text_col: str, shingle: int, percent: int):
        ship_package(documents.sparkSession)
        source = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
            .withColumn("text_key", F.xxhash64("text"))
        self.digests = stored(_digests(source, shingle), "digests")
        known = self.digests.where("id IS NOT NULL")
        self.twice = stored(known.groupBy("id", "text_key").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "twice")
        sets = stored(known.where("n_shingles > 0").groupBy(_SET)
                      .agg(F.min(F.struct("id", "text_key")).alias("first"), F.count("*").alias("rows"),
                           F.min("signature").alias("signature")).select(*_SET, "first.*", "rows", "signature"), "sets-seen")
        numbered = with_row_index(sets.select("id", *_SET), ["id", *_SET], "node").drop("id")
        self.classes = stored(sets.join(numbered, _SET), "classes")
        self.links = self._linked(source, shingle, percent)

    def _linked(self, source: DataFrame, shingle: int, percent: int) -> DataFrame:
        """Links (a, b) between nodes that connect all that is similar."""
        representatives = self.classes.select(F.col("node").alias("id"), "signature")
        keyed = _keyed(representatives)
        shared = keyed.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
        members = stored(keyed.join(shared.select("key", "first"), "key").distinct(), "members")

        # every representative against the smallest one it shares a bucket with
        star = _close(members.where("first < id").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct(),
                      representatives)
        star = stored(star.groupBy("b").agg(F.min("a").alias("a")), "star")
        wanted = self.classes.join(members.select(F.col("id").alias("node")).distinct(), "node", "left_semi") \
            .select("id", "text_key", "node")
        sets = stored(_sets(_once(source.where("id IS NOT NULL"), self.twice), wanted, shingle), "sets")
        links = stored(_confirmed(star, sets, percent), "links")
        labels = components(links)

        # buckets that still hold several components
        labelled = members.join(labels.withColumnRenamed("node", "id"), "id", "left") \
            .select("key", "id", F.coalesce("component", "id").alias("component"))
        mixed = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                            F.count("*").alias("n")) \
            .where("low < high").select("key", F.ceil(F.col("n") / BUCKET_BLOCK).cast("int").alias("blocks"))
        near = _close_forest(members.join(mixed, "key"), representatives)
        families = components(near).withColumnRenamed("node", "id").withColumnRenamed("component", "family")
        return stored(links.select("a", "b").union(_family_links(families, labels, sets, percent)), "all-links")

    def own(self) -> DataFrame:
        """Links (id, a, b) between the nodes of each id whose rows have different sets."""
        text = F.struct(*_SET)
        repeated = self.digests.where("id IS NOT NULL").groupBy("id") \
            .agg(F.min(text).alias("low"), F.max(text).alias("high")).where("low != high").select("id")
        among = self.digests.where("n_shingles > 0").join(stored(repeated, "repeated"), "id", "left_semi") \
            .select("id", *_SET).distinct()
        of_row = stored(among.join(self.classes.select(*_SET, "node"), _SET).select("id", F.col("node").alias("b")),
                        "own-classes")
        return of_row.join(of_row.groupBy("id").agg(F.min("b").alias("a")), "id").select("id", "a", "b")


def _once(rows: DataFrame, twice: DataFrame) -> DataFrame:
    """Rows (id, text, text_key), equal ones once."""
    keys = ["id", "text_key"]
    return rows.join(twice, keys, "left_anti").unionByName(rows.join(twice, keys, "left_semi").dropDuplicates(keys))


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80) -> DataFrame:
    """Per row: ``n_shingles``, ``component_id`` (the smallest id reachable over links of
    similarity ``percent`` / 100 or more, itself included) and ``kept``."""
    clusters = _Clusters(documents, id_col, text_col, shingle, percent)
    own, classes = clusters.own(), clusters.classes
    labels = components(clusters.links.union(own.select("a", "b")))
    names = classes.select(F.col("node").alias("component"), F.col("id").alias("component_id"))
    component = stored(labels.join(names, "component").select("node", "component_id"), "component-ids")
    by_class = stored(classes.join(component, "node", "left")
                      .select(*_SET, "rows", F.coalesce("component_id", "id").alias("component_id")), "by-class")
    rows, filled = clusters.digests.select("id", *_SET), F.expr("n_shingles > 0 AND id IS NOT NULL")
    out = looked_up(rows.where(filled), by_class, _SET, rows.count()).select("id", "n_shingles", "component_id")
    # an empty text shares the component of its id's other texts
    of_id = own.groupBy("id").agg(F.min("a").alias("node")).join(component, "node").select("id", "component_id")
    bare = rows.where(~filled).join(of_id, "id", "left") \
        .select("id", "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
    return out.unionByName(bare).select(F.col("id").alias(id_col), "n_shingles", "component_id",
                                        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def without_near_copies(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                        percent: int = 80) -> DataFrame:
    """The documents, in all their columns, without near-copies: of the texts that links
    connect, the one with the smallest id stays (of several such of that id, one).  Texts
    that nothing links stay, whether or not another row repeats their id; so do empty
    texts and rows with a null id.  Of rows equal in id and text one stays."""
    columns = documents.columns
    clusters = _Clusters(documents, id_col, text_col, shingle, percent)
    labels = components(clusters.links)
    kept = clusters.classes.join(labels, "node", "left").where("component IS NULL OR component = node").select("id", "text_key")
    empty = clusters.digests.where("n_shingles = 0 AND id IS NOT NULL").select("id", "text_key").distinct()
    kept = stored(kept.union(empty), "kept-texts")
    rows = documents.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_row"))
    rows = rows.select("_row", F.col("_row")[id_col].alias("id"),
                       F.xxhash64(F.col("_row")[text_col].cast("string")).alias("text_key"))
    keys = ["id", "text_key"]
    known = rows.join(kept, keys, "left_semi")
    copies = known.join(clusters.twice, keys, "left_semi").groupBy(keys) \
        .agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    return known.join(clusters.twice, keys, "left_anti").select("_row").union(copies.select("_row")) \
        .union(rows.where("id IS NULL").select("_row")).select(*(F.col("_row")[c].alias(c) for c in columns))
