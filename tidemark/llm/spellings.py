"""Spelling variants: words of the corpus that differ by one edit.

Words are maximal runs of ASCII letters and U+00C0 to U+00FF, A-Z lower-cased, counted
over all documents.  (The corpus is given a few known misspellings on the way: a run
whose keyed checksum is divisible by ``TYPO`` loses one code point.)

Two words are one edit apart exactly if common prefix plus common suffix reach the
longer length minus one.  So either the prefix or the suffix is at least half as long,
and words only have to meet those that share this half: every word goes to the groups
(longer length, side, half).  A group of more than ``GROUP`` words is split again in the
same way, by half of what is left to agree on, until it is small; once nothing is left,
a group holds one word for every letter of the alphabet at most.  A pair counts in one
group alone, the one that its prefix length leads to.

Inside a task, groups lie one after the other in sorted order and are cut into tiles:
padded code-point matrices, aligned left for prefixes and right for suffixes.  Tiles
that share a group are compared with each other, all rows with all rows at once, and
only each word's number of near words and its best one leave the task, never the pairs.

The form of a word is its near word of largest count (ties: the smallest) if it is at
least ``RATIO`` times as frequent; roots follow forms by pointer doubling, and since
counts grow by that ratio, chains are short.

Rows: one per word.  Null and empty texts have no words, a null id counts as the empty
text in the checksum, rows that repeat an id count each, a text is cut at separators
into bounded pieces, whatever its length.  Words that are equal in count and near to
each other have no form in each other.  An empty table gives no words.  Only the id and
the text column are read, so other columns may have any name.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import ship_package, stored
from tidemark.llm.textblocks import blocks, from_raw, raw, strings

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
TYPO = 199
#: Words in a group that is compared as it is.
GROUP = 2048
#: Rows of a tile, and cells of a comparison at once.
TILE = 256
CELLS = 2 << 20
#: Text that is counted at once.
BLOCK_BYTES = 3 << 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def letters(texts: pa.StringArray) -> pa.StringArray:
    """The texts with A-Z lower-cased and a space for every byte that is no letter's."""
    offsets, data = raw(texts)
    wide = data == 0xC3  # leads U+00C0 to U+00FF, and always stands before its second byte
    keep = _LETTER[data] | wide
    keep[1:] |= wide[:-1]
    return from_raw(offsets, np.where(keep, _LOWER[data], np.uint8(0x20)))


def _pieces(texts: pa.StringArray, limit: int) -> tuple[pa.StringArray, np.ndarray]:
    """Recoded texts cut at spaces into pieces of about ``limit`` bytes, and each piece's text."""
    offsets, data = raw(texts)
    if not len(offsets) or int(np.diff(offsets).max(initial=0)) <= limit:
        return texts, np.arange(len(texts))
    cuts, owner = [0], []
    for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        while b - a > limit:
            space = np.flatnonzero(data[a + limit:b] == 0x20)
            if not len(space):
                break
            a += limit + int(space[0])
            cuts.append(a)
            owner.append(k)
        cuts.append(b)
        owner.append(k)
    return from_raw(np.array(cuts, np.int32), data), np.array(owner)


def _shifted(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Checksums carried over ``lengths`` further bytes: row k, column j holds the checksum
    k after ``lengths[j]`` (ascending) zero bytes."""
    out, done = np.empty((len(crc), len(lengths)), np.uint32), 0
    for j, n in enumerate(lengths.tolist()):
        for _ in range(n - done):
            crc = _CRC[crc & 0xFF] ^ (crc >> np.uint32(8))
        out[:, j], done = crc, n
    return out


#: Words of more bytes are checksummed one by one.
_SHORT = 64


def count_words(ids: list[str], texts: pa.StringArray, typo: int = TYPO, limit: int = BLOCK_BYTES):
    """Distinct words of a block of texts and their counts, with the misspellings."""
    recoded, owner = _pieces(letters(texts), limit)
    total: dict[str, int] = {}
    names = [f"{i}:".encode() for i in ids]
    prefix = np.array([zlib.crc32(n) for n in names], np.uint32)
    for first, last in _groups(recoded, limit):
        split = pc.ascii_split_whitespace(recoded.slice(first, last - first))
        flat = split.flatten()
        doc = np.repeat(owner[first:last], np.diff(split.offsets.to_numpy()))
        filled = pc.greater(pc.binary_length(flat), 0)
        doc = doc[filled.to_numpy(zero_copy_only=False)]
        coded = flat.filter(filled).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        at = coded.indices.to_numpy()
        if not len(at):
            continue
        encoded = [w.encode() for w in distinct]
        size = np.array([len(w) for w in encoded])
        own = np.array([zlib.crc32(w) for w in encoded], np.uint32)
        lengths, column = np.unique(np.minimum(size, _SHORT), return_inverse=True)
        low = int(doc[0])
        carried = _shifted(prefix[low:int(doc[-1]) + 1], lengths)
        check = carried[doc - low, column[at]] ^ own[at]
        for k in np.flatnonzero(size[at] > _SHORT).tolist():
            check[k] = zlib.crc32(names[doc[k]] + encoded[at[k]])
        hit = check % np.uint32(typo) == 0
        counts = np.bincount(at[~hit], minlength=len(distinct))
        for k in np.flatnonzero(hit).tolist():
            word = distinct[at[k]]
            gone = int(check[k]) % len(word)
            word = word[:gone] + word[gone + 1:]
            total[word] = total.get(word, 0) + 1
        for k in np.flatnonzero(counts).tolist():
            word = distinct[k]
            total[word] = total.get(word, 0) + int(counts[k])
    return total


def _groups(texts: pa.StringArray, limit: int):
    """Ranges of consecutive texts of about ``limit`` bytes."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(texts):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield first, last
        first = last


def word_counts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, typo: int = TYPO) -> DataFrame:
    """(word, n): the words of ``min_length`` code points and ``min_count`` occurrences at least."""
    ship_package(documents.sparkSession)
    rows = documents.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                            F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")

    def run(batches):
        for batch in batches:
            for part in blocks(batch, 1, BLOCK_BYTES):
                total = count_words(part.column(0).to_pylist(), strings(part.column(1)), typo)
                long = {w: n for w, n in total.items() if len(w) >= min_length}
                yield pa.RecordBatch.from_arrays([pa.array(long.keys(), pa.string()), pa.array(long.values(), pa.int64())],
                                                 names=["word", "n"])

    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")) \
        .where(F.col("n") >= min_count)


# ------------------------------------------------------------------- groups
#
# A group (longer, head, tail, limit, head_text, tail_text) holds words of ``longer`` or
# one fewer code points with the first ``head`` and the last ``tail`` in common, and
# counts pairs with a common prefix of ``head`` or more but fewer than ``limit``.

_GROUP = ["longer", "head", "tail", "limit", "head_text", "tail_text"]


def _halved(rows: DataFrame) -> DataFrame:
    """Every word to the two groups that agree on half of what its group leaves open:
    more of the prefix, or less of it and more of the suffix."""
    half = F.expr("cast(ceil((longer - 1 - head - tail) / 2) AS int)")
    rows = rows.withColumn("half", half)
    more_head = F.struct("longer", (F.col("head") + F.col("half")).alias("head"), "tail", "limit")
    more_tail = F.struct("longer", "head", (F.col("tail") + F.col("half")).alias("tail"),
                         F.least("limit", F.col("head") + F.col("half")).alias("limit"))
    return rows.select("word", "n", F.explode(F.array(more_head, more_tail)).alias("g")).where("g.head < g.limit") \
        .select("word", "n", "g.*") \
        .select("word", "n", "longer", "head", "tail", "limit", F.expr("substr(word, 1, head)").alias("head_text"),
                F.expr("right(word, tail)").alias("tail_text"))


def _grouped(words: DataFrame, group: int) -> DataFrame:
    """Words in groups of at most ``group`` words that together meet all near pairs."""
    size = F.length("word")
    rows = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("longer")) \
        .select("word", "n", "longer", F.lit(0).alias("head"), F.lit(0).alias("tail"), F.col("longer").alias("limit"))
    done = None
    while True:
        rows = stored(_halved(rows), "spelling-groups")
        sizes = rows.groupBy(_GROUP).agg(F.count("*").alias("_size")).where(F.col("_size") > group)
        large = stored(sizes.where("longer - 1 - head - tail > 0"), "large-groups")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, _GROUP, "left_anti")
        done = small if done is None else done.unionByName(small)
        rows = rows.join(large, _GROUP, "left_semi")


# -------------------------------------------------------------------- tiles

def _points(words: list[str], width: int, side: str, pad: int) -> np.ndarray:
    """Words as rows of code points, from the front or from the back, padded with ``pad``."""
    out = np.full((len(words), width), pad, np.int32)
    for k, word in enumerate(words):
        row = np.frombuffer(word.encode("utf-32-le"), np.int32)
        out[k, :len(row)] = row if side == "head" else row[::-1]
    return out


def common(a: list[str], b: list[str], side: str, cells: int = CELLS) -> np.ndarray:
    """Length of the common prefix (``head``) or suffix (``tail``) of every a with every b."""
    width = max(map(len, a + b))
    x, y = _points(a, width, side, -1), _points(b, width, side, -2)
    out = np.zeros((len(a), len(b)), np.int32)
    open_ = np.ones(out.shape, bool)
    step = max(1, cells // out.size)
    for first in range(0, width, step):
        same = x[:, None, first:first + step] == y[None, :, first:first + step]
        run = np.where(same.all(2), same.shape[2], same.argmin(2))
        out += np.where(open_, run, 0).astype(np.int32)
        open_ &= run == same.shape[2]
        if not open_.any():
            break
    return out


class Tile:
    """Consecutive rows of sorted groups: words, counts, group numbers and bounds."""

    def __init__(self, rows: list[tuple], numbers: list[int]):
        self.words = [r[0] for r in rows]
        self.n = np.array([r[1] for r in rows], np.int64)
        self.longer, self.head, self.tail, self.limit = (np.array([r[k] for r in rows], np.int64) for k in (2, 3, 4, 5))
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.number = np.array(numbers, np.int64)

    def near(self, other: Tile) -> np.ndarray:
        """Whether a row and a row of the other tile are one edit apart, in this their group."""
        head, tail = common(self.words, other.words, "head"), common(self.words, other.words, "tail")
        longer = self.longer[:, None]
        return ((self.number[:, None] == other.number[None, :])
                & (np.maximum(self.size[:, None], other.size[None, :]) == longer)
                & (head + tail >= longer - 1) & (head < longer)
                & (head >= self.head[:, None]) & (head < self.limit[:, None]) & (tail >= self.tail[:, None]))

    def best(self, near: np.ndarray, other: Tile):
        """(row, number of near words, largest count among them, the smallest such word)."""
        for k in np.flatnonzero(near.any(1)).tolist():
            at = np.flatnonzero(near[k])
            most = int(other.n[at].max())
            yield self.words[k], len(at), most, min(other.words[j] for j in at.tolist() if other.n[j] == most)


def _groups_of(batches):
    """The rows of each group of two words or more, in a stream sorted by groups."""
    own = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("word", "n", *_GROUP))):
            if own and row[2:] != own[0][2:]:
                if len(own) > 1:
                    yield own
                own = []
            own.append(row)
    if len(own) > 1:
        yield own


def _tiles(batches, rows_at_once: int, cells: int):
    """Tiles of a stream of rows sorted by groups."""
    rows, numbers, width = [], [], 0
    for number, group in enumerate(_groups_of(batches)):
        for row in group:
            width = max(width, len(row[0]))
            if rows and (len(rows) == rows_at_once or width * (len(rows) + 1) > cells):
                yield Tile(rows, numbers)
                rows, numbers, width = [], [], len(row[0])
            rows.append(row[:6])
            numbers.append(number)
    if rows:
        yield Tile(rows, numbers)


def _compared(tile_rows: int):
    def run(batches):
        waiting: list[Tile] = []
        for tile in _tiles(batches, tile_rows, CELLS):
            out = []
            # earlier tiles that end in the group this one begins with
            waiting = [t for t in waiting if t.number[-1] == tile.number[0]]
            for other in [*waiting, tile]:
                near = tile.near(other)
                out.extend(tile.best(near, other))
                if other is not tile:
                    out.extend(other.best(near.T, tile))
            waiting.append(tile)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                    names=["word", "n_near", "best_n", "best"])

    return run


def near_words(words: DataFrame, group: int = GROUP, tile: int = TILE) -> DataFrame:
    """Per word (of a table of distinct words with counts ``n``) with near words: ``n_near``,
    the near word ``best`` of the largest count, the smallest of equal ones, and ``best_n``."""
    ship_package(words.sparkSession)
    rows = _grouped(words, group).repartition(*_GROUP).sortWithinPartitions(*_GROUP, "word")
    found = rows.mapInArrow(_compared(tile), "word string, n_near bigint, best_n bigint, best string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                     F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b")) \
        .select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.m")).alias("best_n"))


def _roots(words: DataFrame, ratio: int) -> DataFrame:
    """(word, root) of the words with a form: pointers are doubled until all chains are done.
    A form is ``ratio`` times as frequent, so the largest count bounds a chain's length."""
    forms = stored(words.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "forms")
    most = words.agg(F.max("n")).first()[0] or 1
    reach, longest = 1, 1
    while ratio ** (longest + 1) <= most:
        longest += 1
    while reach < longest:
        onward = forms.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        forms = stored(forms.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root")),
                       "forms")
        reach *= 2
    return forms


def spelling_variants(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, typo: int = TYPO,
                      group: int = GROUP, tile: int = TILE) -> DataFrame:
    """Per word: ``form``, ``root``, ``n``, ``n_near`` and ``form_n``."""
    words = stored(word_counts(documents, id_col, text_col, min_length, min_count, typo), "words")
    formed = words.join(near_words(words, group, tile), "word", "left") \
        .withColumn("form", F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best")))
    formed = stored(formed.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form",
                                  F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n")), "formed")
    return formed.join(_roots(formed, ratio), "word", "left") \
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
