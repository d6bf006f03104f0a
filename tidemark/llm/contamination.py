"""Benchmark decontamination by an FM-index per training shard.

Words of the documents in a task are cut into shards of at most ``SHARD_WORDS``
words.  Each shard gets an FM-index over its word ids: a suffix array (prefix
doubling; every document ends in a terminator of its own), the
Burrows-Wheeler sequence in a wavelet matrix, and every ``SAMPLE``-th suffix
position.  All benchmark windows are searched backwards at once, occurrences
are located by walking to the next sampled position, and the word spans of a
document are merged.  One pass over the documents, no shuffle.  The benchmark's windows
lie in files, each made of about ``BENCHMARK_BLOCK_BYTES`` of text, below the shared
folder; a task searches its shard for one file's windows after the other and holds one at
a time, so neither the driver nor a worker ever holds the whole benchmark.

Rows: every row of the documents gives one row, repeated rows included.  A null
or empty text has no words (``n_words`` 0, not contaminated); a null id stays
null.  Benchmark rows with a null text, no words or a null id are no test items.
An empty benchmark marks nothing.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.files import locate, make_folder
from tidemark.llm.store import ship_package, stored
from tidemark.llm.textblocks import ALNUM, blocks, ranges, strings, words
from tidemark.session import shared_dir

WINDOW = 10
SHARD_WORDS = 1 << 19
SAMPLE = 32
#: Benchmark text in a file, on average, and so in a worker's memory at once.
BENCHMARK_BLOCK_BYTES = 4 << 20


class FMIndex:
    """Counts and locates words patterns in ``text`` (ids below ``2 ** 21``, each
    document closed by a terminator id that occurs once)."""

    def __init__(self, text: np.ndarray, n_symbols: int, sample: int = SAMPLE):
        n = len(text)
        suffixes = suffix_array(text)
        bwt = text[suffixes - 1]
        counts = np.bincount(text, minlength=n_symbols)
        self.before = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.bits = max(1, int(n_symbols - 1).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        level = bwt
        for bit in range(self.bits - 1, -1, -1):
            one = (level >> bit) & 1
            prefix = np.empty(n + 1, np.int32)
            prefix[0] = 0
            np.cumsum(one, out=prefix[1:])
            self.ones.append(prefix)
            self.zeros.append(n - int(prefix[-1]))
            mask = one.astype(bool)
            level = np.concatenate([level[~mask], level[mask]])
        sampled = suffixes % sample == 0
        self.sampled = sampled
        self.sample_rank = np.concatenate([[0], np.cumsum(sampled)]).astype(np.int32)
        self.positions = suffixes[sampled]

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol among the first ``ends`` entries of the BWT."""
        start, at = np.zeros_like(ends), ends
        for level in range(self.bits):
            prefix, zeros = self.ones[level], self.zeros[level]
            one = (symbols >> (self.bits - 1 - level)) & 1 == 1
            a, b = prefix[start], prefix[at]
            start = np.where(one, zeros + a, start - a)
            at = np.where(one, zeros + b, at - b)
        return at - start

    def previous(self, rows: np.ndarray) -> np.ndarray:
        """The row of the suffix that starts one word earlier."""
        symbol, start, at = np.zeros_like(rows), np.zeros_like(rows), rows
        for level in range(self.bits):
            prefix, zeros = self.ones[level], self.zeros[level]
            a, b = prefix[start], prefix[at]
            one = prefix[at + 1] != b
            symbol = symbol * 2 + one
            start = np.where(one, zeros + a, start - a)
            at = np.where(one, zeros + b, at - b)
        return self.before[symbol] + at - start

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, first row, end row) of the patterns that occur; ``patterns``
        holds ids right-aligned, -1 for a word that the shard doesn't have."""
        live = np.arange(len(patterns))
        first = np.zeros(len(live), np.int64)
        end = np.full(len(live), len(self.sampled), np.int64)
        done: list[tuple] = []
        for step in range(patterns.shape[1]):
            over = lengths[live] == step
            if over.any():
                done.append((live[over], first[over], end[over]))
                live, first, end = live[~over], first[~over], end[~over]
            symbols = patterns[live, patterns.shape[1] - 1 - step]
            known = symbols >= 0
            live, first, end, symbols = live[known], first[known], end[known], symbols[known]
            if not len(live):
                break
            base = self.before[symbols]
            first, end = base + self.rank(symbols, first), base + self.rank(symbols, end)
            some = first < end
            live, first, end = live[some], first[some], end[some]
        else:
            done.append((live, first, end))
        return tuple(np.concatenate(x) for x in zip(*done)) if done else (live, first, end)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row's suffix."""
        out = np.empty(len(rows), np.int64)
        at, where, steps = rows, np.arange(len(rows)), 0
        while len(at):
            hit = self.sampled[at]
            out[where[hit]] = self.positions[self.sample_rank[at[hit]]] + steps
            at, where = self.previous(at[~hit]), where[~hit]
            steps += 1
        return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only groups that still tie are sorted again."""
    n = len(text)
    wide = np.concatenate([text, np.zeros(2, text.dtype)]).astype(np.int64)
    key = (wide[:n] << 42) | (wide[1:n + 1] << 21) | wide[2:]
    order = np.argsort(key)
    ordered = key[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank = np.empty(n, np.int64)
    heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = heads
    alone = new & np.concatenate([new[1:], [True]])
    slots = np.flatnonzero(~alone)
    step = 3
    while len(slots):
        suffix = order[slots]
        key = (rank[suffix] << 32) | rank[np.minimum(suffix + step, n - 1)]
        by = np.argsort(key)
        suffix, key = suffix[by], key[by]
        order[slots] = suffix
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[suffix] = np.maximum.accumulate(np.where(new, slots, 0))
        slots = slots[~(new & np.concatenate([new[1:], [True]]))]
        step *= 2
    return order


class Phrases:
    """Distinct windows of the test items, as ids of their own vocabulary."""

    def __init__(self, items: list[str], texts: list[str], window: int):
        flat, offsets = words(pa.array(texts, pa.string()), ALNUM)
        encoded = flat.dictionary_encode()
        ids = encoded.indices.to_numpy().astype(np.int64)
        self.vocabulary = encoded.dictionary
        self.window = window
        self.items = items
        counts = np.diff(offsets)
        per_item = np.where(counts >= window, counts - window + 1, np.minimum(counts, 1))
        starts = ranges(offsets[:-1], per_item)
        item = np.repeat(np.arange(len(items)), per_item)
        length = np.minimum(counts, window)[item]
        matrix = np.full((len(starts), window), -1, np.int64)
        for back in range(window):  # right-aligned
            has = length > back
            matrix[has, window - 1 - back] = ids[starts[has] + length[has] - 1 - back]
        if len(matrix):
            distinct, which = np.unique(np.column_stack([length, matrix]), axis=0, return_inverse=True)
            which = which.reshape(-1)
        else:
            distinct, which = np.zeros((0, window + 1), np.int64), np.zeros(0, np.int64)
        self.lengths, self.patterns = distinct[:, 0].copy(), distinct[:, 1:].astype(np.int32)
        pairs = np.unique(np.column_stack([which, item]), axis=0) if len(which) else np.zeros((0, 2), np.int64)
        self.pattern_items = pairs[:, 1]
        self.pattern_offsets = np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))

    def in_shard(self, dictionary: pa.Array) -> np.ndarray:
        """The patterns in the ids of ``dictionary``; -1 for absent words."""
        known = pc.fill_null(pc.index_in(self.vocabulary, value_set=dictionary), -1).to_numpy(zero_copy_only=False)
        return np.where(self.patterns >= 0, np.append(known, -1)[self.patterns], -1).astype(np.int64)


def _segments(offsets: np.ndarray, limit: int, overlap: int) -> Iterator[list[tuple[int, int, int]]]:
    """Shards as lists of (document, first word, end word); a document of more than
    ``limit`` words is cut with an overlap that no window crosses unseen."""
    shard: list[tuple[int, int, int]] = []
    size = 0
    for doc in range(len(offsets) - 1):
        first, end = int(offsets[doc]), int(offsets[doc + 1])
        while first < end:
            stop = min(end, first + limit)
            if size and size + stop - first > limit:
                yield shard
                shard, size = [], 0
            shard.append((doc, first, stop))
            size += stop - first
            first = end if stop == end else stop - overlap
    if shard:
        yield shard


class PhraseFiles:
    """The windows of a benchmark in files, read one after the other at each iteration."""

    #: The last file that was read; a benchmark of one file is read once by a worker.
    _last: tuple[tuple, Phrases] | None = None

    def __init__(self, uris: list[str], window: int):
        self.uris, self.window = uris, window

    def __iter__(self) -> Iterator[Phrases]:
        for uri in self.uris:
            if PhraseFiles._last is None or PhraseFiles._last[0] != (uri, self.window):
                PhraseFiles._last = None
                fs, path = locate(uri)
                with fs.open_input_file(path) as source:
                    PhraseFiles._last = ((uri, self.window), pickle.loads(source.read()))
            yield PhraseFiles._last[1]


def scan(texts: pa.StringArray, phrases: list[Phrases] | PhraseFiles, shard_words: int = SHARD_WORDS):
    """(word offsets, hit mask over all words, per document the hit items)."""
    flat, offsets = words(texts, ALNUM)
    encoded = flat.dictionary_encode()
    ids, dictionary = encoded.indices.to_numpy(), encoded.dictionary
    change = np.zeros(len(ids) + 1, np.int64)
    found: list[set] = [set() for _ in range(len(texts))]
    overlap = (phrases.window if isinstance(phrases, PhraseFiles) else max((p.window for p in phrases), default=1)) - 1
    for shard in _segments(offsets, max(shard_words, 2 * overlap + 2), overlap):
        doc, first, end = (np.array(x, np.int64) for x in zip(*shard))
        count = len(shard)
        size = end - first + 1
        starts = np.concatenate([[0], np.cumsum(size)])
        text = np.empty(starts[-1], np.int64)
        closing = starts[1:] - 1
        source = np.concatenate([ids[a:b] for _, a, b in shard])
        used, local = np.unique(source, return_inverse=True)
        inside = np.ones(len(text), bool)
        inside[closing] = False
        text[inside] = local + count
        text[closing] = np.arange(count)
        vocabulary = dictionary.take(pa.array(used))
        index = FMIndex(text, len(used) + count)
        for block in phrases:
            patterns = block.in_shard(vocabulary)
            patterns = np.where(patterns >= 0, patterns + count, -1)
            which, low, high = index.search(patterns, block.lengths)
            if not len(which):
                continue
            rows = ranges(low, high - low)
            which = np.repeat(which, high - low)
            position = index.locate(rows)
            segment = np.searchsorted(starts, position, side="right") - 1
            begin = first[segment] + position - starts[segment]
            np.add.at(change, begin, 1)
            np.add.at(change, begin + block.lengths[which], -1)
            pairs = np.unique(doc[segment] * len(block.lengths) + which)
            for pair in pairs.tolist():
                d, w = divmod(pair, len(block.lengths))
                a, b = block.pattern_offsets[w], block.pattern_offsets[w + 1]
                found[d].update(block.items[i] for i in block.pattern_items[a:b].tolist())
    return offsets, np.cumsum(change[:-1]) > 0, found


def _spans(mask: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return [{"first_word": int(a), "end_word": int(b)} for a, b in zip(edges[::2], edges[1::2])]


def phrase_files(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> PhraseFiles:
    """The windows of the test items in as many files as their size asks for, each made by a
    task; rows that repeat an item and its text count once.  Only the files' names pass
    through the driver."""
    spark = benchmark.sparkSession
    ship_package(spark)
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")) \
        .where("item IS NOT NULL AND text IS NOT NULL").distinct()
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    folder = shared_dir(spark, "benchmark")
    make_folder(folder)

    def run(batches):
        items, texts = [], []
        for batch in batches:
            items += batch.column(0).to_pylist()
            texts += batch.column(1).to_pylist()
        if items:
            fs, base = locate(folder)
            name = f"phrases-{uuid.uuid4().hex}"
            with fs.open_output_stream(f"{base}/{name}") as out:
                out.write(pickle.dumps(Phrases(items, texts, window), protocol=5))
            yield pa.RecordBatch.from_pydict({"name": [name]})

    dealt = rows.repartition(max(1, -(-size // BENCHMARK_BLOCK_BYTES)), F.xxhash64("item", "text"))
    names = stored(dealt.mapInArrow(run, "name string"), "benchmark-files").collect() if size else []  # one row a file
    return PhraseFiles(sorted(f"{folder}/{r['name']}" for r in names), window)


def contamination(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per document: ``n_words``, ``n_hit`` (words inside an occurrence of a window
    of ``window`` item words, or of a whole shorter item), ``items`` with occurring
    windows (sorted as strings), their digest, ``contaminated`` and the merged
    removal ``spans`` (word positions)."""
    ship_package(documents.sparkSession)
    phrases = phrase_files(benchmark, item_col, item_text_col, window)
    id_type = documents.schema[id_col].dataType
    schema = T.StructType([
        T.StructField(id_col, id_type), T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType()),
        T.StructField("contaminated", T.BooleanType()), T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first_word", T.LongType()),
                                                         T.StructField("end_word", T.LongType())])))])

    def run(batches):
        spans_type = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64())]))
        for batch in batches:
            for part in blocks(batch, 1):
                offsets, hit, found = scan(strings(part.column(1)), phrases)
                totals = np.concatenate([[0], np.cumsum(hit)])
                n_hit = totals[offsets[1:]] - totals[offsets[:-1]]
                items = [sorted(x) for x in found]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(np.diff(offsets), pa.int64()), pa.array(n_hit, pa.int64()),
                    pa.array([len(x) for x in items], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
                    pa.array(n_hit > 0), pa.array(items, pa.list_(pa.string())),
                    pa.array([_spans(hit[a:b]) if n else [] for a, b, n in
                              zip(offsets[:-1].tolist(), offsets[1:].tolist(), n_hit.tolist())], spans_type),
                ], names=[f.name for f in schema])

    return documents.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def uncontaminated(documents: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents, in all their columns, without a window of any test item."""
    ship_package(documents.sparkSession)
    phrases = phrase_files(benchmark, item_col, item_text_col, window)
    at = documents.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in blocks(batch, at):
                _, _, found = scan(strings(part.column(at)), phrases)
                yield part.filter(pa.array([not items for items in found], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
