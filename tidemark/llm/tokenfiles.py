"""Token ids in flat binary files.

Documents are sorted by id into range partitions.  A task encodes its texts and
writes three files: ``tokens`` (all ids as unsigned little-endian integers, 16
bits where the vocabulary allows it, else 32), ``offsets`` (64-bit starts of its
documents and the end) and ``ids`` (the document ids, Arrow IPC).  A prefix sum
over the partitions' token counts gives each partition's base, so a document's
global start is base + offset and no task needs another's data.  Files have
names of their own per attempt; only those of committed tasks are in the
manifest, so a lost executor leaves nothing behind that counts.

Equal words get equal ids whatever surrounds them (white space separates the
vocabulary's words), so the library encodes each distinct word once, as a stem and the
punctuation behind it, and a worker remembers the pieces in flat arrays; the ids are
gathered for all places.  A vocabulary of another kind is refused.

Rows: one document per row; a null text is empty and holds the end id alone.
Rows are ordered by id (null first), rows that repeat an id by the first 32 characters
of their texts (null first) and then by the texts' hashes, so that one id's rows are
spread over tasks like any others.  Texts are encoded whole, whatever their length.
An empty table gives an empty manifest and no documents.  Only the id and the text
column are read, so other columns may have any name.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.files import locate, make_folder, mapped, span
from tidemark.llm.store import ship_package, stored
from tidemark.llm.textblocks import SPACED, blocks, ranges, raw, strings, words

END_ID = 2
#: Text that is encoded at once.
BLOCK_BYTES = 12 << 20
#: Pieces of words that a worker remembers between blocks.
CACHE_WORDS = 1_000_000
_TRAILING = ",.!?;:"
_BETWEEN = "\x01"
_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


#: Texts on which a vocabulary must behave as ``WordEncoder`` takes it to.
_PROBES = ["", "A b", "Word, word. WORD!? x;:y don't (a) [b] {c}", "\u00c9t\u00e9 \u00dcBER caf\u00e9, \u0130I \u00df.",
           "a,b.c !x? 12.5 3,4. 5! a1, 1a; \u00e9.", "tab\tnew\nline\r\x0b\x0c x", "x_y- -z ... ,,, a... \u4e2d\u6587\u3002 \U0001f600!",
           "<|endoftext|> a <| b |>", "a\u00a0b\u2003c\u3000d e\u0301"]


class _Pieces:
    """Known pieces of words: their strings, and the ids of all of them in one array."""

    def __init__(self, dtype: np.dtype):
        self.known = pa.array([], pa.string())
        self.ids, self.begin = np.zeros(0, dtype), np.zeros(1, np.int64)

    def find(self, pieces: pa.StringArray, encode) -> np.ndarray:
        """The places of ``pieces`` (distinct) among the known ones; ``encode`` gives (ids,
        lengths) of those that are new.  Beyond ``CACHE_WORDS`` the older ones are forgotten."""
        at = pc.index_in(pieces, value_set=self.known)
        if not at.null_count:
            return at.to_numpy(zero_copy_only=False).astype(np.int64)
        if len(self.known) + at.null_count > CACHE_WORDS:
            self.__init__(self.ids.dtype)
            at = pa.nulls(len(pieces), pa.int32())
        new = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
        fresh = pieces.take(pa.array(new))
        ids, lengths = encode(fresh)
        out = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        out[new] = len(self.known) + np.arange(len(new))
        self.known = pa.concat_arrays([self.known, fresh])
        self.ids = np.concatenate([self.ids, ids])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(lengths)])
        return out


class WordEncoder:
    """Encodes whole texts with a word-wise, lower-casing tokenizer of the tokenizers
    library; any other is refused."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.between = self._library(_BETWEEN)
        self.pieces = _Pieces(self.dtype)
        self._check(path)

    def _check(self, path: str) -> None:
        ids, counts = self.encode(pa.array(_PROBES), 0)
        ends = np.cumsum(counts)
        for text, e, n in zip(_PROBES, ends.tolist(), counts.tolist()):
            if ids[e - n:e - 1].tolist() != self._library(text).tolist():
                raise ValueError(f"{path} is no vocabulary of lower-case words that end at white space")

    def _library(self, text: str) -> np.ndarray:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, self.dtype)

    def _learnt(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids) of pieces: encoded together, with a separator between them."""
        odd = pc.match_substring(pieces, _BETWEEN).to_numpy(zero_copy_only=False)
        if len(self.between) != 1 or odd.any():
            each = [self._library(p) for p in pieces.to_pylist()]
            return np.concatenate(each), np.array([len(x) for x in each], np.int64)
        ids, lengths = [], []
        for first in range(0, len(pieces), 20_000):
            part = self._library(f" {_BETWEEN} ".join(pieces.slice(first, 20_000).to_pylist()))
            cut = part == self.between[0]
            ends = np.flatnonzero(np.append(cut, True))
            lengths.append(np.diff(ends, prepend=-1) - 1)
            ids.append(part[~cut])
        return np.concatenate(ids), np.concatenate(lengths)

    def _of_words(self, distinct: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all distinct words, the number of each one's ids)."""
        # punctuation after a plain letter is a piece of its own to the vocabulary
        bare = pc.ascii_rtrim(distinct, characters=_TRAILING)
        size, whole = (pc.binary_length(x).to_numpy(zero_copy_only=False) for x in (bare, distinct))
        offsets, data = raw(bare)
        last = np.zeros(len(bare), np.uint8)
        last[size > 0] = data[offsets[1:][size > 0] - 1]
        cut = (size < whole) & _PLAIN[last]
        stems = pc.if_else(pa.array(cut), bare, distinct)
        stems = pc.if_else(pc.string_is_ascii(stems), pc.ascii_lower(stems), stems)
        offsets, data = raw(distinct)
        rests = pa.array([data[a:b].tobytes().decode() for a, b in zip((offsets[:-1] + size)[cut].tolist(),
                                                                       offsets[1:][cut].tolist())], pa.string())
        coded = pa.concat_arrays([stems, rests]).dictionary_encode()
        at = self.pieces.find(coded.dictionary, self._learnt)[coded.indices.to_numpy()]
        # a word is its stem and, where there is one, its rest
        second = np.cumsum(cut) - 1
        order = np.argsort(np.concatenate([2 * np.arange(len(distinct)), 2 * np.flatnonzero(cut) + 1]), kind="stable")
        lengths = np.diff(self.pieces.begin)[at]
        per_word = lengths[:len(distinct)].copy()
        per_word[cut] += lengths[len(distinct):][second[cut]]
        return self.pieces.ids[ranges(self.pieces.begin[at[order]], lengths[order])], per_word

    def encode(self, texts: pa.StringArray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, the number of ids of each text with its end id)."""
        flat, offsets = words(texts, SPACED)
        encoded = flat.dictionary_encode()
        pool, lengths = self._of_words(encoded.dictionary)
        at = encoded.indices.to_numpy()
        begin = np.concatenate([[0], np.cumsum(lengths)])
        own = lengths[at]
        before = np.concatenate([[0], np.cumsum(own)])
        counts = np.diff(before[offsets])
        # the special tokens' strings are looked for in the text as it stands
        special = np.flatnonzero(pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False))
        whole = {int(k): self._library(texts[int(k)].as_py()) for k in special}
        ids = pool[ranges(begin[at], own)]
        if whole:
            pieces = [whole.get(k, ids[before[offsets[k]]:before[offsets[k + 1]]]) for k in range(len(texts))]
            counts = np.array([len(x) for x in pieces], np.int64)
            ids = np.concatenate(pieces)
        out = np.empty(len(ids) + len(counts), self.dtype)
        ends = np.cumsum(counts + 1) - 1
        body = np.ones(len(out), bool)
        body[ends] = False
        out[body], out[ends] = ids, end_id
        return out, counts + 1


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write_tokens(documents: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID) -> list[dict]:
    """Write the token files below ``folder``; returns the manifest in order of ids:
    name, dtype, n_docs, n_tokens and base (ids in all files before) of each partition."""
    spark = documents.sparkSession
    ship_package(spark)
    make_folder(folder)
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # an id that many rows repeat, or no id at all, is cut by the texts' beginnings and hashes
    order = ["id", F.substring("text", 1, 32), F.xxhash64("text")]
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text") \
        .select("id", "text", F.spark_partition_id().alias("part"))

    def run(batches):
        encoder = word_encoder(tokenizer)
        fs, base = locate(folder)
        name, streams, writer = uuid.uuid4().hex, None, None
        n_docs = n_tokens = part_id = 0
        for batch in batches:
            for part in blocks(batch, 1, BLOCK_BYTES):
                ids, counts = encoder.encode(strings(part.column(1)), end_id)
                if streams is None:
                    part_id = part.column(2)[0].as_py()
                    streams = [fs.open_output_stream(f"{base}/{kind}-{name}") for kind in ("tokens", "offsets", "ids")]
                    writer = pa.ipc.new_file(streams[2], pa.schema([("id", part.schema.field(0).type)]))
                streams[0].write(ids.tobytes())
                streams[1].write((n_tokens + np.cumsum(counts) - counts).astype("<u8").tobytes())
                writer.write_batch(pa.RecordBatch.from_arrays([part.column(0)], names=["id"]))
                n_docs, n_tokens = n_docs + len(counts), n_tokens + len(ids)
        if streams is not None:
            streams[1].write(np.array([n_tokens], "<u8").tobytes())
            writer.close()
            for stream in streams:
                stream.close()
            yield pa.RecordBatch.from_pylist([{"part": part_id, "name": name, "dtype": encoder.dtype.str,
                                               "n_docs": n_docs, "n_tokens": n_tokens}],
                                             schema=pa.schema([("part", pa.int64()), ("name", pa.string()),
                                                               ("dtype", pa.string()), ("n_docs", pa.int64()),
                                                               ("n_tokens", pa.int64())]))

    written = stored(ordered.mapInArrow(run, "part bigint, name string, dtype string, n_docs bigint, n_tokens bigint"),
                     "token-manifest")
    manifest = [r.asDict() for r in written.orderBy("part").collect()]  # one row per file
    base = 0
    for entry in manifest:
        entry["base"] = base
        base += entry["n_tokens"]
    return manifest


def read_tokens(spark: SparkSession, folder: str, manifest: list[dict], id_type: str = "bigint",
                id_col: str = "doc_id") -> DataFrame:
    """Per document, from the memory-mapped files: its global ``start``, ``n_tokens``
    and ``ids_crc32`` (of the ids as unsigned 32-bit little-endian integers)."""
    schema = f"{id_col} {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint"
    if not manifest:
        return spark.createDataFrame([], schema)
    ship_package(spark)
    files = spark.createDataFrame([(e["name"], e["dtype"], e["base"], e["n_docs"]) for e in manifest],
                                  "name string, dtype string, base bigint, n_docs bigint").repartition(len(manifest))

    def run(batches):
        for batch in batches:
            for entry in batch.to_pylist():
                tokens, offsets = mapped(f"{folder}/tokens-{entry['name']}"), mapped(f"{folder}/offsets-{entry['name']}")
                starts = span(offsets, "<u8", 0, entry["n_docs"] + 1).astype(np.int64)
                done = 0
                with pa.ipc.open_file(mapped(f"{folder}/ids-{entry['name']}")) as ids:
                    for k in range(ids.num_record_batches):
                        column = ids.get_batch(k).column(0)
                        own = starts[done:done + len(column) + 1]
                        block = span(tokens, entry["dtype"], int(own[0]), int(own[-1])).astype("<u4")
                        at = (own - own[0]).tolist()
                        yield pa.RecordBatch.from_arrays(
                            [column, pa.array(entry["base"] + own[:-1]), pa.array(np.diff(own)),
                             pa.array([zlib.crc32(block[a:b]) for a, b in zip(at, at[1:])], pa.int64())],
                            names=[id_col, "start", "n_tokens", "ids_crc32"])
                        done += len(column)

    return files.mapInArrow(run, schema)
