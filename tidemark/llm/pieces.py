"""SentencePiece encoding and decoding with seeded merge-dropout.

A merge-type (BPE) model segments a text by an agenda: of all neighbouring
symbols that together are a piece, the best-scored pair (the leftmost on a tie)
is merged first.  Merge-dropout skips a candidate when it comes up; here a keyed
hash of (seed, document, place in the text, both pieces, place in the unit) decides, so
an encoding can be repeated anywhere, other seeds give other segmentations of the same
text, and every occurrence of a word is decided for itself.  A unit is a word with the
white space before it; no piece of the model crosses a unit's border, so units are
segmented on their own.  The agendas of all distinct units of a block run side by side
in numpy, one candidate per round each.  All occurrences of a unit begin with one form;
where a candidate comes up, those that skip it part from those that merge, so that
occurrences share a form, and its work, as long as they have decided alike.

Decoding gives every text back byte for byte, whatever was skipped: characters
without a piece become byte pieces, and so does a literal U+2581, which the
model itself would give back as a space.

Rows: one result row per row of the documents.  A null text counts as empty and
has no pieces.  A null id is hashed as the empty text.  Rows that repeat id and text are
encoded alike.  A text of any length is encoded whole; a run without white space of over
``_LONG`` characters is segmented on its own.  An empty table gives an empty result.  Only
the id and the text column are read, so other columns may have any name.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.store import ship_package
from tidemark.llm.textblocks import blocks, from_raw, hashes, mix, ranges, raw, strings

SEED, DROPOUT = 20_240, 0.1
SPACE = "▁"
_NONE = np.int64(2**62)
#: Units and occurrences that are worked on at once, and the longest unit among them.
_CHUNK, _OCCURRENCES, _LONG = 60_000, 300_000, 4096


def skipped(seed: int, variant, left, right, place) -> np.ndarray:
    """The keyed hash of a candidate merge, as a number from 0 to 1."""
    left, right, place, variant = (np.atleast_1d(np.asarray(x, np.int64)) for x in (left, right, place, variant))
    key = mix(left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64))
    key = mix(key + place.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + variant.astype(np.uint64))
    return (mix(key ^ mix(np.full(1, seed, np.uint64))[0]) >> np.uint64(11)) / float(1 << 53)


class PieceModel:
    """The pieces, scores and merges of a merge-type SentencePiece model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        plain = [i for i in range(len(pieces)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        if any(SPACE in pieces[i].lstrip(SPACE) for i in plain):
            raise ValueError("a piece of the model crosses the border of a word")
        self.byte = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        if not all(model.is_byte(int(i)) for i in self.byte):
            raise ValueError("the model has no byte pieces")
        ids = {pieces[i]: i for i in plain}
        self.character = np.full(0x110000, -1, np.int32)
        for i in plain:
            if len(pieces[i]) == 1:
                self.character[ord(pieces[i])] = i
        self.character[ord(" ")] = self.character[ord(SPACE)]
        self.character[ord(SPACE)] = -1  # a literal one goes by its bytes
        scores = sorted({model.get_score(i) for i in plain}, reverse=True)
        rank = {s: k for k, s in enumerate(scores)}
        merges = {(ids[p[:k]], ids[p[k:]]): i for i in plain for p in [pieces[i]]
                  for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids}
        keys = np.array([a << 32 | b for a, b in merges], np.int64)
        to = np.array(list(merges.values()), np.int64)
        self.ranks = {i: rank[model.get_score(i)] for i in plain}
        order = np.array([self.ranks[i] for i in merges.values()], np.int64)
        self.merges = merges
        # a table addressed by hash: one entry per slot, the rest sorted behind it
        self.slot_bits = max(10, int(len(keys) * 4).bit_length())
        slots = self._slot(keys)
        first = np.unique(slots, return_index=True)[1]
        self.table = np.full((3, 1 << self.slot_bits), -1, np.int64)
        self.table[:, slots[first]] = keys[first], to[first], order[first]
        rest = np.setdiff1d(np.arange(len(keys)), first)
        rest = rest[np.argsort(keys[rest])]
        self.rest = np.stack([keys[rest], to[rest], order[rest]])
        self.crowded = np.zeros(1 << self.slot_bits, bool)
        self.crowded[slots[rest]] = True
        # bytes of each piece
        text = [b""] * len(pieces)
        for i in plain:
            text[i] = pieces[i].replace(SPACE, " ").encode()
        for b, i in enumerate(self.byte):
            text[i] = bytes([b])
        self.text = np.frombuffer(b"".join(text), np.uint8)
        self.length = np.array([len(x) for x in text], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.pieces = pieces

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) >> np.uint64(64 - self.slot_bits)).astype(np.int64)

    def merge(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(merged piece, rank) of each pair; piece -1 where there is none."""
        keys = left << 32 | right
        slots = self._slot(keys)
        hit = self.table[0][slots] == keys
        to, rank = np.where(hit, self.table[1][slots], -1), self.table[2][slots]
        look = np.flatnonzero(~hit & self.crowded[slots])
        if len(look):
            at = np.minimum(np.searchsorted(self.rest[0], keys[look]), self.rest.shape[1] - 1)
            same = self.rest[0][at] == keys[look]
            to[look[same]], rank[look[same]] = self.rest[1][at[same]], self.rest[2][at[same]]
        bad = (left < 0) | (right < 0)
        to[bad] = -1
        return to, rank

    # -- segmenting ---------------------------------------------------------

    def agenda(self, symbols: list[int], place: int, variant: int, seed: int, dropout: float) -> list[int]:
        """One unit by a heap: the plain form, and the one for very long runs."""
        n = len(symbols)
        symbols, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple] = []

        def push(k):
            if 0 <= k < n and after[k] < n:
                to = self.merges.get((symbols[k], symbols[after[k]]))
                if to is not None:
                    heapq.heappush(heap, (self.ranks[to], k, symbols[k], symbols[after[k]], to))
        for k in range(n - 1):
            push(k)
        gone = [False] * n
        while heap:
            _, k, a, b, to = heapq.heappop(heap)
            if gone[k] or symbols[k] != a or after[k] >= n or symbols[after[k]] != b:
                continue
            if dropout and skipped(seed, variant, a, b, place + k) < dropout:
                continue
            right = after[k]
            symbols[k], gone[right], after[k] = to, True, after[right]
            if after[k] < n:
                before[after[k]] = k
            push(k)
            if before[k] >= 0:
                push(before[k])
        return [s for s, g in zip(symbols, gone) if not g]

    def _rounds(self, symbols, place, form, owner, variants, seed, dropout):
        """Runs of symbols, each the form (``form``, from 0) of one or more occurrences,
        merged until nothing is left to do.  ``owner`` is the form of each occurrence.  Every
        round looks at the best candidate of each form; occurrences whose keyed hash skips
        it part from those that merge, so a form is shared by all that decided alike.
        Returns (symbols, form), the form of each occurrence and its skips."""
        forms = int(form[-1]) + 1 if len(form) else 0
        skips, final = np.zeros(len(owner), np.int64), owner.copy()
        out: list[tuple] = []
        if not len(symbols):
            return symbols, form, final, skips
        run, label = form.copy(), np.arange(forms)  # forms at work, numbered anew, and their labels
        open_ = np.arange(len(owner))
        own = owner.copy()  # of the open occurrences, the form's number
        to, priority = self._pairs(symbols, place, run, np.arange(len(symbols)))
        while len(symbols):
            heads = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
            sizes = np.diff(np.append(heads, len(symbols)))
            best = np.minimum.reduceat(priority, heads)
            done = best == _NONE
            if done.any():
                idle, busy = np.repeat(done, sizes), np.repeat(~done, sizes)
                out.append((symbols[idle], place[idle], label[run[idle]]))
                symbols, place, to, priority = symbols[busy], place[busy], to[busy], priority[busy]
                sizes, best, label, number = sizes[~done], best[~done], label[~done], np.cumsum(~done) - 1
                run = np.repeat(np.arange(len(label)), sizes)
                still = ~done[own]
                open_, own = open_[still], number[own[still]]
                if not len(symbols):
                    break
            k = np.flatnonzero(priority == np.repeat(best, sizes))
            if dropout:
                skip = skipped(seed, variants[open_], symbols[k][own], symbols[k + 1][own], place[k][own]) < dropout
                skips[open_[skip]] += 1
                some = np.bincount(own[skip], minlength=len(label))
                every = some == np.bincount(own, minlength=len(label))
                parted = np.flatnonzero((some > 0) & ~every)
                if len(parted):
                    # those that skip go on with a copy of the form
                    first = (np.cumsum(sizes) - sizes)[parted]
                    copy = ranges(first, sizes[parted])
                    number = np.full(len(label), -1)
                    number[parted] = len(label) + np.arange(len(parted))
                    at = k[parted] - first + len(symbols) + np.cumsum(sizes[parted]) - sizes[parted]
                    symbols, place, to, priority = (np.concatenate([x, x[copy]]) for x in (symbols, place, to, priority))
                    run = np.concatenate([run, np.repeat(number[parted], sizes[parted])])
                    priority[at] = _NONE
                    moved = skip & (number[own] >= 0)
                    own = np.where(moved, number[own], own)
                    label = np.concatenate([label, forms + np.arange(len(parted))])
                    final[open_[moved]] = label[own[moved]]
                    forms += len(parted)
                priority[k[every & (some > 0)]] = _NONE
                k = k[~(every & (some > 0))]
            if not len(k):
                continue
            symbols[k] = to[k]
            keep = np.ones(len(symbols), bool)
            keep[k + 1] = False
            new = k - np.arange(len(k))  # each merge before it has taken one symbol away
            symbols, place, run = symbols[keep], place[keep], run[keep]
            to, priority = to[keep], priority[keep]
            near = np.unique(np.concatenate([new, new[new > 0] - 1]))
            to[near], priority[near] = self._pairs(symbols, place, run, near)
        symbols, place, form = (np.concatenate(x) for x in zip(*out))
        order = np.lexsort((place, form))
        return symbols[order], form[order], final, skips

    def _pairs(self, symbols, place, run, k):
        """(merged piece, priority) of the pairs that begin at ``k``."""
        nxt = np.minimum(k + 1, len(symbols) - 1)
        merged, rank = self.merge(symbols[k], symbols[nxt])
        merged[(k + 1 >= len(symbols)) | (run[k] != run[nxt])] = -1
        return merged, np.where(merged >= 0, rank << 32 | place[k], _NONE)

    def segment(self, units: pa.StringArray, variants: np.ndarray, seed: int, dropout: float):
        """(ids, the number of ids of each unit, the number of skips of each unit)."""
        ids, counts, form, skips = self.forms(units, np.arange(len(units)), variants, seed, dropout)
        begin = np.cumsum(counts) - counts
        return ids[ranges(begin[form], counts[form])], counts[form], skips

    def forms(self, units: pa.StringArray, owner: np.ndarray, variants: np.ndarray, seed: int, dropout: float):
        """Of occurrences of ``units`` (``owner`` names the unit of each, in ascending order)
        the distinct segmentations: their ids, the number of each one's ids, and of each
        occurrence its segmentation and its skips."""
        ids, counts, forms, skips, done = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [], [], 0
        of = np.searchsorted(owner, np.arange(len(units) + 1))
        first = 0
        while first < len(units):
            last = max(first + 1, min(first + _CHUNK, int(np.searchsorted(of, of[first] + _OCCURRENCES, side="right")) - 1))
            part = slice(of[first], of[last])
            own = self._segment(units.slice(first, last - first), owner[part] - first, variants[part], seed, dropout)
            ids.append(own[0])
            counts.append(own[1])
            forms.append(own[2] + done)
            skips.append(own[3])
            done += len(own[1])
            first = last
        none = np.zeros(0, np.int64)
        return np.concatenate(ids), np.concatenate(counts), np.concatenate([none, *forms]), np.concatenate([none, *skips])

    def _segment(self, units, owner, variants, seed, dropout):
        _, data = raw(units)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = pc.utf8_length(units).to_numpy().astype(np.int64)
        unit = np.repeat(np.arange(len(units)), sizes)
        place = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        symbols = self.character[points].astype(np.int64)
        symbols = np.where(symbols >= 0, symbols, -1 - points)
        # so many rounds would be slow for the others; an empty unit has nothing to merge
        plain = np.flatnonzero((sizes <= _LONG) & (sizes > 0))
        number = np.full(len(units), -1)
        number[plain] = np.arange(len(plain))
        among = number[unit] >= 0
        short = number[owner] >= 0
        merged, of, final, own_skips = self._rounds(symbols[among], place[among], number[unit[among]],
                                                    number[owner[short]], variants[short], seed, dropout)
        form, skips = np.full(len(owner), -1), np.zeros(len(owner), np.int64)
        form[short], skips[short] = final, own_skips
        total = max(int(of[-1]) + 1 if len(of) else 0, len(plain))
        more = [(merged, of)]
        for k in np.flatnonzero(~short).tolist():
            one = np.array(self.agenda(symbols[unit == owner[k]].tolist(), 0, int(variants[k]), seed, dropout), np.int64)
            more.append((one, np.full(len(one), total)))
            form[k], total = total, total + 1
        merged, of = (np.concatenate(x) for x in zip(*more))
        # characters without a piece become byte pieces
        lost = np.flatnonzero(merged < 0)
        width = np.ones(len(merged), np.int64)
        if len(lost):
            point = -1 - merged[lost]
            width[lost] = 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000)
            encoded = np.frombuffer(point.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
            ids = np.repeat(merged, width)
            ids[np.repeat(merged < 0, width)] = self.byte[encoded]
        else:
            ids = merged
        counts = np.bincount(of, weights=width, minlength=total).astype(np.int64)
        return ids.astype(np.int32), counts, form, skips

    # -- whole texts --------------------------------------------------------

    def encode(self, texts: pa.StringArray, keys: np.ndarray, seed: int = SEED, dropout: float = DROPOUT):
        """(ids, ids per text, skips per text); ``keys``: a hash of each document's id."""
        filled = pc.greater(pc.binary_length(texts), 0)
        led = pc.if_else(filled, pc.binary_join_element_wise(" ", texts, ""), texts)  # the model's leading space
        offsets, data = raw(strings(led))
        white = (data == 32) | ((data >= 9) & (data <= 13))
        # a unit ends where white space follows something else, and at the end of a text
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = white[1:] & ~white[:-1]
        cut[offsets] = True
        ends = np.flatnonzero(cut) if len(data) else np.zeros(1, np.int64)
        first = np.searchsorted(ends, offsets[:-1])
        units = np.searchsorted(ends, offsets[1:]) - first
        encoded = from_raw(ends, data).dictionary_encode() if len(ends) > 1 else pa.array([""])[:0].dictionary_encode()
        place = np.arange(len(ends) - 1) - np.repeat(first, units)
        variant = mix(np.repeat(keys, units) + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                      + np.uint64(seed)).view(np.int64)
        unit = encoded.indices.to_numpy().astype(np.int64)
        order = np.argsort(unit, kind="stable")
        pool, counts, form, skips = self.forms(encoded.dictionary, unit[order], variant[order], seed, dropout)
        at, skipped_ = np.empty_like(form), np.empty_like(skips)
        at[order], skipped_[order] = form, skips
        begin = np.cumsum(counts) - counts
        own = counts[at]
        ids = pool[ranges(begin[at], own)]

        def per_text(x):
            total = np.concatenate([[0], np.cumsum(x)])
            return total[first + units] - total[first]
        return ids, per_text(own), per_text(skipped_)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, bytes) of the texts, without the leading space."""
        length = self.length[ids]
        data = self.text[ranges(self.start[ids], length)]
        total = np.concatenate([[0], np.cumsum(length)])
        ends = total[np.cumsum(counts)]
        starts = np.concatenate([[0], ends[:-1]])
        lead = (starts < ends) & (data[np.minimum(starts, max(len(data) - 1, 0))] == 32) if len(data) else starts < 0
        keep = np.ones(len(data), bool)
        keep[starts[lead]] = False
        return np.concatenate([[0], np.cumsum(ends - starts - lead)]), data[keep]


_MODELS: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode_pieces(documents: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
                  dropout: float = DROPOUT) -> DataFrame:
    """Per row: ``ids`` of the segmentation, ``n_tokens``, ``n_skipped`` (merges that the
    dropout skipped), ``ids_crc32`` (of the ids as 32-bit little-endian integers) and
    ``lossless``, whether the ids decode to the text byte for byte."""
    ship_package(documents.sparkSession)
    schema = T.StructType([T.StructField(id_col, documents.schema[id_col].dataType)]
                          + [T.StructField(n, t) for n, t in (
                              ("n_tokens", T.LongType()), ("n_skipped", T.LongType()), ("ids_crc32", T.LongType()),
                              ("lossless", T.BooleanType()), ("ids", T.ArrayType(T.IntegerType())))])

    def run(batches):
        codec = piece_model(model)
        for batch in batches:
            for part in blocks(batch, 1):
                texts = strings(part.column(1))
                keys = hashes(strings(part.column(0)))
                ids, counts, skips = codec.encode(texts, keys, seed, dropout)
                offsets, data = codec.decode(ids, counts)
                own_offsets, own = raw(texts)
                same = np.diff(offsets) == np.diff(own_offsets)
                if not (same.all() and np.array_equal(data, own)):
                    same &= np.array([data[a:b].tobytes() == own[c:d].tobytes() for a, b, c, d in zip(
                        offsets[:-1], offsets[1:], own_offsets[:-1], own_offsets[1:])])
                ends = np.concatenate([[0], np.cumsum(counts)])
                little = ids.astype("<i4")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts), pa.array(skips),
                     pa.array([zlib.crc32(little[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.int64()),
                     pa.array(same), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))],
                    names=schema.names)

    return documents.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def decode_pieces(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row of an encoding: the id and the text."""
    ship_package(encoded.sparkSession)
    schema = T.StructType([T.StructField(id_col, encoded.schema[id_col].dataType),
                           T.StructField("text", T.StringType())])

    def run(batches):
        codec = piece_model(model)
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                lists = part.column(1)
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                offsets, data = codec.decode(lists.flatten().to_numpy(zero_copy_only=False), counts)
                yield pa.RecordBatch.from_arrays([part.column(0), from_raw(offsets, data)], names=[id_col, "text"])

    return encoded.select(id_col, F.col(ids_col).cast("array<int>")).mapInArrow(run, schema)
