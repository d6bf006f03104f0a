"""Rows that must not get lost, hot keys and odd rows: near-dedup, token files, the
benchmark in many files, and the pipeline from end to end."""

import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tests.llm.test_operators import BPE, CLASH, ODD, brute_contamination, docs, sentence

import corpus_pipeline
from tidemark.llm import contamination, neardup, textblocks, tokenfiles
from tidemark.session import shared_dir


def texts_left(df):
    return sorted((str(r.doc_id), str(r.text)) for r in df.collect())


# ---- near-dedup -----------------------------------------------------------------

def test_no_text_is_lost_that_is_no_copy(spark):
    rnd = random.Random(2)
    one, two, three = (sentence(rnd, 40) for _ in range(3))
    near = one.rsplit(" ", 1)[0]
    rows = [(5, one), (5, two),              # an id with two different texts: both stay
            (6, None), (6, three), (6, ""),  # null and empty texts beside a real one
            (7, near), (8, one), (8, "a text of its own that nothing else looks like at all"),
            (9, two), (9, two),              # copies of a smaller id's text
            (10, "twice the same row"), (10, "twice the same row"), (11, None), (None, one), (None, None)]
    for order in (rows, rows[::-1]):
        left = neardup.without_near_copies(docs(spark, order).repartition(3))
        assert left.columns == docs(spark, []).columns
        assert texts_left(left) == sorted((str(i), str(t)) for i, t in [
            rows[0], rows[1], rows[2], rows[3], rows[4], rows[7], rows[10], rows[12], rows[13], rows[14]])


def test_a_text_that_was_kept_stays_beside_a_null(spark):
    text = sentence(random.Random(3), 30)
    left = neardup.without_near_copies(docs(spark, [(1, None), (1, text), (2, text)]))
    assert texts_left(left) == [("1", "None"), ("1", text)]


def test_many_equal_rows_are_one_class(spark):
    rnd = random.Random(4)
    same, other = sentence(rnd, 30), sentence(rnd, 30)
    rows = [(k, same) for k in range(100, 700)] + [(5, other)] * 300 + [(3, other + " more")] + [(1, sentence(rnd, 30))]
    out = neardup.near_duplicates(docs(spark, rows).repartition(5)).collect()
    by_id = {r.doc_id: r.component_id for r in out}
    assert len(out) == len(rows) and by_id[699] == 100 and by_id[5] == by_id[3] == 3 and by_id[1] == 1
    assert sorted(i for i, _ in texts_left(neardup.without_near_copies(docs(spark, rows)))) == ["1", "100", "3"]


def test_near_dedup_with_text_ids(spark):
    text = sentence(random.Random(6), 50)
    table = spark.createDataFrame([("b", text), ("a", text + " x"), ("c", "something else entirely here and there")],
                                  "doc_id string, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(table).collect()}
    assert got == {"a": "a", "b": "a", "c": "c"}


# ---- token files ----------------------------------------------------------------

def test_rows_without_an_id_are_spread(spark):
    rows = [(None if k % 3 else k, f"{'same start of every text ' * 3}{k}") for k in range(3000)]
    folder = shared_dir(spark, "t-hot-tokens")
    manifest = tokenfiles.write_tokens(docs(spark, rows).repartition(6), folder, BPE)
    sizes = [e["n_docs"] for e in manifest]
    assert sum(sizes) == 3000 and len(sizes) == 8 and max(sizes) < 2 * 3000 / 8
    back = tokenfiles.read_tokens(spark, folder, manifest).collect()
    assert sorted(r.doc_id for r in back if r.doc_id is not None) == list(range(0, 3000, 3))
    starts = sorted((r.start, r.n_tokens) for r in back)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_other_vocabularies_are_refused():
    for name in ("byte_bpe_50k.json",):
        with pytest.raises(ValueError, match="no vocabulary"):
            tokenfiles.WordEncoder(public_tokenizers.path(name))


def test_forgotten_pieces_are_encoded_again(monkeypatch):
    monkeypatch.setattr(tokenfiles, "CACHE_WORDS", 40)
    encoder, rnd = tokenfiles.WordEncoder(BPE), random.Random(8)
    for _ in range(20):
        texts = [sentence(rnd, 12) + rnd.choice([".", "!", "\x01", ""]) for _ in range(5)]
        ids, counts = encoder.encode(pa.array(texts), 2)
        ends = np.cumsum(counts)
        assert [ids[e - n:e - 1].tolist() for e, n in zip(ends, counts)] == [encoder._library(t).tolist() for t in texts]


def test_token_files_with_text_ids(spark):
    table = spark.createDataFrame([("b", "two words"), ("a", "one"), (None, None)], "doc_id string, text string")
    folder = shared_dir(spark, "t-text-ids")
    manifest = tokenfiles.write_tokens(table, folder, BPE)
    back = {r.doc_id: r.start for r in tokenfiles.read_tokens(spark, folder, manifest, "string").collect()}
    assert back == {None: 0, "a": 1, "b": 3}


# ---- benchmark in many files ------------------------------------------------------

def test_many_small_benchmark_files_equal_one(spark, monkeypatch):
    rnd = random.Random(9)
    items = [(k, sentence(rnd, rnd.randrange(25))) for k in range(60)] + [(3, "one more text of item three")]
    rows = ODD + [(k, " ".join([sentence(rnd, 8), rnd.choice(items)[1], sentence(rnd, 5)])) for k in range(20, 60)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = sorted(brute_contamination([t for _, t in rows], items))

    def found():
        out = contamination.contamination(docs(spark, rows), bench).collect()
        return sorted((r.n_words, r.n_hit, r["items"]) for r in out)

    assert found() == want
    monkeypatch.setattr(contamination, "BENCHMARK_BLOCK_BYTES", 300)
    files = contamination.phrase_files(bench, "item_id", "text", 10)
    assert len(files.uris) > 5 and found() == want
    # a file at a time: the one read last is all that is held
    offsets, hit, _ = contamination.scan(textblocks.strings(pa.array([t for _, t in rows], pa.string())), files, 400)
    assert hit.sum() == sum(n for _, n, _ in want)
    held = contamination.PhraseFiles._last
    assert held[0] == (files.uris[-1], 10) and len(held[1].items) < 20


# ---- licenses, urls, lines, pages ---------------------------------------------------

def test_license_wordings_have_one_label_a_place(spark):
    texts = {"Distributed under the terms of the GNU General Public License, version 3.": "gpl-3",
             "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited "
             "to the warranties of merchantability, fitness for a particular purpose and noninfringement.": "mit",
             "BSD 3-Clause License": "bsd-3", "// SPDX-License-Identifier: MPL-2.0": "mpl-2",
             "SPDX-License-Identifier: Zlib": "", "Licensed under CC BY-NC-SA 4.0": "cc-by-nc,cc-by-nc-sa",
             "Licensed under CC BY-SA 4.0": "cc-by-sa", "SPDX-License-Identifier: MIT and SPDX-License-Identifier: ISC": "isc,mit",
             "licensed under the Apache License, version 2.0": "apache-2", "": "", None: ""}
    from tidemark.llm import licenses
    out = licenses.licenses(docs(spark, [(k, t) for k, t in enumerate(texts)])).collect()
    assert {r.doc_id: r.labels for r in out} == dict(enumerate(texts.values()))


def test_lines_with_ids_that_are_no_numbers(spark):
    from tidemark.llm import linededup
    lines = [f"a line of text number {k}" for k in range(40)]
    rnd = random.Random(12)
    rows = [(f"doc-2024-{k:04d}", "\n".join(rnd.sample(lines, 8))) for k in range(120)]
    table = spark.createDataFrame(rows + [(None, lines[0])], "doc_id string, text string").repartition(5)
    seen, want = set(), {}
    for i, text in sorted(rows):
        own = [x for x in text.split("\n") if x not in seen]
        seen |= set(own)
        want[i] = (8, 8 - len(own), "\n".join(own))
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in linededup.line_dedup(table).collect()}
    assert got == want | {None: (1, 1, "")}
    counts = table.withColumnRenamed("doc_id", "id")
    sizes = counts.groupBy(linededup._batch_of(counts, 4).alias("b")).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 45
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_hot_pages_and_addresses(spark):
    from tidemark.llm import urlfilter, warc
    urls = ["http://a.example.com/x"] * 900 + [None] * 700 + ["no address"] * 300 + [f"http://h{k}.org/p{k}" for k in range(100)]
    pages = spark.createDataFrame([(k, u, "dup") for k, u in enumerate(urls)], "page_id bigint, url string, host string")
    out = urlfilter.judge_urls(pages).collect()
    assert sorted(r.page_id for r in out) == list(range(2000))
    assert {r.verdict for r in out if r.host == ""} == {"allow"} and sum(r.host == "" for r in out) == 1000
    assert len({(r.host, r.path, r.score, r.verdict) for r in out if r.host == "a.example.com"}) == 1
    big = "z" * 1500
    html = [big] * 500 + [""] * 400 + [None] * 100 + ["only " * 300 + str(k) for k in range(20)]
    pages = spark.createDataFrame([(k if k % 50 else None, "http://h/", h) for k, h in enumerate(html)],
                                  "page_id bigint, url string, html string").repartition(4)
    folder = shared_dir(spark, "t-hot-warc")
    got = warc.read_warc(spark, folder, warc.write_warc(pages, folder)).collect()
    assert len(got) == len(html) and sum(r.record_type == "response" for r in got) == len(html) - 499
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {499}


# ---- pipeline ---------------------------------------------------------------------

def test_pipeline_of_odd_rows(spark, tmp_path):
    rnd = random.Random(10)

    def clean(k):
        return "\n".join(f"The {sentence(rnd, 12)} number {k}." for _ in range(4))

    good = [(k, clean(k)) for k in range(1, 7)]
    rows = good + [(3, clean(30)), (20, good[0][1]), (21, good[0][1]), (22, ""), (None, clean(31)), (None, None), (23, None),
                   (24, "Too short."), (25, "A " + "long line of words goes on and on here, " * 3000 + "and ends.")]
    folder = str(tmp_path / "tables")
    docs(spark, rows).withColumn("n_chars", F.length("text")).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, good[4][1]), (2, None)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    out = corpus_pipeline.run(spark, folder).collect()
    ids = [r.doc_id for r in out]
    assert all(r.lossless for r in out)
    # copies, short and empty texts and the test item's text go; all else stays, a null id too
    assert sorted(map(str, ids)) == sorted(map(str, [1, 2, 3, 3, 4, 6, None]))
    for name in ("empty",):
        folder = str(tmp_path / name)
        spark.createDataFrame([], CLASH + ", n_chars int").write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
        assert corpus_pipeline.run(spark, folder).count() == 0


# ---- sentencepiece ------------------------------------------------------------------

def test_every_occurrence_is_decided_for_itself(monkeypatch):
    from tidemark.llm import pieces
    model = pieces.piece_model(public_tokenizers.path("piece_bpe_32k.model"))
    words = [" understanding", " a", " xyz中", "", " internationalisation", "\n"]
    rnd = np.random.default_rng(3)
    owner = np.sort(rnd.integers(0, len(words), 400))
    variants = rnd.integers(-2 ** 62, 2 ** 62, 400)
    for occurrences in (7, 300_000):
        monkeypatch.setattr(pieces, "_OCCURRENCES", occurrences)
        ids, counts, form, skips = model.forms(pa.array(words), owner, variants, 5, 0.3)
        begin = np.cumsum(counts) - counts
        seen = set()
        for k, (u, v) in enumerate(zip(owner.tolist(), variants.tolist())):
            symbols = [int(model.character[ord(c)]) if model.character[ord(c)] >= 0 else -1 - ord(c) for c in words[u]]
            want = [x for s in model.agenda(symbols, 0, v, 5, 0.3)
                    for x in ([s] if s >= 0 else model.byte[list(chr(-1 - s).encode())].tolist())]
            got = ids[begin[form[k]]:begin[form[k]] + counts[form[k]]].tolist()
            assert got == want, (words[u], v)
            seen.add((u, tuple(got)))
        # more than a handful of segmentations of one word, and far fewer forms than occurrences
        assert sum(u == 0 for u, _ in seen) > 8
        if occurrences > 400:
            assert len(seen) <= len(counts) < 300 and skips.sum() > 100
