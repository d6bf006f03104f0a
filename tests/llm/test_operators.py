"""Each operator against a brute-force version, on rows with nulls, empty and
repeated texts, ties, empty tables and extra columns whose names clash."""

import contextlib
import hashlib
import random
import re
import threading
import zlib

import numpy as np
import psutil
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tidemark.llm import components, contamination, licenses, linededup, neardup, pieces, quality, textblocks
from tidemark.llm import tokenfiles, toxicity, urlfilter, warc
from tidemark.session import shared_dir

WORDS = rb"[0-9a-z\x80-\xff]+"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("word_bpe_49k.json")
#: Extra columns named like those that operators make.
CLASH = "doc_id bigint, text string, id string, n_words int, key string, h1 int, _row int, kept string, component int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, None, 2, 3, "k", None) for i, t in rows], CLASH)


def alnum(text):
    return [w.decode() for w in re.findall(WORDS, (text or "").encode().lower())]


def spaced(text):
    return [w.decode() for w in re.findall(rb"[^ \t-\r]+", (text or "").encode().lower())]


def sentence(rnd, n, vocabulary="alpha Beta gamma, delta. éta Ünd one two three four".split()):
    return " ".join(rnd.choice(vocabulary) + str(rnd.randrange(40)) for _ in range(n))


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (None, "nobody's text here, at all"), (None, None),
       (5, "same text twice over and over again"), (5, "same text twice over and over again"), (6, "\x0b\x1cé İK ▁ x" * 3),
       (7, "long " * 5000)]


# ---- 1 contamination ----------------------------------------------------------

def brute_contamination(texts, items, window=10):
    wins = {}
    for item, text in items:
        w = alnum(text)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[k:k + window]), set()).add(str(item))
    out = []
    for text in texts:
        w, hit, found = alnum(text), set(), set()
        for size in {len(k) for k in wins}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in wins:
                    found |= wins[tuple(w[k:k + size])]
                    hit.update(range(k, k + size))
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("shard", [64, 300, contamination.SHARD_WORDS])
def test_contamination_in_shards(shard):
    rnd = random.Random(1)
    some = lambda n: " ".join(rnd.choice(["a", "b", "C", "é,", "d!"]) for _ in range(n))
    texts = [some(rnd.randrange(60)) for _ in range(80)] + ["", None, "a " * 300]
    items = [(i, some(rnd.randrange(15))) for i in range(40)]
    phrases = [contamination.Phrases([str(i) for i, _ in part], [t for _, t in part], 10)
               for part in (items[:20], items[20:])]
    offsets, hit, found = contamination.scan(textblocks.strings(pa.array(texts, pa.string())), phrases, shard)
    got = [(int(b - a), int(hit[a:b].sum()), sorted(f)) for a, b, f in zip(offsets, offsets[1:], found)]
    assert got == brute_contamination(texts, items)


def test_contamination_of_odd_rows(spark):
    rows = ODD + [(8, "x one two three four five six seven eight nine ten y")]
    items = [(1, "One two, three four five six seven eight nine ten"), (2, None), (None, "a"), (3, "same text"), (3, "")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    out = contamination.contamination(docs(spark, rows), bench).collect()
    want = brute_contamination([t for _, t in rows], [(i, t) for i, t in items if i is not None and t is not None])
    assert sorted((r.n_words, r.n_hit, r["items"]) for r in out) == sorted(want)
    hit = next(r for r in out if r.doc_id == 8)
    assert [(s.first_word, s.end_word) for s in hit.spans] == [(1, 11)] and hit.contaminated
    assert hit.items_sha256 == hashlib.sha256(b"1").hexdigest()
    left = contamination.uncontaminated(docs(spark, rows), bench)
    assert left.columns == docs(spark, []).columns and left.where("doc_id IN (5, 8)").count() == 0
    assert contamination.contamination(docs(spark, []), bench).count() == 0
    assert not any(r.contaminated for r in contamination.contamination(docs(spark, rows), bench.limit(0)).collect())


# ---- 2 licenses ----------------------------------------------------------------

def test_licenses(spark):
    rows = ODD + [(10, "Released under the MIT License."), (11, "x under the mit license under the MIT-license"),
                  (12, "Licensed under the Apache License, Version 2.0"), (13, "cc by NC cc by nc"),
                  (14, "this work is licensed under a gnu general public license version 3"), (15, "under the mint license")]
    out = {}
    for r in licenses.licenses(docs(spark, rows)).collect():
        out.setdefault((r.doc_id, r.n_words), []).append(r)
    phrases = [(p.split(), label) for p, label in licenses.PHRASES]
    for i, text in rows:
        w = alnum(text)
        at = [(k, label) for k in range(len(w)) for p, label in phrases if w[k:k + len(p)] == p]
        want = (len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None),
                ",".join(sorted({x for _, x in at})))
        for r in out[(i, len(w))]:
            assert (r.n_base, r.first_word, r.last_word, r.base_labels) == want, (i, r)
            assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert sum(map(len, out.values())) == len(rows)
    assert [r.labels for r in out[(14, 12)]] == ["gpl-3"] and [r.labels for r in out[(15, 4)]] == [""]
    assert licenses.licenses(docs(spark, [])).count() == 0


# ---- 3 quality -----------------------------------------------------------------

def test_quality(spark):
    rnd = random.Random(3)
    rows = ODD + [(20 + k, " ".join(rnd.choice("ab cd ef. gh".split()) for _ in range(rnd.randrange(60)))) for k in range(30)]
    rows += [(60, "home | about | contact\n" + sentence(rnd, 30) + ".\nAll rights reserved\n" + "Same line here.\n" * 3),
             (61, "a### b$$$ c&&& d*** " * 10)]
    out = quality.quality(docs(spark, rows)).collect()
    want = []
    for i, text in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        runs, covered = {}, set()
        for k in range(len(w) - 4):
            runs.setdefault(tuple(w[k:k + 5]), []).append(k)
        for places in runs.values():
            if len(places) > 1:
                covered.update(p + k for p in places for k in range(5))
        filled = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(filled) - len(set(filled)),
                     len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w)))
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out]
    assert sorted(got, key=lambda x: str(x)) == sorted(want, key=lambda x: str(x))
    kept = {r.doc_id for r in out if r.kept}
    assert 61 not in kept and 60 in kept
    clean = quality.cleaned(docs(spark, rows))
    assert clean.columns == docs(spark, []).columns
    rest = {r.doc_id: r.text for r in clean.collect()}
    assert set(rest) == kept and "home" not in rest[60] and "rights" not in rest[60] and "Same line" in rest[60]
    assert quality.quality(docs(spark, [])).count() == 0 and quality.cleaned(docs(spark, [])).count() == 0


# ---- 4 urls --------------------------------------------------------------------

def test_url_rules_and_model(spark):
    rnd = random.Random(4)
    urls = [None, "", "no-scheme.net/x", "http://a.NET/", "http://net", "http://xnet/", "https://example.net/en/a?b=://c/",
            "http://www.Example.com/de/1#x", "http://example.com/DE/1", "ftp://b.org/fr/", "http://b.org?fr/", "http://b.org/fr/"]
    urls += [f"http://site{rnd.randrange(99)}.example.com/en/{rnd.randrange(9999)}" for _ in range(400)]
    urls += [f"http://{x}.example.com/en/{rnd.randrange(9999)}" for x in ("casino-win", "free-bets") for _ in range(40)]
    pages = spark.createDataFrame([(k, u, 1) for k, u in enumerate(urls)] + [(None, "http://q.com/", 2)],
                                  "page_id bigint, url string, host int")
    out = {r.page_id: r for r in urlfilter.judge_urls(pages).collect()}
    assert len(out) == len(urls) + 1
    for k, url in enumerate(urls):
        rest = url.partition("://")[2] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.encode().lower().decode()
        fits = [(len(h + p), h + p, v) for v, h, p in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits)[1:] if fits else (None, None)
        r = out[k]
        assert (r.host, r.path, r.rule) == (host, path, rule) and (rule is None or r.verdict == verdict), url
    judged = [(urls[k], r.verdict) for k, r in out.items() if k is not None and r.rule is None and "example.com/en/" in (urls[k] or "")]
    bad = [v for u, v in judged if "casino" in u or "bets" in u]
    good = [v for u, v in judged if "site" in u]
    assert bad.count("block") / len(bad) > 0.9 and good.count("block") / len(good) < 0.05
    assert urlfilter.judge_urls(pages.limit(0)).count() == 0


# ---- 5 near duplicates ------------------------------------------------------------

def brute_components(rows, size, percent=80):
    sets = {}
    for i, text in rows:
        w = spaced(text)
        grams = [tuple(w[k:k + size]) for k in range(len(w) - size + 1)] if len(w) >= size else [tuple(w)] * bool(w)
        sets.setdefault(i, set()).add(frozenset(grams))
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[x] for b in sets[y]):
                a, b = top(x), top(y)
                parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def test_near_duplicates_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BUCKET_BLOCK", 16)  # many blocks, as in a hot group
    monkeypatch.setattr(neardup, "FAMILY_BLOCK", 2000)
    rnd = random.Random(5)
    rows = [r for r in ODD if r[0] is not None]
    base = [sentence(rnd, 150).split() for _ in range(4)]
    for k in range(160):
        words = list(base[k % 4] if k % 3 else base[0])
        for _ in range(rnd.randrange(9)):
            words[rnd.randrange(len(words))] = f"edit{rnd.randrange(9999)}"
        rows.append((100 + (k * 7) % 1000, " ".join(words)))
    rows += [(2000 + k, sentence(rnd, rnd.randrange(1, 8))) for k in range(20)] + [(3000, rows[20][1]), (3001, rows[20][1])]
    out = neardup.near_duplicates(docs(spark, rows + [(None, "x y z")]), shingle=4).collect()
    want = brute_components(rows, 4)
    assert len(out) == len(rows) + 1
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.kept) == (want[r.doc_id], r.doc_id == want[r.doc_id])
    left = neardup.without_near_copies(docs(spark, rows + [(None, "x y z")]), shingle=4)
    assert left.columns == docs(spark, []).columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted(i for i in want if want[i] == i)
    assert neardup.near_duplicates(docs(spark, [])).count() == 0


def test_many_short_unlinked_texts_in_one_family(spark):
    """Texts that differ in their last word alone: similarity 6 / 8, one family, no link."""
    peak, done = [0], threading.Event()

    def watch():
        while not done.wait(0.05):
            for p in psutil.Process().children(recursive=True):
                with contextlib.suppress(psutil.Error):
                    if "python" in p.name():
                        peak[0] = max(peak[0], p.memory_info().rss)
    rows = [(k, f"one two three four five six seven eight nine last{k}") for k in range(5000)]
    rows += [(9000, rows[17][1] + " "), (9001, rows[17][1].upper())]
    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        out = neardup.near_duplicates(docs(spark, rows), shingle=4).collect()
    finally:
        done.set()
        watcher.join()
    assert {r.doc_id: r.component_id for r in out} == {i: 17 if i >= 9000 else i for i, _ in rows}
    assert peak[0] < 500e6, peak  # one matrix of all members has 25 million cells


def test_ids_repeated_with_different_texts(spark):
    """A link that runs through an id's several texts counts, also for its empty text."""
    rnd = random.Random(8)
    t = [sentence(rnd, 60) for _ in range(5)]
    rows = [(5, t[0]), (5, t[1]), (3, t[0]), (7, t[1] + " more"), (5, ""), (5, None), (11, t[2]), (11, t[3]), (10, t[3]),
            (12, t[2] + " more"), (12, t[4]), (13, t[4]), (20, ""), (20, None), (21, "one two"), (21, " ")]
    out = neardup.near_duplicates(docs(spark, rows), shingle=4).collect()
    want = brute_components(rows, 4)
    assert {want[i] for i in (3, 5, 7)} == {3} and {want[i] for i in (10, 11, 12, 13)} == {10}
    assert sorted((r.doc_id, r.component_id, r.kept) for r in out) == sorted((i, want[i], want[i] == i) for i, _ in rows)


def test_block_pairs_spread_over_tasks(spark):
    """All pairs of the blocks of one group that hold a query block, each once and not in one task."""
    rows = [(7, k, [k], 4, 12, k < 4) for k in range(12)]
    blocks_of = spark.createDataFrame(rows, "family int, block int, members array<int>, queries int, blocks int, query boolean")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = neardup._block_pairs(blocks_of, "family").select("x", "y", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted((r.x[0], r.y[0]) for r in out) == [(i, j) for i in range(12) for j in range(i, 12) if i < 4]
    assert len({r.task for r in out}) == 8  # as many as the session has shuffle partitions


def test_pigeonhole_guarantee():
    rnd = np.random.default_rng(5)
    one = rnd.integers(0, 1 << 16, (50, neardup.SLOTS), dtype=np.uint16)
    other = one.copy()
    for row in other:  # as many wrong slots as the threshold allows, anywhere
        row[rnd.choice(neardup.SLOTS, 2 * neardup.CHUNKS - 1, replace=False)] ^= 1
    assert all(set(a) & set(b) for a, b in zip(neardup.chunk_keys(one).tolist(), neardup.chunk_keys(other).tolist()))


def test_components(spark):
    rnd = random.Random(6)
    for edges in ([(k, k + 1) for k in range(40)], [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)], []):
        parent = {x: x for e in edges for x in e if e[0] != e[1]}

        def top(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for a, b in edges:
            if a != b:
                a, b = top(a), top(b)
                parent[max(a, b)] = min(a, b)
        got = components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
        assert {r.node: r.component for r in got} == {x: top(x) for x in parent}


def test_components_of_a_long_chain(spark, monkeypatch):
    """A chain of ascending ids takes rounds by the logarithm of its length."""
    tables, stored = [], components.stored
    monkeypatch.setattr(components, "stored", lambda df, name: tables.append(name) or stored(df, name))
    edges = spark.range(1, 100).selectExpr("id AS a", "id + 1 AS b")
    got = components.components(edges).collect()
    assert {r.node: r.component for r in got} == dict.fromkeys(range(1, 101), 1)
    assert tables.count("labels") <= 20


# ---- 6 lines ------------------------------------------------------------------

def brute_lines(rows, smallest=10):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").encode().lower().decode()
    rank = lambda i: (i is None, i or 0)
    owner = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            k = key(line)
            owner[k] = min(owner.get(k, rank(i)), rank(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < smallest or owner[key(x)] == rank(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("batches", [1, 5])
def test_line_dedup(spark, batches):
    rnd = random.Random(7)
    lines = [f"{'  ' * (k % 2)}Common Line number {k} É" for k in range(12)] + ["short", "", "\t", "common line NUMBER 3 É "]
    rows = ODD + [(50 + (k * 13) % 97, "\n".join(rnd.choice(lines) for _ in range(rnd.randrange(9)))) for k in range(60)]
    got = linededup.line_dedup(docs(spark, rows), batches=batches).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_lines(rows)))
    left = linededup.without_repeated_lines(docs(spark, rows), batches=batches)
    want = [(i, t) for (i, _, n, t) in brute_lines(rows) if not n or t.strip(" \t\n\x0b\x0c\r")]
    assert left.columns == docs(spark, []).columns
    assert sorted(str((r.doc_id, r.text)) for r in left.collect()) == sorted(map(str, want))
    assert linededup.line_dedup(docs(spark, [])).count() == 0


def test_line_runs_are_compacted(spark):
    store = linededup.LineRuns(spark, fan_in=2, buckets=3)
    for k in range(5):
        rows = [(x, x * 7, k * 100 + x) for x in range(k, k + 4)]
        new = store.add(spark.createDataFrame(rows, "h1 bigint, h2 bigint, owner bigint"))
        assert sorted(r.h1 for r in new.collect()) == ([0, 1, 2, 3] if k == 0 else [k + 3])
    assert [len(level) for level in store.levels] == [1, 0, 1]  # five batches: one run of four and one of one
    assert sum(spark.table(n).count() for n in store.runs()) == 8


# ---- 7 pieces ------------------------------------------------------------------

def odd_texts(seed, n):
    rnd = random.Random(seed)
    parts = ["a", "B", "é", "É", "the", "ing", "'s", ",", "…", "1", "２", " ", "  ", "\n", "\t", "\x0b", "　", "中", "文",
             "😀", "\x01", "İ", "aaaa", "er", "on", "J̌", "é", "̸", "don't", "<|", "<|endoftext|>", "."]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randrange(14))) for _ in range(n)] + ["", "x" * 6000, " "]


def test_pieces_without_dropout_equal_the_library():
    import sentencepiece
    library, model, texts = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.piece_model(PIECES), odd_texts(8, 1500)
    ids, counts, skips = model.encode(pa.array(texts), np.arange(len(texts), dtype=np.uint64), dropout=0.0)
    ends = np.cumsum(counts)
    assert [ids[e - n:e].tolist() for e, n in zip(ends, counts)] == [library.encode(t) for t in texts] and not skips.any()


def test_dropout_is_lossless_keyed_and_varied():
    model, texts = pieces.piece_model(PIECES), odd_texts(9, 500) + ["▁", "a▁b ▁ c"]
    keys, arrays = np.arange(len(texts), dtype=np.uint64), pa.array(texts)
    first = model.encode(arrays, keys, seed=1, dropout=0.3)
    offsets, data = model.decode(first[0], first[1])
    assert [data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])] == texts
    assert all(np.array_equal(a, b) for a, b in zip(first, model.encode(arrays, keys, seed=1, dropout=0.3)))
    assert not np.array_equal(first[0], model.encode(arrays, keys, seed=2, dropout=0.3)[0])
    words = sorted({w for t in texts for w in t.split(" ") if 0 < len(w) < 60 and "▁" not in w})
    variants = np.arange(len(words)) % 8
    ids, counts, _ = model.segment(pa.array(words), variants, 7, 0.3)
    ends = np.cumsum(counts)
    for word, variant, e, n in zip(words, variants.tolist(), ends, counts):
        symbols = [int(model.character[ord(c)]) if model.character[ord(c)] >= 0 else -1 - ord(c) for c in word]
        plain = [x for s in model.agenda(symbols, 0, variant, 7, 0.3)
                 for x in ([s] if s >= 0 else model.byte[list(chr(-1 - s).encode())].tolist())]
        assert plain == ids[e - n:e].tolist(), word


def test_pieces_query_form(spark):
    out = pieces.encode_pieces(docs(spark, ODD), PIECES)
    rows = out.collect()
    assert all(r.lossless and r.n_tokens == len(r.ids) for r in rows) and len(rows) == len(ODD)
    assert all(zlib.crc32(np.array(r.ids, "<i4")) == r.ids_crc32 for r in rows)
    back = pieces.decode_pieces(out, PIECES).collect()
    assert sorted(map(str, map(tuple, back))) == sorted(str((i, t or "")) for i, t in ODD)
    assert pieces.encode_pieces(docs(spark, []), PIECES).count() == 0


# ---- 8 toxicity -----------------------------------------------------------------

def test_gradients():
    rng = np.random.default_rng(0)
    net = toxicity.Network(5, 4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    features = rng.normal(size=(20, 5)).astype(np.float32)
    index, mask = rng.integers(0, 20, (6, 7)), np.ones((6, 7), bool)
    mask[0, 4:], index[0, 4:], mask[1], index[1] = False, 20, False, 20
    target = np.array([1, 0, 1, 0, 1, 0.0])
    _, grad = net.gradients(features, index, mask, target)
    for name, value in net.p.items():
        flat = value.reshape(-1)
        for j in (0, len(flat) // 2, len(flat) - 1):
            old, losses = flat[j], []
            for step in (1e-3, -1e-3):
                flat[j] = old + step
                losses.append(net.gradients(features, index, mask, target)[0])
            flat[j] = old
            assert abs((losses[0] - losses[1]) / 2e-3 - grad[name].reshape(-1)[j]) < 2e-3


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 48, 49, 500):
        starts, document = toxicity.windows(np.array([0, n]))
        covered = {p for s in starts.tolist() for p in range(s, min(n, s + toxicity.WINDOW))}
        assert covered == set(range(n)) and len(document) >= 1


def test_toxicity_trains_on_one_row_of_an_id(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(toxicity, "Model", lambda texts, labels, prior: taken.append((texts, labels)))
    free = [r.id for r in spark.range(60).where(~toxicity.held_out("id")).limit(6).collect()]
    known = spark.createDataFrame([(i, k % 2) for k, i in enumerate(free)], "doc_id bigint, toxic int")
    rows = [(i, f"text {i}") for i in free] + [(free[1], f"copy {k}") for k in range(300)] + [(free[2], None)]
    toxicity.train(docs(spark, rows), known, sample=3)
    (texts, labels), = taken
    assert sorted(zip(texts, labels)) == sorted(("copy 0" if k == 1 else f"text {i}", k % 2) for k, i in enumerate(free))


def test_toxicity_learns_planted_words(spark):
    rnd = random.Random(10)
    bad = ["vilebad", "vilest", "wretchy", "scummer"]
    rows, labels = [], []
    for k in range(400):
        words = sentence(rnd, rnd.randrange(20, 120)).split()
        toxic = k % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    extra = [(1000, None), (1001, ""), (None, "vilebad text"), (3, rows[3][1])]
    known = spark.createDataFrame(labels + [(None, 1), (5000, 1), (7, None)], "doc_id bigint, toxic int")
    out = toxicity.toxicity(docs(spark, rows + extra), known).collect()
    assert len(out) == len(rows + extra) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    held = [r for r in out if r.doc_id is not None and r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert held and all(r.held_out for r in held) and not any(r.held_out for r in out if r.doc_id is None)
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) / len(held) > 0.95
    assert toxicity.toxicity(docs(spark, []), known).count() == 0
    none = toxicity.toxicity(docs(spark, rows[:3]), known.limit(0)).collect()
    assert [r.score for r in none] == [0.0] * 3


# ---- 9 token files ----------------------------------------------------------------

def test_word_encoder_equals_the_library():
    from tokenizers import Tokenizer
    library, texts = Tokenizer.from_file(BPE), odd_texts(11, 3000)
    ids, counts = tokenfiles.WordEncoder(BPE).encode(pa.array(texts), 2)
    ends = np.cumsum(counts)
    assert [ids[e - n:e].tolist() for e, n in zip(ends, counts)] == \
        [library.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(BPE)
    rows = ODD + [(100 - k, f"text number {k} of many") for k in range(50)]
    folder = shared_dir(spark, "t-tokens")
    manifest = tokenfiles.write_tokens(docs(spark, rows).repartition(7), folder, BPE)
    got = tokenfiles.read_tokens(spark, folder, manifest).collect()
    start, want = 0, []
    for i, text in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, (x[1] or "").encode())):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        start += len(ids)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and manifest[0]["dtype"] == "<u2"
    assert tokenfiles.read_tokens(spark, folder, tokenfiles.write_tokens(docs(spark, []), folder, BPE)).count() == 0


# ---- 10 warc ----------------------------------------------------------------------

def test_warc_round_trip(spark):
    big, other = "<p>équal</p>" * 200, "y" * 1000
    rows = [(k, f"http://h/{k} \r\n", big) for k in (5, 9, 2)] + [(1, None, None), (3, "u", ""), (4, "u", "x" * 999), (6, "u", "x" * 999),
            (7, "u", other), (None, "u", other), (9, "again", big)] + [(100 + k, "u", f"page {k} " * 50) for k in range(600)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, digest string")
    folder = shared_dir(spark, "t-warc")
    got = warc.read_warc(spark, folder, warc.write_warc(pages.repartition(3), folder), payloads=True).collect()
    largest = {}
    for i, _, html in rows:
        if i is not None:
            largest[html or ""] = max(largest.get(html or "", i), i)
    want = []
    for i, _, html in rows:
        payload = (html or "").encode()
        revisit = len(payload) >= 1000 and largest[html] != i
        want.append((i, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response",
                     largest[html] if revisit else None, None if revisit else payload))
    assert sorted(map(str, ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                             None if r.payload is None else bytes(r.payload)) for r in got))) == sorted(map(str, want))
    assert warc.read_warc(spark, folder, warc.write_warc(pages.limit(0), folder)).count() == 0


def test_broken_archives_are_refused():
    import io

    class Kept(io.BytesIO):
        def close(self):
            self.kept = self.getvalue()
            super().close()

    def archive(records):
        out = Kept()
        writer = warc.ArchiveWriter(out)
        for r in records:
            writer.write(r)
        writer.close()
        return out.kept
    good = [warc.record(k, "u", f"payload {k} <html>".encode() * 30, None) for k in range(700)]
    data = archive(good)
    assert int.from_bytes(data[:4], "little") == warc.SKIPPABLE  # the dictionary stands in front
    assert [r["page_id"] for r in warc.read_archive(io.BytesIO(data), 100)] == list(range(700))
    for broken in (good[0].replace(b"WARC/1.1", b"WARC/9.9"), good[0].replace(b"payload 0", b"payload X", 1),
                   good[0] + b"more", good[0] + good[1], good[0].replace(b"WARC-Type: response\r\n", b""), good[0][:-4]):
        with pytest.raises(warc.WarcError):
            list(warc.read_archive(io.BytesIO(archive([broken]))))
    with pytest.raises(warc.WarcError):
        list(warc.read_archive(io.BytesIO(data[:-5])))


# ---- helpers -----------------------------------------------------------------------

def test_hashes_tell_strings_apart():
    texts = odd_texts(12, 5000)
    values = textblocks.hashes(pa.array(texts))
    assert len(set(values.tolist())) == len(set(texts))
    alone = np.concatenate([textblocks.hashes(pa.array([t])) for t in texts[:200]])
    assert np.array_equal(values[:200], alone)  # whatever stands beside a string


def test_blocks_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (0, 5, 100, 3, 0)] + [None])], names=["t"])
    for size in (1, 6, 1000):
        assert sum(b.num_rows for b in textblocks.blocks(batch, 0, size)) == 6
