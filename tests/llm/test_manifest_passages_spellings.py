"""The Merkle manifest, the removal of repeated passages and the spelling variants
against brute-force versions, with odd rows, ties, hot groups and empty tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tests.llm.test_operators import ODD, docs
from tidemark.llm import merkle, spellings, substrings, textblocks

# ---- 11 merkle ------------------------------------------------------------------


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_tree(hashes, fan=16):
    """(top, the path of (left, right) of every leaf)."""
    level, paths, place = list(hashes), [[] for _ in hashes], list(range(len(hashes)))
    while len(level) > 1:
        for k, at in enumerate(place):
            first = at // fan * fan
            run = level[first:first + fan]
            paths[k].append(("".join(run[:at - first]), "".join(run[at - first + 1:])))
        level = [digest("".join(level[a:a + fan])) for a in range(0, len(level), fan)]
        place = [at // fan for at in place]
    return (level[0] if level else None), paths


def brute_merkle(rows, fan=16):
    """rows: (doc_id, source, lang, n_chars, text)"""
    def leaf(row):
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    trees, out = {}, []
    for row in rows:
        trees.setdefault(row[1], []).append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(trees[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in order}
    built = {s: brute_tree([leaf(r) for r in trees[s]], fan) for s in order}
    root, above = brute_tree([built[s][0] for s in order], fan)
    for s, top in zip(order, above):
        for row, own in zip(trees[s], built[s][1]):
            path, node = own + top, leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                node = leaf((*row[:4], re.sub("[A-Z]", lambda m: m[0].lower(), row[4])))
            for left, right in path:
                node = digest(left + node + right)
            out.append((row[0], leaf(row), built[s][0], root, digest("".join(a + b for a, b in path)), node, node == root))
    return out


def listed(spark, rows):
    return spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id bigint, source string, lang string, n_chars int, "
                                 "text string, tree string, pos int")


@pytest.mark.parametrize("fan, levels", [(16, 3), (3, 2), (2, 1)])
def test_merkle_equals_brute_force(spark, fan, levels):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["a", "a", "a", "b", "é"]), None if i % 9 == 0 else "en", i if i % 7 else None, f"Text No {i}")
            for i in range(230)]
    rows += [(None, None, None, None, None), (None, "a", "x", 1, "Y"), (5, "a", "en", 5, "Text No 5"), (5, "a", "en", 5, ""),
             (6, "", "de", 6, "Lone"), (7, None, "de", 6, "É" * 50_000), (5, "a", "en", 5, "Text No 5")]
    rnd.shuffle(rows)
    table = listed(spark, rows).repartition(5)
    out = merkle.verified(table, altered=merkle.lower_cased(table), fan=fan, levels=levels)
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, brute_merkle(rows, fan)))


def test_merkle_of_few_rows(spark):
    table = listed(spark, [(1, "s", "en", 2, "ab")])
    row, = merkle.verified(table, altered=merkle.lower_cased(table)).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified
    assert row.proof_sha256 == digest("")
    none = listed(spark, [])
    assert merkle.verified(none, altered=merkle.lower_cased(none)).count() == 0


def test_every_node_has_a_place_of_its_own():
    for fan, levels in ((16, 4), (2, 9), (3, 1)):
        places = [merkle.address(d, np.arange(fan ** d), levels, fan) for d in range(levels)]
        every = np.concatenate(places)
        assert sorted(every.tolist()) == list(range(merkle.nodes(levels, fan)))
    # the upper half stands in front, and every subtree below is one aligned run
    assert sorted(np.concatenate([merkle.address(d, np.arange(2 ** d), 4, 2) for d in (0, 1)]).tolist()) == [0, 1, 2]
    below = [sorted(np.concatenate([merkle.address(2 + d, np.arange(k << d, k + 1 << d), 4, 2) for d in (0, 1)]).tolist())
             for k in range(4)]
    assert below == [[3 + 3 * k, 4 + 3 * k, 5 + 3 * k] for k in range(4)]


def test_a_hot_source_is_spread_and_a_block_is_bounded(spark):
    rows = [(i, "hot" if i % 3 else f"s{i}", "en", 1, f"t{i}") for i in range(3000)]
    leaves, rounds, subroots, upper = merkle.merkle_manifest(listed(spark, rows), fan=4, levels=2)
    assert rounds[0].agg({"count": "max"}).first()[0] <= 16 and subroots.count() == 1001 and len(upper) > 1
    assert leaves.where("tree = '+hot'").groupBy("pos").count().count() == 2000


# ---- 12 passages ----------------------------------------------------------------

def brute_passages(rows, window):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, w in split:
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k:k + window])
                least[key] = min(i, least.get(key, i))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and least[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), digest(kept)))
    return out


@pytest.mark.parametrize("window, gram, shares, block", [(50, 16, 4096, 8 << 20), (6, 3, 4096, 2000), (6, 6, 1, 200),
                                                         (4, 1, 10 ** 9, 3000)])
def test_passages_equal_brute_force(spark, monkeypatch, window, gram, shares, block):
    monkeypatch.setattr(substrings, "SHARES", shares)
    monkeypatch.setattr(substrings, "BLOCK_BYTES", block)
    rnd = random.Random(window)
    some = lambda n: " ".join(rnd.choice(["a", "B", "b", "c,", "é"]) for _ in range(n))
    shared = [some(n) for n in (3, 6, 49, 50, 51, 80)]
    rows = [(rnd.randrange(90), "\n ".join([some(rnd.randrange(30)), rnd.choice(shared), some(rnd.randrange(9)),
                                            rnd.choice(shared)])) for _ in range(150)]
    rows += ODD + [(i, shared[5]) for i in range(200, 260)] + [(300, "x y " * 400), (301, "y x " * 300), (None, shared[5])]
    out = substrings.passage_dedup(docs(spark, rows).repartition(4), window=window, gram=gram).collect()
    assert sorted(str(tuple(r)[:4]) for r in out) == sorted(map(str, brute_passages(rows, window)))
    for r in out:
        places = [p for s in r.spans for p in range(s.first_word, s.end_word)]
        assert len(set(places)) == len(places) == r.n_removed
        assert all(a.end_word < b.first_word for a, b in zip(r.spans, r.spans[1:]))


def test_passages_keep_rows_and_columns(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    rows = [(1, "Start " + passage), (2, f"one  two {passage} three"), (2, "other\ntext"), (3, passage), (4, None), (None, passage)]
    out = substrings.without_repeated_passages(docs(spark, rows))
    assert out.columns == docs(spark, []).columns
    assert sorted(str((r.doc_id, r.text)) for r in out.collect()) == sorted(map(str, [
        rows[0], (2, "one two three"), rows[2], (3, ""), rows[4], rows[5]]))
    assert substrings.passage_dedup(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        substrings.repeated_passages(docs(spark, rows), window=5, gram=6)


def test_passages_with_text_ids(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    table = spark.createDataFrame([("b", passage), ("a", passage + " x"), ("ab", "y " + passage)], "doc_id string, text string")
    got = {r.doc_id: r.n_removed for r in substrings.passage_dedup(table).collect()}
    assert got == {"a": 0, "ab": 60, "b": 60}


def test_a_common_passage_sends_one_row_a_block():
    passage = " ".join(f"w{k}" for k in range(70))
    texts = [f"u{k} " * 5 + passage for k in range(500)]
    part = pa.RecordBatch.from_arrays([pa.array(range(500)), pa.array(texts), pa.array(range(500), pa.int64())],
                                      names=["id", "text", "text_key"])
    out = substrings._runs(part, 50, 16, np.zeros(0, np.uint64)).to_pylist()
    keys = {}
    for r in out:
        if not r["settled"]:
            keys[r["key"]] = keys.get(r["key"], 0) + 1
    # the windows in the passage alone are settled for all documents but the first
    inner = [r for r in out if not r["settled"] and r["first"] >= 5]
    assert {r["id"] for r in inner} == {0}
    assert sum(len(r["hashes"]) for r in out) == 500 * 26


def test_rolling_hashes_and_minima():
    values = textblocks.mix(np.arange(1, 200, dtype=np.uint64) % np.uint64(7))
    hashed = substrings.rolling(values, 9)
    seen = {}
    for k in range(len(values) - 8):
        assert seen.setdefault(tuple(values[k:k + 9].tolist()), hashed[k]) == hashed[k]
    assert len(set(seen.values())) == len(seen)
    for size in (1, 2, 5, 8, 13):
        assert substrings.sliding_min(values, size).tolist() == [min(values[k:k + size]) for k in range(len(values) - size + 1)]


# ---- 13 spellings ---------------------------------------------------------------

def brute_words(rows, typo=199):
    counts = {}
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % typo == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] = counts.get(run, 0) + 1
    return counts


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(counts, ratio=5):
    form, out = {}, []
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


@pytest.mark.parametrize("group, tile, typo", [(2048, 256, 199), (6, 4, 7), (1, 3, 2)])
def test_spellings_equal_brute_force(spark, group, tile, typo):
    rnd = random.Random(group)
    stems = ["abcdefg", "abcdef", "abcdxefg", "aaaaaaa", "aaaaaaaa", "éàÿabcd", "çabcdefg", "Éàÿabcd", "wordlong" * 5]
    rows = []
    for k in range(400):
        words = []
        for _ in range(rnd.randrange(12)):
            w = rnd.choice(stems[:1 + int(rnd.random() ** 3 * len(stems))])
            if rnd.random() < 0.2:
                p = rnd.randrange(len(w))
                w = w[:p] + rnd.choice(["", "x", "xy", "É", "a"]) + w[p + rnd.randrange(2):]
            words.append(rnd.choice([w, w, w.upper(), w.title()]))
        rows.append((k // 2, rnd.choice([" ", "-", "1", "×", "ā", "\n"]).join(words)))
    rows += ODD + [(None, "abcdefg abcdefh " * 6), (900, "z" * 5000 + " " + "z" * 5001 + " "), (901, ("z" * 5000 + " ") * 5)]
    counts = {w: n for w, n in brute_words(rows, typo).items() if len(w) >= 6 and n >= 5}
    got = spellings.spelling_variants(docs(spark, rows).repartition(3), group=group, tile=tile, typo=typo)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute_variants(counts)))


def test_spelling_forms_follow_chains_and_break_ties(spark):
    words = {"aaaaaa": 1000, "aaaaab": 200, "aaaabb": 40, "aaabbb": 8, "zzzzzz": 1000, "zzzzzy": 200, "zzzzxz": 200, "zzzzxy": 40}
    text = " ".join(f"{w} " * n for w, n in words.items())
    counts = brute_words([(1, text)], typo=10 ** 9)
    got = spellings.spelling_variants(docs(spark, [(1, text)]), typo=10 ** 9).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_variants(counts)))
    assert {r.word: r.root for r in got}["aaabbb"] == "aaaaaa" and {r.word: r.form for r in got}["zzzzxy"] == "zzzzxz"
    assert spellings.spelling_variants(docs(spark, [])).count() == 0


def test_long_texts_are_cut_between_words():
    text = " ".join(f"wörd{'abc'[k % 3]}{'xyz'[k % 7 % 3]}" for k in range(5000)) + " " + "q" * 4000
    whole = spellings.count_words(["5"], pa.array([text]), 3)
    assert spellings.count_words(["5"], pa.array([text]), 3, limit=100) == whole == brute_words([(5, text)], 3)


def test_common_prefixes_and_suffixes():
    a, b = ["abc", "x", "abcd" * 30], ["abd", "c", "abcd" * 29 + "abcx"]
    for cells in (1, 50, 1 << 20):
        assert spellings.common(a, b, "head", cells).tolist() == [[2, 0, 3], [0, 0, 0], [2, 0, 119]]
        assert spellings.common(a, b, "tail", cells)[0].tolist() == [0, 1, 0]
