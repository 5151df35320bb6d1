"""Merkle manifest, BPE and phrases against brute force, with awkward rows and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.llm import bpe, merkle, packing, phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- Merkle -------------------------------------------------------------------------------------
def brute_tree(leaves):
    """(root, siblings of each leaf) by whole levels."""
    level, paths, place = leaves, [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for k, i in enumerate(place):
            run = range(i - i % 3, min(i - i % 3 + 3, len(level)))
            paths[k].append(("".join(level[j] for j in run if j < i), "".join(level[j] for j in run if j > i)))
            place[k] = i // 3
        level = [sha("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
    return level[0], paths


def brute_merkle(rows):
    """rows: (doc_id, source, lang, n_chars, text) -> result rows."""

    def leaf(r):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    trees = {}
    for r in rows:
        hit = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 2 == 0
        other = leaf((*r[:4], r[4].replace("\n", "") if r[4] is not None and hit else r[4]))
        trees.setdefault(r[1], []).append((r[0], leaf(r), other))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    done = {}
    for s in order:
        own = sorted(trees[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        done[s] = (own, *brute_tree([x[1] for x in own]))
    root, over = brute_tree([done[s][1] for s in order])
    out = []
    for s, above in zip(order, over):
        own, subroot, paths = done[s]
        for (i, digest, other), path in zip(own, paths):
            whole, folded = [*path, *above], other
            for a, b in whole:
                folded = sha(a + folded + b)
            out.append((i, digest, subroot, root, sha("".join(a + b for a, b in whole)), folded, folded == root))
    return sorted(out, key=str)


def awkward_rows():
    r = random.Random(3)
    rows = [(k, f"s{k % 3}", "en", k * 7, f"line {k}\nnext\n" if k % 4 else f"flat {k}") for k in range(260)]
    rows += [(1000, None, None, None, None), (None, None, "en", 1, "a\nb"), (None, "s1", None, 2, ""), (5, "s1", "en", 3, "again"), (7, "s1", "en", 49, "line 7\nnext\n"), (2000, "", "de", 0, "\n"), (2001, "é", "fr", 9, "x" * 100_000 + "\n")]
    rows += [rows[3], rows[3]]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("height", [1, 2, 7])
def test_merkle(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "RANGE_ROWS", 60)
    rows = awkward_rows()
    table = spark.createDataFrame([(*x, "t", 1, "z") for x in rows], "doc_id long, source string, lang string, n_chars long, text string, tree string, rank int, altered string")
    got = merkle.verify(table.repartition(3), {"text": merkle.tamper_newlines(F.col("doc_id"), F.col("text"))})
    found = sorted((tuple(x) for x in got.collect()), key=str)
    assert found == brute_merkle(rows)
    assert {x[-1] for x in found} == {True, False}


def test_merkle_small_tables(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.verify(spark.createDataFrame([], schema)).count() == 0
    one = [(3, "a", "en", 1, "x\n")]
    assert [tuple(x) for x in merkle.verify(spark.createDataFrame(one, schema), {"text": merkle.tamper_newlines(F.col("doc_id"), F.col("text"))}).collect()] == brute_merkle(one)


def test_layout_is_recursive():
    for levels in range(1, 9):
        every = [merkle.addresses(levels, d, np.arange(3**d)) for d in range(levels)]
        assert sorted(np.concatenate(every).tolist()) == list(range(merkle.size_of(levels)))
        top = levels // 2
        if levels > 1:
            # The top part is first; each part below it is one stretch.
            assert sorted(np.concatenate(every[:top]).tolist()) == list(range(merkle.size_of(top)))
            size = merkle.size_of(levels - top)
            for d in range(top, levels):
                part = (every[d] - merkle.size_of(top)) // size
                assert part.tolist() == [i // 3 ** (d - top) for i in range(3**d)]


# ---- BPE ----------------------------------------------------------------------------------------
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_tokenizer())


def awkward_texts():
    r = random.Random(5)
    letters = "aabcdeé ñ  \n\t'st'll1٣²Ⅷ½_-.😀\x1c\x1f\x85​ İ中文字́\U00010940ʰ"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 80))) for _ in range(800)]
    texts += [None, "", " ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b<|endoftext|", "x" * 300, "ab" * 5000, " " * 500 + "end", "é" * 97, "word " * 40_000, "\x00\x01", "it's we'LL 'Tis don''t"]
    return texts


def test_bpe_is_the_librarys(spark):
    exact, texts = library(), awkward_texts()
    table = spark.createDataFrame([(k, t, "own", 7) for k, t in enumerate(texts)], "doc_id long, text string, Ids string, _text int")
    coded = bpe.encode(table.repartition(3))
    assert coded.columns == ["doc_id", "text", "_text", "ids"]
    whole = bpe.decode(coded).collect()
    assert sorted((r["doc_id"], r["text"], r["_text"]) for r in whole) == [(k, t, 7) for k, t in enumerate(texts)]
    want = {k: exact.encode(t or "", add_special_tokens=False).ids for k, t in enumerate(texts)}
    assert {r["doc_id"]: r["ids"] for r in coded.collect()} == want
    assert {r["doc_id"]: r["decoded"] for r in whole} == {k: exact.decode(v, skip_special_tokens=False) for k, v in want.items()}


def test_bpe_decodes_any_ids(spark):
    exact, r = library(), random.Random(8)
    lists = [[r.randrange(50257) for _ in range(r.randint(0, 25))] for _ in range(500)]
    got = {x["k"]: x["decoded"] for x in bpe.decode(spark.createDataFrame(list(enumerate(lists)), "k long, ids array<int>")).collect()}
    assert got == {k: exact.decode(v, skip_special_tokens=False) for k, v in enumerate(lists)}
    odd = spark.createDataFrame([(0, None), (1, [-1, 60000, None, 64]), (2, [])], "k long, ids array<int>")
    assert {x["k"]: x["decoded"] for x in bpe.decode(odd).collect()} == {0: "", 1: exact.decode([64]), 2: ""}
    assert bpe.decode(bpe.encode(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


def test_bpe_arrays_and_heap_agree():
    words, r = bpe.Vocabulary(packing.default_tokenizer()), random.Random(9)
    some = [bytes(r.choice(b"abetins \xc3\xa9") for _ in range(r.randint(1, bpe.SHORT))) for _ in range(2000)]
    assert [np.frombuffer(x, "<i4").tolist() for x in words.encode(some)] == [words.long(w) for w in some]


def test_bpe_table_of_words_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 50)
    exact, coder = library(), bpe.Encoder(packing.default_tokenizer())
    for k in range(6):
        texts = [f"one{k} two{j} three" for j in range(30)]
        assert [x.tolist() for x in coder.encode(texts)] == [exact.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(coder.words) <= 80


# ---- phrases ------------------------------------------------------------------------------------
def brute_phrases(rows, least, longest, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for m in range(1, longest + 1):
                f.update((lang, tuple(ws[i : i + m])) for i in range(len(ws) - m + 1))
    cands = {(g, w): a for (g, w), a in f.items() if len(w) > 1 and a >= least}
    covered = {(g, w[i:j]) for (g, w), a in cands.items() for i in range(len(w)) for j in range(i + 1, len(w) + 1) if j - i < len(w) and f[g, w[i:j]] == a}
    out = []
    for g in n:
        own = []
        for (lang, w), a in cands.items():
            if lang == g and (g, w) not in covered:
                score, k = min((1000 * a * n[g] // (f[g, w[:k]] * f[g, w[k:]]), k) for k in range(1, len(w)))
                own.append((-score, -a, " ".join(w).encode(), f[g, w[:k]], f[g, w[k:]]))
        out += [(g, i, p.decode(), -a, l, r, n[g], -s) for i, (s, a, p, l, r) in enumerate(sorted(own)[:top], 1)]
    return sorted(out)


def phrase_rows():
    r = random.Random(4)
    words = ["A", "b", "c", "D", "e", "été", "x\x1cy", "\xa0", "12"]
    rows = [(r.choice(["en", "en", "de", None, "und"]), "".join(r.choice(words) + r.choice([" ", " ", " ", "\t", "  ", ". ", "\n", "\x0b", ",x "]) for _ in range(r.randint(0, 60)))) for _ in range(300)]
    rows += [("en", None), ("en", ""), (None, " \t.,"), ("fr", "once only"), ("en", "one two three four five six. " * 40), ("en", "tie tie tie " * 60), ("de", "w" * 50_000)]
    return rows + rows[:20]


@pytest.mark.parametrize(("least", "longest", "top"), [(20, 5, 2000), (12, 3, 7), (60, 2, 3)])
def test_phrases(spark, monkeypatch, least, longest, top):
    monkeypatch.setattr(phrases, "BATCH_WORDS", 900)
    monkeypatch.setattr(phrases, "ROW_WORDS", 200)
    monkeypatch.setattr(phrases, "RANKED", 10)
    monkeypatch.setattr(phrases, "PART_PLACES", 700)
    rows = phrase_rows()
    table = spark.createDataFrame([(k, *r, 1, "q") for k, r in enumerate(rows)], "doc_id long, lang string, text string, batch int, word string")
    got = phrases.phrases(table.repartition(4), least=least, longest=longest, top=top).drop("k")
    found = sorted(tuple(x) for x in got.collect())
    assert found and found == brute_phrases(rows, least, longest, top)


def test_phrases_of_nothing(spark, docs, empty):
    assert phrases.phrases(empty).count() == 0
    assert phrases.phrases(docs, least=1_000_000).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    found = spark.createDataFrame([("en", "a b", big, [4 * big], [5 * big])], "lang string, phrase string, f long, pf array<long>, sf array<long>")
    totals = spark.createDataFrame([("en", 7 * big)], "lang string, total long")
    assert phrases._ranked(found, totals, 5).first()["score"] == 1000 * big * 7 * big // (20 * big * big)


def test_trie_bursts_and_spills():
    r = np.random.default_rng(6)
    words = np.append(0, r.integers(1, 40, 500))
    trie = phrases.HatTrie(words, burst=16, most=2000)
    total, runs = Counter(), []
    for _ in range(20):
        a, b = r.zipf(1.3, 3000) % 500 + 1, r.integers(1, 501, 3000)
        a[:500], b[:500] = 7, 9
        total.update(zip(a.tolist(), b.tolist()))
        trie.add(a.astype(np.int64), b.astype(np.int64))
        runs += trie.spill()
    depth = max(isinstance(c, phrases.Node) for c in trie.root.children)
    assert runs and depth
    runs += trie.spill(True)
    seen = Counter()
    for keys, counts in runs:
        assert (np.diff(keys) > 0).all()
        for k, n in zip(keys.tolist(), counts.tolist()):
            seen[k >> 32, k & 0xFFFFFFFF] += n
    assert seen == total and len(trie.root) == 0
