"""Each operator against brute force on a small table, with its awkward rows and an empty table."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from driftline.llm import common, exact_dedup, hnsw, html_extract, langid, minhash, mixing, packing, ppm, queries, substring, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def low(t):
    return (t or "").translate(LOWER)


def residue(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_ppm_probabilities_add_up():
    trie = ppm.Trie(2)
    for text in ("abc abd", "b", ""):
        for context, symbol in trie.contexts(text):
            trie.learn(context, symbol, 2)
    for context in (b"\0\0", b"ab", b"zz", b"\0b", b"c "):
        assert sum(10 ** trie.symbol_log(context, s) for s in range(256)) == pytest.approx(1)


@pytest.mark.parametrize("order", [1, 2, 5, 6])
def test_ppm(spark, docs, empty, order):
    few = docs.where("doc_id <> 5")
    rows = [(r["doc_id"], r["text"]) for r in few.collect()]
    trie, seen = ppm.Trie(order), Counter()
    tokens = {i: [w.encode() for w in WORD.findall(low(t))] + [b"\n"] for i, t in rows}

    def windows(i):
        coded = bytes(order) + b"".join(w + b" " for w in tokens[i][:-1]) + b"\n"
        return [(coded[k - order : k], coded[k]) for k in range(order, len(coded))]

    for i, _ in rows:
        if residue(i, 7) != 2:
            seen.update(tokens[i])
            for context, symbol in windows(i):
                trie.learn(context, symbol)
    total, distinct = sum(seen.values()), len(seen)
    got = ppm.ppm_score(few, order=order, batch_bytes=20_000).collect()
    assert len(got) == len(rows) and {r["held_out"] for r in got} == {True, False}
    for r in got:
        ws = tokens[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (residue(r["doc_id"], 7) == 2, len(ws), sum(w in seen for w in ws), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((seen[w] + 1) / (total + distinct + 1)) for w in ws))
        assert r["score"] == pytest.approx(sum(trie.symbol_log(*w) for w in windows(r["doc_id"])))
    assert ppm.ppm_score(empty, order=order).count() == 0


def test_ppm_adaptive(spark, docs, empty):
    rows = ppm.adaptive_score(docs.where("doc_id in (0, 2, 5)").withColumn("text", F.substring("text", 1, 4000))).collect()
    a = {r["doc_id"]: r["score"] / r["n_tokens"] for r in rows}
    assert a[5] > a[0] and a[2] == pytest.approx(-math.log10(256))
    assert ppm.adaptive_score(empty).count() == 0


def test_ppm_query_depends_on_the_order_of_words(spark, tmp_path):
    """A held-out text costs more when its words are shuffled: contexts go on across words."""
    words = "the old man stands at the river and counts the boats that pass under a bridge of stone".split()
    other = random.Random(4).sample(words, len(words))
    rows = [(i, " ".join(words if i % 2 else words[::-1][:3] + words)) for i in range(60)] + [(1000, " ".join(words)), (1001, " ".join(other))]
    held = [1000, 1001]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in ppm.ppm_score(df, held_out=F.col("doc_id").isin(held)).collect()}
    assert scores[1000] > scores[1001] + 5
    df.write.parquet(f"{tmp_path}/documents.parquet")
    own = {r["doc_id"]: r["score"] for r in queries.op1_ppm_score(spark, str(tmp_path)).collect()}
    assert own[1000] > own[1001] + 5


def test_rows_of_one_id_are_dealt_by_text(spark):
    """Null ids and one length: no batch holds much more than its share."""
    df = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.format_string("%0100d", "id").alias("text"))
    rows, count = common.batched(df, 10_000)
    sizes = [r["n"] for r in rows.groupBy("batch").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert count == 20 and len(sizes) == 20 and max(sizes) < 200


def test_mix(spark, docs, empty):
    got = mixing.mix(docs).collect()
    sizes, texts = Counter(), {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got:
        assert r["size"] == len(WORD.findall(texts[r["doc_id"]] or "")) and 0 <= r["taken"] <= 2 * r["size"]
        sizes[r["source"]] += r["size"]
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, full, left = {}, set(), 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in full]
        share = {s: (left - sum(2 * sizes[x] for x in full)) * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            break
        full |= set(over)
    target = {s: 2.0 * sizes[s] if s in full else share[s] for s in order}
    taken = Counter()
    for r in got:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]]
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == math.floor(target[s] + 1e-9) for s in order)
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)
    rows = mixing.apply_mix(docs)
    assert rows.columns == docs.columns
    assert rows.select(F.sum(F.size(F.regexp_extract_all("text", F.lit(f"({WORD.pattern})"), F.lit(1))))).first()[0] == sum(taken.values())
    assert mixing.mix(empty).count() == 0


def test_mix_of_clashing_columns_and_rows_alike_in_id_and_size(spark):
    rows = [(k % 3 if k % 4 else None, f"{chr(97 + k)} b c", "a", 100 + k, -1.0, "q", "r", "x") for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long, target double, source_size string, taken string, key string")
    out = mixing.apply_mix(df)
    assert out.columns == df.columns
    got = sorted(map(str, out.collect()))
    assert len(got) == 18 and {r["size"] for r in out.collect()} <= set(range(100, 112))
    for other in (df.repartition(5), df.orderBy(F.desc("size"))):
        assert sorted(map(str, mixing.apply_mix(other).collect())) == got


def test_mix_of_many_sources(spark):
    """The water level against the excess given on step by step."""
    rnd = random.Random(5)
    sizes = {f"s{k:03}": rnd.choice((0, 1, 5, 40, 300)) * rnd.randrange(1, 9) for k in range(90)}
    found = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes))}
    full = set()
    while True:
        open_ = [s for s in sizes if s not in full]
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        if not (over := {s for s in open_ if share[s] > 2 * sizes[s]}):
            break
        full |= over
    assert found == pytest.approx({s: 2.0 * sizes[s] if s in full else share[s] for s in sizes})


@pytest.mark.parametrize("run_rows", [20_000, 2])
def test_exact_dedup(spark, docs, empty, run_rows):
    head = "same first characters " * 5
    extra = [(300 + k, head + str(k % 4), "en", "a", "q") for k in range(12)] + [(400 + k, "HOT" if k % 2 else "hot", "en", "a", "q") for k in range(9)] + [(None, "hot", "en", "a", "q"), (None, "alone", "en", "a", "q")]
    all_ = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    rows = [(r["doc_id"], low(r["text"])) for r in all_.collect()]
    groups = {}
    for i, t in rows:
        groups.setdefault(t, []).append(i)
    best = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    want = ordered((i, best[t], len(groups[t]), i == best[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in rows)
    assert ordered(tuple(r) for r in exact_dedup.exact_dedup(all_, run_rows=run_rows).collect()) == want
    least = {r["doc_id"]: r["keep_id"] for r in exact_dedup.exact_dedup(all_, keep="min", run_rows=run_rows).collect()}
    assert least[408] == 400 and least[1] == 0
    kept = exact_dedup.apply_exact_dedup(all_.withColumn("_key", F.lit("q")), run_rows=run_rows)
    assert kept.columns == [*docs.columns, "_key"]
    assert ordered((r["doc_id"],) for r in kept.collect()) == ordered((i,) for i in best.values())
    assert exact_dedup.exact_dedup(empty, run_rows=run_rows).count() == 0


def test_pack(spark, docs, empty):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(packing.default_tokenizer())
    many = docs.unionByName(spark.createDataFrame([(100 + k, "tok " * (k * 7 % 900), "en", "a", "q") for k in range(120)], docs.schema)).where("doc_id <> 13")
    many = many.unionByName(spark.createDataFrame([(990, "a <|endoftext|> b", "en", "a", "q")], many.schema))
    ids = {r["doc_id"]: np.array(exact.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4") for r in many.collect()}
    pieces = packing.pack(many).collect()
    by, sequences = {}, {}
    for p in pieces:
        by.setdefault(p["doc_id"], []).append(p)
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert by.keys() == ids.keys()
    for i, own in by.items():
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids[i]) and zlib.crc32(ids[i][at : at + p["length"]].tobytes()) == p["ids_crc32"]
            at += p["length"]
        assert at == len(ids[i])
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == 1024 or (at < 1024 and at & (at - 1) == 0)
    assert packing.pack(empty).count() == 0


def test_pack_plan_uses_each_length_at_most_as_often_as_it_occurs():
    rng = np.random.default_rng(0)
    h = np.zeros(64, np.int64)
    h[1:] = rng.integers(0, 50, 63)
    combos, n = packing.solve(h, 64)
    used = np.zeros(64, np.int64)
    for c, k in zip(combos, n):
        assert c.sum() == 64 or (c[1:] == 0).all()
        np.add.at(used, c, k)
    left = h - used
    assert (left[1:] >= 0).all()
    # Nothing that fits is left, and no less is packed than by matching pairs alone.
    assert not any(left[a] and left[b] and (a != b or left[a] > 1) for a in range(1, 64) for b in (64 - a,))
    pairs = sum(64 * min(h[a], h[64 - a]) for a in range(33, 64)) + 64 * (h[32] // 2)
    assert (used[1:] * np.arange(1, 64)).sum() >= pairs


def test_pack_fills_windows_with_short_rests(spark):
    """Empty texts (1 token) and copies of a power of two of tokens share windows; only the last tail is shorter."""
    rows = [(k, "") for k in range(700)] + [(1000 + k, "tok " * 200) for k in range(60)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    held = Counter()
    for p in pieces:
        held[p["sequence_id"]] += p["length"]
    short = [n for n in held.values() if n < 1024]
    assert sum(short) < 1024 and len(short) == len(set(short)) and all(n & (n - 1) == 0 for n in short)
    h = np.zeros(1024, np.int64)
    h[[1, 64, 512]] = 5000, 30_000, 7
    combos, n = packing.solve(h, 1024)
    assert all(c.sum() == 1024 for c in combos)


def near_brute(rows):
    """Rows may share ids; each is linked by its own text."""
    sets = []
    for _, t in rows:
        w = WORD.findall(low(t))
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    some = [k for k in range(len(rows)) if sets[k]]
    for a, x in enumerate(some):
        for y in some[:a]:
            k = len(sets[x] & sets[y])
            if 100 * k >= 75 * (len(sets[x]) + len(sets[y]) - k):
                parent[root(x)] = root(y)
    best = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            best[root(k)] = min(i, best.get(root(k), i))
    return [(i, len(sets[k]), best.get(root(k)), i == best.get(root(k))) for k, (i, _) in enumerate(rows)]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v if v is not None else 0) for v in r))


def near_found(df):
    return ordered(tuple(r) for r in minhash.near_duplicates(df).collect())


def test_near_dedup(spark, docs, empty, monkeypatch):
    rnd, base = random.Random(3), [f"w{k}" for k in range(120)]
    extra = []
    for i in range(200):
        w = list(base)
        for _ in range(rnd.choice((1, 2, 3, 4, 6))):
            w[rnd.randrange(120)] = f"x{rnd.randrange(10**6)}"
        extra.append((1000 + i, " ".join(w), "en", "a", "q"))
    monkeypatch.setattr(minhash, "BLOCK", 50)
    monkeypatch.setattr(minhash, "SALT_ROWS", 20)
    all_ = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    rows = [(r["doc_id"], r["text"]) for r in all_.collect()]
    assert near_found(all_) == ordered(near_brute(rows))
    kept = minhash.apply_near_dedup(docs)
    assert kept.columns == docs.columns
    assert kept.count() == kept.select("doc_id").distinct().count()
    assert minhash.near_duplicates(empty).count() == 0


def test_near_dedup_of_repeated_and_null_ids_and_colliding_words(spark):
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    x, y = "".join(thue_morse(2048, "x", "y")), "".join(thue_morse(2048, "y", "x"))
    rows = [(5, a), (5, b), (9, a + " x"), (8, b + " y"), (12, a + " z"), (None, b + " n"), (None, "null and alone here"), (20, f"{x} tail"), (21, f"{y} tail"), (30, "A  b\tC d e F"), (31, "a b c d e f"), (None, "")]
    got = near_found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == ordered(near_brute(rows))
    assert (8, 57, 5, False) in got and (None, 57, 5, False) in got and (21, 1, 21, True) in got
    kept = minhash.apply_near_dedup(spark.createDataFrame([(*r, 1) for r in [*rows, (5, a), (5, a.upper())]], "doc_id long, text string, _class int"))
    assert kept.columns == ["doc_id", "text", "_class"]
    assert ordered((r["doc_id"], r["text"].lower()) for r in kept.collect()) == ordered([(5, a), (5, b), (None, "null and alone here"), (20, f"{x} tail"), (21, f"{y} tail"), (30, "a  b\tc d e f"), (None, "")])


def test_intersections_in_chunks():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, 80).astype(np.uint64)) for _ in range(12)]
    want = [[len(np.intersect1d(a, b)) for b in sets[4:]] for a in sets]
    assert minhash.intersections(sets, sets[4:], chunk=37).tolist() == want


def test_language(spark, docs, empty):
    en, fr = "the house of the old man stands there ", "été où est la garçon à l'école "
    rows = [(i, (en if i % 2 else fr) * (1 + i % 5), "en" if i % 2 else "fr", "a", "q") for i in range(100, 220)]
    got = langid.language(docs.drop("lang").withColumn("lang", F.lit(None).cast("string")).select(*docs.columns).unionByName(spark.createDataFrame(rows, docs.schema)), steps=120).collect()
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (2, 3, 4, 12))
    held = [r for r in got if r["doc_id"] >= 100 and r["held_out"]]
    assert held and all(r["held_out"] == (residue(r["doc_id"], 4) == 2) for r in got)
    assert sum(r["lang_pred"] == ("en" if r["doc_id"] % 2 else "fr") for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert langid.language(empty).count() == 0


def test_language_gradients():
    model = langid.Model(["a", "b"], hidden=3)
    data, lang = np.random.default_rng(0).integers(97, 101, (7, 4)).astype(np.intp), np.array([0, 1, 1, 0])
    _, grads = model.step(data, lang)
    for p, g in zip(model.parameters(), grads):
        flat = np.flatnonzero(np.abs(g.reshape(-1)) > 1e-4)[:4]
        for k in flat:
            at = np.unravel_index(k, p.shape)
            old, e = p[at], 1e-2
            p[at] = old + e
            up = model.step(data, lang)[0]
            p[at] = old - e
            down = model.step(data, lang)[0]
            p[at] = old
            assert (up - down) / (2 * e) == pytest.approx(g[at], rel=0.15, abs=2e-3)


def test_toxicity(spark, docs, empty):
    rnd = random.Random(1)
    bad, rows, labels = ["idiot", "scumbag", "moronic"], [], []
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    for i in range(200, 600):
        w = [rnd.choice(vocabulary) for _ in range(rnd.randrange(5, 80))]
        toxic = i % 4 == 0
        if toxic:
            w.insert(rnd.randrange(len(w)), rnd.choice(bad) + rnd.choice(["", "s", "ic", "!"]))
        rows.append((i, " ".join(w), "en", "a", "q"))
        labels.append((i, 1, int(toxic)))
    lab = spark.createDataFrame([*labels, (2, 1, None), (3, 0, 0)], "doc_id long, quality int, toxic int")
    all_ = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    got = toxicity.toxicity(all_, lab, epochs=80).collect()
    held = [r for r in got if r["doc_id"] >= 200 and r["held_out"]]
    assert len(got) == all_.count() and sum(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    clean = toxicity.apply_toxicity(all_, lab, epochs=80)
    assert clean.columns == docs.columns and clean.count() == sum(r["predicted"] == 0 for r in got)
    assert toxicity.toxicity(empty, lab, epochs=5).count() == 0
    assert {r["score"] for r in toxicity.toxicity(docs, lab.where("false")).collect()} == {0.0}


def test_html(spark):
    page = "<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><a href=x>menu</a></nav><div class='ad'>buy</div><article><h1>T &amp; U</h1><p><b>One long paragraph\n of text.<br><p>Short.</p></article><div id=comments><p>me too</p></div><footer>f</footer>"
    rows = [(1, "u", page), (2, None, None), (3, "v", ""), (4, "w", "plain text"), (4, "w", "plain text")]
    got = sorted((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in html_extract.extract(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")).collect() if r["url"])
    want = "T & U\nOne long paragraph of text.\nShort."
    assert got == [(1, "u", want, len(want)), (3, "v", "", 0), (4, "w", "plain text", 10), (4, "w", "plain text", 10)]


def test_html_without_regions_keeps_short_ends_of_the_text():
    menu = "<ul>" + "".join(f"<li><a href=/{k}>Menu item {k}</a></li>" for k in range(30)) + "</ul>"
    body = [f"{k} " + "word " * 80 for k in range(8)]
    ends = [f"Closing {k}" for k in range(4)]
    text = "<p>Short opening.</p>" + "".join(f"<p>{b}</p>" for b in body) + "<ul>" + "".join(f"<li>{e}</li>" for e in ends) + "</ul>"
    want = "\n".join(["Short opening.", *(b.strip() for b in body), *ends])
    assert html_extract.main_text(f"<body>{menu}<div>{text}</div><div><p>Elsewhere</p></div></body>") == want
    assert html_extract.main_text(f"<body>{menu}{text}</body>") == want


def test_html_ratios_decide_about_links_in_regions(monkeypatch):
    """Runs of links at an article's ends are menus, by their ratios alone; links beside or between text stay."""
    links = "".join(f"<li><a href=/{k}>Item number {k}</a></li>" for k in range(6))
    body = ["word " * 60 + str(k) for k in range(4)]
    text = "".join(f"<p>{b}</p>" for b in body)
    pages = {
        f"<article><ul>{links}</ul><h1>Title</h1>{text}<p>End.</p><ul>{links}</ul></article>": ["Title", *body, "End."],
        f"<article>{text}<p><a href=x>Source</a></p></article>": [*body, "Source"],
        f"<article><p>{body[0]}</p><ul>{links}</ul><p>Short end.</p></article>": [body[0], *(f"Item number {k}" for k in range(6)), "Short end."],
        f"<main><h2><a href=x>Linked title</a></h2>{text}</main><ul>{links}</ul>": ["Linked title", *body],
        f"<article><p>Hi.</p>{text * 30}<p>Bye.</p></article>": ["Hi.", *body * 30, "Bye."],
        f"<article><ul>{links}</ul></article>": [f"Item number {k}" for k in range(6)],
    }
    for page, want in pages.items():
        assert html_extract.main_text(f"<body>{page}</body>").split("\n") == want
    monkeypatch.setattr(html_extract, "_trimmed", lambda own, blocks, ratios, near, low, f=html_extract._trimmed: f(own, blocks, [1.0] * len(ratios), [1.0] * len(near), 0.0))
    first = next(iter(pages))
    assert html_extract.main_text(first).count("Item number") == 12


def test_html_takes_the_heavier_of_regions_and_the_rest():
    body = ["word " * 80 + str(k) for k in range(6)]
    cards = "".join(f"<article><p>{'teaser ' * 12}{k}</p></article>" for k in range(3))
    page = "<body><div>" + "".join(f"<p>{b}</p>" for b in body) + f"</div>{cards}</body>"
    assert html_extract.main_text(page) == "\n".join(body)
    assert html_extract.main_text(f"<body><div><p>{'aside ' * 12}</p></div><article><p>{body[0]}</p></article></body>") == body[0]


def test_html_of_deep_nesting_takes_time_in_proportion():
    import time

    def seconds(n):
        page = "<body>" + "<div><b>" * n + "<p>text of the page</p>" + "</b></div>" * n
        best = 9.0
        for _ in range(3):
            start = time.perf_counter()
            assert html_extract.main_text(page) == "text of the page"
            best = min(best, time.perf_counter() - start)
        return best

    assert seconds(16_000) < 8 * seconds(4_000) + 0.1


def test_html_in_odd_wrappers(spark, empty):
    text = "word " * 80 + "end"
    assert html_extract.main_text(f"<body><div class='search results'><h1>T</h1><p>{text}</p><p>Short.</p></div></body>") == f"T\n{text}\nShort."
    assert html_extract.main_text(f"<body><div class=notice><p>{text}</p></div></body>") == ""
    assert html_extract.main_text(f"<body><p>{text}</p><b><p>over</b>lapped</p><i>unclosed") == f"{text}\noverlapped\nunclosed"
    pages = spark.createDataFrame([(None, None, "<p>x")], "page_id long, url string, html string")
    assert [tuple(r) for r in html_extract.extract(pages).collect()] == [(None, None, "x", 1)]
    assert html_extract.extract(pages.where("false")).count() == 0


def test_html_names():
    text = "word " * 80 + "end"
    assert html_extract.main_text(f"<body><div class=widget><article><p>{text}</p><div class=share>Share</div></article></div><p>Short.</p></body>") == text
    assert html_extract.main_text(f"<body><article><p>{text}</p></article><div id=comments><article><p>me too</p></article></div></body>") == text
    for name in ("no-sidebar", "social-science", "search-results-text"):
        assert html_extract.main_text(f"<body><div class='{name}'><p>{text}</p></div></body>") == text
    for name in ("comment-list", "site-footer", "ad-1"):
        assert html_extract.main_text(f"<body><div><p>{text}</p></div><div class={name}><p>{text}</p></div></body>") == text


def test_nearest(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 12)).astype(np.float32) * rng.uniform(0.5, 2, (900, 1)).astype(np.float32)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(1000 + k, x[0].tolist(), 1) for k in range(60)]
    rows += [(2000, None, 1), (2020, [0.0] * 12, 1), (2040, [float("nan")] + [1.0] * 11, 1), (2060, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = {}
    for r in hnsw.nearest(df, shard_rows=300).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    ids = np.array([r[0] for r in rows[:960]])
    m = np.array([r[1] for r in rows[:960]], np.float64)
    hits = 0
    assert sorted(got) == sorted(i for i in ids.tolist() if i % 20 == 0)
    for q, own in got.items():
        s = m @ m[ids.tolist().index(q)]
        s[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -s))[:20]].tolist()
        hits += len({i for i, _ in own} & set(best))
        assert len(own) == 20 and own == sorted(own, key=lambda p: (-p[1], p[0]))
    assert hits >= 0.95 * 20 * len(got)
    assert hnsw.nearest(df.where("false")).count() == 0


def test_nearest_keeps_doubles_and_odd_ids(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(300, [1e200, 0.0, 0.0, 0.0, 0.0, 1.0]), (301, [1e-200] * 6), (None, [9.0] * 6), (7, x[7].tolist()), (7, [99.0] * 6), (302, [1.0, 2.0])]
    got = {}
    for r in hnsw.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    ids = [r[0] for r in rows[:202]]
    m = np.array([r[1] for r in rows[:202]])
    assert sorted(got) == sorted(i for i in ids if i % 20 == 0)
    hits = 0
    for q, own in got.items():
        s = m @ m[ids.index(q)]
        best = sorted((-v, i) for v, i in zip(s.tolist(), ids) if i != q)[:20]
        hits += len({i for _, i in best} & {i for i, _ in own})
        assert all(v == pytest.approx(s[ids.index(i)], rel=1e-12) for i, v in own)
    assert hits >= 0.95 * 20 * len(got)


def thue_morse(n, a, b):
    """n letters of the sequence in a and b; with its complement it collides under polynomials modulo 2^64."""
    return [(a, b)[k.bit_count() % 2] for k in range(n)]


def repeats_brute(rows):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = Counter(tuple(w[k : k + 35]) for _, w in words for k in range(len(w) - 34))
    want = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = [True] * 35
        spans = [k for k in range(len(w) + 1) if (k > 0 and gone[k - 1]) != (k < len(w) and gone[k])]
        want.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g), list(zip(spans[::2], spans[1::2]))))
    return want


@pytest.mark.parametrize("group_rows", [50_000, 3])
def test_remove_repeats(spark, docs, empty, group_rows):
    extra = [" ".join(["a b c d e"] * 20), *(" ".join(f"u{k}" for k in range(n)) for n in (36, 35, 34))]
    odd = ["".join(thue_morse(2048, "x", "y")), "".join(thue_morse(2048, "y", "x"))]
    around = [f"v{k}" for k in range(20)]
    extra += [" ".join([*around, w, *around[::-1]]) for w in odd]
    extra += [" ".join(f"s{k}" for k in range(30)) + " " + x + " " + " ".join(thue_morse(2048, x, y)) for x, y in (("p", "q"), ("q", "p"))]
    extra += ["ab c " * 20, "a bc " * 20]
    all_ = docs.unionByName(spark.createDataFrame([(500 + k, t, "en", "a", "q") for k, t in enumerate(extra)], docs.schema))
    all_ = all_.unionByName(spark.createDataFrame([(None, "n " * 3, "en", "a", "q")], docs.schema))
    rows = [(r["doc_id"], r["text"]) for r in all_.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    got = [(*tuple(r)[:4], [tuple(s) for s in r["spans"]]) for r in substring.remove_repeats(all_, group_rows=group_rows, batch_bytes=10_000).collect()]
    assert sorted(got, key=key) == sorted(repeats_brute(rows), key=key)
    assert substring.remove_repeats(empty).count() == 0


def test_suffix_tree_orders_suffixes_and_counts_shared_words():
    rng = random.Random(3)
    for window in (1, 2, 5):
        texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(1, 23))) for _ in range(40)] + ["a"] * 2
        tree = substring.suffix_tree(pa.array(texts), window)
        words = [t.split() for t in texts]
        suffixes = [words[t][f:] for t, f in zip(tree.text, tree.first)]
        assert sorted(zip(tree.text.tolist(), tree.first.tolist())) == [(t, f) for t, w in enumerate(words) for f in range(len(w) - window + 1)]
        shared = lambda x, y: next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
        assert tree.shared.tolist() == [0] + [shared(x, y) for x, y in zip(suffixes, suffixes[1:])]
        # Neighbours in the order share the most: whatever any two suffixes share, all between them share as well.
        for i in range(0, len(suffixes), 17):
            for j in range(i + 1, len(suffixes), 29):
                assert shared(suffixes[i], suffixes[j]) == min(tree.shared[i + 1 : j + 1])
    assert len(substring.suffix_tree(pa.array([], pa.string()), 3).text) == 0


def test_hot_prefixes_in_parts():
    """One prefix in parts gives the marks that it gives whole, and so do counted anchors."""
    rng = random.Random(5)
    window, rows = 4, []
    for prefix in range(30):
        for batch in range(300 if prefix == 7 else rng.randrange(1, 9)):
            n = window if prefix == 7 else rng.randrange(window, 9)
            rows.append((batch, prefix, prefix, True, len(rows), 1, " ".join(rng.choice(f"p{prefix} q{prefix}".split()) for _ in range(n))))
    schema = pa.schema([("batch", pa.int32()), ("prefix", pa.int64()), ("anchor", pa.int64()), ("large", pa.bool_()), ("rank", pa.int32()), ("n", pa.int64()), ("piece", pa.string())])
    table = pa.table([list(c) for c in zip(*rows)], schema=schema)
    seen = Counter()
    for r in rows:
        w = r[6].split()
        seen.update((r[1], *w[k : k + window]) for k in range(len(w) - window + 1))
    want = {}
    for r in rows:
        w = r[6].split()
        mark = sum(1 << k for k in range(len(w) - window + 1) if seen[(r[1], *w[k : k + window])] > 1)
        want |= {r[4]: mark} if mark else {}
    for chunk, held, most in ((10_000, 1 << 15, 1 << 16), (7, 10, 20), (50, 20, 100), (1, 1, 2)):
        got = Counter()
        for b in substring._trees(window, held, most)(iter(table.to_batches(chunk))):
            for rank, mark in zip(b.column("rank").to_pylist(), b.column("mark").to_pylist()):
                got[rank] |= mark
        assert got == want
    counted = table.select(["batch", "anchor", "n"])
    kept = [b for b in substring._repeated(40)(iter(counted.to_batches(9)))]
    got = Counter((a, big) for b in kept for a, big in zip(b.column("anchor").to_pylist(), b.column("large").to_pylist()))
    n = Counter(r[2] for r in rows)
    assert got == Counter({(a, k > 40): k for a, k in n.items() if k > 1})


def test_repeats_query(spark, tmp_path, docs):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = sorted((i, n, r, hashlib.sha256(k.encode()).hexdigest()) for i, n, r, k, _ in repeats_brute([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert sorted(tuple(r) for r in queries.op10_remove_repeats(spark, str(tmp_path)).collect()) == want


def test_names_of_runs():
    from driftline.llm import wordhash

    rng = random.Random(1)
    texts = [" ".join(rng.choice(("ab", "c", "d", "e")) for _ in range(rng.randrange(60))) for _ in range(50)] + [" \t x  y\n", None, ""]
    found = wordhash.words(pa.array(texts))
    split = [(t or "").split() for t in texts]
    flat = [w for own in split for w in own]
    assert found.per_text.tolist() == [len(w) for w in split] and [found.known[int(k)].as_py() for k in found.number] == flat
    for length in (1, 2, 3, 5, 12, 35):
        named = wordhash.names(found.number, length)
        runs = [tuple(flat[k : k + length]) for k in range(len(named))]
        assert len({*zip(runs, named.tolist())}) == len({*runs}) == len({*named.tolist()})
    owner, _, _ = wordhash.shingles(found, 5)
    for k, w in enumerate(split):
        assert (owner == k).sum() == (len({tuple(w[j : j + 5]) for j in range(len(w) - 4)}) if len(w) >= 5 else min(1, len(w)))
