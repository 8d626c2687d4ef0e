"""The text operators against brute force on small tables with nulls, empty and repeated rows, ties and extra columns."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from parcelcast.llm import decontaminate, hamming, htmltext, jaccard, linededup, mixing, nbsvm, substrings, tokenids, toxicity
from parcelcast.llm.common import Words

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, label string"
AWKWARD = [None, "", " \t\n ", "one", "One TWO", "a b c d", "A b c d é " * 40, "x" * 5000, "z " * 3000]


def documents(spark, texts, sources=None, start=0):
    """A documents table with extra columns whose names the operators use themselves."""
    rows = [(start + i, t, "en", (sources or ["s"])[i % len(sources or ["s"])], len(t or ""), 7, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def near_texts(seed, count=60, words=40, vocabulary=30):
    """Random texts, copies with a few changed words, and exact copies."""
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        if out and rng.random() < 0.6:
            text = rng.choice(out).split(" ")
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                text[rng.randrange(len(text))] = f"w{rng.randrange(vocabulary)}"
        else:
            text = [f"w{rng.randrange(vocabulary)}" for _ in range(rng.choice([3, 12, words, 2 * words]))]
        out.append(" ".join(text))
    return out


def words_of(text):
    return (text or "").encode().split()


def test_words_match_a_plain_split():
    texts = [t or "" for t in AWKWARD] + ["end.", "a\x0bb\x0cc", ""]
    words = Words(pa.array(texts))
    got = [[bytes(words.raw[x:y]) for x, y in zip(words.start[a:b], words.end[a:b])] for a, b in words.spans()]
    assert got == [words_of(t) for t in texts]
    assert len(set(words.hash.tolist())) == len({w for t in texts for w in words_of(t)})


# --- op 1


def brute_top(ids, codes, k):
    out = {}
    for i, c in zip(ids, codes):
        if i % 50 == 0:
            near = sorted((int(np.bitwise_count(c ^ d).sum()), j) for j, d in zip(ids, codes) if j != i)
            out[i] = near[:k]
    return out


@pytest.mark.parametrize("bits", [16, 64, 100])
def test_top_k_matches_brute_force(spark, bits):
    rng = np.random.default_rng(bits)
    vectors = rng.standard_normal((300, bits))
    vectors[100:200] = vectors[7]  # a vector that a third of the rows hold
    rows = [(i, v.tolist(), 1, 2) for i, v in enumerate(vectors)] + [(1000, None, 1, 2), (1050, None, 1, 2), (7, vectors[7].tolist(), 1, 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, distance int")
    got = {}
    for r in hamming.top_k(df, k=10, rows_per_block=20, queries_per_block=4).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["distance"], r["vec_id"]))
    codes = np.packbits(vectors > 0, axis=1, bitorder="little")
    assert got == brute_top(range(300), codes, 10)


def test_top_k_holds_bounded_candidates():
    import tracemalloc

    rng = np.random.default_rng(1)
    codes = rng.integers(0, 2**63, (20_000, 1), dtype=np.uint64)
    index, asked = hamming.MultiIndex(np.arange(20_000), codes, 11), np.arange(0, 20_000, 20)
    tracemalloc.start()
    q, ids, d = (np.concatenate(x) for x in zip(*index.nearest(asked, codes[asked], 10)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6 < len(asked) * len(codes) * 8  # not a number for each pair of a query and a code
    assert len(q) == 10 * len(asked)
    for one in (0, 517, 999):
        away = np.bitwise_count(codes[:, 0] ^ codes[asked[one], 0]).astype(int)
        away[asked[one]] = 99
        assert ids[q == one].tolist() == np.lexsort((np.arange(20_000), away))[:10].tolist()


@pytest.mark.parametrize("probe_cost", [0.001, 512])
def test_top_k_of_an_id_with_many_vectors(monkeypatch, probe_cost):
    monkeypatch.setattr(hamming, "PROBE_COST", probe_cost)  # all radii probed, or all codes compared
    rng = np.random.default_rng(2)
    codes = np.concatenate([np.arange(30, dtype=np.uint64)[:, None], rng.integers(0, 2**63, (300, 1), dtype=np.uint64)])
    ids = np.concatenate([np.zeros(30, dtype=np.int64), np.arange(300) % 150 + 1])  # id 0 is near itself 30 times
    index = hamming.MultiIndex(ids, codes, 6)
    q, found, d = (np.concatenate(x) for x in zip(*index.nearest(ids, codes, 5)))
    for one in range(len(ids)):
        away = np.bitwise_count(codes[:, 0] ^ codes[one, 0]).astype(int)
        want = sorted((a, i) for a, i in zip(away.tolist(), ids.tolist()) if i != ids[one])[:5]
        assert list(zip(d[q == one].tolist(), found[q == one].tolist())) == want


def test_top_k_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert hamming.top_k(empty).count() == 0


# --- op 2


def test_html_keeps_the_article_only():
    body = "<h1>Title</h1><p>Fish &amp; chips <b>are</b>\n  good for all of us here in this long paragraph of text, surely.</p><p>x</p>"
    page = ("<html><head><title>T</title><style>p{}</style><script>var a='</p><p>no';</script></head><body>"
            "<header>Site</header><nav><ul><li><a href='/'>Home</a></li></ul></nav><div class='ad box'>Buy it now</div>"
            f"<!-- c --><article>{body}</article><aside>More</aside><div id='comments'><p>{'I disagree. ' * 20}</p></div>"
            "<form>Search</form><footer>&copy; us</footer>")
    want = "Title\nFish & chips are good for all of us here in this long paragraph of text, surely.\nx"
    assert htmltext.main_text(page) == want
    assert htmltext.main_text(page.replace("article>", "div>")) == want
    assert [htmltext.main_text(t) for t in (None, "", "<p></p>", "plain 2 < 3")] == ["", "", "", "plain 2 < 3"]


def test_html_keeps_short_parts_of_the_region():
    """A dropped part inside the region does not end it; headings, tails and cells in boxes of their own stay."""
    long = "This paragraph is long enough to make the window sums surge well above eighty characters of text."
    want = f"Title\n{long}\nShort end."
    share, more = "<div class='share'>Share it</div>", "<aside>More</aside>"
    menu = "<div><a href='/'>Home</a> <a href='/n'>News</a></div>"
    parts = f"<h1>Title</h1>{share}<p>{long}</p>{more}<p>Short end.</p>"
    boxes = f"<div><h1>Title</h1></div>{share}<div><div><p>{long}</p></div></div>{more}<div><p>Short end.</p></div>"
    cells = f"<tr><td><h1>Title</h1></td></tr><tr><td>{share}{long}</td></tr><tr><td>{more}</td><td>Short end.</td></tr>"
    for body in (f"<article>{parts}</article>", f"<main><div>{boxes}</div></main>", f"<div>{boxes}</div>", f"<div><div>{boxes}</div></div>",
                 boxes, f"<table>{cells}</table>", f"<div><table><tbody>{cells}</tbody></table></div>"):
        page = f"<body><nav>Home</nav>{menu}{body}<footer>us</footer><div>&copy; 2024</div></body>"
        assert htmltext.main_text(page) == want, body
    for body in (parts, boxes, f"<table>{cells}</table>"):  # no run is dense: still all of it
        page = f"<body><nav>Home</nav><div>{menu}{body.replace(long, 'Not long.')}</div><footer>us</footer></body>"
        assert htmltext.main_text(page) == "Title\nNot long.\nShort end.", body
    assert htmltext.main_text("<article><header><h1>Title</h1></header><p>x</p></article>") == "Title\nx"


def test_html_noise_names():
    long = "This paragraph is long enough to make the window sums surge well above eighty characters of text."
    for mark in ('a href="/hidden-valley"', 'b title="Hidden gems"', 'p aria-hidden="false"', 'p data-id="menu"', 'div class="content has-sidebar"',
                 'div class="no-comments"', 'div class="article-header"', 'div class="entry-footer"', 'div class="overflow-hidden"'):
        name = mark.split()[0]
        page = f"<article><p>{long}</p><{mark}>Kept</{name}></article>"
        assert "Kept" in htmltext.main_text(page), mark
    for mark in ("p hidden", "div class='box AD'", "div id=comments", "div class='site-header'", "div class='share-buttons'", "div class='comment-list'",
                 "div role='search'", "p style='display: none'", "div class='post-comments'"):
        name = mark.split()[0]
        assert htmltext.main_text(f"<article><p>{long}</p><{mark}>Lost</{name}></article>") == long, mark
    inner = f"<h1>Title</h1><p>{long}</p><div class='ad'>Buy</div><p>End.</p>"
    for mark in ("form id=f", "div class='sidebar'", "div id='page' class='header'", "section hidden", "header"):
        name = mark.split()[0]
        assert htmltext.main_text(f"<body><nav>Home</nav><{mark}>{inner}</{name}><footer>us</footer></body>") == f"Title\n{long}\nEnd.", mark
    talk = "I disagree. " * 40  # most of the text, and still no article
    assert htmltext.main_text(f"<article><p>{long}</p></article><div class='sidebar'>{talk}</div><div id='comments'>{talk}</div>") == long


def test_html_rows(spark):
    rows = [(1, "u", "<p>a</p>", 9, "t"), (1, "u", "<p>a</p>", 9, "t"), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars long, text string")
    got = sorted(htmltext.extract(df).collect(), key=str)
    assert sorted((r["text"], r["n_chars"]) for r in got) == [("", 0), ("a", 1), ("a", 1)]
    assert htmltext.extract(df.limit(0)).count() == 0


# --- op 3


def brute_lines(texts):
    lines = [(i, k, frozenset(words_of(x))) for i, t in enumerate(texts) for k, x in enumerate((t or "").split("\n"))]
    gone = {}
    for a, (i, k, s) in enumerate(lines):
        gone[i, k] = bool(s) and any(10 * len(s & o) >= 8 * len(s | o) for _, _, o in lines[:a] if o)
    return gone


@pytest.mark.parametrize("hot", [2, 256])
def test_lines_match_brute_force(spark, hot):
    rng = random.Random(hot)
    pool = near_texts(hot, 60, 10)
    texts = ["\n".join(rng.choices(pool, k=4)) for _ in range(25)] + AWKWARD
    got = {(r["d"], r["l"]): r["gone"] for r in linededup.removed_lines(documents(spark, texts), hot=hot).collect()}
    assert got == brute_lines(texts)


def test_line_text_and_empty_table(spark):
    docs = documents(spark, ["a b\nc d", "a b\nnew", None])
    assert [r["text"] for r in linededup.dedup_lines(docs).orderBy("doc_id").collect()] == ["a b\nc d", "new", None]
    assert linededup.removed_lines(docs.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [1, 256])
def test_lines_of_equal_ids_are_judged_by_their_own_words(spark, hot):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(1, "v w x y z"), (1, "a b c d e"), (2, "a b c d e f"), (3, "v w x y z q"), (3, "v w x y z q"), (None, "k l m n o"), (None, "p l m n o"),
            (4, long), (5, long.replace("w7 ", "other ")), (6, long.replace("w", "u"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["d"], r["gone"]) for r in linededup.removed_lines(docs, hot=hot).collect())
    assert got == [(1, False), (1, False), (2, True), (3, True), (3, True), (4, False), (5, True), (6, False)] + [(linededup.LAST, False)] * 2


def test_words_are_hashed_once_and_split_at_any_white_space(spark):
    docs = spark.createDataFrame([(1, " a b  c \na\tb\x0bc\x0c\r\nc b a b\n\n \t"), (2, None)], "doc_id long, text string")
    levels = linededup.rarity_levels(docs)
    assert sum(x > 1 for x in levels) == 3  # three words, whatever lies between them
    sets = linededup.with_sets(linededup.lines_of(docs), levels)
    assert sets._jdf.queryExecution().analyzed().toString().count("xxhash64(lambda") == 1
    found = [r["t"] for r in sets.orderBy("d", "l").collect()]
    assert found[0] == found[1] == found[2] and len(found[0]) == 3 and found[3:] == [[], [], []]


# --- op 4


def brute_components(texts, size, percent):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = []
    for t in texts:
        w = (t or "").encode().translate(low).split()
        sets.append({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    label = list(range(len(texts)))
    for _ in texts:
        for a, x in enumerate(sets):
            for b in range(a):
                if x and sets[b] and 100 * len(x & sets[b]) >= percent * len(x | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    return {i: (len(s), label[i]) for i, s in enumerate(sets)}


@pytest.mark.parametrize("seed,size,percent", [(1, 4, 85), (2, 4, 85), (3, 5, 80), (4, 1, 60)])
def test_components_match_brute_force(spark, seed, size, percent):
    texts = near_texts(seed) + AWKWARD + ["ONE"]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_components(documents(spark, texts), size, percent).collect()}
    assert got == brute_components(texts, size, percent)


def test_components_of_odd_rows(spark):
    docs = documents(spark, ["a b c d e", "a b c d e", None]).unionByName(documents(spark, ["a b c d e"], start=1))
    docs = docs.unionByName(docs.limit(1).selectExpr("CAST(NULL AS BIGINT) doc_id", *docs.columns[1:]))
    got = sorted(jaccard.near_components(docs).select("doc_id", "component_id").collect(), key=str)
    assert sorted((r[0], r[1]) for r in got if r[0] is not None) == [(0, 0), (1, 0), (1, 0), (2, 2)]
    assert [r[1] for r in got if r[0] is None] == [None]
    assert sorted(r["doc_id"] is None or r["doc_id"] for r in jaccard.keep_one(docs).collect()) == [0, True, 2]
    assert jaccard.near_components(docs.limit(0)).count() == 0


# --- op 5 and 10


def test_network_gradients():
    network = toxicity.GatedNetwork()
    x = toxicity.word_inputs(Words(pa.array(["you are a big fool and more", "nice day to all"])))
    windows, _ = toxicity.window_rows(x, 6, 3)
    y = np.arange(len(windows)) % 2
    loss = lambda: float(np.mean(np.logaddexp(0, (z := network.forward(network.inputs(x), windows)[0].astype(float))) - y * z))
    gradients = network.gradients(x, windows, y.astype(np.float32))
    for name, grad in gradients.items():
        at = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        old, step = network.p[name][at], 1e-2
        network.p[name][at] = old + step
        up = loss()
        network.p[name][at] = old - step
        down = loss()
        network.p[name][at] = old
        assert grad[at] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=1e-4), name


def test_windows_cover_all_words():
    x = toxicity.word_inputs(Words(pa.array([" ".join(f"w{i}" for i in range(53)), "", "one"])))
    windows, first = toxicity.window_rows(x, 16, 8)
    assert first.tolist() == [0, 6, 7, 8]
    assert set(windows[:6].ravel().tolist()) - {len(x.word_ids)} == set(x.tokens[:53].tolist())
    assert (windows[6] == len(x.word_ids)).all()


@pytest.mark.parametrize("module,query,label,least", [(toxicity, "op5_toxicity", "toxic", 0.9), (nbsvm, "op10_quality", "quality", 0.95)])
def test_held_out_accuracy(spark, module, query, label, least):
    got = entry_point.queries()[query](spark, MIDDLE)
    known = spark.read.parquet(f"{MIDDLE}/labels.parquet").select("doc_id", label)
    rows = got.filter("held_out").join(known, "doc_id").collect()
    assert len(rows) > 20 and np.mean([r["predicted"] == r[label] for r in rows]) >= least
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) == r["held_out"] for r in rows)


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (nbsvm, "quality")])
def test_scores_of_odd_rows(spark, module, label):
    docs = documents(spark, AWKWARD + ["good words here"] * 20 + ["bad bad!! words"] * 20)
    labels = spark.createDataFrame([(i, int(i < 29)) for i in range(9, 49)] + [(9, 1), (None, 1), (3, None)], f"doc_id long, {label} int")
    rows = module.classify(docs, labels).collect()
    assert len(rows) == 49 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (0, 1)}) == 1  # null and empty texts
    nobody = module.classify(docs, labels.limit(0)).collect()
    assert {r["score"] for r in nobody} == {0.5}
    assert module.classify(docs.limit(0), labels).count() == 0


# --- op 6


def test_tiles_are_longest_first():
    assert sorted(decontaminate.tile([[1, 2, 3, 4, 5, 9, 1, 2]], [1, 2, 3, 4, 5], 2)) == [5]
    assert sorted(decontaminate.tile([[4, 5, 6, 7, 1, 2, 3, 4]], [1, 2, 3, 4, 5, 6, 7], 3)) == [3, 4]
    assert decontaminate.tile([[1, 2]], [1, 2, 3], 3) == []


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_benchmark_items_are_found(spark, limit):
    item = "the quick brown fox jumps over the lazy dog while seven wizards boil a kettle"
    w = item.split()
    texts = [f"Before. {item} after", " ".join(["x"] + w[7:] + ["y"] + w[:7]).upper(), " ".join(w[:5]) + " and nothing else",
             "clean words only", f"{item} {item}", "short item"] + AWKWARD
    items = spark.createDataFrame([(5, item, 1), (6, None, 1), (7, "", 1), (8, "short item", 1), (5, item, 1)], "item_id long, text string, doc_id int")
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in decontaminate.contaminated(documents(spark, texts), items, broadcast_bytes=limit).collect()}
    assert got == {(0, 5): 1.0, (1, 5): 1.0, (4, 5): 1.0, (5, 8): 1.0}
    kept = decontaminate.clean(documents(spark, texts), items).collect()
    assert {r["doc_id"] for r in kept} == set(range(len(texts))) - {0, 1, 4, 5}
    assert decontaminate.contaminated(documents(spark, texts).limit(0), items).count() == 0


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_null_and_equal_ids_are_judged_by_row(spark, limit):
    item, other = "the quick brown fox jumps over the lazy dog", "seven wizards boil a kettle while it rains"
    rows = [(None, f"x {item}"), (None, f"y {other}"), (None, "clean words"), (3, item), (3, "also clean"), (3, None), (4, other), (4, "free")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(None, item), (9, other), (None, None)], "item_id long, text string")
    got = decontaminate.contaminated(docs, items, broadcast_bytes=limit).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=str) == sorted([(None, None), (None, 9), (3, None), (4, 9)], key=str)
    kept = decontaminate.clean(docs, items, broadcast_bytes=limit)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(None, "clean words"), (3, "also clean"), (3, None), (4, "free")], key=str)


# --- op 7


def test_mix_meets_targets(spark):
    rng = random.Random(1)
    texts = [" ".join(["w"] * rng.choice([1, 5, 40])) for _ in range(900)] + [None, ""]
    docs = documents(spark, texts, ["big"] * 20 + ["b", "c", None])
    rows = mixing.mix(docs, blocks=8, parts=4).collect()
    assert len(rows) == len(texts)
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(docs.repartition(5), blocks=8, parts=4).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}
    by_source = {}
    names = ["big"] * 20 + ["b", "c", None]
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and len(r["shards"]) == r["copies"]
        s = by_source.setdefault(names[r["doc_id"] % len(names)], [r["source_size"], r["target"], 0])
        s[2] += r["taken"]
    total = sum(s[0] for s in by_source.values())
    assert sum(s[1] for s in by_source.values()) == pytest.approx(total)
    for size, target, taken in by_source.values():
        assert target <= 3 * size + 1e-9 and abs(taken - target) <= 40
    copies = mixing.draw(docs, mixing.mix(docs, blocks=8, parts=4))
    assert copies.count() == sum(r["copies"] for r in rows)


def test_mix_of_nothing(spark):
    docs = documents(spark, [None, ""])
    assert [(r["target"], r["taken"]) for r in mixing.mix(docs).collect()] == [(0.0, 0), (0.0, 0)]
    assert mixing.mix(docs.limit(0)).count() == 0


def test_tree_splits_evenly(spark):
    units = spark.range(1000).selectExpr("concat('s', id % 3) src", "id block", "1 turn")
    sizes = [r["count"] for r in mixing.split_tree(units, 8).groupBy("shard").count().collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 1


# --- op 8


def brute_spans(texts, length):
    first, out = {}, {}
    for i, t in enumerate(texts):
        w, gone = words_of(t), set()
        for k in range(len(w) - length + 1):
            g = tuple(w[k:k + length])
            if first.setdefault(g, i) < i:
                gone |= set(range(k, k + length))
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest())
    return out


@pytest.mark.parametrize("seed,length,gram", [(1, 13, 4), (2, 13, 4), (3, 5, 2)])
def test_substrings_match_brute_force(spark, seed, length, gram):
    rng = random.Random(seed)
    texts = near_texts(seed, 50) + AWKWARD
    texts += [" ".join([*rng.choice(texts[:50]).split()[5:30], "new", *rng.choice(texts[:50]).split()[:20]]) for _ in range(15)]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest())
           for r in substrings.dedup(documents(spark, texts), length, gram).collect()}
    assert got == brute_spans(texts, length)


def test_automaton_statistics():
    automaton = substrings.SuffixAutomaton([[1, 2, 3, 1, 2], [7, 8]])
    assert automaton.statistics([1, 2, 3, 9, 2, 7, 8, 1, 2, 3, 1, 2, 7]) == [1, 2, 3, 0, 1, 1, 2, 1, 2, 3, 4, 5, 1]


def test_substrings_of_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(20))
    docs = documents(spark, [text, text]).unionByName(documents(spark, [text], start=1))
    docs = docs.unionByName(docs.limit(1).selectExpr("CAST(NULL AS BIGINT) doc_id", *docs.columns[1:]))
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_removed"]) for r in substrings.dedup(docs).collect())
    assert got == [(-1, 0), (0, 0), (1, 20), (1, 20)]
    assert substrings.dedup(docs.limit(0)).count() == 0


# --- op 9


def test_grammar_round_trip():
    rng = np.random.default_rng(3)
    for ids in ([], [5], [7] * 1001, rng.integers(0, 4, 5000), np.tile(rng.integers(0, 49000, 50), 40)):
        ids = np.array(ids, dtype=np.uint32)
        payload = tokenids.pack(ids, min_count=2)
        assert (tokenids.unpack(payload) == ids).all()
        for a, b in ((0, 1), (3, 40), (len(ids) // 2, len(ids))):
            assert (tokenids.unpack(payload, a, min(b, len(ids))) == ids[a:b]).all()
    assert len(tokenids.pack(np.array([7] * 1001, dtype=np.uint32))) < 1001


def test_grammar_leaves_no_frequent_pair():
    rng = np.random.default_rng(4)
    text = (49000 * rng.random(60000) ** 6).astype(np.uint32)
    passage = rng.integers(0, 49000, 3000).astype(np.uint32)
    copies = np.tile(passage, 40)
    for ids, least in ((text, 8), (copies, 8), (np.full(100_000, 7, np.uint32), 8), (rng.integers(0, 40, 30000).astype(np.uint32), 2)):
        rules, lengths, symbols = tokenids.compress(ids, min_count=least)
        counts = np.unique(symbols[:-1] << 32 | symbols[1:], return_counts=True)[1]
        assert counts.max(initial=0) < least
        assert (tokenids._expand(symbols, rules) == ids).all()
        assert [len(tokenids._expand(np.array([tokenids.BASE + k]), rules)) for k in range(0, len(rules), 97)] == lengths[::97].tolist()
    assert len(tokenids.compress(copies)[2]) < 300


def test_token_files_match_the_tokenizer(spark, tmp_path):
    texts = AWKWARD + ["Hello, world. It's 3.14!", "<|endoftext|> X<|ENDOFTEXT|>", "Été ÉTÉ ſ ﬁ İ Σς. 中文,字", "a.,b. c,. d..", "don't. I'LL,"]
    path = str(tmp_path / "ids")
    tokenids.write(documents(spark, texts).repartition(3), path, tokenids.public_tokenizer(), shard_tokens=50)
    rows = tokenids.read(spark, path).orderBy("doc_id").collect()
    start = 0
    for text, r in zip(texts, rows, strict=True):
        ids = tokenids._tokenizer(tokenids.public_tokenizer()).encode(text or "", add_special_tokens=False).ids + [2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())), text
        start += len(ids)
    tokenids.write(documents(spark, [None]).limit(0), str(tmp_path / "none"), tokenids.public_tokenizer())
    assert tokenids.read(spark, str(tmp_path / "none")).count() == 0


# --- pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    quality, near, clean, mixed, tokens = (f for _, f in corpus_pipeline.STAGES)
    one = quality(spark, docs, SMALL)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = nbsvm.fit(docs, labels)
    kept = {r["doc_id"] for r in nbsvm.score(docs, model).filter("predicted = 1").collect()}
    assert {r["doc_id"] for r in one.collect()} == kept and one.columns == docs.columns
    rows = sorted((r["doc_id"], r["text"]) for r in one.collect())
    labels_of = brute_components([t for _, t in rows], 5, 80)
    two = near(spark, one, SMALL)
    assert {r["doc_id"] for r in two.collect()} == {rows[i][0] for i, (_, c) in labels_of.items() if c == i}
    three = clean(spark, two, SMALL)
    hit = {r["doc_id"] for r in decontaminate.contaminated(two, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    assert {r["doc_id"] for r in three.collect()} == {r["doc_id"] for r in two.collect()} - hit
    four = mixed(spark, three, SMALL)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(three).collect()}
    counted = {}
    for r in four.collect():
        counted[r["doc_id"]] = counted.get(r["doc_id"], 0) + 1
    assert counted == {i: c for i, c in copies.items() if c} and four.columns == docs.columns
    assert tokens(spark, four, SMALL).count() == sum(copies.values())
    assert corpus_pipeline.run(spark, SMALL).count() == sum(copies.values())
