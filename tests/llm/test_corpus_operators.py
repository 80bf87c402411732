"""Joins over a corpus, pages and vectors against plain versions."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelake.llm import ann, components, decontaminate, html, jaccard, repeats
from ratelake.llm.rindex import RunIndex

from .texts import corpus, frame, words


def sets_of(rows):
    out = []
    for i, t in rows:
        w = words(t)
        out.append((i, frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])))
    return out


def brute_components(rows):
    sets = sets_of(rows)
    parent = list(range(len(sets)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a], sets[b]
            both = len(x[1] & y[1])
            if (x[0] is not None and x[0] == y[0]) or (both and 100 * both >= 80 * (len(x[1]) + len(y[1]) - both)):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted((str(i), len(s), str(least.get(find(k)))) for k, (i, s) in enumerate(sets))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_jaccard_components(spark, seed):
    rows = corpus(seed, 150)
    got = jaccard.near_duplicates(frame(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute_components(rows)


@pytest.mark.parametrize("n", range(1, 7))
def test_jaccard_tiny_partitions(spark, n):
    """Partitions that hold a few words in all, down to one."""
    text = " ".join(f"w{k}" for k in range(n))
    rows = [(1, text), (2, text.upper()), (3, "w0"), (4, None), (5, "")]
    for parts in (1, 5):
        got = jaccard.near_duplicates(frame(spark, rows).repartition(parts, "doc_id")).collect()
        assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute_components(rows)
    alone = jaccard.near_duplicates(frame(spark, rows[:1])).collect()
    assert [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in alone] == [(1, max(1, n - 4), 1)]


def test_jaccard_dense_family(spark):
    """Many edited copies of one text: links between them are not all with one pivot."""
    rng = np.random.default_rng(4)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(140):
        text = list(base)
        for at in rng.integers(0, 120, rng.integers(0, 7)):
            text[at] = f"e{rng.integers(0, 400)}"
        rows.append((k, " ".join(text)))
    got = jaccard.near_duplicates(frame(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute_components(rows)


def near_misses(seed, copies):
    """Texts that each replace 4 words of one: most pairs are just too different to link."""
    rng = np.random.default_rng(seed)
    base = [f"w{k}" for k in range(110)]
    rows = []
    for k in range(copies):
        text = list(base)
        for at in rng.choice(110, 4, replace=False):
            text[at] = f"e{k}-{at}"
        rows.append((k, " ".join(text)))
    return rows


def test_jaccard_family_meets_once(spark, monkeypatch):
    """Pairs of a family make a row each, not one in every list that they share."""
    rows, made = near_misses(6, 14), []
    plain = jaccard._open_pairs
    monkeypatch.setattr(jaccard, "_open_pairs", lambda *tables: made.append(plain(*tables).count()) or plain(*tables))
    got = jaccard.near_duplicates(frame(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == brute_components(rows)
    assert len({r["component_id"] for r in got}) > 1 and made[0] <= 14 * 13 // 2


def test_jaccard_unlike_texts_stay(spark, monkeypatch):
    """Texts that share a passage only are told apart without being sent to each other."""
    rng = np.random.default_rng(7)
    rows = []
    for k in range(120):
        own = [f"u{w}" for w in rng.integers(0, 1 << 40, 50)]
        rows.append((k, " ".join(own[:25] + [f"p{k // 6}-{j}" for j in range(14)] + own[25:])))
    compared, plain = [], jaccard.stored

    def stored(table, purpose):
        out = plain(table, purpose)
        if purpose == "jaccard-pairs":
            compared.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stored", stored)
    got = jaccard.near_duplicates(frame(spark, rows)).collect()
    assert all(r["component_id"] == r["doc_id"] for r in got) and sum(compared) < 20


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_jaccard_most_overlap(seed):
    rng = np.random.default_rng(seed)
    for _ in range(300):
        size = int(rng.integers(1, 900))
        x = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        kept = x[rng.random(len(x)) < rng.random()]
        y = np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, int(rng.integers(1, 900))).astype(np.uint64)]))
        most = jaccard.most_overlap(len(x), jaccard.signature(x), len(y), jaccard.signature(y))
        assert len(np.intersect1d(x, y)) <= most <= min(len(x), len(y))
    x, y = (rng.integers(0, 1 << 63, 800).astype(np.uint64) for _ in range(2))
    assert jaccard.most_overlap(800, jaccard.signature(x), 800, jaccard.signature(y)) < 300


def test_jaccard_empty(spark):
    assert jaccard.near_duplicates(frame(spark, [])).count() == 0
    assert jaccard.near_duplicates(frame(spark, [(1, None), (2, "")])).collect()[0]["n_shingles"] == 0


def test_components_chain(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 95), (7, 7), (None, 3)]
    got = components.components(spark.createDataFrame(edges, "u long, v long"))
    assert {r["node"]: r["component"] for r in got.collect()} == {k: 0 for k in range(1, 41)} | {100: 90, 95: 90}


def brute_repeats(rows, length=50):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    least = {}
    for i, t in order:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            least.setdefault(b[k : k + length], i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            first = least[b[k : k + length]]
            if (i is None and first is not None) or (i is not None and first < i):
                gone[k : k + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((str(i), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats(spark, seed):
    rows = corpus(seed, 80)
    got = repeats.remove_repeats(frame(spark, rows), "digest").collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == brute_repeats(rows)
    kept = {str(r["doc_id"]): hashlib.sha256(bytes(r["kept"])).hexdigest() for r in repeats.remove_repeats(frame(spark, rows)).collect()}
    assert kept == {r[0]: r[4] for r in brute_repeats(rows)} or len(kept) < len(rows)
    assert repeats.remove_repeats(frame(spark, [])).count() == 0


def test_repeats_of_like_hashes(spark):
    """Different strings filed under one key whose hashes agree in their high 32 bits."""
    pairs = [
        ("oycwwebtazbgyvyxkpqzddrwecsgtywytptvwywnvwmuievcef", "wfbvuwlplheinhpxkpqzddrwecsgtywytptghkyyvsfqiewsll"),
        ("upicwaieavirhccxkpqzddrwecsgtywytptlhzqyzgqlneijmd", "xgpgytphupkunflxkpqzddrwecsgtywytptrpfghviyfvtynvr"),
    ]
    rows = [(2 * k + n, t) for k, pair in enumerate(pairs) for n, t in enumerate(pair)] + [(9, pairs[0][1])]
    got = repeats.remove_repeats(frame(spark, rows), "digest").collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == brute_repeats(rows)
    for pair in pairs:  # alone, so that no other stretch of the key calls for their bytes
        got = repeats.remove_repeats(frame(spark, list(enumerate(pair))), "digest").collect()
        assert [r["n_removed"] for r in got] == [0, 0]


def test_crowded_windows_are_the_index():
    """The two ways to settle stretches give the same answers."""
    rng = np.random.default_rng(3)
    base = bytes(rng.integers(97, 100, 400).astype(np.uint8))
    strings = list({base[a : a + n] for a, n in zip(rng.integers(0, 300, 60), rng.integers(50, 90, 60))})
    values = rng.integers(0, 9, len(strings))
    least = {}
    for s, v in zip(strings, values):
        for k in range(len(s) - 49):
            least[s[k : k + 50]] = min(least.get(s[k : k + 50], 99), int(v))
    got = RunIndex(strings, values, 50).stream()
    none = np.iinfo(np.int64).max
    assert got.tolist() == [least.get(s[k : k + 50], none) if k + 50 <= len(s) else none for s in strings for k in range(len(s))]


def test_decontamination(spark):
    rng = np.random.default_rng(6)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 4))
    item = [[word() for _ in range(40)] for _ in range(5)]
    filler = lambda n: [word() for _ in range(n)]
    edited = [w if k % 6 else word() for k, w in enumerate(item[1])]
    docs = [
        (1, " ".join(filler(200) + item[0] + filler(100))), (2, " ".join(filler(90) + edited)), (3, " ".join(filler(400))),
        (4, None), (5, ""), (6, " ".join(filler(50) + item[2][:8])), (7, " ".join(item[3]).upper()), (7, " ".join(item[3]).upper()),
        (8, " ".join(item[0] + filler(3000) + item[4])),
    ]
    items = [(k, " ".join(w)) for k, w in enumerate(item)] + [(9, None), (10, ""), (11, "of"), (0, "zz zz zz zz")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(frame(spark, docs), bench).collect())
    assert got == [(1, 0), (2, 1), (7, 3), (7, 3), (8, 0), (8, 4)]
    assert decontaminate.contaminated(frame(spark, []), bench).count() == 0
    assert decontaminate.contaminated(frame(spark, docs), bench.limit(0)).count() == 0


def test_decontamination_edited_beside_verbatim(spark):
    """A verbatim copy in the corpus does not hide edited ones, nor they each other."""
    rng = np.random.default_rng(16)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 4))
    item = [word() for _ in range(40)]
    edits = [[w if (at + shift) % k else word() for at, w in enumerate(item)] for k in range(4, 9) for shift in range(k)]
    inserted = [w for at in range(0, 40, 2) for w in (*item[at : at + 2], word())][:-1]
    texts = [item, inserted, *edits]
    docs = [(k, " ".join([word() for _ in range(60)] + t + [word() for _ in range(30)])) for k, t in enumerate(texts)]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r["doc_id"]: round(r["score"] * 40) for r in decontaminate.contaminated(frame(spark, docs), bench).collect()}
    wanted = {k: brute_alignment(item, d.split()) for k, (_, d) in enumerate(docs)}
    assert got == {k: s for k, s in wanted.items() if s >= 16} and set(got) == set(range(len(docs)))


def test_decontamination_short_items_and_excerpts(spark):
    items = [(k, " ".join(f"s{k}x{j}" for j in range(k))) for k in (2, 3, 4, 5)] + [(300, " ".join(f"p{j}" for j in range(300)))]
    passage = items[-1][1].split()
    docs = [(k, f"before it {t} and after") for k, t in items[:-1]]
    docs += [(10, "s4x0 s4x1 s4x2 other"), (11, " ".join(["a", *passage[90:190], "b"])), (12, " ".join(["a", *passage[90:139], "b"]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], round(r["score"] * r["item_id"])) for r in decontaminate.contaminated(frame(spark, docs), bench).collect()}
    assert got == {(3, 3, 3), (4, 4, 4), (5, 5, 5), (11, 300, 100)}


def brute_alignment(a, b):
    best = 0
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (1 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment():
    rng = np.random.default_rng(8)
    for _ in range(60):
        a, b = rng.integers(0, 6, rng.integers(1, 20)), rng.integers(0, 6, rng.integers(1, 30))
        assert decontaminate.align(a, b)[0] == brute_alignment(a.tolist(), b.tolist())


def test_nearest(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(0, 1, (1200, 16)).astype(np.float32)
    v[300:420] = v[0]
    rows = [(k, [float(x) for x in r], 1) for k, r in enumerate(v)]
    rows += [(5000, None, 1), (5050, [0.0] * 16, 1), (5100, [float("nan")] + [1.0] * 15, 1), (5150, [None] + [1.0] * 15, 1), (0, rows[0][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 50 == 0, 5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    x = v.astype(np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 1200, 50):
        near = np.round(unit @ unit[q], 12)
        near[q] = -9
        top = np.lexsort((np.arange(1200), -near))[:5].tolist()
        mine = [i for _, i, _ in sorted(got[q])]
        hits += len(set(top) & set(mine))
        assert len(mine) == 5 and all(abs(s - unit[i] @ unit[q]) < 1e-12 for _, i, s in got[q])
    assert hits >= 0.9 * 5 * 24 and set(got) == set(range(0, 1200, 50))
    assert [i for _, i, _ in sorted(got[300])] == [0, 301, 302, 303, 304]
    assert ann.nearest(df.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0
    assert sorted(r["vec_id"] for r in ann.nearest(df.filter("vec_id < 3"), F.col("vec_id") == 0, 5).collect()) == [1, 2]


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav>
<article><h1>Main &amp; title</h1><p>First   paragraph of
the text, with <b>bold</b> words.<p>Second one, unclosed.<script>var a = "<p>no</p>";</script></article>
<footer>&copy; nobody</footer></body></html>"""


def test_pages(spark):
    rows = [(k, f"http://h/{k}", PAGE.replace("First", f"First {k} and"), "old", 5) for k in range(40)]
    rows += [(90, "u", None, "o", 1), (91, None, "", "o", 1), (92, "u", "plain & simple", "o", 1), (None, "u", "<p>" * 3000 + "deep", "o", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = {r["page_id"]: r for r in html.extract(pages).collect()}
    assert len(got) == len(rows) and set(got[0].asDict()) == {"page_id", "url", "text", "n_chars"}
    for k in range(40):
        assert got[k]["text"] == f"Main & title\nFirst {k} and paragraph of the text, with bold words.\nSecond one, unclosed."
        assert got[k]["n_chars"] == len(got[k]["text"])
    assert got[90]["text"] == got[91]["text"] == ""
    assert html.extract(pages.limit(0)).count() == 0


def test_articles_in_table_cells():
    """Tables that only lay out a page, and articles without any mark-up of their own."""
    import ratelake.llm.dom as dom

    rng = np.random.default_rng(21)
    vocabulary = ["".join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(400)]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(30, 60))) + "." for _ in range(60)]
    model = html.train([f"<body><nav><a>{texts[0]}</a></nav><article>{''.join(f'<p>{t}</p>' for t in texts[k:k + 9])}</article></body>" for k in range(50)])
    a, b = texts[40], texts[41]
    for page in (
        f"<table><tr><td>menu</td><td><p>{a}</p><p>{b}</p></td></tr></table>",
        f'<html><body><table><tr><td><a href="#">menu</a></td><td><p>{a}</p><p>{b}</p></td></tr></table></body></html>',
        f"<div><div><div><p>{a}</p><p>{b}</p></div></div></div>",
        f"<p>{a}</p><p>{b}</p>",
        f"<article><table><tr><td>{a}</td></tr><tr><td>{b}</td></tr></table></article>",
    ):
        parsed = dom.Page(page)
        kept = html.main_text(parsed, model.odds(parsed.features())).split("\n")
        assert [t for t in kept if t != "menu"] == [a, b], page
    menu = dom.Page('<body><nav><a href="#">home</a> <a href="#">about</a></nav></body>')
    assert html.main_text(menu, model.odds(menu.features())) == ""


def test_pages_without_head_end():
    """The end tag of head may be left out, with or without a body tag after it."""
    import ratelake.llm.dom as dom

    def text(page):
        return [t for _, t in dom.Page(page).blocks]

    wanted = text(PAGE)
    assert wanted[1:] == ["Main & title", "First paragraph of the text, with bold words.", "Second one, unclosed.", "© nobody"]
    assert text(PAGE.replace("</head>", "")) == text(PAGE.replace("</head><body>", "")) == wanted
    head = "<html><head><title>t</title><meta charset=utf-8><noscript><div>on</div></noscript><script>var a</script><template><p>x</p></template>"
    for rest in ("<body><p>a</p>", "<article><p>a</p></article>", "<span>a</span>", "\n a", "</head><body>a", "<noscript><body>a"):
        assert text(head + rest) == ["a"]
    assert text(head + "</head></html>") == text(head) == []


def test_layouts_never_seen():
    """Trees trained on some layouts sort the blocks of others."""
    rng = np.random.default_rng(12)
    vocabulary = ["".join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(400)]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(8, 60))) + "." for _ in range(60)]
    model = html.train([f"<body><nav><a>{texts[0]}</a></nav><article>{''.join(f'<p>{t}</p>' for t in texts[k:k + 9])}</article></body>" for k in range(50)])
    right = total = 0
    import ratelake.llm.dom as dom

    for _ in range(40):
        page = html.lay_out(rng, texts)
        parsed = dom.Page(page)
        wanted = html._known_labels(dom, page, parsed)
        kept = html.kept_blocks(parsed, model.odds(parsed.features()))
        right += sum(k == (wanted[n] > 0) for k, (n, _) in zip(kept, parsed.blocks))
        total += len(kept)
    assert right >= 0.97 * total
