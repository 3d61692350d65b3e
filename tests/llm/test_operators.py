"""The operators for training text against brute force, and on odd rows."""

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from runlens.llm import byteconv, compact_windows, fertility, license_scan, main_text, mixing, pieces, rp_forest, site_quality
from runlens.llm import weighted_minhash as wm
from runlens.llm.textblocks import blocks

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, row int, _tokens int"


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("etaoinshr"), rng.integers(2, 9))) for _ in range(n))


BASE = prose(1, 120)
LONG = prose(2, 6000)
ODD = [(1, None), (2, ""), (3, "  \n\t"), (4, "one two"), (5, BASE), (5, BASE), (6, BASE), (7, BASE.replace(" ", "  ", 1) + " tail"),
       (8, LONG), (9, "word " * 100), (None, BASE), (10, "日本語 🙂 ▁ é\r\n;\r")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", None if i == 4 else "s", None, "x", 1, 2) for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows, covered = {}, set()
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k:k + 8]), []).append(k)
    for at in windows.values():
        if len(at) > 1:
            covered.update(i for k in at for i in range(k, k + 8))
    return (len(words), sum(map(len, words)), sum(c in "[#*$%&|<>]" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_base_counts_by_brute_force():
    texts = [t for _, t in ODD] + ["a b\na b\n\n \nc [#] a b\na b", " ".join(BASE.split()[:9] * 3), "\n\nx\n"]
    for block in blocks(pa.array(texts), 900):
        found = fertility.base_counts(block)
        for k in range(block.n_texts):
            assert tuple(int(v[k]) for v in found.values()) == plain_counts(texts[block.first_row + k])


def test_fertility_on_odd_rows(odd, empty):
    rows = fertility.tokenizer_fertility(odd).collect()
    assert len(rows) == len(ODD)
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 3, 4, 9))
    assert [r.kept for r in rows if r.doc_id == 5] == [True, True]
    assert fertility.tokenizer_fertility(empty).count() == 0


def test_forest_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 16)) + np.repeat(rng.normal(size=(10, 16)) * 3, 300, axis=0)
    x[1000:1500] = x[1000]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(5000, None, 0), (5050, [0.0] * 16, 0), (5100, [float("nan")] * 16, 0), (7, x[7].tolist(), 0)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, v int")
    got = {}
    for r in rp_forest.nearest(table, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = 0
    for q in range(0, 3000, 50):
        s = np.round(unit @ unit[q], 12)
        s[q] = -2
        best = np.argsort(-s, kind="stable")[:5]
        own = sorted(got[q])
        assert [r for r, _, _ in own] == [1, 2, 3, 4, 5]
        hit += len({v for _, v, _ in own} & set(best.tolist()))
        if 1000 <= q < 1500:
            assert [v for _, v, _ in own] == best.tolist()
    assert set(got) == set(range(0, 3000, 50)) and hit >= 0.9 * 300
    assert rp_forest.nearest(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_forest_takes_vectors_of_any_length(spark):
    rows = [(50, [1.0, 2.0]), (51, [1.0, 2.0, 0.0]), (52, [1.0, 2.0, 0.5]), (53, [2.0]), (54, [-1.0, 0.0, 0.0, 3.0]), (100, [0.0, 0.0, 0.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in rp_forest.nearest(table, F.col("vec_id") % 50 == 0).collect()}
    assert [got[50, k][0] for k in range(1, 6)] == [51, 52, 53, 100, 54] and got[50, 1][1] == pytest.approx(1.0)
    assert got[100, 1] == (54, pytest.approx(3 / 10 ** 0.5)) and [got[100, k][0] for k in range(2, 6)] == [50, 51, 52, 53]


def test_site_quality(spark, odd, empty):
    rows = [(i, prose(i, 60) if i % 4 else "### *** " * 30, "en", f"s{i % 3}", 0) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), "x") for i in range(0, 400, 2)] + [(1, None, "x")], "doc_id bigint, quality int, path string")
    args = (F.col("source"), F.concat_ws("/", "source", "lang"))
    got = {r.row.doc_id: r.kept for r in site_quality.classify(docs, labels, *args, ["doc_id"]).collect()}
    assert got == {i: i % 4 > 0 for i in range(400)}
    assert site_quality.classify(odd, labels, *args, ["doc_id"]).count() == len(ODD)
    assert site_quality.classify(empty, labels, *args, ["doc_id"]).count() == 0
    assert all(r.kept for r in site_quality.classify(docs, labels.limit(0), *args, ["doc_id"]).collect())


def test_site_posterior_shrinks_sparse_paths(spark):
    rows = [("h", "p", 0.9)] * 200 + [("h", "rare", 0.0)] + [("g", "q", 0.1)] * 200
    sites = {r.path: r for r in site_quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, p_text double")).collect()}
    assert 0.1 < sites["rare"].p_path < sites["p"].p_path and sites["q"].p_path < 0.2


def test_tables_equal_convolution():
    rng = np.random.default_rng(0)
    windows = rng.integers(1, 255, (9, byteconv.WIDTH)).astype(np.uint8)
    net = byteconv.train(windows, np.arange(9) % 2, ["a", "b"], epochs=1)
    f, _ = net.features(windows)
    z = np.exp(f @ net.params["out"] + net.params["bias"])
    assert np.allclose(net.probabilities(windows, net.tables()), z / z.sum(axis=1, keepdims=True), atol=1e-5)


def test_language_held_out_and_odd(spark, odd, empty):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join("".join(rng.choice(list("abcde" if i % 2 else "vwxyz"), 5)) for _ in range(40)), "odd" if i % 2 else "even") for i in range(300)]
    found = byteconv.identify_language(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), 50).collect()
    assert all(r.lang_pred == ("odd" if r.doc_id % 2 else "even") and 0 <= r.score <= 1 for r in found)
    assert 0 < sum(r.held_out for r in found) < 300
    got = byteconv.identify_language(odd).collect()
    assert len(got) == len(ODD) and {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    assert byteconv.identify_language(empty).count() == 0


@pytest.mark.parametrize("target", [mixing.Target(max_repetition=2.0), mixing.Target(max_repetition=None, entropy=1.0)])
def test_mixing_meets_its_target(spark, target):
    rows = [(i, "w " * (i % 7 + 1), "a" if i < 300 else "b" if i < 380 else None) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("n", F.lit(1))
    mixed = mixing.mix(docs, target, n_blocks=8).toPandas()
    plan = {(s or "-"): p for s, p in zip(mixed.source, mixed.plan)}
    if target.entropy is None:
        passes = [p["passes"] for p in plan.values()]
        assert max(passes) / min(passes) <= 2.0 + 1e-3 and min(passes) >= 1 - 1e-3
        assert set(mixed.doc_id) == set(range(400))
    else:
        w = np.array([p["weight"] for p in plan.values()])
        assert abs(-(w * np.log(w)).sum() - 1.0) < 1e-6
    assert {p["block"] for p in mixed.plan} == set(range(8))


def test_mixing_on_odd_rows(odd, empty):
    assert mixing.mix(odd).count() >= len(ODD) and mixing.mix(empty).count() == 0


def test_main_text(spark):
    page = ('<html><head><title>T</title><script>var a="</p> x";</script></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav>'
            '<header>Top</header><div class="ad">Buy</div><article><h1>Head &amp; more</h1><p>Some <b>bo</b>ld\n text<p>Second'
            '<ul><li>item</li></ul><div class="comments"><p>Nice!</p></div></article><aside>Side</aside><footer>&copy; x</footer>')
    rows = [(1, "u", page), (2, "u", None), (3, "u", ""), (4, "u", "<"), (1, "u", page), (5, "u", "<nav>a b</nav>"), (6, "u", "<p>" + "w " * 50_000)]
    got = main_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit(1))).collect()
    want = "Head & more Some bold text Second item"
    assert [r.text for r in got if r.page_id == 1] == [want, want] and len(got) == 7
    assert {r.page_id: r.n_chars for r in got if r.page_id in (2, 3, 5, 6)} == {2: 0, 3: 0, 5: 0, 6: 99_999}


def test_main_text_round_a_box():
    for box in ('<div class="ad">{}</div>', "<aside>{}</aside>", '<form><p>{}</p></form>', '<div class="newsletter"><ul><li>{}</ul></div>'):
        page = f"<nav>Home</nav><article><p>{prose(1, 30)}</p>{box.format(prose(2, 200))}<p>{prose(3, 60)}</p></article><footer>End</footer>"
        assert main_text.extract(page, main_text.Weights()) == f"{prose(1, 30)} {prose(3, 60)}"


def test_main_text_with_a_classed_body():
    page = f'<html class="no-comments"><body class="has-sidebar"><article><p>{prose(1, 30)}</p></article></body></html>'
    assert main_text.extract(page, main_text.Weights()) == prose(1, 30)


WRAPPERS = ['<div class="layout-with-sidebar">{}</div>', '<div id="no-comments">{}</div>', '<section class="social-science">{}</section>',
            '<div class="page has-banner">{}</div>', '<form action="/x">{}</form>', '<div class="widget">{}</div>', "<nav>{}</nav>"]


def page_of(body):
    return ('<html><head><title>T</title></head><body><nav><ul><li><a href="/">Home</a></li><li>About us</li></ul></nav><header>Site name</header>'
            f'{body}<div class="site-footer">Imprint and terms</div><div class="cookie-banner">We use cookies</div><footer>End</footer></body></html>')


@pytest.mark.parametrize("fitted", [False, True])
def test_main_text_in_wrappers(spark, fitted):
    weights = main_text.Weights()
    if fitted:
        weights = main_text.fit(spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html"))
    first, second = prose(21, 40), prose(22, 60)
    text = f"Head {first} {second}"
    inner = f"<h1>Head</h1><p>{first}</p><p>{second}</p>"
    for wrapper in WRAPPERS:
        assert main_text.extract(page_of(wrapper.format(f"<article>{inner}</article>")), weights) == text
    for whole in (f'<main class="related-work">{inner}</main>', f'<article class="post share-enabled">{inner}</article>',
                  f'<main><form><article>{inner}</article></form></main>', f'<article><div class="entry-header"><h1>Head</h1></div>{inner[13:]}</article>'):
        assert main_text.extract(page_of(whole), weights) == text
    # Tables, formulas and boxes within the article take nothing with them.
    table = "<table>" + "".join(f"<tr><td>{k}</td><td>{k * k}</td></tr>" for k in range(80)) + "</table>"
    numbers = " ".join(f"{k} {k * k}" for k in range(80))
    assert main_text.extract(page_of(f"<article><p>{first}</p>{table}<p>{second}</p></article>"), weights) == f"{first} {numbers} {second}"
    math = "<math><mi>x</mi><mo>=</mo><mn>1</mn></math>"
    assert main_text.extract(page_of(f"<article><p>{first} {math} end</p></article>"), weights) == f"{first} x=1 end"
    comments = '<section class="post-comments"><article class="comment"><p>' + prose(23, 30) + "</p></article></section>"
    related = '<div class="related-posts"><article><p>' + prose(24, 20) + "</p></article></div>"
    for extra in (comments, related, '<div class="shareButtons">Tell all</div>', '<div class="ad-slot-3">Buy this</div>'):
        assert main_text.extract(page_of(f"<article><p>{first}</p>{extra}<p>{second}</p></article>"), weights) == f"{first} {second}"
        assert main_text.extract(page_of(f"<article><p>{first}</p><p>{second}</p></article>{extra}"), weights) == f"{first} {second}"


def test_main_text_of_pages_that_mark_nothing():
    first, second, weights = prose(25, 80), prose(26, 90), main_text.Weights()
    body = f"<div class='story'><h1>Head</h1><p>{first}</p><p>{second}</p></div>"
    for page in (page_of(body), page_of(f"<form>{body}</form>"), page_of(f"<div class='wrap has-sidebar'>{body}<div class='sidebar'>{prose(27, 50)}</div></div>")):
        assert main_text.extract(page, weights).endswith(f"Head {first} {second}")


def test_names_of_classes():
    aside = ["ad", "ads", "sidebar", "site-footer", "main-nav", "navBar", "cookie_banner", "related-posts", "ad-slot-3", "share-buttons", "comments"]
    content = ["no-comments", "has-sidebar", "layout-with-sidebar", "social-science", "related-work", "share-enabled", "post", "download", "entry-header", "123"]
    assert all(main_text.named(n) == main_text.ASIDE for n in aside) and all(main_text.named(n) == main_text.CONTENT_SIDE for n in content)
    assert main_text.named("page-header") == main_text.OUTER_HEADER


def test_best_span_by_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(200):
        s = rng.integers(-5, 5, 12).tolist()
        a, b = main_text.best_span(s)
        assert sum(s[a:b]) == max([0] + [sum(s[i:j]) for i in range(12) for j in range(i, 13)])


def edit(text, every, seed):
    words = text.split()
    for k in range(seed % every, len(words), every):
        words[k] = f"new{seed}x{k}"
    return " ".join(words)


def test_near_duplicates_by_brute_force(spark, odd, empty):
    texts = [prose(s, 150) for s in range(40)] + [edit(prose(s, 150), e, s + e) for s in range(8) for e in (40, 60, 90, 150)] + [prose(3, 150)] * 50
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("node", F.lit(1))
    got = {r.doc_id: r.class_id for r in wm.near_duplicates(docs).collect()}
    counts = wm.document_frequencies(docs)
    idf = wm.inverse_frequencies(counts)
    sets = []
    for block in blocks(pa.array(texts)):
        t, h, c = wm.text_shingles(block)
        sets += [dict(zip(h[t == k].tolist(), (c * idf[wm.place(h)])[t == k].tolist())) for k in range(block.n_texts)]
    parent = list(range(len(texts)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in combinations(range(len(texts)), 2):
        low = sum(min(w, sets[b].get(h, 0)) for h, w in sets[a].items())
        if low >= 0.8 * (sum(sets[a].values()) + sum(sets[b].values()) - low):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    assert got == {k: root(k) for k in range(len(texts))}
    found = wm.near_duplicates(odd).collect()
    assert len(found) == len(ODD) and {r.class_id for r in found if r.doc_id in (5, 6, 7, None)} == {5}
    assert {r.class_id for r in found if r.doc_id in (1, 2)} == {1}
    assert wm.near_duplicates(empty).count() == 0 and wm.keep_one(odd).where("doc_id in (5, 6, 7)").count() == 1


def test_compact_windows_by_brute_force():
    h = np.random.default_rng(1).integers(0, 1 << 62, 300).astype(np.uint64)
    got = set(zip(*(c.tolist() for c in compact_windows.compact_windows(h, np.array([0, 120]), np.array([119, 299]), 10))))
    want, open_parts = set(), [(0, 119), (120, 299)]
    while open_parts:
        low, high = open_parts.pop()
        if high - low + 1 >= 10:
            c = low + int(np.argmin(h[low:high + 1] >> np.uint64(26)))
            want.add((low, c, high))
            open_parts += [(low, c - 1), (c + 1, high)]
    assert got == want


def test_repeated_passages(spark, odd, empty):
    passage = prose(50, 60)
    rows = [(i, prose(100 + i, 80) + " " + (passage if i % 2 else edit(passage, 61, 7)) + " " + prose(200 + i, 40)) for i in range(12)]
    rows += [(100 + i, prose(300 + i, 150)) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("a", F.lit(1))
    found = compact_windows.repeated_passages(docs)
    got = found.collect()
    assert {r.doc_id for r in got} == set(range(1, 12)) and all(r.first_doc_id < r.doc_id for r in got)
    left = {r.doc_id: r.text for r in compact_windows.remove_repeats(docs, found).collect()}
    assert left[0] == rows[0][1] and all(left[100 + i] == rows[12 + i][1] for i in range(12))
    assert all(passage not in left[i] and prose(100 + i, 80)[:-20] in left[i] for i in range(1, 12))
    pairs = {(r.first_doc_id, r.doc_id) for r in compact_windows.repeated_passages(odd).collect()}
    assert (5, 6) in pairs and compact_windows.repeated_passages(empty).count() == 0


@pytest.mark.parametrize("change", ["substituted", "inserted", "deleted"])
def test_candidates_of_changed_passages(spark, change):
    rows = []
    for k in range(90):
        n = (55, 60, 70)[k % 3]
        words = prose(1000 + k, n).split()
        other = words[:n // 2] + ([] if change == "deleted" else ["new"]) + words[n // 2 + (change != "inserted"):]
        rows += [(2 * k, prose(2000 + k, 70) + " " + " ".join(words) + " " + prose(3000 + k, 50)),
                 (2 * k + 1, prose(4000 + k, 40) + " " + " ".join(other) + " " + prose(5000 + k, 80))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    pairs = {(r.a, r.b) for r in compact_windows.candidate_pairs(compact_windows.signature_groups(compact_windows.windows(docs))).collect()}
    for size in range(3):
        assert sum((2 * k, 2 * k + 1) in pairs for k in range(size, 90, 3)) >= 28
    assert len({r.doc_id for r in compact_windows.repeated_passages(docs).collect()}) >= 84


def test_exact_passages_round_a_common_core(spark):
    rows, want = [], set()
    for group in range(8):
        core, outer = prose(9000 + group, 49), prose(9100 + group, 11).split()
        for k in range(60):
            inside = " ".join(outer[:6] + [core] + outer[6:]) if k in (31, 47) else f"u{group}x{k} {core} v{group}x{k}"
            rows.append((100 * group + k, prose(10_000 + 100 * group + k, 20) + " " + inside + " " + prose(20_000 + 100 * group + k, 20)))
        want.add((100 * group + 31, 100 * group + 47, 20, 80))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    exact = compact_windows.exact_passages(docs, compact_windows.signature_groups(compact_windows.windows(docs)))
    assert {(r.first_doc_id, r.doc_id, r.start_word, r.end_word) for r in exact.collect()} == want
    spans = [(r.doc_id, r.start_word, r.end_word) for r in compact_windows.repeated_passages(docs).collect()]
    assert all(any(d == doc and low <= start and high >= end for d, low, high in spans) for _, doc, start, end in want)


def test_near_passages_round_a_common_core(spark):
    rows, want = [], set()
    for group in range(8):
        core, outer = prose(9000 + group, 49), prose(9100 + group, 11).split()
        for k in range(60):
            inside = " ".join(outer[:6] + [core] + outer[6:]) if k in (31, 47) else f"u{group}x{k} {core} v{group}x{k}"
            if k == 47:
                words = inside.split()
                inside = " ".join(words[:30] + ["changed"] + words[31:])
            rows.append((100 * group + k, prose(10_000 + 100 * group + k, 20) + " " + inside + " " + prose(20_000 + 100 * group + k, 20)))
        want.add((100 * group + 31, 100 * group + 47))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r.first_doc_id, r.doc_id) for r in compact_windows.repeated_passages(docs).collect()}
    assert found == want


def test_bitmaps_bound_what_is_shared():
    rng = np.random.default_rng(3)
    for k in range(40):
        a = rng.integers(0, 1 << 62, 120).astype(np.uint64)
        b = np.where(rng.random(120) < 0.03 * (k % 5), rng.integers(0, 1 << 62, 120).astype(np.uint64), a)
        b[k:k + 20] = b[60] if k % 2 else b[k:k + 20]
        (x, y), different, fewest, content = compact_windows._bitmaps(np.concatenate([a, b]), np.array([10, 130]), np.array([100, 220]), 46)
        sets = [set(c[10:101].tolist()) for c in (a, b)]
        hidden = different - np.bitwise_count(np.stack([x, y])).sum(axis=1, dtype=np.int64)
        assert different.tolist() == [len(c) for c in sets] and (content[0] == content[1]) == (a[10:101] == b[10:101]).all()
        assert len(sets[0] & sets[1]) <= np.bitwise_count(x & y).sum(dtype=np.int64) + hidden.min()
        assert fewest.tolist() == [min(len(set(c[i:i + 46].tolist())) for i in range(10, 56)) for c in (a, b)]


def shingles_of(text):
    (block,) = blocks(pa.array([text]))
    return block.shingles(compact_windows.SHINGLE)[0]


def test_near_windows_are_tied_by_few_rows(spark):
    rng = np.random.default_rng(11)

    def words(n):
        return [f"w{x}" for x in rng.integers(0, 1 << 40, n)]

    core = words(70)
    # The first document holds 40 words of what all others nearly share, so it settles none of them.
    rows = [(0, " ".join(words(30) + core[15:55] + words(30)))]
    for i in range(1, 41):
        own = list(core)
        own[2 + i % 10], own[58 + i % 10] = words(2)
        rows.append((i, " ".join(words(30) + own + words(30))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r.first_doc_id, r.doc_id) for r in compact_windows.repeated_passages(docs).collect()}
    assert {b for _, b in found} == set(range(2, 41)) and len(found) < 200


def test_runs_of_a_cell_by_brute_force():
    rng = np.random.default_rng(12)
    base = rng.integers(1, 1 << 62, 91).astype(np.uint64)
    lists = []
    for _ in range(40):
        own, n = base.copy(), rng.integers(1, 6)
        for p in rng.integers(0, 87, n):
            own[p:p + 5] = rng.integers(1, 1 << 62, 5)
        lists.append(own)
    end = np.cumsum([len(x) for x in lists])
    runs = compact_windows._Runs(np.concatenate(lists), end - 91, end, np.full(40, 91), 46, 0.8)
    score = runs.best(np.arange(39), 39)
    assert (score >= 0).any() and (score < 0).any()
    for e in range(39):
        same = lists[e] == lists[39]
        best = max((same[i:j].sum() - 2 * (j - i) * 0.8 / 1.8 for i in range(46) for j in range(i + 46, 92) if same[i] and same[j - 1]), default=-9)
        assert (score[e] >= -1e-3) == (best >= -1e-9)


def test_passages_with_repeated_phrases():
    for n in (50, 60, 80, 90, 120, 150):
        for size in range(5, 11):
            passage, before = prose(n, n).split(), prose(n + 1, 60).split()
            twice = passage[:4] + passage[n // 2:n // 2 + size] + passage[4 + size:]
            for text, earlier in ((twice, before), (passage, before[:30] + passage[9:9 + size] + before[30:]),
                                  (passage, before[:30] + passage[:size] + before[30:] + passage[-size:])):
                a, b = (shingles_of(" ".join(x + text + y)) for x, y in ((earlier, prose(7, 30).split()), (prose(8, 50).split(), prose(9, 40).split())))
                found = compact_windows.matching_passages(a, b, np.ones(len(a), bool), np.ones(len(b), bool), 46, 0.8)
                assert [(b0, b1) for b0, b1, _, _ in found] == [(50, 50 + n - 5)]
    a, b = shingles_of("w " * 90), shingles_of("x y z " + "w " * 70)
    assert [f[:2] for f in compact_windows.matching_passages(a, b, np.ones(len(a), bool), np.ones(len(b), bool), 46, 0.8)] == [(3, 68)]


def test_streaming_viterbi_and_round_trip(spark, odd, empty):
    model = pieces.PieceModel.load()
    for text in [" " + t for _, t in ODD if t and len(t) < 2000] + [" " + "x" * 500]:
        best = [(0, 0)] + [None] * len(text)
        for i in range(len(text)):
            if best[i] is None:
                continue
            for size in range(1, model.longest + 1):
                p = text[i:i + size]
                s = model.scores.get(p, model.unknown if size == 1 else None)
                if len(p) == size and s is not None and (best[i + size] is None or best[i][0] + s > best[i + size][0]):
                    best[i + size] = (best[i][0] + s, i)
        cuts, end = [], len(text)
        while end:
            cuts.append(text[best[end][1]:end])
            end = best[end][1]
        want = [k for p in cuts[::-1] for k in ([model.ids[p]] if p in model.ids else [model.byte_ids[b] for b in p.encode()])]
        assert [k for ids in model.stream(iter([text[:7], text[7:]])) for k in ids] == want
        for block in blocks(pa.array([text[1:]])):
            assert pieces._Encoder.of(pieces.MODEL).encode(block)[1].tolist() == want
    encoded = pieces.encode(odd, ["doc_id", "text"])
    assert all(r.row.text == r.text for r in pieces.decode(encoded, ["row"]).select("row.row", "text").collect())
    assert pieces.encode(empty, ["doc_id"]).count() == 0


def test_license_scan_by_brute_force(spark, odd, empty):
    rows = [(i, prose(i, i) + " " + t + " " + prose(i + 50, 9)) for i, t in enumerate(list(license_scan.TEMPLATES.values()) * 3)]
    rows += [(90, prose(3, 40)), (91, "Licensed under the")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("h", F.lit(1))
    got = {(r.doc_id, r.license) for r in license_scan.scan(docs).collect()}
    shingles = lambda t: {tuple(w[k:k + 3]) for w in [re.findall(r"[^\W_]+", t.lower())] for k in range(len(w) - 2)}
    want = {(i, n) for i, t in rows for n, s in license_scan.TEMPLATES.items() if len(shingles(s) & shingles(t)) >= 0.8 * len(shingles(s))}
    assert got == want
    assert license_scan.scan(odd).count() == 0 and license_scan.scan(empty).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    rows = [(i, prose(i, 80), "en", f"s{i % 2}", 0) for i in range(60)] + [(100, prose(1, 80), "en", "s0", 0), (101, "### *** " * 40, "en", "s1", 0)]
    rows += [(102, "||| ### " * 40, "en", "s1", 0), (103, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in range(30)] + [(101, 0)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    ids = {r.doc_id for r in out.select("doc_id").collect()}
    assert set(range(60)) <= ids and not ids & {100, 101, 102}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeats", "mixture", "encoding"]


def test_columns_of_any_name(spark):
    names = ["weight", "plan", "quota", "passes", "n_docs", "n_tokens", "_tokens", "_doc", "_own", "_id", "_node", "_spans", "_source", "spans", "keeper"]
    passage = prose(77, 60)
    rows = [(i, prose(i, 30) + " " + (passage if i < 2 else prose(500 + i, 60)), f"s{i % 2}") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumns({c: F.lit(f"own {c}") for c in names})
    mixed = mixing.mix(docs)
    assert mixed.count() >= 6 and mixed.columns == [c for c in docs.columns if c != "plan"] + ["plan"]
    assert mixed.select("weight", "_tokens", "quota").distinct().collect() == [("own weight", "own _tokens", "own quota")]
    assert mixed.select("plan.weight").first()[0] > 0
    kept = wm.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == 6 and {r._own for r in kept.collect()} == {"own _own"}
    passages = spark.createDataFrame([(1, 30, 90)], "doc_id bigint, start_word bigint, end_word bigint")
    left = compact_windows.remove_repeats(docs, passages)
    assert left.columns == docs.columns and {r._spans for r in left.collect()} == {"own _spans"}
    assert {r.doc_id: r.text for r in left.collect()}[1].strip() == prose(1, 30)


def test_written_tables_go_when_they_are_done(spark, tmp_path, monkeypatch):
    from runlens.plans import tables
    monkeypatch.setattr(tables, "shared_dir", lambda spark: str(tmp_path))
    passage = prose(90, 60)
    docs = spark.createDataFrame([(i, prose(91 + i, 40) + " " + passage + " " + prose(94 + i, 40)) for i in range(3)], "doc_id bigint, text string")
    assert {r.doc_id for r in compact_windows.repeated_passages(docs).collect()} == {1, 2}
    assert {p.name.split("-")[0] for p in tmp_path.iterdir()} == {"passages", "runs"}
    wm.near_duplicates(docs).collect()
    assert not {"sketches", "buckets", "texts", "rest"} & {p.name.split("-")[0] for p in tmp_path.iterdir()}


def test_rare_elements_bound_what_is_shared(spark):
    rng = np.random.default_rng(5)
    rows, sets = [], {}
    for k in range(24):
        # Copies of 200 elements, of which each has its own 10, 30 or 50.
        own = (10, 30, 50)[k % 3]
        base = [int(x) for x in rng.permutation(200)[: 200 - own]] + [1000 * (k + 1) + j for j in range(own)]
        sets[bytes([k])] = {x: 1.0 + x % 7 / 10 for x in base}
        rows += [(bytes([k]), x, w) for x, w in sets[bytes([k])].items()]
    rare = wm.rarest_elements(spark.createDataFrame(rows, "node binary, element bigint, weight double"))
    pairs = rare.alias("x").join(rare.alias("y"), F.col("x.node") != F.col("y.node"))
    columns = ["x.node", "y.node", wm.shared_at_most("x", "y"), "x.total", wm.shared_at_most("y", "x"), "y.total"]
    for a, b, most, total, most_of_b, total_b in pairs.select(*columns).collect():
        own, other = sets[bytes(a)], sets[bytes(b)]
        assert sum(w for x, w in own.items() if x in other) <= most + 1e-6
        if bytes(a)[0] % 3 == bytes(b)[0] % 3 == 2:
            assert min(most / total, most_of_b / total_b) < 0.85
