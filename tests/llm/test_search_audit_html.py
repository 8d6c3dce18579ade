"""Ranked search, filter audit and main text: odd tables against brute force."""

import random
import time

import duckdb
import numpy as np
import pytest

import brute
from conftest import LONG
from quipu.llm import audit, htmlblocks, mincut, ranked
from quipu.llm.common import stored
from quipu.llm.queries import QUERIES

ROOT = "/root/testdata/sf0.001"
CLASH = ("id", "n", "terms", "tf", "score", "item", "rank", "block", "part", "failed", "digest", "shard", "first", "bit", "before")


# -- ranked search


def hits(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (str(r.item_id), r["rank"])):
        out.setdefault(r.item_id, []).append((r.score, r.doc_id))
    return out


def test_ranking_of_odd_rows(make, benchmark, odd_rows):
    rows = [r for r in odd_rows if r[0] is not None] + [(100 + i, "the quick Fox, naïve café" + " x" * (i % 3)) for i in range(60)]
    rows = sorted({r[0]: r for r in rows}.values(), key=lambda r: r[0])
    items = [(1, "Quick FOX fox jumps"), (2, None), (3, ""), (4, "nowhere"), (5, "café 文字 🙂"), (6, "x"), (7, LONG)]
    got = hits(ranked.search(make(rows, CLASH), benchmark(items)))
    want = brute.ranked([r[1] for r in rows], [t for _, t in items])
    assert got == {i: [(s, rows[p][0]) for s, p in w] for (i, _), w in zip(items, want) if w}


@pytest.mark.parametrize("block_items", [3, 1000])
def test_blocks_of_items_give_the_same(make, benchmark, block_items):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(30)))) for i in range(700)]
    items = [(i, " ".join(rng.choices(words, k=6))) for i in range(7)]
    got = hits(ranked.search(make(rows), benchmark(items), block_items=block_items))
    want = brute.ranked([t for _, t in rows], [t for _, t in items])
    assert got == {i: w for (i, _), w in zip(items, want)}


def test_equal_scores_go_by_id_whatever_their_number(make, benchmark):
    rows = [(i, "same words here") for i in range(1000, 0, -1)] + [(None, "same words here")]
    rows += [(2000 + i, "others") for i in range(100)]
    got = hits(ranked.search(make(rows), benchmark([(1, "words"), (None, "same")])))
    assert [d for _, d in got[1]] == list(range(1, 21)) and [d for _, d in got[None]] == list(range(1, 21))
    few = make([(None, "a b"), (2, "a b"), (2, "a b"), *[(9 + i, "c") for i in range(20)]])
    assert [d for _, d in hits(ranked.search(few, benchmark([(1, "b b")])))[1]] == [2, 2, None]


def test_search_of_nothing(make, benchmark, odd_rows):
    assert ranked.search(make([]), benchmark([(1, "one")])).collect() == []
    assert ranked.search(make(odd_rows), benchmark([])).collect() == []
    assert ranked.search(make([(1, None), (2, " ")]), benchmark([(1, "one")])).collect() == []


def test_search_by_text_ids(spark, benchmark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), ("c", "two"), ("d", "two"), ("e", "two")], "doc_id string, text string")
    assert [d for _, d in hits(ranked.search(docs, benchmark([(1, "one")])))[1]] == ["a", "b"]


def test_digits_keep_large_weights_exact():
    weight = np.array([44_361, 7, 40_000], np.int64)
    items = [{0: 30_000_000, 1: 1}, {2: 3}]
    (tile,) = ranked.tiles(items, weight)
    terms, rows, impact = np.array([0, 1, 2, 5]), np.array([0, 0, 1, 1]), np.array([999_999, 5, 999_998, 9])
    got = ranked.tile_scores(tile, terms, rows, impact, 2)
    assert got.tolist() == [[44_361 * 30_000_000 * 999_999 + 35, 0], [0, 120_000 * 999_998]]


def test_terms_of_a_text_longer_than_a_chunk(monkeypatch):
    monkeypatch.setattr(ranked, "CHUNK", 10)
    text = "Ab cd-ef gh_ij Éa 12345678901234567890 k".encode()
    assert [w.decode() for c in ranked.term_lists(text) for w in c] == brute.TERM.findall(text.decode().translate(brute.LOWER))


# -- filter audit


def counted(df):
    return {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in df.collect()
    }


@pytest.mark.parametrize("shard,bucket,hot", [(audit.SHARD_BYTES, audit.BUCKET_WORDS, 2000), (60, 3, 2)])
def test_audit_of_odd_rows(spark, make, odd_rows, monkeypatch, shard, bucket, hot):
    """Shards, buckets of the dictionary and hot digests of any size give the same."""
    monkeypatch.setattr(audit, "BUCKET_WORDS", bucket)
    monkeypatch.setattr(audit, "HOT_KEYS", hot)
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["Aa", "b", "c#", "D", "e\te", "ß"], k=n)) for n in (3, 99, 100, 101, 150)]
    texts += [" ".join(f"w{i}" for i in range(130)), "#", "\n"]
    rows = odd_rows + [(30 + i, rng.choice(texts), rng.choice(["en", "fr", "", None]), "s", 1) for i in range(120)]
    labels = [(i, i % 3 == 0 and 1 or 0, i % 5 == 0 and 1 or None) for i in range(0, 150, 2)] + [(30, 1, 1), (30, 0, 0), (None, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = counted(audit.interactions(make(rows, CLASH), marks))
    assert got == brute.audit([(r[0], r[1], r[2] if len(r) > 2 else "en") for r in rows], labels)


def test_words_have_one_number_each(make, odd_rows):
    """Numbers of the dictionary mean the same word in every shard, and the rows are the texts' words."""
    docs = make(odd_rows + [(50 + i, f"the cat {i % 4} the") for i in range(40)]).repartition(4)
    shards = stored(audit.local_shards(docs, "doc_id", "text", "lang", 10, "#"), "test-shards")
    pieces = audit.word_numbers(shards, 3, with_words=True).collect()
    by_word = {}
    for r in pieces:
        for w, n in zip(bytes(r.words).split(), audit.unpacked(r.numbers).tolist()):
            by_word.setdefault(w, set()).add((r.bucket, n))
    assert all(len(v) == 1 for v in by_word.values())
    assert len({next(iter(v)) for v in by_word.values()}) == len(by_word)
    assert by_word.keys() == {w.encode() for t, in docs.select("text").collect() for w in (t or "").split()}


def test_audit_of_nothing(spark, make, odd_rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.interactions(make([]), none).collect() == []
    got = audit.interactions(make(odd_rows), none)
    assert got.filter("good_lost + toxic_lost > 0").count() == 0 and got.count() == 600 * len({r[2] or "" for r in odd_rows if len(r) > 2} | {"en"})


def test_numbers_survive_packing():
    numbers = np.array([0, 1, 255, 256, 2**32 - 1])
    assert audit.unpacked(audit.packed(numbers)).tolist() == numbers.tolist()
    assert audit.unpacked(audit.packed(np.empty(0))).tolist() == []


# -- main text


def test_main_text_of_the_test_pages(spark):
    got = {r.page_id: r for r in QUERIES["op13_html"](spark, ROOT).collect()}
    rows = duckdb.sql(f"select page_id, url, html from '{ROOT}/pages.parquet'").fetchall()
    assert len(got) == len(rows)
    for page, url, html in rows:
        want = brute.article(html)
        assert (got[page].url, got[page].text, got[page].n_chars) == (url, want, len(want))


def test_least_cuts_against_all_labellings():
    rng = random.Random(5)
    for _ in range(1500):
        n = rng.randint(1, 9)
        terminal = [rng.randint(-8, 8) for _ in range(n)]
        edges = [(a, b, rng.randint(0, 5)) for a in range(n) for b in range(a) if rng.random() < 0.5]
        sides = mincut.minimum_cut(terminal, edges)
        assert brute.cut_price(terminal, edges, sides) == brute.least_cut(terminal, edges)


TEXT = "The committee met on Tuesday, and after a long debate, it agreed to publish the report in full, with all of its annexes."
PAGES = {
    "no elements of HTML 5": (
        f"""<body class="has-sidebar"><div id="top"><div class="menu"><a href=/>Home</a> <a href=/n>News</a></div></div><div id="wrap"><div id="content">
        <h1>Report out</h1><p>{TEXT}<p>Short one.<p>{TEXT}<ul><li>first point<li>second point</ul><div class="ad">{TEXT}</div><p>{TEXT}</div>
        <div id="sidebar"><h3>Latest</h3><ul><li><a href=x>Another story</a></ul><p>{TEXT}</p></div></div>
        <div class="cookie-notice">{TEXT} <button>Accept</button></div><div class="comments"><div class=comment><p>{TEXT}</p></div></div><div id=footer>&copy; 2020</div>""",
        ["Report out", TEXT, "Short one.", TEXT, "first point", "second point", TEXT],
    ),
    "no names at all": (
        f"<table><tr><td><a href=1>Home</a><td><a href=2>About</a></table><p>{TEXT}</p><p>Yes.</p><p>{TEXT}</p><hr><a href=3>Next</a> | <a href=4>Back</a>",
        [TEXT, "Yes.", TEXT],
    ),
    "all inside an article": (
        f"""<main><article class="post comments-open category-legal"><header><h1>Title here</h1></header><p>{TEXT}</p><pre>a  =
        1</pre><table><tr><th>Year</th><td>17</td></table><aside><p>{TEXT}</p></aside><form><label>Mail</label><p>{TEXT}</p></form><p>end</p>
        <section class="comments"><p>{TEXT}</p></section><footer>Tags: x</footer></article></main><section id=comments><article class="comment"><p>{TEXT}</p></article></section>""",
        ["Title here", TEXT, "a = 1", "Year", "17", "end"],
    ),
    "a form around the page": (
        f"<form id=f><header>{TEXT}</header><div class='main-content'><h2>Head</h2><p>{TEXT}</p><p>tiny</p></div><div class=newsletter><p>{TEXT}</p></div></form>",
        ["Head", TEXT, "tiny"],
    ),
    "hidden and replaced": (
        f"<article><p>{TEXT}</p><p style='display: none'>{TEXT}</p><div hidden>{TEXT}</div><script>var a = '<p>no</p>'</script><style>p {{}}</style><!-- <p>no</p> --><noscript>{TEXT}</noscript>",
        [TEXT],
    ),
    "references and blanks": (f"<article><p title='a > b'>x &lt;b&gt; &amp;amp; caf&eacute;&nbsp;\n &#x41;<br>{TEXT}<!-- a > b --></article>", [f"x <b> &amp; café A {TEXT}"]),
}


@pytest.mark.parametrize("name", PAGES)
@pytest.mark.parametrize("learned", [False, True])
def test_main_text_of(name, learned):
    """With weights learned from the test pages, and from no page at all."""
    found = {}
    if learned:
        for (html,) in duckdb.sql(f"select html from '{ROOT}/pages.parquet'").fetchall():
            for key, n in mincut.taught(htmlblocks.Page(html)).items():
                found[key] = found.get(key, 0) + n
    assert mincut.main_text(PAGES[name][0], mincut.weights(found)).split("\n") == PAGES[name][1]


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (2, None, ""), (None, "u", "  \n"), (5, "u", "no tags, but some words. " * 20), (6, "u", "<"), (7, "u", "<p"), (8, "u", "<!-- never ends > x"), (9, "u", "<script>x")]
    pages = spark.createDataFrame([r + (7,) for r in rows], "page_id long, url string, html string, text int")
    got = mincut.extract(pages)
    assert got.columns == ["page_id", "url", "html", "text"] and got.schema["text"].dataType.simpleString() == "string"
    texts = sorted((str(r.page_id), r.text) for r in got.collect())
    assert [t for t in texts if t[1]] == [("5", ("no tags, but some words. " * 20).strip())] and len(texts) == len(rows)
    assert mincut.extract(pages.limit(0)).collect() == []


def test_very_long_pages_end():
    weight, start = mincut.weights({}), time.time()
    many = "<article>" + "".join(f"<p>{'word, ' * (i % 30)}x</p><ul><li><a href=x>l{i}</a></ul>" for i in range(20_000))
    assert mincut.main_text(many, weight).count("\n") >= 20_000
    for html in ("<a" * 300_000, "<div>" * 100_000 + "x" + "</span>" * 10_000, "<p><!--" * 100_000, '<a x="' * 100_000 + ">", "<script>" * 50_000, "a" * 3_000_000, " " * 3_000_000):
        mincut.main_text(html, weight)
    assert time.time() - start < 60
