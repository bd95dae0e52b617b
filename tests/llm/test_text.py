import gzip
import hashlib
import io
import math
import re
import sys
import time
from collections import Counter

import pyarrow as pa
import pytest
from helpers import LOWER, SMALL, documents, in_sql, nothing, rows, sample_texts

from millrace.llm import common, decontaminate, html_text, lm_score, mixing, token_count, warc
from millrace.llm.queries import ORACLE_SQL, QUERIES
from millrace.session import work_path

# Archives


def pages(spark, data):
    return spark.createDataFrame(data, "page_id long, url string, html string, key string, payload string, `refers_to` string").repartition(2)


PAGES = [
    (1, "http://a/ b\r\nc", "<p>same</p>", "k", "p", "r"),
    (5, None, "<p>same</p>", None, None, None),
    (5, None, "<p>same</p>", None, None, None),
    (2, "http://ä", None, None, None, None),
    (3, "u", "", None, None, None),
    (None, "u", "é" * 200_000, None, None, None),
    (None, "u", "<p>same</p>", None, None, None),
    (9, "u", "WARC/1.1\r\n\r\n", None, None, None),
]


def test_archives_give_back_what_was_written(spark):
    found = rows(warc.archive_round_trip(spark, pages(spark, PAGES)).drop("url"))
    expected = []
    for page_id, _, html, *_ in PAGES:
        body = (html or "").encode()
        same = [p[0] for p in PAGES if (p[2] or "") == (html or "") and p[0] is not None]
        first = max(same, default=None)
        revisit = first is not None and page_id != first
        expected.append((page_id, len(body), warc.sha1_base32(body), "revisit" if revisit else "response", first if revisit else None))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    at = sorted(range(5), key=lambda i: names[i])
    assert found == sorted((tuple(r[i] for i in at) for r in expected), key=repr)


def test_payloads_and_small_archives(spark):
    written = warc.write_archives(warc.plan_records(pages(spark, PAGES), least=1), work_path(spark, "warc"), size=100)
    assert written.agg({"records": "sum"}).first()[0] == len(PAGES) and written.count() > 2
    bodies = Counter(bytes(r.payload).decode() for r in warc.read_archives(written).collect() if r.payload is not None)
    assert bodies == Counter(["<p>same</p>"] * 2 + ["", "", "é" * 200_000, "WARC/1.1\r\n\r\n"])  # empty ones are all responses


def test_archives_of_nothing(spark):
    assert warc.archive_round_trip(spark, pages(spark, [])).collect() == []


def test_damage_is_noticed():
    raw = warc.record(1, "u", b"body", warc.sha1_base32(b"body"), None, False, "2020-01-01T00:00:00Z")
    assert warc.parse(raw)[1:] == (b"body", 4)
    for bad in (raw.replace(b"body", b"b0dy"), raw[:-1], raw + b"x", b"HTTP/1.1 200"):
        with pytest.raises(ValueError):
            warc.parse(bad)
    two = gzip.compress(raw) + gzip.compress(raw)
    assert list(warc.members(io.BytesIO(two))) == [raw, raw]
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(two[:-9])))


def test_archive_query_matches_sql(spark):
    table = spark.read.parquet(f"{SMALL}/pages.parquet")
    assert rows(QUERIES["op1_warc"](spark, SMALL)) == in_sql(ORACLE_SQL["op1_warc"], pages=table)


# Language model


def brute_force_scores(given, least=2, alpha=0.4):
    texts = [(i, (t or "").lower().split()) for i, t in given]
    one = Counter(w for _, x in texts for w in x)
    total = sum(one.values())
    one["\x00"] = len(texts)
    two = Counter(p for _, x in texts for p in zip(["\x00", *x], x))
    out = []
    for i, x in texts:
        pairs = list(zip(["\x00", *x], x))
        s = sum(math.log(two[p] / one[p[0]]) if two[p] >= least else math.log(alpha * one[p[1]] / total) for p in pairs)
        out.append((i, len(x), round(s, 4), sum(two[p] < least for p in pairs)))
    return sorted(out, key=repr)


def scores(df):
    return sorted(((r.doc_id, r.n_words, round(r.log_score, 4) + 0.0, r.n_backed_off) for r in df.collect()), key=repr)


def test_scores_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "PACK", 50)
    docs = documents(spark)
    assert scores(lm_score.score_corpus(spark, docs)) == [(i, n, s + 0.0, b) for i, n, s, b in brute_force_scores(sample_texts())]


def test_scores_of_a_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found, expected = scores(QUERIES["op2_lm_scores"](spark, SMALL)), brute_force_scores(given)
    assert [(a, b, d) for a, b, _, d in found] == [(a, b, d) for a, b, _, d in expected]
    assert all(abs(x[2] - y[2]) < 1e-2 for x, y in zip(found, expected))


def test_small_vocabulary_and_empty_model(spark):
    docs = documents(spark, [(1, "a a a b b c d"), (2, "a b x y")])
    model = lm_score.fit(docs, vocabulary=2)
    ids, counts = model.vocabulary.value
    assert ids == {"a": 2, "b": 3} and counts.tolist() == [4, 2, 4, 3] and model.total == 11
    assert lm_score.score_corpus(spark, nothing(spark)).collect() == []
    none = lm_score.score(docs, lm_score.fit(nothing(spark))).collect()
    assert sorted((r.n_words, r.n_backed_off) for r in none) == [(4, 4), (7, 7)]


def test_every_word_keeps_its_count(spark):
    """No size of the corpus makes rare words one word, and a model scores documents it was not made of."""
    given = [(i, f"r{i} r{i} common r{i + 1} r{i} r{i}") for i in range(300)]
    docs = documents(spark, given)
    model = lm_score.fit(docs)
    assert model.vocabulary is None
    assert (model.words.count(), model.pairs.count(), model.total) == (303, 1500, 1800)  # the begin mark is one more word
    assert scores(lm_score.score(docs, model)) == scores(lm_score.score_corpus(spark, docs)) == [(i, n, s + 0.0, b) for i, n, s, b in brute_force_scores(given)]
    (r,) = lm_score.score(documents(spark, [(1, "never seen")]), model).collect()
    assert (r.n_words, r.n_backed_off) == (2, 2) and abs(r.log_score - 2 * math.log(0.4 / 1800)) < 1e-5


@pytest.mark.parametrize(("hot", "rounds"), [(0, 1), (5, 3), (1 << 18, 2)])
def test_what_scoring_holds_on_disk(spark, monkeypatch, hot, rounds):
    """Scores do not depend on what is broadcast or on the rounds; counts go before texts are scored, and only pairs seen are written."""
    for name, value in (("PACK", 50), ("HOT", hot), ("ROUNDS", rounds)):
        monkeypatch.setattr(lm_score, name, value)
    places, rows_of = [], []
    monkeypatch.setattr(lm_score, "discard", lambda s, at: (places.append(at), rows_of.append(s.read.parquet(at).collect()), common.discard(s, at)))
    given = [*sample_texts(), (90, "a b a b c"), (91, "c a b")]
    assert scores(lm_score.score_corpus(spark, documents(spark, given))) == [(i, n, s + 0.0, b) for i, n, s, b in brute_force_scores(given)]
    assert all(r.n >= 2 for r in rows_of[0] if r.v is not None) and any(r.n == 1 for r in rows_of[0])
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(places[0])
    assert not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def test_words_are_found_and_hashed_together():
    """As split one by one, with Python's idea of white space, and without a call for each word."""
    spaces = "".join(c for c in map(chr, range(0x110000)) if c.isspace())
    odd = ["", " ", "a", spaces, "x".join(spaces), "İ ΑΣ ΑΣΑ É", "\x00 \x00\x00 \x1c\x00", *(f"{'q' * n} Q{'q' * n}" for n in (7, 8, 9, 255, 256, 257, 5000))]
    given = [*odd, *(" ".join(f"{'ab' * (i % 9)}{i}-{j}" for j in range(500)) for i in range(40))]
    batch = pa.RecordBatch.from_arrays([pa.array(given)], ["text"])
    calls = Counter()
    sys.setprofile(lambda frame, event, arg: calls.update([event]))
    try:
        ((_, sizes, v, w),) = [x[:2] + x[-2:] for x in lm_score._chunks(iter([batch]), None, lm_score.PACK)]
    finally:
        sys.setprofile(None)
    assert calls["call"] + calls["c_call"] < len(w) / 10
    split = [x.lower().split() for x in given]
    assert sizes.tolist() == [len(x) for x in split]
    keys = set(zip((x for y in split for x in y), w.tolist()))
    assert len(keys) == len({k for _, k in keys}) == len({x for x, _ in keys}) and not {k for _, k in keys} & {lm_score.UNK, lm_score.BEGIN}
    assert v.tolist() == [p for n, at in zip(sizes, sizes.cumsum() - sizes) if n for p in (lm_score.BEGIN, *w[at : at + n - 1].tolist())]


@pytest.mark.parametrize("hot", [0, 1, 3, 1 << 18])
def test_scores_with_a_vocabulary(spark, monkeypatch, hot):
    """Rare words are one, also next to each other; equal counts are broadcast together or not at all."""
    monkeypatch.setattr(lm_score, "HOT", hot)
    given = [(1, "a a a b b c d"), (2, "a b x y"), (3, "p q r s a"), (4, None)]
    docs = documents(spark, given)
    known = [(i, t and " ".join(w if w in "ab" else "_" for w in t.split())) for i, t in given]
    assert scores(lm_score.score(docs, lm_score.fit(docs, vocabulary=2))) == [(i, n, s + 0.0, b) for i, n, s, b in brute_force_scores(known)]


def test_the_commonest(spark):
    rows_of = spark.createDataFrame([(i, n) for i, n in enumerate([9, 7, 7, 3, 3, 3, 1])], "key long, n long")
    assert [lm_score._commonest(rows_of, size).count() for size in (0, 1, 2, 3, 5, 6, 9)] == [0, 1, 1, 3, 3, 6, 7]


# Decontamination

ITEMS = [
    (1, " ".join(f"W{i}" for i in range(15))),
    (2, "only three words"),
    (3, "élan vital"),
    (4, None),
    (5, " .,; "),
    (6, "once"),
    (6, "once"),
    (7, "x x"),
    (8, " ".join(f"v{i}" for i in range(30)) + " w5 w6 w7"),
]


def brute_force_hits(given, items, window=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    grams = [(i, w) for i, t in items if (w := words(t))]
    windows = {(i, tuple(w[s : s + n])) for i, w in grams for n in [min(window, len(w))] for s in range(len(w) - n + 1)}
    by = {}
    for i, g in windows:
        by.setdefault(g, set()).add(i)
    out = []
    for doc_id, text in given:
        w, hit, found = words(text), set(), set()
        for n in {len(g) for g in by}:
            for s in range(len(w) - n + 1):
                if (g := tuple(w[s : s + n])) in by:
                    hit |= set(range(s, s + n))
                    found |= by[g]
        ids = ",".join(sorted(map(str, found)))
        out.append((hit and 20 * len(hit) >= len(w) or False, doc_id, hashlib.sha256(ids.encode()).hexdigest(), len(hit), len(found), len(w)))
    return out


def contaminated_texts():
    w = [f"w{i}" for i in range(15)]
    return [
        *sample_texts(),
        (50, "Before " + "; ".join(w[:13]).upper() + " after"),
        (51, " ".join(w[1:13])),  # one word short
        (52, "words Only, three. WORDS only three words once"),
        (53, "ÉLAN vital; Élan Vital; élan vital"),
        (54, "x x x x y x"),
        (55, "filler " * 400 + "only three words"),
        (56, " ".join(["a", *w, "b", *w[:14], "c"])),
        (57, " ".join(f"v{i}" for i in range(5, 25))),
    ]


@pytest.mark.parametrize("broadcast", [decontaminate.BROADCAST, -1])
def test_hits_match_brute_force(spark, broadcast, monkeypatch):
    monkeypatch.setattr(decontaminate.find_hits, "__defaults__", (13, broadcast))
    docs = documents(spark, contaminated_texts())
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "'x' AS words", "1 AS gram")
    expected = brute_force_hits(contaminated_texts(), ITEMS)
    assert rows(decontaminate.contamination(docs, items)) == sorted(expected, key=repr)
    assert sum(r[0] for r in expected) > 5
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[1] for r in expected if not r[0])


def test_hit_words_are_cut(spark):
    docs = documents(spark, [(1, "Keep: Only, three. WORDS; and this!"), (2, "only three words"), (3, None), (4, "x y"), (5, "a x x, x b")])
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontaminate.cut_contaminated(docs, items)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "Keep: and this!", 2: "", 3: None, 4: "x y", 5: "a b"}


def test_hits_of_nothing(spark):
    docs, items = documents(spark), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contamination(nothing(spark), items).collect() == []
    assert not any(r.n_hit for r in decontaminate.contamination(docs, items.limit(0)).collect())
    assert decontaminate.contamination(docs, items.limit(0)).count() == docs.count()


def test_decontamination_query_matches_sql(spark):
    tables = {n: spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "benchmark")}
    assert rows(QUERIES["op3_decontaminate"](spark, SMALL)) == in_sql(ORACLE_SQL["op3_decontaminate"], **tables)


# Web pages

SITE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body class="home">
<header><h1>Site</h1><a href="/">Home</a></header><nav><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></nav>
<div id="cookie-notice">We use cookies on this site to make many things better for you</div><!-- <p>hidden</p> -->
<div class="content"><h2>A &lt;title&gt;</h2><p>Some &amp; more&nbsp;words   in a
paragraph<br>that goes on.<p>With a <a href="q?a='>'">link</a> in it<script>var t = "</p><p>no";</script>
<aside>Related things</aside><ul><li>first<li>second</ul><form>Name <input name=n></form>
<div class="comments"><p>I think this is a very good article and I say so here at length</div></div>
<div class="ad-box">Buy this now</div><footer>&copy; us</footer>"""


def test_article_is_found():
    tree = html_text.train()
    assert html_text.main_text(SITE, tree) == "A <title> Some & more words in a paragraph that goes on. With a link in it first second"


@pytest.mark.parametrize("page", ["", " ", "<", "<p", "<a href='x", "<!-- open", "<script>x", "</div></p>", "<div" * 1000, "<p>" * 5000, "&#xD800;&bogus;\x00"])
def test_broken_pages_do_not_fail(page):
    assert isinstance(html_text.main_text(page, html_text.train()), str)


@pytest.mark.parametrize("start", ["<body>", "", "<body><div>", "<p>A line to begin with.</p>"])
def test_head_may_be_left_open(start):
    text = "Enough words for a paragraph of an article, which goes on for a while and has no links in it at all."
    head = "<html><head><meta charset=utf-8><title>not this</title><style>p { color: red }</style>"
    found = html_text.main_text(f"{head}{start}<h1>A heading of it</h1><p>{text}</p><p>{text}</p>", html_text.train())
    assert found.endswith(f"{text} {text}") and "not this" not in found and "color" not in found
    assert html_text.blocks("<html><head><title>x</title>Only text")[0].text == "Only text"


TEXT = "Enough words for a paragraph of an article, which goes on for a while and has no links in it at all."


@pytest.mark.parametrize(
    "wrapper",
    ["content has-sidebar", "overflow-hidden", "elementor-widget-container", "commentary", "promotion", "shared-content", "md:hidden", "post widget", "with-banner", "content alert",
     "contact-page", "legal-news", "tags-page", "search-results-item", "page-menu-open", "mb-4 margin-bottom", "privacy-law"],
)
def test_wrappers_of_an_article_do_not_hide_it(wrapper):
    page = f'<body><nav><a href=x>One</a></nav><div class="{wrapper}"><h1>A heading of it</h1><p>{TEXT}</p><p>{TEXT}</p></div><footer>us</footer>'
    assert html_text.main_text(page, html_text.train()).endswith(f"{TEXT} {TEXT}")


@pytest.mark.parametrize(
    "other",
    ['article class="comment"', 'div class="comments"', 'div class="comment-content"', 'div class="sidebar2"', 'div class="related-posts"', 'div class="hidden"', 'aside class="content"', 'div id="cookie-notice"',
     'div id="discussion"', 'div class="responses"', 'div class="user-post"', 'div class="privacy"', 'div class="bottom"', 'div class="social-links"', 'div class="share-buttons"'],
)
def test_what_surrounds_an_article_stays_out(other):
    page = f'<body><div class="content"><h1>A heading of it</h1><p>{TEXT}</p></div><{other}><p>{"Other words of this. " * 8}</p></{other.split()[0]}>'
    assert html_text.main_text(page, html_text.train()) == f"A heading of it {TEXT}"


ARTICLE = f"<h1>A heading of it</h1><p>{TEXT}</p><p>{TEXT}</p>"


@pytest.mark.parametrize(
    "page",
    [
        f'<body><form id="aspnetForm" method=post><nav><a href=x>One</a></nav><div>{ARTICLE}</div><footer>us</footer></form>',
        f"<body><nav><a href=x>One</a></nav><form action=q><input name=q><article>{ARTICLE}</article><footer>us</footer>",
        f"<body><nav><button>Menu<a href=x>One</a></nav><article>{ARTICLE}</article>",
        f"<body><button>Menu<article>{ARTICLE}</article>",
        f"<body><select><option>One<option>Two<article>{ARTICLE}</article>",
        f"<body><form><p>Your name and your address, and what you would like to tell us about it</p><input></form><article>{ARTICLE}</article>",
        f"<body><article>{ARTICLE}<form><p>Write to us if you have something to say about this</p></form></article>",
        f'<body><article><b class="x">{ARTICLE}</article></b><footer>us</footer>',
    ],
)
def test_forms_and_what_is_left_open(page):
    assert html_text.main_text(page, html_text.train()) == f"A heading of it {TEXT} {TEXT}"


@pytest.mark.parametrize("wrapper", ["div", 'div class="content"', 'form id="aspnetForm"', 'div class="contact-page"'])
def test_articles_without_their_element(spark, wrapper):
    """Most texts stay whole where the pages of the table say ``article`` in no tag."""
    tree, same, total = html_text.train(), 0, 0
    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        page = r.html.replace("<article>", f"<{wrapper}>").replace("</article>", f"</{wrapper.split()[0]}>")
        same, total = same + (html_text.main_text(page, tree) == html_text.main_text(r.html, tree)), total + 1
    assert same >= 0.98 * total, f"{same} of {total}"


@pytest.mark.parametrize("page", ["<div class=x>" * 8_000 + "</b>" * 8_000, "<b class=x>" * 8_000 + "<p></p>" * 8_000, "<svg>" + "<p>" * 8_000 + "</a>" * 8_000])
def test_stray_tags_take_linear_time(page):
    start = time.process_time()
    html_text.blocks(page)
    assert time.process_time() - start < 1


def test_tree_learns_its_table():
    tree = html_text.train()
    right = total = 0
    for page in html_text.PAGES:
        found = [html_text.Block("", w, k, {"+": 1, "-": -1, ".": 0}[s[0]], "h" in s) for s, w, k, _ in page]
        for row, (*_, label) in zip(html_text.features(found), page):
            right, total = right + ((html_text.decide(tree, row) >= 0.5) == bool(label)), total + 1
    assert right / total > 0.95


def test_articles_of_a_table(spark):
    import html

    found = {r.page_id: r.text for r in QUERIES["op5_html_text"](spark, SMALL).collect()}
    table = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    assert len(found) == len(table)
    for r in table:
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        assert found[r.page_id] == " ".join(html.unescape(re.sub(r"<[^>]+>", " ", article.replace("<b>", "").replace("</b>", ""))).split())


def test_text_of_odd_rows(spark):
    data = pages(spark, [(1, "u", SITE, "", "", ""), (1, "u", SITE, "", "", ""), (None, None, None, "", "", ""), (2, "v", "<p>" + "long " * 100_000, "", "", "")])
    out = html_text.extract_text(data).collect()
    assert sorted(r.n_chars for r in out) == [0, *sorted([len(r.text) for r in out])[1:]] and len(out) == 4
    assert max(r.n_chars for r in out) == 5 * 100_000 - 1
    assert html_text.extract_text(pages(spark, [])).collect() == []


# Token counts

ODD = ["aaaa aaaaaaa", "<|endoftext|>x<|startoftext|><|endoftext|> y <|endoftext", "ΣΑΣ ΌΔΟΣ İ K ẞ ǅ", "don't I'LL we've 123 ４５ ①", "é 힣 👩‍👩‍👧 ​﻿", "\x1c a\x85b c\x00d", "日本語", "x" * 5000, "ab" * 3000]


def test_counts_match_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    given = [*sample_texts(), *((100 + i, t) for i, t in enumerate(ODD)), *((1000 + i, t) for i, t in table)]
    found = token_count.token_counts(documents(spark, given), path).collect()
    expected = [(i, len((t or "").encode()), n, n > 2048) for i, t in given for n in [len(library.encode(t or "", add_special_tokens=False).ids)]]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    kept = token_count.drop_over_limit(documents(spark, given), path, limit=20).collect()
    assert Counter(r.doc_id for r in kept) == Counter(i for i, _, n, _ in expected if n <= 20)
    assert token_count.token_counts(nothing(spark), path).collect() == []


def test_forgetting_words_changes_nothing(monkeypatch):
    import public_tokenizers

    table = token_count.MergeTable(public_tokenizers.path("word_bpe_49k.json"))
    texts = [t or "" for _, t in sample_texts()]
    expected = token_count.Counting(table).count(texts)
    monkeypatch.setattr(token_count, "REMEMBERED", 1)
    counting = token_count.Counting(table)
    assert [counting.count([t])[0] for t in texts] == expected


def test_memory_is_bounded_by_characters():
    import public_tokenizers

    counting = token_count.Counting(token_count.MergeTable(public_tokenizers.path("word_bpe_49k.json")))
    text = "\n".join("日本語の文章" * (10 + i % 90) for i in range(2_000))  # over a million characters without a blank
    assert len(text) > 500_000 and counting.count([text, "a b", text])[0] == counting.count([text])[0]
    assert set(counting.known) == {"a", "b"} and counting.held == 2


# Mixing


def brute_force_targets(sizes, weights=(3.0, 1.0, 2.0), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        rate = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * rate > most * sizes[s]}
        if not above:
            return out | {s: weight[s] * rate for s in open_}
        out |= {s: float(most * sizes[s]) for s in above}
        left, open_ = left - sum(out[s] for s in above), open_ - above
    return out


@pytest.mark.parametrize("block,fan", [(mixing.BLOCK, mixing.FAN_IN), (5, 2)])
def test_mix_comes_near_its_targets(spark, block, fan):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").union(
        spark.createDataFrame([(10_000 + i, None if i % 2 else "a b c", "en", None, 0) for i in range(8)] + [(20_000, " ", "en", "none", 0)], "a long, b string, c string, d string, e long")
    )
    found = mixing.mix(docs, block=block, fan_in=fan).collect()
    source = {r.doc_id: (r.source, len([w for w in re.split(r"[\x20\x09-\x0D]+", r.text or "") if w])) for r in docs.collect()}
    sizes = Counter()
    for s, n in source.values():
        sizes[s] += n
    expected = brute_force_targets(dict(sizes))
    taken, largest = Counter(), Counter()
    for r in found:
        s, n = source[r.doc_id]
        assert (r.size, r.source_size) == (n, sizes[s]) and r.target == pytest.approx(expected[s])
        assert r.taken == r.copies * r.size and r.copies in (0, 1, 2)
        assert not sizes[s] or r.copies in (math.floor(expected[s] / sizes[s]), math.ceil(expected[s] / sizes[s])) or not n
        taken[s] += r.taken
        largest[s] = max(largest[s], n)
    assert len(found) == len(source)
    assert all(abs(taken[s] - expected[s]) <= largest[s] + 1e-6 for s in sizes)
    again = mixing.mix(docs.repartition(7), block=block, fan_in=fan)
    assert rows(again) == sorted(rows(mixing.mix(docs, block=block, fan_in=fan)), key=repr)


def test_rounding_keeps_expectations(spark):
    docs = documents(spark, [(i, "w " * (1 + i % 7)) for i in range(300)])
    mean = Counter()
    for seed in range(6):
        for r in mixing.mix(docs, seed=seed, block=20, fan_in=3).collect():
            mean[r.target / r.source_size] += (r.copies - r.target / r.source_size) / 6
    assert all(abs(v) < 20 for v in mean.values())


def test_mix_of_odd_rows(spark):
    docs = documents(spark)
    found = mixing.mix(docs).collect()
    assert len(found) == len(sample_texts())
    out = mixing.take_mix(docs)
    assert out.columns == [*docs.columns, "copy_"] and sum(r.copies for r in found) == out.count()
    assert mixing.mix(nothing(spark)).collect() == [] and mixing.take_mix(nothing(spark)).collect() == []
