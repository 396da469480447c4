"""Each operator against a brute-force version, and on rows with nulls, repeats, long texts and clashing columns."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from tidemark.llm import (
    components,
    exact_topk,
    html_text,
    mixing,
    packing,
    quality_model,
    quality_rules,
    shards,
    simhash_dedup,
    token_counts,
    token_shards,
)
from tidemark.llm.byte_tokens import Encoder
from tidemark.llm.common import on_workers, tokenizer
from tidemark.session import fresh_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, slot int, size string, number int, row long"

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
TEXTS = [
    None, "", " \t\n", "one", "Two words", "Two words", "three little words", "THREE little WORDS here now",
    "don't  we'll I'M <|endoftext|> done <|startoftext|>", "café CAFÉ İstanbul ΣΣΣ naïve 123 4.5", "a b\u0085c\x1cd e",
    "中文 text \U0001F600\U0001F600 emoji", "line one\nline two\nline one\n\n \nline one", "x" * 5000, " " * 3000 + "y",
    "A!! B!! C!! D!! " * 30, "same eight words again and again and on " * 20, LONG, LONG + " more", "rep " * 4000,
]


def rows():
    """Every text, with repeats, null ids and null sources."""
    out = []
    for i, text in enumerate(TEXTS):
        source = [None, "b", "a", "é"][i % 4]
        out.append((i * 3, text, "en", source, None, "clash", 7, "clash", 9, i))
        if i % 5 == 0:
            out.append((i * 3, text, "en", source, None, None, 7, None, 9, i))
        if i % 7 == 0:
            out.append((None, text, None, source, 3, "clash", None, "clash", None, None))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    on_workers(spark)
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return on_workers(spark).createDataFrame([], SCHEMA)


def given(docs):
    return [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]


# clashing columns


def test_columns_that_repeat_or_differ_by_case(spark, docs):
    """What each operator reads is taken by place, so twins of its columns do no harm."""
    given_docs = docs.select("doc_id", "text", "source", "lang", "n_chars")
    twins = given_docs.toDF("doc_id", "text", "source", "lang", "n_chars").select(
        "*", F.lit("x").alias("TEXT"), F.lit("y").alias("row"), F.lit(1).alias("Doc_Id"), F.lit("z").alias("text"))
    n = docs.count()
    assert token_counts.count_tokens(twins).count() == n
    assert shards.digest(shards.shard_documents(twins)).select("text_crc32").subtract(
        docs.select(F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("c"))).count() == 0
    judged = quality_rules.judge(twins)
    assert judged.count() == n and {"doc_id", "text", "TEXT_5", "Doc_Id_7", "text_8"} <= set(judged.select("record.*").columns)
    once = simhash_dedup.keep_one(docs.select("doc_id", "text", "source"))
    assert Counter(r["doc_id"] for r in simhash_dedup.keep_one(twins).select("doc_id").collect()) == Counter(
        r["doc_id"] for r in once.select("doc_id").collect())
    assert simhash_dedup.near_duplicates(twins).count() == n
    assert mixing.mix(twins).count() == n
    assert packing.pack_documents(twins).select("doc_id", "doc_tokens").count() >= n
    assert token_shards.digest(spark, token_shards.write_shards(twins)).select("doc_id", "start").count() >= n
    labels = spark.createDataFrame([(3, 1), (6, 0)], "doc_id long, quality int")
    assert quality_model.classify(twins, labels).count() == n


# 1 token counts


def test_token_counts(docs, empty):
    library = tokenizer(token_counts.VOCABULARY)
    expected = Counter(
        (d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t, _ in given(docs)
    )
    for parts in (1, 50, 1 << 20):  # from no heavy pre-token to all
        got = token_counts.count_tokens(docs, heavy_parts=parts).collect()
        assert Counter(tuple(r) for r in got) == expected
    assert token_counts.count_tokens(empty).count() == 0


def test_token_counts_on_given_table(spark):
    docs = on_workers(spark).read.parquet("/root/testdata/sf0.001/documents.parquet")
    library = tokenizer(token_counts.VOCABULARY)
    expected = {r["doc_id"]: len(library.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs).collect()} == expected


# 2 html


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1><nav><ul><li><a href="/">Menu</a></li></ul></nav></header><div id="cookie-notice">We use cookies.</div>
%s<aside class="sidebar"><p>Side text of some length that is not the article at all.</p></aside><div class="ad">Buy!</div>
<section class="comments"><h3>Comments</h3><p>Reader: great article, I liked it a lot, really.</p></section><footer>&copy; us</footer></body></html>"""
BODY = """<h1>Title &amp; more</h1><p>First   paragraph,\n with <b>bold</b> text<br>and a break, quite long in all.
<p>On.</p><ul><li>one<li>two</ul><div class="advert">Buy this</div><form><label>Mail</label></form><blockquote><p>Quote &lt;here&gt;</p></blockquote>"""
TEXT = "Title & more\nFirst paragraph, with bold text and a break, quite long in all.\nOn.\none\ntwo\nQuote <here>"


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main><article class='post'>%s</article></main>", "<div class='content'>%s</div>", "<main>%s</main>", "<div role='main'>%s</div>"])
def test_main_text(wrap):
    assert html_text.main_text(PAGE % (wrap % BODY)) == TEXT


def test_main_text_edges():
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<nav>menu</nav>") == ""
    assert html_text.main_text("plain") == "plain"
    assert html_text.main_text("<article><p><b>Short.<br></article>") == "Short."
    assert html_text.main_text("<p" * 10 + "<div>" * 50_000 + "deep") == "deep"
    assert html_text.main_text("<p>end</p>" + "<a <a " * 20_000) == "end"  # a tag broken off takes no time
    assert html_text.main_text("<article>" + "<p>ab cd</p>" * 20_000 + "</article>") == "\n".join(["ab cd"] * 20_000)


@pytest.mark.parametrize("wrap", [
    "<div class='site-inner'><div class='content-sidebar-wrap'><main>%s</main></div></div>",
    "<div><div class='right-sidebar'><article>%s</article></div></div>",
    "<article class='post category-social tag-newsletter'>%s</article>",
    "<form id='aspnetForm'><div><article>%s</article></div></form>",
    "<form><div class='content-sidebar-wrap'><main class='promo'><article class='tag-ads'>%s</article></main></div></form>",
    "<main><div class='content-sidebar-wrap'><article>%s</article></div></main>",
    "<div id='page' class='comments-closed'><article>%s</article></div>",
])
def test_main_text_inside_what_names_or_forms_drop(wrap):
    assert html_text.main_text(PAGE % (wrap % BODY)) == TEXT


@pytest.mark.parametrize("other", [
    "<div><div id='comments'><article class='comment-body'><p>%s</p></article></div></div>",
    "<div><div class='related'><article><p>%s</p></article></div></div>", "<div><article class='comment'><p>%s</p></article></div>",
])
@pytest.mark.parametrize("wrap", ["<article>%s%s</article>", "<article>%s</article>%s", "<main>%s%s</main>", "<div><div class='content'>%s</div>%s</div>"])
def test_other_articles_are_not_the_main_text(wrap, other):
    assert html_text.main_text(PAGE % (wrap % (BODY, other % "Not the article itself."))) == TEXT


def test_main_text_keeps_what_main_holds_around_an_article():
    page = "<main><h1>T</h1><p>intro</p><article><p>%s</p></article><article><p>second</p></article><div class='ad'>Buy</div><p>end</p></main>" % ("text " * 50)
    assert html_text.main_text(PAGE % page).split("\n") == ["T", "intro", ("text " * 50).strip(), "second", "end"]


def test_main_text_of_blocks_in_the_body():
    """The clusters only locate the text: short blocks before and after them are kept."""
    long = ("long paragraph of the text " * 20).strip()
    before = ["Title", "By them", "intro"]
    after = ["So", "it is", "one", "two", "Notes", "short", "end"]
    body = "<h1>Title</h1><p>By <b>them</b></p><p>intro</p>" + f"<p>{long}</p>" * 3
    body += "<p>So</p><p><i>it is</i></p><ul><li>one<li>two</ul><h2>Notes</h2><p>short</p><div class='ad'>Buy</div><p>end</p>"
    assert html_text.main_text(PAGE % body).split("\n") == before + [long] * 3 + after


def test_dropped_inline_elements_go_alone():
    body = """<article><a class='share'>Share</a><p>Text <span class='advert'>Buy</span> more</p><p>long text <span class='share'>x</p>
    <p>a <small hidden>b</small><b>c</b></p><span class='ad'>Buy</span></article>"""
    assert html_text.main_text(PAGE % body) == "Text more\nlong text\na c"


LONG_LINE = "A sentence of the article that goes on for quite a while, as those do. "


@pytest.mark.parametrize("inside, kept", [
    ('<h2 id="discussion">Discussion</h2><p>%s</p>', "Discussion"), ('<h2 id="navigation">Navigation</h2><p>%s</p>', "Navigation"),
    ('<section id="discussion"><p>%s</p><p>So.</p></section>', "So."), ('<section id="related-work"><h2>Related work</h2><p>%s</p></section>', "Related work"),
    ('<p>At <span class="share-price">42</span> a piece.</p><p>%s</p>', "At 42 a piece."),
    ('<p class="social-science">Of people.</p><p>%s</p>', "Of people."), ('<div role="note"><p>%s</p></div><p>End.</p>', "End."),
    ('<div class="notice"><p>%s</p></div><p>End.</p>', "End."),
])
def test_names_made_from_headings_do_not_drop_text(inside, kept):
    text = (LONG_LINE * 4).strip()
    body = f"<article><h1>T</h1><p>{text}</p>{inside % text}<p>{text}</p></article>"
    got = html_text.main_text(PAGE % body).split("\n")
    assert kept in got and got.count(text) == 3


def test_doubtful_names_drop_what_is_in_no_cluster():
    text = (LONG_LINE * 4).strip()
    note = "<div class='social'>" + "".join(f"<p><a href='/{i}'><b>x{i}</b></a></p>" for i in range(9)) + "</div>"
    assert html_text.main_text(PAGE % f"<article><p>{text}</p><p>{text}</p>{note}</article>") == f"{text}\n{text}"


MISLEADING = [
    # teasers are marked as articles, the text is not
    "<div class='story'>%s</div><article><a href='/1'><b>One</b> <i>more</i></a></article>" + "".join(
        f"<article><h3><a href='/{i}'><b>Read</b> <i>this</i> <u>next</u> <em>one</em> {i}</a></h3></article>" for i in range(40)),
    # the main element holds a list of links only
    "<div class='story'>%s</div><main>" + "".join(
        f"<p><a href='/{i}'><b>a</b><i>short</i><u>link</u></a> <a href='/x'><b>and</b></a> <a href='/y'>one</a> {i}</p>" for i in range(60)) + "</main>",
]


@pytest.mark.parametrize("page", MISLEADING)
def test_the_clusters_choose_the_region(page):
    text = [(LONG_LINE * n).strip() for n in (3, 4, 3, 5)]
    assert html_text.main_text(PAGE % (page % "".join(f"<p>{t}</p>" for t in text))).split("\n") == text


def test_without_smoothing_and_threshold_other_regions_are_chosen(monkeypatch):
    """Where a region is marked wrongly or not at all the clusters decide; given pages mark theirs rightly."""
    text = "".join(f"<p>{(LONG_LINE * n).strip()}</p>" for n in (2, 2))
    cards = "".join(f"<p><a href='/{i}'><b>a</b><i>rather</i><u>short</u></a> <a href='/x'><b>teaser</b></a> {i}</p>" for i in range(30))
    unmarked = "".join(f"<div>{i} <a href='/{i}'>x</a></div>" for i in range(8)) + f"<div><p>{(LONG_LINE * 6).strip()}</p><p>{(LONG_LINE * 5).strip()}</p></div>"
    unmarked += "<div>-</div>" * 4 + cards.replace("<p>", "<div>").replace("</p>", "</div>")
    pages = [PAGE % f"<div class='story'>{text}</div><main>{cards}</main>", PAGE % unmarked]
    with_clusters = [html_text.main_text(p) for p in pages]
    assert all(LONG_LINE.strip() in t and "teaser" not in t for t in with_clusters)
    monkeypatch.setattr(html_text, "_clustered", lambda lines: (np.array([len(x[0]) for x in lines], float), np.ones(len(lines), bool)))
    assert all("teaser" in html_text.main_text(p) for p in pages)


def test_extract(spark):
    pages = spark.createDataFrame(
        [(1, None, None, "x"), (None, "u", PAGE % f"<article>{BODY}</article>", None), (1, None, None, "x")],
        "page_id long, url string, html string, text string",
    )
    got = html_text.extract(pages).collect()
    assert Counter(tuple(r) for r in got) == Counter([(1, None, "", 0)] * 2 + [(None, "u", TEXT, len(TEXT))])
    assert html_text.extract(pages.limit(0)).count() == 0


def test_extract_given_pages(spark):
    """The given pages mark their article; its blocks are cut out by pattern."""
    import html

    pages = on_workers(spark).read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        blocks = re.split("</?(?:p|h1)>", re.search("<article>(.*?)</article>", r["html"], re.S).group(1))
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks]
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)


# 3 simhash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                root[find(b)] = find(a)
    return {n: find(n) for n in nodes}


def check_near_duplicates(docs):
    expected, members = [], defaultdict(list)
    fps = {t: brute_fingerprint(t) for _, t, _ in given(docs)}
    root = brute_components(sorted(set(fps.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    for d, t, _ in given(docs):
        members[root[fps[t]]].append(d)
    for d, t, _ in given(docs):
        ids = [m for m in members[root[fps[t]]] if m is not None]
        expected.append((d, fps[t], min(ids, default=None)))
    got = simhash_dedup.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got) == Counter(expected)
    return members


def test_simhash(docs, empty):
    members = check_near_duplicates(docs)
    assert simhash_dedup.near_duplicates(empty).count() == 0
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    left = kept.collect()
    assert len(left) == len(members)
    assert simhash_dedup.keep_one(empty).count() == 0


def test_simhash_on_given_table(spark):
    check_near_duplicates(on_workers(spark).read.parquet("/root/testdata/sf0.001/documents.parquet"))


@pytest.mark.parametrize("distance", [1, 2, 3, 4])
@pytest.mark.parametrize("direct", [1024, 4])
def test_links_lose_no_pair(spark, monkeypatch, distance, direct):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64)
    near = [int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for c in centres for _ in range(25)]
    fps = sorted({*near, 0, 1, 3, 7, 2**64 - 1, 2**64 - 2})
    monkeypatch.setattr(simhash_dedup, "DIRECT", direct)

    def batches(f, *arrays):
        import pyarrow as pa

        names, columns = zip(*arrays)
        columns = [np.array(c, np.uint64).view(np.int64) for c in columns]
        for i in range(0, len(columns[0]), 37):
            yield from f(iter([pa.RecordBatch.from_arrays([pa.array(c[i : i + 37]) for c in columns], list(names))]))

    cells = []
    for b in batches(lambda x: simhash_dedup._to_grid(x, 4, -(-distance // 2)), ("fp", fps)):
        cells += zip(b.column("cell").to_pylist(), b.column("fp").to_pylist())
    cells.sort()
    import pyarrow as pa

    table = pa.table([pa.array([c for c, _ in cells]), pa.array([f for _, f in cells])], names=["cell", "fp"])
    links = [(a % 2**64, b % 2**64) for out in simhash_dedup._links(iter(table.to_batches(max_chunksize=50)), distance) for a, b in zip(*(out.column(c).to_pylist() for c in "ab"))]
    linked = {frozenset(x) for x in links}
    got = brute_components(fps, lambda a, b: frozenset((a, b)) in linked)
    expected = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= distance)

    def groups(roots):
        out = defaultdict(set)
        for n, r in roots.items():
            out[r].add(n)
        return sorted(map(sorted, out.values()))

    assert groups(got) == groups(expected)


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(200, int(x)) for x in range(201, 260)] + [(int(a), int(b)) for a, b in rng.integers(300, 400, (70, 2))]
    nodes = sorted({n for e in edges for n in e})
    both = {frozenset(e) for e in edges}
    expected = brute_components(nodes, lambda a, b: frozenset((a, b)) in both)
    least = {}
    for n, r in expected.items():
        least[r] = min(least.get(r, n), n)
    got = {r["node"]: r["root"] for r in components.roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {n: got.get(n, n) for n in nodes} == {n: least[expected[n]] for n in nodes}
    assert components.roots(spark.createDataFrame([], "a long, b long")).count() == 0


# 4 sharding


def test_shards(docs, empty):
    sharded = shards.shard_documents(docs)
    got = shards.digest(sharded).collect()
    data = [(t or "").encode() for _, t, _ in given(docs)]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (d, len(b) + 1, zlib.crc32(b)) for (d, _, _), b in zip(given(docs), data)
    )
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append(r["slot"])
    counts = [len(by_shard[s]) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}
    assert shards.shard_documents(empty).count() == 0


def test_shards_are_shuffled(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    got = shards.digest(shards.shard_documents(docs)).toPandas().sort_values(["shard", "slot"])
    order = got["doc_id"].to_numpy()
    assert abs(np.corrcoef(order, np.arange(4000))[0, 1]) < 0.1
    assert (np.abs(np.diff(order)) == 1).mean() < 0.02


# 5 quality rules


def brute_statistics(text):
    words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def brute_votes(text):
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words = brute_statistics(text)
    values = {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat_words, "n_lines": len([x for x in (text or "").split("\n") if WORD.search(x)]),
        "n_capitals": sum(c.isupper() for c in text or ""), "n_shouts": (text or "").count("!"), "greatest": max, "abs": abs,
    }
    votes = {}
    for rule, (value, keep, reject) in quality_rules.RULES.items():
        x = eval(value, {}, values)  # the rules' formulas are plain arithmetic
        votes[rule] = 1 if x <= keep else -1 if x > reject else 0
    return votes, n_words < 20 or 100 * n_repeat_words > 30 * n_words


def brute_kept(texts):
    """Expectation-maximisation over single documents."""
    votes = [brute_votes(t) for t in texts]
    prior, rates = quality_rules.PRIOR, {r: (quality_rules.GOOD, quality_rules.BAD) for r in quality_rules.RULES}

    def posterior(v):
        odds = math.log(prior / (1 - prior)) + sum(math.log(rates[r][0][x] / rates[r][1][x]) for r, x in v.items())
        return 1 / (1 + math.exp(-odds))

    for _ in range(quality_rules.ROUNDS):
        good = [(v, posterior(v)) for v, failed in votes if not failed]
        if not good:
            break
        n, g, s = len(good), sum(p for _, p in good), quality_rules.SMOOTH
        rates = {
            r: tuple(
                {x: (sum(w for w, v in side if v[r] == x) + s * before[x]) / (total + s) for x in (1, -1, 0)}
                for side, total, before in (([(p, v) for v, p in good], g, quality_rules.GOOD), ([(1 - p, v) for v, p in good], n - g, quality_rules.BAD))
            )
            for r in quality_rules.RULES
        }
        prior = (g + s * quality_rules.PRIOR) / (n + s)
    return [not failed and posterior(v) >= quality_rules.KEEP for v, failed in votes]


def check_rules(docs):
    got = quality_rules.judge(docs).select("record.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    texts = [t for _, t, _ in given(docs)]
    expected = Counter()
    for (d, t, _), kept in zip(given(docs), brute_kept(texts)):
        expected[d, *brute_statistics(t), brute_votes(t)[1], kept] += 1
    assert Counter(tuple(r) for r in got) == expected


def test_quality_rules(docs, empty):
    check_rules(docs)
    assert quality_rules.judge(empty).count() == 0


def test_quality_rules_on_given_table(spark):
    check_rules(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_quality_rules_run_no_python(docs):
    plan = quality_rules.judge(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# 6 exact top-k


def brute_top_k(vectors, k=5):
    """``vectors`` are rows (id, vector): every other row is a candidate, and each row of a query's id has its own k."""
    out = []
    for a, (q, x) in enumerate(vectors):
        if q % 50 == 0:
            scores = sorted((-sum(s * t for s, t in zip(x, y)), v) for b, (v, y) in enumerate(vectors) if b != a)
            out += [(q, i + 1, v, -s) for i, (s, v) in enumerate(scores[:k])]
    return Counter(out)


@pytest.mark.parametrize("block, pack", [(1 << 16, 1 << 12), (40, 2)])
def test_top_k(spark, block, pack):
    rng = np.random.default_rng(2)
    sound = {i: [float(x) for x in rng.normal(0, rng.choice([0.1, 1, 3]), 9)] for i in range(400)}
    sound |= {i: sound[i - 400] for i in range(400, 460)}  # ties
    sound |= {500: [0.0] * 9, 550: [1.0, 2.0], 600: [-0.001] * 9}
    rows = [*sound.items(), (50, sound[50]), (50, sound[50]), (7, sound[7])]  # repeated rows are rows
    broken = [(700, None), (650, [1.0, None]), (701, [float("nan")] * 9), (702, [float("inf")] * 9), (703, []), (None, [1.0] * 9)]
    df = on_workers(spark).createDataFrame([(i, v, "x", 1) for i, v in [*rows, *broken]], "vec_id long, embedding array<double>, block string, score int")
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    got = exact_topk.top_k(df.repartition(5), block=block, pack=pack).collect()
    assert Counter(tuple(r) for r in got) == brute_top_k(whole)
    assert exact_topk.top_k(df.limit(0)).count() == 0


def test_each_row_of_an_id_has_its_own_result(spark):
    rows = [(50, [1.0, 0.0]), (50, [1.0, 0.0]), (50, [2.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])]
    df = on_workers(spark).createDataFrame(rows, "vec_id long, embedding array<double>")
    got = exact_topk.top_k(df).collect()
    assert len(got) == 15 and Counter(tuple(r) for r in got) == brute_top_k([(i, [256 * int(x) for x in v]) for i, v in rows])


def test_top_k_against_its_sql_with_repeated_ids(spark, tmp_path):
    import duckdb

    from tidemark.llm.oracles import TOPK

    rng = np.random.default_rng(9)
    rows = [(int(i) % 90, [float(x) for x in rng.normal(0, 1, 5)]) for i in range(200)]
    rows += rows[::7]
    on_workers(spark).createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "e"))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/e/*.parquet'")
    expected = Counter(duck.execute(TOPK).fetchall())
    assert Counter(tuple(r) for r in exact_topk.top_k(spark.read.parquet(str(tmp_path / "e")), block=30, pack=4).collect()) == expected


@pytest.mark.parametrize("block, pack", [(1 << 16, 1 << 12), (20, 3)])
def test_top_k_keeps_every_vector_of_an_id(spark, block, pack):
    """Against a join of all rows; ids repeat with other vectors, among queries and candidates."""
    rng = np.random.default_rng(5)
    rows = [(i % 130, [float(x) for x in rng.normal(0, rng.choice([0.1, 1, 3]), 6)]) for i in range(400)]
    rows += [(50, [float(x) for x in rng.normal(0, 1, 6)]) for _ in range(60)]
    expected = brute_top_k([(i, [math.floor(256 * x) for x in v]) for i, v in rows])
    df = on_workers(spark).createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert Counter(tuple(r) for r in exact_topk.top_k(df, block=block, pack=pack).collect()) == expected


def test_queries_are_pruned_before_they_move(spark, monkeypatch):
    """Few vectors are long: the many short ones are sent few queries, in several copies of a block."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 2.0 ** -(i % 12), 8)]) for i in range(3000)]
    df = on_workers(spark).createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    sent, search = [], exact_topk._search

    def counted(blocks, queries, splits, *rest):
        vectors = sum(splits.get(r["block"], 0) * r["count"] for r in blocks.groupBy("block").count().collect())
        sent.append((queries.count(), vectors, sum(splits.values())))
        return search(blocks, queries, splits, *rest)

    monkeypatch.setattr(exact_topk, "_search", counted)
    got = exact_topk.top_k(df, block=100, pack=10).collect()
    assert Counter(tuple(r) for r in got) == brute_top_k([(i, [math.floor(256 * x) for x in v]) for i, v in rows])
    queries, vectors, tasks = sent[1]
    assert queries < 60 * 29 / 2 and vectors < 3000 * 6 / 2 and tasks > 10


def test_top_k_of_huge_components(spark):
    vectors = {i * 25: [float((i * 7919) % 101) * 1e12, float(i % 3) * 1e11] for i in range(30)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    scale = 2.0**-16
    got = exact_topk.top_k(df, scale=scale).collect()
    assert Counter(tuple(r) for r in got) == brute_top_k([(i, [math.floor(scale * x) for x in v]) for i, v in vectors.items()])


# 7 token shards


def plain_feistel(number, count, key=token_shards.KEY):
    """One number through the network, in plain integers."""
    low = (1 << 64) - 1

    def mixed(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & low
        x = (x ^ x >> 27) * 0x94D049BB133111EB & low
        return x ^ x >> 31

    half = 1
    while 1 << 2 * half < count:
        half += 1
    while True:
        left, right = number >> half, number % (1 << half)
        for i in range(1, token_shards.ROUNDS + 1):
            left, right = right, left ^ mixed((right + mixed((i * 0x9E3779B97F4A7C15 + key) & low)) & low) % (1 << half)
        number = left << half | right
        if number < count:
            return number


def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        slots = token_shards.feistel(np.arange(n), n)
        assert slots.tolist() == [plain_feistel(i, n) for i in range(n)]
        assert sorted(slots.tolist()) == list(range(n))
    assert token_shards.feistel(np.arange(1000), 1000, key=1).tolist() != token_shards.feistel(np.arange(1000), 1000, key=2).tolist()


def test_token_shards(spark, docs, empty):
    """Ids by the library, slots by plain integers, files by their bytes."""
    import os

    path = token_shards.write_shards(docs, records=64)
    got = token_shards.digest(spark, path, records=64).collect()
    library, expected, bodies = tokenizer(token_shards.VOCABULARY), Counter(), Counter()
    for d, t, _ in given(docs):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, token_shards.END]).astype("<u2")
        for s in range(0, len(ids), 512):
            piece = ids[s : s + 512]
            record = np.full(512, token_shards.PAD, "<u2")
            record[: len(piece)] = piece
            expected[d, s, len(piece), zlib.crc32(record.tobytes())] += 1
            bodies[record.tobytes()] += 1
    assert Counter((r["doc_id"], r["start"], r["n_tokens"], r["record_crc32"]) for r in got) == expected
    assert sorted(r["slot"] for r in got) == list(range(len(got)))
    assert all(r["slot"] == r["shard"] * 64 + r["record"] for r in got)
    # a file a shard: frames of 256 records of one stride, then their places
    size = 25 + 2 * 512
    assert token_shards.stride() == size
    files = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.startswith("part-"):
                assert files.setdefault(int(folder.rsplit("shard=")[-1]), f"{folder}/{name}") == f"{folder}/{name}"
    assert sorted(files) == list(range(-(-len(got) // 64)))
    by_slot = {r["slot"]: r for r in got}
    seen = Counter()
    for shard, name in files.items():
        data = open(name, "rb").read()
        frames = int.from_bytes(data[-5:-1], "little")
        places = [int.from_bytes(data[len(data) - 5 - 4 * i :][:4], "little") for i in range(frames + 1, 0, -1)]
        records = b"".join(zstandard.ZstdDecompressor().decompress(data[a : b - 1]) for a, b in zip(places, places[1:]))
        assert len(records) == size * sum(r["shard"] == shard for r in got)
        for k in range(len(records) // size):
            body = records[k * size + 25 : (k + 1) * size]
            assert zlib.crc32(body) == by_slot[shard * 64 + k]["record_crc32"]
            seen[body] += 1
    assert seen == bodies
    read = list(token_shards.read_from(spark, path, 50, 40, records=64))
    assert [s for s, _ in read] == list(range(50, 90))
    assert [zlib.crc32(ids) for _, ids in read] == [by_slot[s]["record_crc32"] for s in range(50, 90)]
    assert len(list(token_shards.read_from(spark, path, len(got) - 3, 40, records=64))) == 3
    assert list(token_shards.read_from(spark, path, len(got) + 100, 2, records=64)) == []
    assert token_shards.digest(spark, token_shards.write_shards(empty)).count() == 0


def test_reading_on_at_any_slot(spark, docs, monkeypatch):
    """Several frames a shard; reading from anywhere gives what reading from the start does."""
    monkeypatch.setattr(token_shards, "FRAME", 5)
    path = fresh_path(spark, "frames")
    parts = []

    def frames(index, body):
        parts.append(list(real(index, body)))
        return iter(parts[-1])

    real = token_shards._frames
    count, records = 103, 20
    body = np.arange(count * 512, dtype="<u2").reshape(count, 512)
    rows = []
    for shard in range(6):
        part = body[shard * records : (shard + 1) * records]
        index = np.zeros(len(part), token_shards.HEADER)
        index["record"], index["n_tokens"] = np.arange(len(part)), 512
        rows += [(shard, i, r) for i, r in enumerate(frames(index, part))]
    df = spark.createDataFrame(rows, "shard long, row long, value binary").repartitionById(6, F.col("shard").cast("int"))
    df.sortWithinPartitions("shard", "row").select("shard", F.col("value").cast("string").alias("value")).write.partitionBy("shard").text(path)
    whole = list(token_shards.read_from(spark, path, 0, 1000, records=records))
    assert [s for s, _ in whole] == list(range(count)) and b"".join(b for _, b in whole) == body.tobytes()
    for start, n in ((0, 1), (4, 2), (19, 3), (20, 20), (37, 50), (102, 5), (103, 1), (250, 1)):
        assert list(token_shards.read_from(spark, path, start, n, records=records)) == whole[start : start + n]


def test_slots_of_numbered_sequences(spark, docs):
    """The order in the files is the permutation of the numbers the sequences were given."""
    path = token_shards.write_shards(docs.coalesce(1), records=32)
    got = sorted(token_shards.digest(spark, path, records=32).collect(), key=lambda r: r["slot"])
    library = tokenizer(token_shards.VOCABULARY)
    pieces = []
    for d, t, _ in given(docs.coalesce(1)):
        n = len(library.encode(t or "", add_special_tokens=False).ids) + 1
        pieces += [(d, s) for s in range(0, n, 512)]
    assert [(r["doc_id"], r["start"]) for r in got] == [
        pieces[i] for i in sorted(range(len(pieces)), key=lambda i: plain_feistel(i, len(pieces)))]


# 8 packing


def check_packing(docs, **options):
    library, expected = tokenizer(packing.VOCABULARY), Counter()
    ids = {t: [*library.encode(t or "", add_special_tokens=False).ids, 1] for _, t, _ in given(docs)}
    got = packing.pack_documents(docs, **options).collect()
    crcs = Counter()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= 2048
    for d, t, _ in given(docs):
        expected[d] += len(ids[t])
    assert Counter({d: sum(r["length"] for r in v) for d, v in by_doc.items()}) == expected
    texts = defaultdict(set)
    for d, t, _ in given(docs):
        texts[d].add(t)
    for d, pieces in by_doc.items():
        if len(texts[d]) == 1:
            (t,) = texts[d]
            for r in pieces:
                part = np.array(ids[t][r["start"] : r["start"] + r["length"]], "<u4")
                assert (r["doc_tokens"], r["ids_crc32"]) == (len(ids[t]), zlib.crc32(part.tobytes()))
    return by_sequence


def test_packing(docs, empty):
    check_packing(docs)
    check_packing(docs, group=5000)
    assert packing.pack_documents(empty).count() == 0


def test_packing_on_given_table(spark):
    docs = on_workers(spark).read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(1)
    filled = check_packing(docs)
    assert sum(2048 - sum(n for _, n in p) for p in filled.values()) < 2048  # one group pads less than a sequence


def test_pack_balances_cost():
    rng = np.random.default_rng(1)
    lengths = [int(x) for x in rng.lognormal(5, 1, 3000)] + [7000, 1, 2048]
    got = list(packing.pack(lengths))
    full, costs, used = Counter(), Counter(), Counter()
    for i, _, n, sequence, _ in got:
        used[i] += n
        full[sequence] += n
        costs[sequence] += packing.cost(n)
    assert used == Counter(dict(enumerate(lengths)))
    assert sum(2048 - n for n in full.values()) < 2048
    mixed = [costs[s] for s in costs if sum(1 for x in got if x[3] == s) > 1]
    assert np.std(mixed) < 0.1 * np.mean(mixed)


# 9 mixing


def brute_targets(sizes):
    """Clamps and reshares round by round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    budget, free, target = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        level = (budget - sum(target.values())) / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not above:
            return target | {s: weight[s] * level for s in free}
        target |= {s: 2.0 * sizes[s] for s in above}
        free -= above
    return target


def check_mixing(docs):
    sizes = Counter()
    for _, t, s in given(docs):
        sizes[s] += len(WORD.findall(t or ""))
    targets = brute_targets(sizes)
    got = mixing.mix(docs).collect()
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert taken[s] == pytest.approx(targets[s], abs=1.01)
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter(
        (d, s, len(WORD.findall(t or ""))) for d, t, s in given(docs)
    )
    return got, taken


def test_mixing(docs, empty):
    got, taken = check_mixing(docs)
    again = mixing.mix(docs.repartition(5)).collect()
    key = ["doc_id", "source", "size", "taken"]
    assert Counter(tuple(r[k] for k in key) for r in got) == Counter(tuple(r[k] for k in key) for r in again)
    mixed = mixing.mixed_documents(docs).collect()
    words = Counter()
    for r in mixed:
        words[r["source"]] += len(WORD.findall(r["text"] or ""))
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in taken.items() if n}
    assert mixing.mix(empty).count() == mixing.mixed_documents(empty).count() == 0


def test_mixing_on_given_table(spark):
    check_mixing(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_mixing_spreads_a_hot_id(spark, monkeypatch):
    """Rows of one id and size meet in small cells, in the order of one running sum over all."""
    monkeypatch.setattr(mixing, "CELL_BITS", 3, raising=False)
    rows = [(7 if i % 3 else None if i % 2 else i, "w " * (i % 4), "ab"[i % 7 > 2]) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got, _ = check_mixing(docs)
    for source in "ab":
        mine = [r for r in got if r["source"] == source]
        more, at, expected = int(mine[0]["target"]) - mine[0]["whole"] * mine[0]["source_size"], 0, Counter()
        for _, d, n in sorted((hashlib.md5(f"42:{'' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest(), r["doc_id"] or 0, r["size"]) for r in mine):
            expected[d, n, max(0, min(n, more - at))] += 1
            at += n
        assert Counter((r["doc_id"] or 0, r["size"], r["extra"]) for r in mine) == expected
    windows = re.findall(r"windowspecdefinition\((.*?)specifiedwindowframe", mixing.mix(docs)._jdf.queryExecution().optimizedPlan().toString())
    assert any("run#" in w and "row#" in w for w in windows)  # rows are only ordered within a cell
    assert all("run#" in w for w in windows if "row#" in w)


@pytest.mark.parametrize("seed", range(6))
def test_water_filling(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = {f"s{i}": int(x) for i, x in enumerate(rng.lognormal(4, 2.5, 7))} | {None: 5, "z": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_mixing_runs_no_python(docs):
    for df in (mixing.mix(docs), mixing.mixed_documents(docs)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


# 10 quality model


def test_quality_model_held_out(spark):
    root = "/root/testdata/sf0.1"
    docs, labels = (on_workers(spark).read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_model.classify(docs, labels).toPandas()
    assert len(got) == docs.count() and got["score"].between(0, 1).all()
    assert ((got["score"] >= 0.3).astype(int) == got["predicted"]).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    held = got[got["held_out"]].merge(labels.toPandas(), on="doc_id")
    good, bad = held[held["quality"] == 1], held[held["quality"] == 0]
    ranks = held["score"].rank()
    auc = (ranks[held["quality"] == 1].mean() - (len(good) + 1) / 2) / len(bad)
    assert auc > 0.98
    assert (good["predicted"] == 1).mean() > 0.99 and (bad["predicted"] == 0).mean() > 0.9


def test_quality_model_edges(spark, docs, empty):
    labels = spark.createDataFrame([(3, 1, 0), (6, 0, 0), (9, 1, 0), (12, None, 1), (None, 1, 0), (3, 1, 0), (21, 7, 0)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        got = quality_model.classify(docs, some).collect()
        assert Counter(r["doc_id"] for r in got) == Counter(d for d, _, _ in given(docs))
        assert all(0 <= r["score"] <= 1 for r in got)
    assert quality_model.classify(empty, labels).count() == 0


@pytest.mark.parametrize("hot", ["documents", "texts", "labels"])
def test_quality_model_learns_both_labels_beside_a_hot_id(spark, hot):
    """An id repeated beyond the number of rows learnt from leaves room for the others."""
    on_workers(spark)
    ids = [i for i in range(1, 200) if zlib.crc32(str(i).encode()) % 5][:40]
    texts = [(i, "good words " * 90 if n % 2 else "BAD!! #1 " * 9) for n, i in enumerate(ids)]
    quality = [(i, n % 2) for n, i in enumerate(ids)]
    # the id first in the order of the hash, so that its labels lead
    first = spark.createDataFrame(quality, "doc_id long, quality int").orderBy(F.xxhash64("doc_id")).first()
    text = dict(texts)[first["doc_id"]]
    if hot == "labels":
        quality += [tuple(first)] * 200
    else:
        texts += [(first["doc_id"], text + (f" {n}" if hot == "texts" else "")) for n in range(200)]
    docs, labels = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(quality, "doc_id long, quality int")
    got = {r["doc_id"]: r["predicted"] for r in quality_model.classify(docs, labels, rows=40).collect() if r["doc_id"] != first["doc_id"]}
    assert got == {i: n % 2 for n, i in enumerate(ids) if i != first["doc_id"]}


def test_boosting_finds_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, len(quality_model.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    scores = quality_model.fit(x[:3000], y[:3000]).scores(x[3000:])
    assert ((scores > 0.5) == y[3000:]).mean() > 0.85
