from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bibweave.llm import ans, html_extract, packing, textvec
from bibweave.llm.html_blocks import blocks, features
from bibweave.llm.html_pages import labelled_pages
from bibweave.llm.queries import tokenizer_path
from bibweave.llm.tokens import Encoder
from tests.conftest import DATA

ODD = [
    "", "  ", "don't. I'LL!! a'b,c 's 1234abc", "ΑΣ, ΟΔΟΣ. x", "J̌ J̌x. é,é É.", "<|endoftext|>", "a<|ENDOFTEXT|>b <|startoftext|>.",
    "a b c\u0085d", "日本語。テスト, ok", "x\x00y.\x1cz", "🙂🙂, a🙂.", "it's's 'S'd", "a.́b", None, "á.b ## #a# .a. !!a", "×÷,× é÷,", "İstanbul, ẞ",
]


def test_cached_encoding_equals_the_library(spark):
    library = Tokenizer.from_file(tokenizer_path())
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    want = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    encoder = Encoder(tokenizer_path())
    for _ in range(2):
        assert [list(x) for x in encoder.rows(pa.array(texts))] == want


def test_encoder_that_forgets(monkeypatch):
    monkeypatch.setattr("bibweave.llm.tokens.MEMORY", 8)
    encoder = Encoder(tokenizer_path())
    texts = ["one two three four", "five six seven", "one eight nine five", "two three"]
    want = [e.ids for e in Tokenizer.from_file(tokenizer_path()).encode_batch(texts, add_special_tokens=False)]
    assert [list(x) for t in texts for x in encoder.rows(pa.array([t]))] == want


def test_random_rows_equal_the_library():
    # letters of many scripts, marks that cut words, white space and contractions, with many rows to a slice
    r = random.Random(11)
    bits = [*"aBzQßéÉüÜñİıŉǅªºµÀÿʼΣςжЖ日本हि가ᄀ\u0301\u030c\u200d\u0085\x1c\x00123٣½“”–…🙂𝐀ﬁÅΩ", *".,;:!?*#$%&()[]<>@/|-_=+~'\"^", *"  \n\t  ", "the", "Dr", "U.S", "'s", "'LL", "'t"]
    rows = ["".join(r.choice(bits) for _ in range(r.choice([0, 1, 2, 4, 8, 14]))) for _ in range(20_000)]
    rows += [x for m in ".,;:!?*#$%&" for e in ("hello", "É", "Paris", "1", "") for x in (e, m + " Heading", e + m + "“x”", m)]
    rows += ["Dr.Müller", "Paris,“quoted”", "U.S.–China", "Read:https://é.org"]
    want = [e.ids for e in Tokenizer.from_file(tokenizer_path()).encode_batch(rows, add_special_tokens=False)]
    assert [list(x) for x in Encoder(tokenizer_path()).rows(pa.array(rows))] == want


def test_special_tokens_in_any_case_are_judged_row_by_row():
    r = random.Random(13)
    library = Tokenizer.from_file(tokenizer_path())

    def cased(t):
        return "".join(c.upper() if r.random() < 0.5 else c for c in t)

    pair = ["see <|endoftext|>", "a <|EndOfText|> b"]
    bits = ["<|endoftext|>", "<|startoftext|>", "<|endoftext", "endoftext|>", "a", "é.", " ", "word", "Dr.", "<|", "|>", ",", "\n"]
    rows = ["".join(cased(r.choice(bits)) if r.random() < 0.6 else r.choice(bits) for _ in range(r.choice([1, 2, 3, 6]))) for _ in range(100_000)]
    for texts in (pair, pair[::-1], rows, rows[:3000] + ["long " * 100_000, *rows[3000:6000]]):
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [list(x) for x in Encoder(tokenizer_path()).rows(pa.array(texts))] == want


def test_other_tokenizers_are_used_whole():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = ["Hello  World. It's", None, "", "a\n\nb Müller"]
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch([x or "" for x in rows], add_special_tokens=False)]
    assert [list(x) for x in Encoder(path).rows(pa.array(rows))] == want


@pytest.mark.parametrize("n", [0, 1, 5, 1024, 1025, 70_000])
def test_block_round_trip(n):
    ids = (np.random.default_rng(n).zipf(1.4, n) % 5000).astype(np.uint32)
    table = ans.Table(ans.scaled_frequencies(np.bincount(np.append(ids, 7), minlength=5000)))
    sizes = [n // 3, n - n // 3]
    raw = ans.encode_block([5, 9], sizes, ids, 77, table, lanes=64, segment=4096)
    docs, got_sizes, start, got = ans.decode_block(raw, table)
    assert (list(docs), list(got_sizes), start) == ([5, 9], sizes, 77) and (got == ids).all()
    if n > 1000:
        share = np.bincount(ids) / n
        share = share[share > 0]
        assert len(raw) < n * -(share * np.log2(share)).sum() / 8 * 1.2 + 12_000
        for at in (3, 20, len(raw) - 2):
            with pytest.raises(ValueError):
                ans.decode_block(raw[:at] + bytes([raw[at] ^ 1]) + raw[at + 1 :], table)


def test_frequencies_fill_the_scale():
    for counts in ([1], [5, 0, 1], [10**12] + [1] * 3000, [1] * 50_000):
        freq = ans.scaled_frequencies(np.array(counts))
        assert freq.sum() == 1 << ans.SCALE and all((f > 0) == (c > 0) for f, c in zip(freq, counts))


def test_token_files_round_trip(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(10_001, None), (10_002, ""), (10_002, "twice"), (10_003, "w " * 50_000)], "doc_id long, text string"))
    ans.write_tokens(docs.withColumn("ids", F.lit(1)).withColumn("shard", F.lit("x")), str(tmp_path / "t"), tokenizer_path(), block_tokens=20_000)
    got = ans.read_tokens(spark, str(tmp_path / "t")).orderBy("start").collect()
    library = Tokenizer.from_file(tokenizer_path())
    want = sorted((r["doc_id"], tuple([*library.encode(r["text"] or "", add_special_tokens=False).ids, 2])) for r in docs.collect())
    assert sorted((r["doc_id"], tuple(r["ids"])) for r in got) == want
    assert [r["doc_id"] for r in got] == [d for d, _ in want]
    at = 0
    for r in got:
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"])) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    ans.write_tokens(docs.where("false"), str(tmp_path / "e"), tokenizer_path())
    assert ans.read_tokens(spark, str(tmp_path / "e")).count() == 0
    ans.write_tokens(spark.createDataFrame([(3, "c"), (None, "x"), (-5, "a"), (None, "y z"), (3, "c")], "doc_id long, text string"), str(tmp_path / "n"), tokenizer_path())
    got = ans.read_tokens(spark, str(tmp_path / "n")).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, None, -5, 3, 3] and [r["start"] for r in got][2:] == [5, 7, 9] and sorted(r["n_tokens"] for r in got) == [2, 2, 2, 2, 3]


def test_rows_of_one_id_spread_over_shards(spark, tmp_path):
    rows = spark.range(4000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.when(F.col("id") % 3 == 1, 7).otherwise(F.col("id"))).alias("doc_id"), F.lit("the same words").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one partition
    try:
        ans.write_tokens(rows.repartition(8), str(tmp_path / "t"), tokenizer_path(), block_tokens=100)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    shards = spark.read.parquet(str(tmp_path / "t") + "/blocks").groupBy("shard").agg(F.sum("tokens").alias("n")).collect()
    assert len(shards) > 2 and max(r["n"] for r in shards) < 0.5 * sum(r["n"] for r in shards)
    got = ans.read_tokens(spark, str(tmp_path / "t")).orderBy("start").collect()
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert ids == sorted(ids) and len(ids) == 4000 and all(r["start"] == 4 * i for i, r in enumerate(got))


def test_spans_are_read_from_checkpoints(spark, tmp_path, monkeypatch):
    ids = (np.random.default_rng(1).zipf(1.5, 9_000) % 300).astype(np.uint32)
    table = ans.Table(ans.scaled_frequencies(np.bincount(ids, minlength=300)))
    block = ans.Block(ans.encode_block([1], [len(ids)], ids, 0, table, lanes=16, segment=1000), table)
    seen = []
    monkeypatch.setattr(block, "segment", lambda i, decode=block.segment: (seen.append(i), decode(i))[1])
    for lo, hi in ((0, 9000), (2500, 2600), (999, 1001), (8999, 20_000), (5, 5)):
        seen.clear()
        assert (block.tokens(lo, hi) == ids[lo:hi]).all() and seen == list(range(lo // 1000, -(-min(hi, 9000) // 1000))) * (hi > lo)
    docs = spark.createDataFrame([(i, f"word{i} " * 50) for i in range(200)], "doc_id long, text string")
    ans.write_tokens(docs, str(tmp_path / "t"), tokenizer_path(), block_tokens=3000)
    flat = [i for r in ans.read_tokens(spark, str(tmp_path / "t")).orderBy("start").collect() for i in r["ids"]]
    for lo, n in ((0, 10), (2990, 5000), (len(flat) - 3, 100), (len(flat), 5)):
        assert [i for r in ans.read_span(spark, str(tmp_path / "t"), lo, n).orderBy("start").collect() for i in r["ids"]] == flat[lo : lo + n]


def test_batches_are_bounded_by_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    found = textvec.map_batches(spark.range(0, 60, 1, 1).selectExpr("repeat('x', 4000000) as t"), sizes, "n long").collect()
    assert sum(r["n"] for r in found) == 60 and max(r["n"] for r in found) <= 5


@pytest.mark.parametrize("n", [0, 1, 7, 400])
def test_best_fit_matches_brute_force(n):
    r = np.random.default_rng(n)
    lengths = r.integers(1, 33, n)
    window, offset = packing.best_fit(lengths, 32)
    left: list[int] = []
    for i in np.argsort(-lengths, kind="stable"):
        room = [c for c in left if lengths[i] <= c < 32]
        if room:
            left[left.index(min(room))] -= lengths[i]
        else:
            left.append(32 - lengths[i])
    assert sorted(32 - np.bincount(window, lengths)) == sorted(left) if n else not len(window)
    for w in set(window):
        own = sorted((offset[i], lengths[i]) for i in range(n) if window[i] == w)
        assert own[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(own, own[1:])) and sum(own[-1]) <= 32


def test_packed_documents(spark):
    rows = [(1, None), (2, ""), (2, "a b"), (None, "a b c"), (3, "word " * 5000), (4, "x y z"), (5, "hello"), (6, "# Heading"), (7, "Dr.Müller"), (8, ".")]
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    docs = docs.withColumn("start", F.lit("clash")).withColumn("length", F.lit(0))
    got = packing.pack_documents(docs, tokenizer_path(), shard_docs=60).collect()
    library = Tokenizer.from_file(tokenizer_path())
    want = []
    for r in docs.collect():
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 1]
        for lo in range(0, len(ids), 2048):
            part = ids[lo : lo + 2048]
            want.append((r["doc_id"] or -1, lo, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)))
    assert sorted((r["doc_id"] or -1, r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == sorted((d if d else -1, *x) for d, *x in want)
    windows: dict = {}
    for r in got:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in windows.values():
        own.sort()
        assert own[0][0] == 0 and all(a + b == c for (a, b), (c, _) in zip(own, own[1:])) and sum(own[-1]) <= 2048
    assert sum(r["length"] for r in got) > 0.9 * 2048 * len(windows)
    assert packing.pack_documents(docs.where("false"), tokenizer_path()).count() == 0


def test_repeated_rows_spread_over_shards(spark):
    docs = spark.createDataFrame([(None, "x")] * 400, "doc_id long, text string")
    got = packing.pack_documents(docs, tokenizer_path(), shard_docs=50).collect()
    assert len(got) == 400 and len({r["sequence_id"] >> 32 for r in got}) == 8
    assert packing.pack_documents(docs.where("false"), tokenizer_path()).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{}</style><script>var a="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">Shop</a></li></ul></nav><div class="cookie-notice">We use cookies here, please agree.</div>
<article><h1>Big&nbsp;title</h1><p><b>First &lt;part&gt; of the story,
 with words and more of them.<br><p>Second part, which is also long enough. It goes on &amp; on.</p><div class="ad">Buy this thing now!</div></article>
<section class="comments"><p>Great story, I liked it. Thank you!</p></section><footer>&copy; 2020 Someone. All rights reserved.</footer></body></html>"""


@pytest.fixture(scope="module")
def field():
    return html_extract.default_field(300)


def test_main_text(field):
    assert html_extract.main_text(PAGE, field) == (
        "Big title First <part> of the story, with words and more of them. Second part, which is also long enough. It goes on & on."
    )
    for odd in ("", "   ", "<", "<p", "<!-- open", "<script>no end", "</div></p>", "<a href='x>y'>", "&am"):
        assert isinstance(html_extract.main_text(odd, field), str)


LONG = "The story goes on with many words, and with commas, so that it reads like one. " * 8


@pytest.mark.parametrize("attrs", ['class="overflow-hidden"', 'aria-hidden="false"', 'class="post hidden-sm"', 'title="the hidden river"', 'data-hidden="no"', 'style="overflow:hidden"', "class=hidden-body"])
def test_attributes_that_hide_nothing(field, attrs):
    page = f"<html><body><nav><a href=/>Home</a></nav><article {attrs}><h1>Title of it</h1><p>{LONG}</p></article></body></html>"
    assert LONG.strip() in html_extract.main_text(page, field)


@pytest.mark.parametrize("attrs", ["hidden", 'aria-hidden="true"', 'style="color:red; display : none"', "HIDDEN=''"])
def test_attributes_that_hide(field, attrs):
    page = f"<html><body><article><p>{LONG}</p><div {attrs}>Secret words, not to be seen by anyone at all.</div></article></body></html>"
    assert html_extract.main_text(page, field) == LONG.strip()


def test_content_of_an_article_stays(field):
    # formulas, drawings, maps and objects are content; what is not drawn is not
    inner = f"<p>{LONG}Formula <math><mi>x</mi> = <mi>y</mi> + 1</math> holds <svg><defs/><desc>no</desc><g><path d=''/></g></svg>here. <map name=m>Within a map.</map> <svg><defs><symbol>no</svg>End.</p>"
    got = html_extract.main_text(f"<body><article>{inner}</article></body>", field)
    assert got == LONG + "Formula x = y + 1 holds here. Within a map. End."
    long = "word " * 400
    assert blocks(f"<p>{long}© all rights reserved</p>")[0].text.endswith("reserved")
    names = html_extract.NAMES
    assert names.index("rights") in features(blocks(f"<p>{long}, Copyright of us</p>"))[0]
    assert names.index("letterless") not in features(blocks(f"<p>{'1 ' * 300}letters</p>"))[0]


def test_field_on_unseen_pages(field):
    wrong = total = 0
    for page, truth in labelled_pages(80, seed=31):
        found = blocks(page)
        want = html_extract.label_blocks(found, truth)
        wrong += sum(a != b for a, b in zip(field.decode(features(found)), want))
        total += len(want)
    assert wrong / total < 0.02


def test_viterbi_matches_enumeration(field):
    r = random.Random(1)
    for n in range(1, 7):
        lines = [[0, *r.sample(range(1, len(field.unary)), 4)] for _ in range(n)]
        best = max(
            range(2**n),
            key=lambda m: sum(field.unary[f, m >> k & 1].sum() for k, f in enumerate(lines)) + sum(field.pair[m >> k & 1, m >> k + 1 & 1] for k in range(n - 1)),
        )
        assert field.decode(lines) == [best >> k & 1 for k in range(n)]


def test_pages_against_their_article_element(spark, field):
    import html
    import re

    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = html_extract.extract_text(pages, field=field).collect()
    raw = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in got:
        m = re.search(r"<article>(.*?)(?:</article>|$)", raw[r["page_id"]], re.S)
        assert r["text"] == " ".join(html.unescape(re.sub(r"<[^>]*(>|$)", " ", m[1])).split())


THEMES = (
    "has-sidebar", "cookie-bar", "comments-open", "post has-comments", "post comment-page", "legal", "single single-post", "nav-open footer-fixed", "page-template sidebar-right", "with-sidebar ads-on",
    "archive tag-news", "search search-results", "popup modal-ready", "newsletter-signup", "promo banner", "related-layout", "social share", "widget-area", "menu-header", "breadcrumb toc",
)
AROUND = (
    '<nav class="menu"><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>',
    '<aside class="sidebar"><h3>Popular</h3><ul><li><a href="/c">Other things</a></li></ul></aside><footer>&copy; 2021 Someone. All rights reserved.</footer>',
)


@pytest.mark.parametrize("theme", THEMES)
def test_theme_classes_keep_the_article(field, theme):
    story = f"<h1>Title of the story</h1><p>{LONG}</p><h2>Part two</h2><p>{LONG}</p><ul><li>One point</li></ul>"
    want = f"Title of the story {LONG.strip()} Part two {LONG.strip()} One point"
    before, after = AROUND
    for page in (
        f"<html><body class='{theme}'>{before}<article>{story}</article>{after}</body></html>",
        f"<html class='{theme}'><body class='{theme}'>{before}<main>{story}</main>{after}</body></html>",
        f"<html><body>{before}<article class='{theme}'>{story}</article>{after}</body></html>",
        f"<html><body><div id='{theme.split()[0]}'>{before}<article class='post'>{story}</article>{after}</div></body></html>",
        f"<html><body>{before}<div class='{theme}'>{story}</div>{after}</body></html>",
    ):
        assert html_extract.main_text(page, field) == want


@pytest.mark.parametrize("quote", ["'", '"'])
def test_a_stray_quote_loses_no_text(quote):
    story = 'He said "no" and it doesn\'t matter, they\'re "fine".'
    for tag in ("<p title=it>", "<p class='x' title=\"a b\">", "<a href=/johns-page class=y>", "<p hidden-not data-x='1'>"):
        for i in range(2, len(tag)):
            page = f"<article><p>First words.</p>{tag[:i]}{quote}{tag[i:]}{story}</p><p class='z'>Second {story}</p><p class=\"z\">Last words.</p></article>"
            text = " ".join(b.text for b in blocks(page))
            assert text.count(story) == 2 and text.startswith("First words.") and text.endswith("Last words."), (tag[:i] + quote + tag[i:], text)
    assert [b.text for b in blocks("<p title='a > b' x>yes</p><p title=\"<b>c</b>\">no</p>")] == ["yes", "no"]


def test_deep_pages_take_linear_time():
    import time

    def took(n):
        pages = "<div class='nav'>" * n + "x " + "<annotation>" * n + "<li>y" * n, "<section><p class='a b'>w " * n, "<a href=\">z" * n, "</p>" * n + "<td>" * n
        began = time.perf_counter()
        for page in pages:
            features(blocks(page))
        return time.perf_counter() - began

    took(500)
    small, large = min(took(2000) for _ in range(3)), min(took(16_000) for _ in range(2))
    assert large < 8 * 2.5 * small


def test_pages_odd_rows(spark, field):
    df = spark.createDataFrame([(1, None, "old", 3), (1, "", "old", 4), (None, "<p>" + "Long text, and more. " * 20_000, "old", 5)], "page_id long, html string, text string, label int")
    got = html_extract.extract_text(df, field=field)
    assert got.columns == ["page_id", "label", "text"] and sorted(len(r["text"]) for r in got.collect())[:2] == [0, 0]
    assert html_extract.extract_text(df.where("false"), field=field).count() == 0


@pytest.mark.parametrize(
    "page, want",
    [
        ('<div class="overflow-hidden"><p class="body-hidden-sm">a b</p><p aria-hidden="false">c</p></div>', ["a b", "c"]),
        ('<p hidden>a</p><p HIDDEN="">b</p><p aria-hidden=true>c</p><p style="x:y; display : none">d</p><p data-x="display:none">e</p>', ["e"]),
        ("<html><head><title>T</title><p>text", ["text"]),
        ("<head><meta charset=x><noscript><img></noscript><b>bold</b> text", ["bold text"]),
        ("<head><title>T</title>\n bare", ["bare"]),
        ("<head><script>x</script><style>y</style></head><body>z", ["z"]),
        ("<p>where <math><semantics><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></semantics></math> holds</p>", ["where x=2 holds"]),
        ("<article><p>a</p><object data=x><p>b</p></object></article>", ["a", "b"]),
    ],
)
def test_blocks_lose_no_article_text(page, want):
    assert [b.text for b in blocks(page)] == want
