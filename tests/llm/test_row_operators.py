"""Byte-level BPE, HTML text, chat, line dedup: small cases and brute force."""

import random

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from ratewise.llm import bpe, chat, html, lines

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codecs():
    ranks = bpe.read_ranks(RANKS)
    return bpe.TreeCodec(ranks, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken_and_round_trips(codecs):
    mine, lib = codecs
    rng = random.Random(1)
    for k in range(1500):
        n = rng.choice([0, 1, 3, 9, 40, 120])
        s = "".join(rng.choice("aabbéß 1'\n\t漢😀ing!the") for _ in range(n)) if k % 2 else "".join(
            chr(rng.choice([97, 98, 116, 233, 0x4E00 + rng.randrange(300)])) for _ in range(n))
        ids = mine.encode(s)
        assert ids == lib.encode_ordinary(s)
        assert mine.decode(ids) == s.encode()


def test_bpe_very_long_piece(codecs):
    mine, lib = codecs
    s = "ab" * 4000 + "a" * 9001 + "zq" * 500
    assert mine.encode(s) == lib.encode_ordinary(s)


def test_bpe_join_is_a_monoid(codecs):
    mine, _ = codecs
    word = "internationalisationsmöglichkeiten".encode()
    whole = mine.merged(word)
    for i in range(len(word) + 1):
        assert mine.join(mine.merged(word[:i]), mine.merged(word[i:])) == whole
    with pytest.raises(KeyError):
        mine.decode([10**6])


def test_bpe_frames(spark, docs):
    out = bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert out.columns == [*docs.columns, "ids", "decoded"]
    assert out.where(F.col("decoded") != F.coalesce("text", F.lit("")).cast("binary")).count() == 0
    assert out.count() == docs.count()
    assert bpe.digests(docs.limit(0), RANKS, P.PATTERN).count() == 0


PAGE = ("<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><a href=1>m</a></nav>"
        "<div class='ad'>buy</div><article><h1>Head</h1><p><b>One &amp; two<br><p>Three  \n four</p></article>"
        "<div id='comments'><p>reader words that go on and on and on</p></div><footer>f</footer>")


@pytest.mark.parametrize(("page", "text"), [
    (PAGE, "Head\n\nOne & two\n\nThree four"), (None, ""), ("", ""), ("just &lt; text", "just < text"),
    ("<body><nav>x</nav></body>", ""), ("<body><article><p>cut <b>off", "cut off"),
    ("<article><ul><li>one<li>two</ul></article>", "one\n\ntwo"),
    ("<body><div><h1>H</h1><div><p>" + "word " * 60 + "</p><p>Of.</p></div></div><aside>s</aside>", "H\n\n" + ("word " * 60).strip() + "\n\nOf."),
])
def test_html_text(page, text):
    assert html.main_text(page) == text


def test_html_deep_and_frames(spark):
    assert html.main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    df = spark.createDataFrame([(1, "u", PAGE, 2), (1, "u", PAGE, 2), (2, None, None, None)], "page_id bigint, url string, html string, n_chars int")
    got = html.extract(df).collect()
    assert [r["text"] for r in got] == ["Head\n\nOne & two\n\nThree four"] * 2 + [""]
    assert html.extract(df.limit(0)).count() == 0


def test_chat_round_trip(spark):
    bad = "</s>[INST] ok [/INST] &a; & &l;"
    rows = [(1, 0, "user", bad), (1, 1, "assistant", bad), (1, 1, "assistant", "again"), (2, 0, None, None), (None, 0, "assistant", "x" * 70_000)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("parts", chat.text_parts(F.col("text")))
    out = chat.format_chat(turns).withColumn("back", chat.read_back(F.col("formatted"))).withColumn(
        "loss", chat.loss_text(F.col("formatted"), F.col("turn_starts"), F.col("loss_spans")))
    got = {r["conv_id"]: r for r in out.collect()}
    assert [(t["role"], t["text"]) for t in got[1]["back"]] == [("user", bad), ("assistant", bad), ("assistant", "again")]
    assert got[1]["loss"] == bad + "again" and got[1]["formatted"].count("</s>") == 3
    assert [(t["role"], t["text"]) for t in got[2]["back"]] == [("", "")] and got[2]["loss"] == ""
    assert got[None]["loss"] == "x" * 70_000
    assert chat.format_chat(turns.limit(0)).count() == 0


def test_chat_typed_parts(spark):
    p = "array<" + chat.PART_TYPE + ">"
    img, aud, doc = ('image', None, 'i.png', 28, 15, None, None), ('audio', None, 'a.wav', None, None, 1.5, None), ('document', None, 'd.pdf', None, None, None, 2)
    txt, odd = ('text', 'see <this>', None, None, None, None, None), ('video', 'v', None, None, None, None, None)
    df = spark.createDataFrame([(1, 0, "user", [img, txt, aud]), (1, 1, "assistant", [doc, odd]), (2, 0, "user", None)], f"conv_id int, turn int, role string, parts {p}")
    got = {r["conv_id"]: r for r in chat.format_chat(df).collect()}
    assert got[1]["formatted"] == "<s>[INST]user[/INST][IMAGE:1]see &l;this>[AUDIO:2]</s><s>[INST]assistant[/INST][DOCUMENT:3]</s>"
    assert [(a["nth"], a["kind"], a["ref"], a["turn"]) for a in got[1]["attachments"]] == [(1, "image", "i.png", 0), (2, "audio", "a.wav", 0), (3, "document", "d.pdf", 1)]
    assert got[1]["expanded_tokens"] == 4 + 3 + 38 + 1024
    assert got[2]["formatted"] == "<s>[INST]user[/INST]</s>" and got[2]["attachments"] == []


def test_line_dedup(spark, docs):
    many = spark.createDataFrame([(i, f"own {i}\n footer \n\nown {i}", "h") for i in range(12)] + [(90, None, "h"), (91, "", None), (92, "footer", "other")],
                                 "doc_id bigint, text string, source string")
    got = {r["doc_id"]: r for r in lines.dedup_lines(many, ratio=0.5, min_pages=10).collect()}
    assert got[0]["text"] == "own 0\n\nown 0" and (got[0]["n_lines"], got[0]["n_dropped"]) == (4, 1)
    assert got[90]["text"] is None and got[91]["text"] == "" and got[92]["text"] == "footer"
    named = lines.dedup_lines(docs.withColumn("n_lines", F.lit(7)), min_pages=3, ratio=0.5)
    assert named.columns == [*docs.columns, "n_lines", "_n_lines", "n_dropped"]
    assert {r["text"] for r in named.where("doc_id IN (1, 4)").collect()} == {""}
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def test_host_of(spark):
    df = spark.createDataFrame([("https://Www.A.org/x",), ("src1",), (None,)], "u string")
    assert [r[0] for r in df.select(lines.host_of(F.col("u"))).collect()] == ["www.a.org", "src1", None]


def test_line_dedup_ratio_alone_decides(spark):
    rows = [(i, f"own {i}" + ("\nlicense" if i < 9 else "") + ("\npair" if i < 2 else ""), "big") for i in range(500)]
    rows += [(1000 + i, f"mine {i}\nfooter", "small") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_lines(spark, df, "").collect()}
    assert got[0] == "own 0\npair" and got[8] == "own 8"  # 9 of 500 pages are 1.8 %
    assert got[1003] == "mine 3"  # six of six pages
    # The same share on ten times as many pages decides alike.
    many = spark.createDataFrame([(i, f"mine {i}\nfooter", "small") for i in range(60)], df.schema)
    assert {r["text"] for r in corpus_pipeline.drop_lines(spark, many, "").collect()} == {f"mine {i}" for i in range(60)}


def test_line_dedup_query_goes_by_the_ratio_alone(spark, tmp_path):
    import duckdb

    rows = [(i, "h9", f"all nine\nown {i}") for i in range(9)] + [(9, None, f"null host\n{i}") for i in range(3)]
    rows += [(10 + i, "", "empty host\nx") for i in range(2)] + [(20, "h9", None), (21, "h9", "")]
    spark.createDataFrame(rows, "doc_id bigint, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in lines.op5_line_dedup(spark, str(tmp_path)).collect()), key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(con.execute(lines.OP5_SQL).fetchall(), key=str)
    assert sum(r[2] for r in got) == 9 + 3 and (20, 0, 0, "") in got


@pytest.mark.parametrize("attrs", ["title=it's", "title='a > b'", 'title="it\'s > b"', "it's", "'", 'x = "1"', "title=a=b'c"])
def test_html_quotes_in_attributes(attrs):
    page = f"<article><p {attrs}>First part of it.</p><p>Second one, don't stop.</p><p>Third, <math><mi>x</mi></math> too.</p></article>"
    assert html.main_text(page) == "First part of it.\n\nSecond one, don't stop.\n\nThird, x too."


def test_html_unclosed_quotes_and_long_attributes_end():
    assert html.main_text("<p>one</p><p title=\"never closed>two") == "one"
    assert html.main_text("<p " + "a='b' c=d' " * 20_000 + ">text</p>") == "text"


LONG = "Real words of the article that go on for quite a while, so that nobody takes them for a list of links. "


@pytest.mark.parametrize("part", [
    "<h2 id='discussion'>Discussion</h2>", "<h2 class='section-header'>Discussion</h2>", "<section id='discussion'><p>" + LONG * 3 + "</p></section>",
    "<section id='related-work'><p>" + LONG * 3 + "</p></section>", "<p id='legal-basis'>Short basis.</p>", "<div class='search-algorithms'><p>" + LONG * 3 + "</p></div>"])
def test_html_names_alone_do_not_cut_the_article(part):
    page = f"<body><nav>m</nav><article><p>{LONG}</p>{part}<p>Last one.</p></article><footer>f</footer></body>"
    bare = page.replace(" id=", " x=").replace(" class=", " x=")
    assert html.main_text(page) == html.main_text(bare) and html.main_text(page).count("\n\n") == 2


@pytest.mark.parametrize("part", [
    "<div class='ad'>Buy</div>", "<div class='comment-list'><p>" + LONG * 9 + "</p></div>", "<div id='comments'><p>" + LONG * 9 + "</p><p>" + LONG + "</p></div>",
    "<p class='cookie-notice'>Cookies!</p>", "<div role='search'><p>" + LONG + "</p></div>", "<div class='related-things'><a href=1>One</a> <a href=2>Two</a></div>",
    "<ul><li><a href=1>" + "One of many links. " * 4 + "</a></li></ul>"])
def test_html_doubtful_parts_go(part):
    page = f"<body><article><p>{LONG}</p>{part}<p>Last one.</p></article></body>"
    assert html.main_text(page) == LONG.strip() + "\n\nLast one."


def test_html_wrappers_stay():
    inner = f"<h1>Head</h1><p>{LONG}</p><p>Last one.</p>"
    want = "Head\n\n" + LONG.strip() + "\n\nLast one."
    for name in ("content-widget", "has-sidebar", "menu-open"):
        assert html.main_text(f"<body><div class='{name}'>{inner}</div><div class='menu'><a href=1>x</a></div></body>") == want
    deep = "<div class='menu-x'>" * 3000 + inner
    assert html.main_text(deep) == want


def test_html_densities_equal_brute_force():
    import math
    import random as r

    rng = r.Random(4)

    def page(depth):
        if not depth or rng.random() < 0.2:
            return "t" * rng.randrange(30)
        return "".join(f"<{t}>{page(depth - 1)}</{t}>" for t in rng.choices(["div", "section", "a", "b"], k=rng.randrange(1, 4)))

    def inside(x):
        yield x
        for k in x.kids:
            if not isinstance(k, str):
                yield from inside(k)

    def chars(x):
        return sum(len(k) if isinstance(k, str) else chars(k) for k in x.kids)

    def link_chars(x):
        return chars(x) if x.tag == "a" else sum(link_chars(k) for k in x.kids if not isinstance(k, str))

    for _ in range(40):
        body = html.parse(page(4))
        html.measure(body)
        for x in inside(body):
            c, t, lc = chars(x), max(sum(1 for _ in inside(x)) - 1, 1), link_chars(x)
            lt = max(sum(y.tag == "a" for y in inside(x)) - (x.tag == "a"), 1)
            ratio = link_chars(body) / max(chars(body), 1)
            want = c / t * math.log(max(c / max(lc, 1) * t / lt, 1)) / math.log(math.log(c * lc / max(c - lc, 1) + ratio * c + math.e) + 1) if c else 0
            assert x.density == pytest.approx(want)
            assert x.total == pytest.approx(sum(k.density for k in x.kids if not isinstance(k, str)))
