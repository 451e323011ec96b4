"""Tokens, pages, personal data, dialogues and urls against plain versions, and the edge cases their docstrings define."""

import hashlib
import html
import random
import re
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.oracle import compare, duck
from tidegate.llm import bpe, chat, html_text, pii, queries, url_filter

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars int"
EDGES = ["", None, " ", "\n\n", "a" * 70_000, "é中😀'll 's", "word " * 30_000, "same text", "same text"]


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def library():
    ranks = bpe.load_ranks(queries.RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_those_of_the_library(library):
    random.seed(1)
    letters = "ab's t'rellvemd  \n\t\r'1९²Ⅷ.!,ñé  ́中😀\x1c\x1f\x85'''"
    texts = ["".join(random.choices(letters, k=random.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(chr(c) for c in range(s, s + 512) if not 0xD800 <= c < 0xE000) for s in range(0, 0x20000, 512)]
    texts += ["", "a" * 64, "a" * 65, "ab" * 500, " " * 300, "'s" * 50, "x" * 5000]
    encode = bpe.Encoder(queries.RANKS, cache_slices=100)
    for part in (texts[:1500], texts[1500:]):
        n, ids, offsets = encode(pa.array(part))
        for t, k, i, o in zip(part, n.to_pylist(), ids.to_pylist(), offsets.to_pylist()):
            ids_ = np.frombuffer(i, "<u4")
            assert ids_.tolist() == library.encode_ordinary(t) and k == len(ids_)
            assert bpe.decode_arrays(queries.RANKS, ids_, np.frombuffer(o, "<u4")) == t.encode()


def test_encode_and_decode_edge_cases(spark, library):
    df = docs(spark, EDGES).withColumn("ids", F.lit(1)).withColumn("Decoded", F.lit("x"))
    out = bpe.decode(bpe.encode(df, queries.RANKS), queries.RANKS)
    assert sorted(out.columns) == sorted(["doc_id", "text", "lang", "source", "n_chars", "n_tokens", "ids", "offsets", "decoded"])
    for r in out.collect():
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
        assert r["n_tokens"] == len(library.encode_ordinary(r["text"] or ""))
    together = bpe.encode(df, queries.RANKS, decoded=True).select("doc_id", "decoded").collect()
    assert {r[0]: bytes(r[1]) for r in together} == {i: (t or "").encode() for i, t in enumerate(EDGES)}
    assert bpe.encode(docs(spark, []), queries.RANKS).count() == 0


def test_bpe_query(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    got = queries.op1_byte_bpe(spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = np.array(library.encode_ordinary(texts[r["doc_id"]]), "<u4")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def plain_main_text(page):
    article = re.search(r"<article>(.*)</article>", page, re.S)[1]
    parts = [re.sub(r"<[^>]+>", "", p) for p in re.split(r"</?(?:p|h1|br)>", article)]
    parts = [re.sub(r"\s+", " ", html.unescape(p)).strip() for p in parts]
    return "\n".join(p for p in parts if p)


def test_html_query(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for r in queries.op2_html_text(spark, SF_DIR).collect():
        want = plain_main_text(pages[r["page_id"]]["html"])
        assert (r["url"], r["text"], r["n_chars"]) == (pages[r["page_id"]]["url"], want, len(want))


BODY = "<p>One two three four five six seven eight.</p>" * 3


@pytest.mark.parametrize(
    "page,want",
    [
        ("", ""),
        ("<html><body></body></html>", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>cut off <b", "cut off"),
        ("<p>a < b and\n c &lt;d&gt; &#233;</p>", "a < b and c <d> é"),
        ("<p>kept<script>var x='</p><p>no';</script> text</p><style>p{}</style>", "kept text"),
        ("<!-- <p>note</p> --><p>shown words here</p>", "shown words here"),
        ("<article><p>first line<br>second line</p><form><label>Mail</label></form></article>", "first line\nsecond line"),
        (
            f"<nav><a href=/>Home</a></nav><article><h1>Title</h1>{BODY}<div class='ad'>Buy it now</div><p>Last one.</p></article>"
            "<section class=comments><p>" + "I liked this a lot. " * 20 + "</p></section><footer>(c) us</footer>",
            "Title\n" + "One two three four five six seven eight.\n" * 3 + "Last one.",
        ),
        (
            f"<header>Site</header><div class='cookie-notice'>{BODY}</div><div class='sidebar'>{BODY}</div><main>{BODY}</main>",
            "\n".join(["One two three four five six seven eight."] * 3),
        ),
    ],
)
def test_html_cases(page, want):
    assert html_text.extract_text(page, html_text.weigh(html_text.count([page]))) == want
    assert html_text.extract_text(page, {}) == want


WORDS_50 = " ".join(f"w{i}" for i in range(50))
ADVERT = "<div class='advert'>" + "<p>buy <b>now</b></p>" * 200 + "</div>"


@pytest.mark.parametrize(
    "page, want",
    [
        # what is left out of a marked article parts nothing, however long
        (f"<nav>x y</nav><article><p>{WORDS_50}</p>{ADVERT}<p>the last words</p></article>", WORDS_50 + "\nthe last words"),
        # marked content wins whatever its length
        (f"<article>one two three</article><div>{WORDS_50}</div>", "one two three"),
        (f"<div>{WORDS_50}</div><main><a href='/'>one link</a></main><p>{WORDS_50}</p>", "one link"),
        # markers inside markers part nothing
        ("<main><h1>Title</h1><p>Lead</p><article><p>Body text</p></article><article>More</article></main>", "Title\nLead\nBody text\nMore"),
        # no markers: boilerplate is left out and costs the region little
        (f"<ul class=nav><li>a</li></ul><div><p>{WORDS_50}</p>{ADVERT}<p>{WORDS_50}</p></div>", f"{WORDS_50}\n{WORDS_50}"),
        # one marked cell after the other in a table of many tags
        ("<article><table>" + "<tr><td>1</td><td><b></b></td></tr>" * 40 + "</table></article>", "\n".join("1" * 40)),
    ],
)
def test_html_regions(page, want):
    fitted = html_text.weigh(html_text.count([page, f"<body><nav>a b</nav><article><p>{WORDS_50}</p></article><div>c</div></body>"]))
    assert html_text.extract_text(page, fitted) == want and html_text.extract_text(page, {}) == want


def test_best_region_equals_a_search_of_all():
    random.seed(5)
    for _ in range(300):
        scores = [random.choice([-3.0, -1.0, 0.0, 1.0, 2.0]) for _ in range(random.randint(0, 14))]
        sums = {(a, b): sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)}
        best = max(sums.values(), default=0.0)
        a, b = html_text.best_region(scores)
        assert (a, b) == (0, 0) if best <= 0 else sums[a, b] == best
    pages = ["<p>a b</p><div class=nav>x y z</div><p>c</p>", f"<article>a{ADVERT}b</article><p>c d</p><main>e</main>", "<b>a</b>" * 9]
    for page in pages:
        scores = html_text.score(list(html_text.tokens(page)), {})
        sums = [sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)]
        a, b = html_text.best_region(scores)
        assert abs(sum(scores[a:b]) - max(sums)) < 1e-9


def test_html_deep_nesting_is_linear():
    n = 60_000
    started = time.process_time()
    assert html_text.extract_text("<div>" * n + "</b>" * n + "words", {}) == "words"
    assert time.process_time() - started < 20  # a search of the whole stack takes minutes


def test_html_copies_of_a_page_are_one_of_the_sample(spark):
    """Ten thousand copies count once, and the weights don't depend on the partitioning."""
    copies = [("<article>" + "<p>x</p>" * 30 + "</article>",)] * 10_000
    others = [(f"<article><h1>t{k}</h1><i>w w w</i></article><div>o</div>",) for k in range(9)]
    df = spark.createDataFrame(copies + others, "html string")
    got = html_text.fit(df, sample=10)
    assert got == html_text.fit(df.repartition(7), sample=10)
    assert got == html_text.weigh(html_text.count([copies[0][0], *(o[0] for o in others)]))


def test_html_edge_cases(spark):
    df = spark.createDataFrame([(1, None, "t"), (2, "", "t"), (3, "<p>x " * 20_000, "t"), (3, "<p>x", "t")], "page_id int, html string, TEXT string")
    got = rows(html_text.extract(df).select("page_id", "n_chars"))
    assert got == [(1, 0), (2, 0), (3, 1), (3, 39_999)]
    assert html_text.extract(df.limit(0)).count() == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def plain_base(t):
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_pii_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    found = 0
    for r in queries.op4_pii(spark, "/root/testdata/sf0.01").collect():
        base = plain_base(texts[r["doc_id"]])
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert set(said.split(",")) <= set(r["spans"].split(","))
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(x[0] == k for x in base) for k in pii.BASE_KINDS]
        found += len(base)
    assert found > 50


def test_pii_spans():
    random.seed(3)
    for _ in range(5000):
        t = "".join(random.choices("a.@-b+ 19(", k=30))
        assert [s[:3] for s in pii.find(t) if s[0] in pii.BASE_KINDS] == plain_base(t)
    t = "Bank account DE89 3704 0044 0532 0130 00, social security 123-45-6789, card 4111 1111 1111 1111 é a@b.co"
    kinds = [s[0] for s in pii.find(t)]
    assert kinds == ["email", "card", "iban", "ssn"]
    assert pii.mask(t) == "Bank account <IBAN>, social security <SSN>, card <CARD> é <EMAIL>"
    assert not pii.find("part 123-45-6789 DE89 3704 0044 0532 0130 01 300.1.1.1")


@pytest.mark.parametrize(
    "text, want",
    [
        ("DE89370400440532013000 BIC COBADEFFXXX", ["DE89370400440532013000"]),
        ("DE89 3704 0044 0532 0130 00 A friend", ["DE89 3704 0044 0532 0130 00"]),
        ("GB82 WEST 1234 5698 7654 32 2024-01-02", ["GB82 WEST 1234 5698 7654 32"]),
        ("AB12 CODE DE89 3704 0044 0532 0130 00", ["DE89 3704 0044 0532 0130 00"]),
        ("DE89370400440532013000 GB82WEST12345698765432", ["DE89370400440532013000", "GB82WEST12345698765432"]),
        ("MT84MALT011000012345MTLCAST001S 1", ["MT84MALT011000012345MTLCAST001S"]),
        ("NO9386011117947.", ["NO9386011117947"]),
        ("DE89370400440532013001 BIC COBADEFFXXX", []),
        ("DE89370400440532013000x", []),
    ],
)
def test_ibans_before_other_words(text, want):
    assert [text[a:b] for kind, a, b, _ in pii.find(text) if kind == "iban"] == want


def test_iban_ends_of_every_country_length():
    for country, size in pii.IBAN_SIZES.items():
        body = "0" * (size - 4)
        check = next(f"{n:02d}" for n in range(2, 99) if pii.mod97(f"{country}{n:02d}{body}"))
        for after in ("", " 1 A B2 C34 D567", " BIC"):
            found = [s[1:3] for s in pii.find(f"{country}{check}{body}{after}") if s[0] == "iban"]
            assert found == [(0, size)]


def test_pii_long_runs_take_linear_time():
    started = time.process_time()
    for text in ("1" * 1_000_000, "1." * 300_000, "+1(" * 200_000, "a@" * 300_000, "1 " * 300_000, "DE89 " * 100_000):
        pii.find(text)
    assert time.process_time() - started < 60
    kinds = [(k, a, b) for k, a, b, _ in pii.find("9" * 1000 + ".1.2.3 1.2.3.4.5.6.7.8 01.002.0003.4")]
    assert kinds == [("ip", 1007, 1014), ("ip", 1015, 1022), ("ip", 1023, 1036)]


def test_pii_edge_cases(spark):
    out = pii.detect(docs(spark, [*EDGES, "x@y.zz " * 2000]).withColumn("pii_spans", F.lit(1)))
    sizes = {r["doc_id"]: r["n"] for r in out.select("doc_id", F.size("pii_spans").alias("n")).collect()}
    assert sizes == {**{i: 0 for i in range(len(EDGES))}, len(EDGES): 2000}
    masked = pii.redact(docs(spark, [None, "to x@y.zz"]).withColumn("_masked", F.lit(7)))
    assert rows(masked.select("text", "_masked")) == [("to <EMAIL>", 7), (None, 7)]
    assert pii.redact(docs(spark, [])).count() == 0


@pytest.mark.parametrize("name", ["op5_chat_perspectives", "op10_url_filter"])
def test_query_matches_sql(spark, name):
    assert compare(spark, duck(SF_DIR), name, queries.QUERIES[name], queries.SQL[name], SF_DIR) is None


def test_perspectives(spark):
    turns = [
        (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi"), (1, 2, "bob", "Hello é"), (1, 3, "ann", ""), (1, 3, "ann", ""),
        (1, 9, "cy", "Late"), (1, None, "bob", None), (2, 0, "system", "alone"), (None, 0, None, "x"),
    ]
    df = spark.createDataFrame(turns, "conv_id int, turn int, role string, text string").withColumn("part", F.lit("z"))
    got = chat.perspectives(df, turns_per_part=4).collect()
    assert {(r["conv_id"], r["perspective"]) for r in got} == {(1, "ann"), (1, "bob"), (1, "cy"), (None, "unknown")}
    assert {r["part"] for r in got if r["conv_id"] == 1} == {-1, 0, 2}
    for r in got:
        said = [r["text"][s["start"] : s["end"]] for s in r["spans"]]
        assert all(x.endswith("<|im_end|>\n") for x in said) and len(said) == r["n_own"]
        assert r["text"].count("<|im_start|>assistant\n") == r["n_own"]
    ann = next(r for r in got if r["perspective"] == "ann" and r["part"] == 0)
    assert ann["text"].startswith("<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>assistant\nHi<|im_end|>\n<|im_start|>user name=bob\n")
    assert [ann["text"][s["start"] : s["end"]] for s in ann["spans"]] == ["Hi<|im_end|>\n"] + ["<|im_end|>\n"] * 2
    assert chat.perspectives(df.limit(0)).count() == 0


def test_perspectives_stay_native(spark):
    plan = chat.perspectives(spark.read.parquet(f"{SF_DIR}/conversations.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def link(target):
    return f'<html><head><link rel="canonical" href="{target}"></head></html>'


def test_blocks_follow_redirects(spark):
    pages = [
        (1, "http://a.io/x", link("http://bad.net/home?a=1&amp;b=2")),  # alias of a blocked url
        (2, "http://b.io/y#top", '<meta http-equiv="refresh" content="0; url=http://a.io/x">'),  # alias of an alias
        (3, "http://c.io/z", link("/w")),
        (4, "http://c.io/w", None),
        (5, "http://ok.example.net/en/1", link("http://bad.net/home?a=1&amp;b=2")),  # its own rule allows it, and its class
        (6, "http://q.net/", ""),
        (7, "http://q.net", ""),  # no path, so the rule's path doesn't fit
        (8, None, link("http://bad.net/")),
        (9, "no scheme", link("http://bad.net/")),
        (10, "HTTP://D.Example.COM/de/1?x#y", None),
        (11, "http://e.io/1", link("http://worse.net/")),
        (11, "http://e.io/1", link("http://worse.net/")),
    ]
    df = spark.createDataFrame(pages, "page_id int, url string, html string").withColumn("rule", F.lit(1))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(df, queries.RULES).collect()}
    assert got[1] == ("a.io", "/x", None, "allow") and got[2][3] == "allow"  # an explicit allow in the class comes first
    assert got[5] == ("ok.example.net", "/en/1", "example.net/en/", "allow")
    assert got[6] == ("q.net", "/", "net/", "block") and got[7] == ("q.net", "", None, "allow")
    assert got[8] == got[9] == ("", "", None, "allow")
    assert got[10] == ("d.example.com", "/de/1", "example.com/de/", "block")
    assert got[11] == ("e.io", "/1", None, "block")
    without = {r["page_id"]: r["verdict"] for r in url_filter.judge(df.filter("page_id <> 5"), queries.RULES).collect()}
    assert without[1] == without[2] == "block" and without[3] == without[4] == "allow"
    given = spark.createDataFrame([("http://c.io/w", "http://far.net/"), (None, "http://x.net/")], "a string, b string")
    more = {r["page_id"]: r["verdict"] for r in url_filter.judge(df, queries.RULES, given).collect()}
    assert more[3] == more[4] == "block"
    assert url_filter.judge(df.limit(0), queries.RULES).count() == 0
