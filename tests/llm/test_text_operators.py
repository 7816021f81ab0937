"""PII, quality, token counts, SentencePiece, language and pages against brute force."""

import hashlib
import random
import re
from collections import Counter
from html import unescape

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sigloom.llm import htmltext, langid, pii, quality, queries, spiece, tokencount
from sigloom.llm.common import remainder

SF = "/root/testdata/sf0.001"

# --- PII --------------------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_pii(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    return {
        "email": [m.span() for m in EMAIL.finditer(t)],
        "ip": [m.span() for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(t) if 16 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))],
        "phone": [m.span() for m in PHONE.finditer(t) if 8 <= len(digits(m.group())) <= 15],
    }


PARTS = st.sampled_from(["@", ".", "a", "b-", "%", "+", "1", "23", "255", "4", "000", " ", "-", "(", ")", "+1 ", "4111111111111111", "4111 1111 1111 1111", "x.y", "é", "1.2.3.4", "a@b.c", "token = "])


@settings(max_examples=600, deadline=None)
@given(st.lists(PARTS, max_size=14).map("".join))
def test_base_spans_equal_the_grammars(t):
    found = pii.find(t)
    assert {k: found.get(k, []) for k in pii.BASE} == brute_pii(t)


def test_more_kinds_and_redaction():
    cases = {
        "see ftp://bob:pw@host.org/x now": ("url", "ftp://bob:pw@host.org/x"),
        "IBAN: DE89 3704 0044 0532 0130 00.": ("iban", "DE89 3704 0044 0532 0130 00"),
        "account no: 12345678 ok": ("account", "12345678"),
        'token = "04dbebab91ab" x': ("secret", "04dbebab91ab"),
    }
    for t, (kind, value) in cases.items():
        assert [t[a:b] for a, b in pii.find(t).get(kind, [])] == [value], t
    assert pii.find("a token of thanks, https://x.org, account of it, 3.14") == {}
    assert pii.redact("mail a.b@c.de or +1 (017) 555-7713.") == "mail <EMAIL> or <PHONE>."
    assert pii.redact("none") == "none"


def test_pii_query(spark, docs, texts):
    got = queries.op1_pii(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        b = brute_pii(texts[r["doc_id"]])
        base = ",".join(f"{k}:{s}:{e}" for k in pii.BASE for s, e in b[k])
        assert [r[f"n_{k}"] for k in pii.BASE] == [len(b[k]) for k in pii.BASE]
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r["spans"].split(","))


def test_pii_odd(odd):
    assert pii.find_pii(odd).count() == odd.count()
    red = pii.redact_pii(odd)
    assert red.columns == odd.columns and red.where("text is null").count() == 1
    assert pii.find_pii(odd.limit(0)).count() == 0


# --- quality ----------------------------------------------------------------------------------


def brute_quality(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = Counter(zip(words, words[1:], words[2:]))
    inside = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(inside)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "cc", " ", " ", "\n", "\xa0", "#", "\x1c", "é "]), max_size=60).map("".join))
def test_measures(t):
    m = quality.measure(t)
    assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == brute_quality(t)


def brute_coverage(t, n):
    words = quality.words_of(t)
    grams = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    inside = {j for i in range(len(words) - n + 1) if grams[tuple(words[i : i + n])] > 1 for j in range(i, i + n)}
    return sum(len(words[i]) for i in inside) / max(1, sum(map(len, words)))


def test_coverage():
    rng = random.Random(2)
    for _ in range(40):
        t = " ".join(rng.choice("abc") for _ in range(rng.randint(1, 90)))
        m = quality.measure(t)
        for n in (5, 6, 8, 10):
            assert m.coverage.get(n, 0.0) == pytest.approx(brute_coverage(t, n))


def test_quality_query_and_labels(spark, texts):
    got = {r["doc_id"]: r for r in queries.op9_quality(spark, SF).collect()}
    assert set(got) == set(texts)
    for i, r in got.items():
        n, chars, symbols, dup, rep = brute_quality(texts[i])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, rep)
        assert r["base_failed"] == (n < 50 or 100 * rep > 50 * n) and not (r["base_failed"] and r["kept"])
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    fine = [got[x["doc_id"]]["kept"] for x in labels if x["quality"] == 1 and not got[x["doc_id"]]["base_failed"]]
    junk = [got[x["doc_id"]]["kept"] for x in labels if x["quality"] == 0]
    assert np.mean(fine) > 0.98 and np.mean(junk) < 0.1


def test_quality_odd(odd):
    assert quality.quality(odd).where("kept").count() == 0
    kept = quality.keep_quality(odd, quality.Rules(min_words=0, max_repeat_percent=100, coverage={}, mean_word=(0, 1e9)))
    assert kept.columns == odd.columns


# --- token counts and SentencePiece -----------------------------------------------------------

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["word", " ", "  ", "\n", "é", "日本", "x" * 40, "▁", "🙂", ". ", "a"]), max_size=60).map("".join), st.sampled_from([(24, 4), (64, 8), (200, 16)]))
def test_spliced_counts(t, sizes):
    e = tokencount.encoder_of(MODEL)
    assert tokencount.count_long(e, t, *sizes) == len(e.sp.encode(t))


def test_counts_query(spark, texts, odd):
    sp = tokencount.encoder_of(MODEL).sp
    for r in queries.op8_token_counts(spark, SF).collect():
        n = len(sp.encode(texts[r["doc_id"]]))
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(texts[r["doc_id"]].encode()), n > 4096)
    wanted = sorted(len(sp.encode(r["text"] or "")) for r in odd.collect())
    assert sorted(r["n_tokens"] for r in tokencount.count_tokens(odd, chunk=500, overlap=16).collect()) == wanted


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab é日\n  \t▁🙂<s>/0"), max_size=40))
def test_sentencepiece_parity(t):
    codec = spiece.codec_of(MODEL)
    flat, size, back = codec.batch([t])
    assert flat.tolist() == codec.sp.encode(t) and size.tolist() == [len(flat)]
    assert back == ["▁" not in t]


def test_sentencepiece_query(spark, texts, odd):
    sp = spiece.codec_of(MODEL).sp
    out = queries.op3_sentencepiece(spark, SF)
    for r in out.collect():
        assert r["ids"] == sp.encode(texts[r["doc_id"]]) and r["n_ids"] == len(r["ids"]) and r["round_trip"]
    back = {r["doc_id"]: r["text"] for r in spiece.decode(out).collect()}
    assert back == texts
    assert spiece.encode(odd).count() == odd.count()


def test_rebuilt_tokenizer_alone():
    proto = spiece.parse(open(MODEL, "rb").read())
    whole, sp = spiece.rebuild(proto), spiece.codec_of(MODEL).sp
    for t in ("Hello  world", "é日🙂", "a\nb", "x" * 300):
        assert whole.encode(t, add_special_tokens=False).ids == sp.encode(t)


# --- language ---------------------------------------------------------------------------------


def test_language_held_out(spark, docs):
    held = remainder(F.col("doc_id"), 4) == 2
    model = langid.fit(docs, ~held)
    got = langid.identify(docs, model, held).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.9 and all(0 <= r["score"] <= 1 for r in got)
    by = {r["lang"]: r["text"] for r in docs.where("length(text) > 800").collect()}
    names, score, sets = model.predict([by["en"][:600] + " " + by["de"][:600], by["en"], "123 !?", ""])
    assert names[1] == "en" and names[2:] == ["und", "und"] and score[2] == 0 and {x.split(":")[0] for x in sets[0].split(",")} == {"en", "de"}
    assert 0.3 < score[0] < 0.7


def test_language_odd(odd, docs):
    model = langid.fit(odd, F.lit(True))
    assert model.languages == ("en",)
    got = langid.identify(odd, model, F.lit(True)).collect()
    assert len(got) == odd.count() and sum(r["lang_pred"] == "und" for r in got) >= 4
    nothing = langid.fit(odd, F.lit(False))
    assert {r["lang_pred"] for r in langid.identify(odd, nothing, F.lit(True)).collect()} == {"und"}
    assert langid.keep_identified(odd, model).columns == odd.columns


# --- pages ------------------------------------------------------------------------------------


def test_pages_query(spark):
    html = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op10_html_text(spark, SF).collect():
        inner = html[r["page_id"]].split("<article>")[1].split("</article>")[0].replace("<br>", " ")
        blocks = (" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


PAGE = """<html><body class="sidebar-left"><header><h1>Site</h1></header><div class="cookie-notice">We use cookies, many of them, really.</div>
<div id="content"><h2>Title here</h2><p>First paragraph, with commas, and enough text to count as one.</p>
<div class="advert">Buy now, this is an advert with quite some text in it.</div>
<p>Second &amp; last&nbsp;paragraph, long enough to count as well, I hope.</p><ul><li>point one</li><li>point two</li></ul>
<form><input>Subscribe to our letter, please, it is free.</form></div>
<aside>Related: <a href=x>one, two, three, four, five</a></aside><div class="comments"><p>Nice article, I liked it, thank you very much.</p></div><footer>(c) us</footer></body></html>"""


def test_page_parts():
    assert htmltext.main_text(PAGE) == (
        "Title here\n\nFirst paragraph, with commas, and enough text to count as one.\n\n"
        "Second & last paragraph, long enough to count as well, I hope.\n\npoint one\n\npoint two"
    )
    assert htmltext.main_text("<article><p>Short.</p></article><p>x") == "Short."
    assert htmltext.main_text("<p>a < b<p>c<script>var x='</p>'") == "a < b\n\nc"
    assert htmltext.main_text("") == "" and htmltext.main_text("<nav>menu</nav>") == ""
    assert htmltext.main_text("<div>" * 3000 + "deep text that is long enough, yes" + "</div>" * 3000) == "deep text that is long enough, yes"


def test_pages_odd(spark):
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (2, "u", "", "x"), (None, "u", "<p>hello there, this is text.", "x")]
    got = htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted(r["text"] for r in got) == ["", "", "", "hello there, this is text."]


# --- values of any length, attributes, mixtures -----------------------------------------------


def test_values_of_any_length():
    value = "a1" * 400
    jwt = "eyJ0" + "aB3_-." * 300 + "x"
    cases = {
        f"token={value} end": ("secret", value),
        f'token = "{value}" end': ("secret", value),
        f"PassWord: {jwt} end": ("secret", jwt),
        f"see https://{'u' * 300}:pw@host.org/x now": ("url", f"https://{'u' * 300}:pw@host.org/x"),
        "svn+ssh://bob@host.org": ("url", "svn+ssh://bob@host.org"),
        f"account: {'1234' * 20}.": ("account", "1234" * 20),
        "AcCount: 12345678": ("account", "12345678"),
        "pay DE89 3704 0044 0532 0130 00 NOW": ("iban", "DE89 3704 0044 0532 0130 00"),
    }
    for t, (kind, found) in cases.items():
        assert [t[a:b] for a, b in pii.find(t).get(kind, [])] == [found], t
    assert pii.redact(f"token={value} end") == "token=<SECRET> end"
    assert pii.find("XDE89370400440532013000 DE89370400440532013001").get("iban") is None
    long = "token=" * 100_000  # linear, whatever the text
    assert pii.find(long) == {}


KEPT = ['title="a hidden gem"', 'data-id="ad-17"', 'data-role="search"', 'data-style="display:none"', 'data-class="related"', 'class="post side-by-side"', 'id="notice-of-award"']
LEFT = ['class="ad"', "class=site-footer", "id='cookie-bar'", "hidden", 'role="search"', 'style="color:red;display: none"', 'class="post sidebar"', 'aria-hidden="true"']


@pytest.mark.parametrize("attributes", KEPT)
def test_attributes_that_say_nothing(attributes):
    page = f"<article><p>First paragraph, long enough to count, with commas.</p><p {attributes}>Second paragraph, which is part of the text.</p></article>"
    assert "Second paragraph" in htmltext.main_text(page)


@pytest.mark.parametrize("attributes", LEFT)
def test_attributes_that_leave_out(attributes):
    page = f"<article><p>First paragraph, long enough to count, with commas.</p><div {attributes}>Second paragraph, which is no part of the text.</div></article>"
    assert "Second paragraph" not in htmltext.main_text(page)


def test_deep_nesting():
    """A paragraph below a hundred open elements is ended by the next one; a long nest takes no time."""
    page = "<article><p>One, two, three, four, five, six.<b><i>" + "<span>" * 100 + "seven<p>eight, nine, ten, eleven, twelve</article>"
    assert htmltext.main_text(page).split("\n\n") == ["One, two, three, four, five, six.seven", "eight, nine, ten, eleven, twelve"]
    assert htmltext.main_text("<div>" * 50_000 + "deep down, there is a text" + "</div>" * 50_000) == "deep down, there is a text"


def brute_mixture(model, text):
    """The chosen languages' shares by plain loops: EM from equal shares, then every set that the order of the shares gives."""
    import math

    buckets, words, _ = langid.features([text])
    edges = [*words, len(buckets)]
    like = [[sum(float(model.table[b, k]) for b in buckets[a:z]) for k in range(len(model.languages))] for a, z in zip(edges, edges[1:])]
    n = len(like)

    def em(langs):
        pi = {k: 1 / len(langs) for k in langs}
        for _ in range(langid.ROUNDS):
            total = dict.fromkeys(langs, 0.0)
            for row in like:
                top = max(row)
                r = {k: math.exp(row[k] - top) * pi[k] for k in langs}
                z = sum(r.values())
                for k in langs:
                    total[k] += r[k] / z
            pi = {k: v / n for k, v in total.items()}
        fit = sum(max(row) + math.log(sum(math.exp(row[k] - max(row)) * pi[k] for k in langs)) for row in like)
        return pi, fit

    everything = range(len(model.languages))
    order = sorted(everything, key=lambda k: -em(list(everything))[0][k])
    best = max(everything, key=lambda k: sum(row[k] for row in like))
    value, shares = sum(row[best] for row in like), {best: 1.0}
    for size in range(2, len(order) + 1):
        pi, fit = em(order[:size])
        if fit - (size - 1) * math.log(n + 1) > value:
            value, shares = fit - (size - 1) * math.log(n + 1), pi
    return shares


def test_mixture_equals_plain_loops(spark, docs):
    model = langid.fit(docs, remainder(F.col("doc_id"), 4) != 2)
    by = {}
    for r in docs.where("length(text) between 50 and 3000").select("lang", "text").orderBy("doc_id").collect():
        by.setdefault(r["lang"], []).append(r["text"])
    assert len(by) >= 3
    texts = [t[0] for t in by.values()] + [" ".join(t[0] for t in by.values())]  # the last one in every language
    names, score, sets = model.predict(texts)
    for t, name, value, chosen in zip(texts, names, score, sets):
        shares = brute_mixture(model, t)
        assert model.languages[max(shares, key=shares.get)] == name and value == pytest.approx(min(1.0, max(shares.values())), abs=1e-6)
        assert {x.split(":")[0] for x in chosen.split(",")} == {model.languages[k] for k, v in shares.items() if v > 1e-4}
    assert sets[-1].count(":") >= len(by)


@pytest.mark.parametrize("empty", ["quality", "tokencount", "spiece", "langid", "htmltext", "pii"])
def test_empty_tables(spark, docs, empty):
    none = docs.limit(0)
    made = {
        "quality": lambda: quality.quality(none),
        "tokencount": lambda: tokencount.count_tokens(none),
        "spiece": lambda: spiece.encode(none),
        "langid": lambda: langid.identify(none, langid.fit(none, F.lit(True)), F.lit(False)),
        "htmltext": lambda: htmltext.extract(spark.createDataFrame([], "page_id long, url string, html string")),
        "pii": lambda: pii.find_pii(none),
    }
    assert made[empty]().count() == 0
