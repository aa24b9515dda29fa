import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import documents

from metricforge.llm import sharding, toxicity, warc


@pytest.mark.parametrize("blocks", [sharding.DIGITS, 1])
def test_interleaving(spark, monkeypatch, blocks):
    monkeypatch.setattr(sharding, "DIGITS", blocks)
    monkeypatch.setattr(sharding, "BLOCKS", 16 ** blocks)
    docs = documents(spark, clash=True, dirty_ids=True).unionByName(documents(spark, clash=True)).repartition(5)
    rows = docs.collect()
    out = sharding.interleave(docs, 7).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in out if r["doc_id"] is not None) == sorted(
        (r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode()))
        for r in rows if r["doc_id"] is not None)
    assert len(out) == len(rows)
    sizes = Counter(r["shard"] for r in out)
    assert set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mixture = Counter((r["shard"], r["source"]) for r in out)
    for source, n in Counter(r["source"] for r in rows).items():
        assert all(abs(mixture[s, source] - n / 7) < 2.5 for s in range(7))
    # The same rows in another order fall into the same places.
    again = sharding.interleave(docs.repartition(2, "text"), 7).collect()
    key = lambda x: sorted((str(r["doc_id"]), r["text_crc32"], r["size"], r["shard"], r["slot"]) for r in x)
    assert [k[0:3] for k in key(again)] == [k[0:3] for k in key(out)]


def test_interleaving_many_small_sources_and_none(spark):
    docs = spark.range(500).selectExpr("id AS doc_id", "'t' AS text", "concat('s', id) AS source")
    sizes = Counter(r["shard"] for r in sharding.interleave(docs, 9).collect())
    assert sorted(sizes.values()) == [55] * 4 + [56] * 5
    assert sharding.interleave(documents(spark, []), 7).count() == 0
    assert sorted(r["shard"] for r in sharding.interleave(documents(spark, ["a", "b"]), 7).collect()) == [0, 3]


PAGES = [
    (1, "http://a/x?p=1&q=2", '<!DOCTYPE html><HTML lang="DE"><head><title>Ein &amp; \n Zwei</title><style>p{}</style>'
     '</head><body><script type="x">var t="</p>";</script><!-- <p>no</p> --><h1>Kopf</h1><p>Eins<br>zwei <b>drei</b>'
     '&nbsp;&lt;vier&gt;<a href="/f&amp;g">fünf</a><ul><li>a<li>b</ul> &amp;lt; </body></html>'),
    (2, None, None), (3, "u", ""), (3, "u", ""), (None, "n", "plain text"), (4, "v", "<p>" + "wort " * 20000),
    (5, "w", "<title>only"), (6, "it's", "<script>never closed"),
]


def test_warc_derivatives(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'x' AS block",
                                                                                            "1 AS head")
    source = warc.responses(pages, "2024-01-01T00:00:00Z")
    out = warc.record_bytes(warc.derive(source)).collect()
    assert len(out) == 2 * len(PAGES)
    by_id = {r["record_id"]: r for r in source.collect()}
    for r in out:
        src = by_id[r["refers_to"]]
        assert src["payload_digest"] == r["payload_digest"] == "sha256:" + hashlib.sha256(src["payload"].encode()).hexdigest()
        assert r["block_digest"] == "sha256:" + hashlib.sha256(r["block"].encode()).hexdigest()
        assert r["content_length"] == len(r["block"].encode())
        head, block = bytes(r["record"]).split(b"\r\n\r\n", 1)
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert fields["WARC-Refers-To"] == src["record_id"] and fields["WARC-Type"] == r["warc_type"]
        assert fields["WARC-Record-ID"] == r["record_id"] and fields.get("WARC-Target-URI") == src["target_uri"]
        assert fields["WARC-Block-Digest"] == r["block_digest"]
        assert block == r["block"].encode() + b"\r\n\r\n"
        assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}-[0-9a-f]{4}-8[0-9a-f]{3}-a[0-9a-f]{3}-[0-9a-f]{12}>", r["record_id"])
    text = {r["page_id"]: r["block"] for r in out if r["warc_type"] == "conversion"}
    assert text[1] == "Kopf\nEins\nzwei drei <vier>fünf\na\nb\n&lt;"
    assert (text[2], text[3], text[None], text[5]) == ("", "", "plain text", "only")
    assert text[4] == ("wort " * 20000).strip()
    meta = {r["page_id"]: r["block"] for r in out if r["warc_type"] == "metadata"}
    lines = meta[1].split("\r\n")
    assert lines[:3] == ["http-status: HTTP/1.1 200 OK", "http-header: Content-Type: text/html; charset=utf-8",
                         f"http-header: Content-Length: {len(PAGES[0][2].encode())}"]
    assert lines[5:7] == ["title: Ein & Zwei", "languageOfContent: de"]
    assert meta[1].endswith("outlink: /f&g\r\n")
    for r in out:
        src = by_id[r["refers_to"]]
        whole = (src["http_head"] + src["payload"]).encode()
        assert r["source_digest"] == src["block_digest"] == "sha256:" + hashlib.sha256(whole).hexdigest()
        head = r["head"].split("\r\n")
        assert f"WARC-Refers-To-Block-Digest: {src['block_digest']}" in head
        assert "WARC-Refers-To-Content-Type: text/html; charset=utf-8" in head
        if r["warc_type"] == "metadata":
            assert f"sourceBlockDigest: {src['block_digest']}\r\n" in r["block"]
            assert f"sourcePayloadDigest: {src['payload_digest']}\r\n" in r["block"]
    assert len({r["record_id"] for r in out}) == 2 * len(set(PAGES))
    assert warc.derive(warc.responses(pages.limit(0), "d")).count() == 0


@pytest.mark.parametrize("html,text", [
    ("3 < 5 and 7 > 2", "3 < 5 and 7 > 2"),
    ("a <b>b</b> <1 <> c<", "a b <1 <> c<"),
    ("&eacute;&#8217;&#x41;&#X42;&nope;&amp &amp;amp; &#0;&#xD800;&#99999999; &#150;&nbsp;z", "é’AB&nope;&amp &amp; ��� – z"),
    ("<script>a</style>b</p>c</script >d<STYLE x>e</style\n>f", "df"),
    ("<script>never closed <p>x", "never closed\nx"),
    ("<!-- <script> -->shown<noscript>no</noscript><!DOCTYPE x><?pi?>", "shown"),
    ("<headline>one</headline><header>two</header><textarea>3</textarea>", "one\ntwo\n3"),
    ("  a \t b\u00a0\r\n \n\n  c  ", "a b\nc"),
])
def test_page_text(html, text):
    assert warc.plain_text(html) == text


def test_links_and_fields():
    html = ("<a href=/plain>1</a><A class=x HREF = '/q?a=1&amp;b=2'>2</a><a data-href=no>3</a><a href=\"\">4</a>"
            "<a\nhref=\" /with space\n\">5</a><area href=no><a id=z\thref=/t>6</a>")
    assert warc.outlinks(html) == ["/plain", "/q?a=1&b=2", "/with space", "/t"]
    block = warc.metadata("<title>a<b>b &lt;</title>", "HTTP/1.1 404 Not Found\r\nX-A: b: c\r\n\r\n", "p", "q")
    assert block.split("\r\n") == [
        "http-status: HTTP/1.1 404 Not Found", "http-header: X-A: b: c", "sourcePayloadDigest: p", "sourceBlockDigest: q",
        "title: a<b>b <", "languageOfContent: ", "contentLength: 25", ""]


def toxic_table(spark, n=1200, seed=1):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 7)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(r.randint(20, 1500 if i % 40 == 0 else 120))]
        bad = i % 6 == 0
        if bad:
            for _ in range(r.randint(1, 8)):
                words.insert(r.randint(0, len(words)), r.choice(["xidiot", "ztrash", "wquux" + word()]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return (spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_toxicity_on_held_out_documents(spark):
    docs, labels = toxic_table(spark)
    model = toxicity.fit(docs, labels.where("doc_id < 900"))
    assert (np.diff(model.thresholds) > 0).all()
    out = toxicity.score(docs.where("doc_id >= 900"), model).collect()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    wrong = sum(r["__mf_rejected"] != bool(truth[r["doc_id"]]) for r in out)
    assert wrong <= 0.03 * len(out)
    for r in out:
        p = r["__mf_grades"]
        assert len(p) == toxicity.GRADES and abs(sum(p) - 1) < 1e-9 and min(p) >= 0
        assert abs(r["__mf_severity"] - sum(k * x for k, x in enumerate(p))) < 1e-9
    # More telling words, more severe.
    one, many = (toxicity.score(spark.createDataFrame([(1, "abc " + "xidiot " * k)], "doc_id long, text string"),
                                model).first()["__mf_severity"] for k in (1, 6))
    assert many > one


def test_cumulative_link_gradient():
    r = np.random.default_rng(0)
    n, width = 200, 5
    x = r.poisson(0.7, (n, width)).astype(float)
    score = x @ np.array([1.5, -1, 0.5, 0, 0])
    grade = np.searchsorted([0.2, 1.0, 2.2], score + r.logistic(size=n) * 0.3)
    row, column = np.nonzero(x)
    w, theta = toxicity.fit_cumulative_link(row, column, x[row, column], grade, width, rounds=800)
    p = toxicity._probabilities(x @ w, theta)
    assert (np.diff(theta) > 0).all() and np.abs(p @ np.arange(4) - grade).mean() < 0.5
    assert w[0] > w[2] > 0 > w[1]


def test_toxicity_of_awkward_tables(spark):
    docs = documents(spark, clash=True, dirty_ids=True)
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, None), (None, 1), (3, 0), (4, 0), (10**9, 1)],
                                   "doc_id long, toxic int")
    for table in (labels, labels.limit(0), labels.where("toxic = 0")):
        out = toxicity.score(docs, toxicity.fit(docs, table))
        assert out.columns[:-3] == docs.columns and out.count() == docs.count()
    assert out.where("__mf_rejected").count() == 0
    none = documents(spark, [])
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0


def test_scores_and_grades_equal_plain_ones(spark):
    docs, labels = toxic_table(spark, 600, seed=4)
    model = toxicity.fit(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    ids = sorted(texts)

    def plain(text):
        words = re.findall(r"[^\W\d_]+", text.lower())
        held = [f"={w}" for w in words] + [w[:k] for w in words for k in (4, 5, 6) if len(w) > k]
        return words, Counter(held)

    held = {i: plain(texts[i]) for i in ids}
    # The terms: smoothed odds above 8 in three documents and more.
    bad, good = sum(toxic.values()), len(ids) - sum(toxic.values())
    seen = {t: [sum(t in held[i][1] for i in ids if toxic[i] == k) for k in (1, 0)] for t in {t for i in ids for t in held[i][1]}}
    odds = {t: (a + 0.5) / (bad + 1) / ((b + 0.5) / (good + 1)) for t, (a, b) in seen.items() if a + b >= 3}
    assert set(model.vocabulary) == {t for t, x in odds.items() if x > 8}
    # The grades: thirds of the share of strongly telling terms.
    dense = {i: sum(n for t, n in held[i][1].items() if odds.get(t, 0) > 20) / len(held[i][0]) for i in ids}
    low, high = np.quantile([dense[i] for i in ids if toxic[i]], [1 / 3, 2 / 3])
    grade = np.array([toxic[i] * (1 + (dense[i] > low) + (dense[i] > high)) for i in ids])
    x = np.zeros((len(ids), len(model.vocabulary)))
    for k, i in enumerate(ids):
        for t, n in held[i][1].items():
            if t in model.vocabulary:
                x[k, model.vocabulary[t]] = n * 300 / (len(held[i][0]) + 100)
    row, column = np.nonzero(x)
    w, theta = toxicity.fit_cumulative_link(row, column, x[row, column], grade, x.shape[1])
    assert np.allclose(w, model.weights, atol=1e-6) and np.allclose(theta, model.thresholds, atol=1e-6)
    # The scores, from the rates.
    above = 1 / (1 + np.exp(-(x @ model.weights)[:, None] + model.thresholds[None, :]))
    for r in toxicity.score(docs, model).collect():
        mine = np.append(1, above[ids.index(r["doc_id"])]) - np.append(above[ids.index(r["doc_id"])], 0)
        assert np.allclose(r["__mf_grades"], mine, atol=1e-9)
        assert abs(r["__mf_severity"] - mine @ np.arange(4)) < 1e-9 and r["__mf_rejected"] == (mine[0] < 0.5)


def test_training_grades_do_not_turn_with_length():
    r = np.random.default_rng(3)
    toxic, telling, words = r.integers(0, 2, 300), r.integers(1, 30, 300), r.integers(20, 900, 300)
    once = toxicity.training_grades(toxic, telling, words)
    factor = r.integers(1, 9, 300)
    assert (toxicity.training_grades(toxic, telling * factor, words * factor) == once).all()
    assert set(once[toxic == 1]) == {1, 2, 3} and set(once[toxic == 0]) == {0}


def test_shards_of_rows_without_ids(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS", 16)
    rows = [(None, f"text {i % 700}", "s0") for i in range(900)] + [(None, "same", "s1")] * 300 + [(7, "same", "s1")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    out = sharding.interleave(docs, 11).collect()
    sizes = Counter(r["shard"] for r in out)
    assert len(out) == 1250 and max(sizes.values()) - min(sizes.values()) <= 1
    for source, n in (("s0", 900), ("s1", 350)):
        per = Counter(r["shard"] for r in out if r["source"] == source)
        assert all(abs(per[k] - n / 11) < 2.5 for k in range(11))
    assert Counter((r["doc_id"], r["text_crc32"]) for r in out) == Counter((i, zlib.crc32(t.encode())) for i, t, _ in rows)
