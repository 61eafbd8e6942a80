"""URL filter, license scan and quality classifier."""

import re

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tidemill.llm import license_scan as L
from tidemill.llm import quality as Q
from tidemill.llm import queries
from tidemill.llm import url_filter as U


def test_url_rules_against_brute_force(spark):
    urls = ["https://example.com/en/1", "http://WWW.Example.COM/en/x?y", "http://a.example.com/en/", "http://example.com/EN/",
            "http://x.net/es/1", "http://net/fr/", "http://net/frx", "http://notcom/", "http://a.com", "ftp://a.com/#/", "http://a.org/ads/1",
            "http://a.org/ADS/1", "http://a.org/x/banner", "http://a.org/xbanner", "http://a.net/fr/://b.com/", "no scheme.com/", "", None,
            "http://example.com:80/en/", "http://a.org/tag/z/page/2", "http://a.org/porn/1.jpg", "http://é.com/en/é"]
    rows = [(i, u, "clash") for i, u in enumerate(urls)] + [(None, urls[0], "clash"), (3, urls[3], "clash"), (3, urls[3], "clash")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, target string")
    got = sorted(map(tuple, U.filter_urls(df, queries.URL_RULES).collect()), key=repr)

    def want(page_id, url):
        url = url or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
        fit = []
        for r in queries.HOST_RULES:
            h, p = r.rule.split("/", 1)
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fit.append((len(r.rule), r.rule, r.action))
        if fit:
            _, rule, action = max(fit)
            return page_id, host, path, rule, action, None
        pats = [(len(r.rule), r.rule, r.action) for r in queries.URL_PATTERNS if re.search(r.regex(), host + path)]
        return (page_id, host, path, None, max(pats)[2], max(pats)[1]) if pats else (page_id, host, path, None, "allow", None)

    assert got == sorted((want(i, u) for i, u, _ in rows), key=repr)


def test_rules_are_filed_under_their_rarest_whole_token(spark):
    rule = U.UrlRule("example.com/en/", "block")
    assert rule.tokens() == ["com", "en", "example"]
    assert U.UrlRule("/foo*bar^", "block", "pattern").tokens() == []   # both may stand inside longer words
    assert U.UrlRule("abc/def/", "block", "pattern").tokens() == ["def"]
    df = spark.createDataFrame([("com",)] * 3 + [("example",), ("en",), ("en",)], "t string")
    keys = df.selectExpr("array(t) AS tokens")
    assert [r.token for r in U.rarest_token_index(keys, [rule]).collect()] == ["example"]


def test_url_filter_empty_table(spark):
    df = spark.createDataFrame([], "page_id bigint, url string")
    assert U.filter_urls(df, queries.URL_RULES).count() == 0


def _base(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    hits = []
    for label, p in (("cc-by", ["cc", "by"]), ("gpl", ["general", "public", "license"]), ("reserved", ["all", "rights", "reserved"])):
        hits += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    at = [i for i, _ in hits]
    return len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def test_license_base_phrases_and_edges(spark):
    texts = ["All Rights Reserved", "cc-by cc by CC/BY by cc", "xcc by", "the GNU General Public License version 3, all rights reserved.",
             "cc by cc by cc by", "", None, "  \n", "general public licensé", "CC BY-NC-SA 4.0", "é all rights  reserved é",
             "word " * 30_000 + "all rights reserved " + "cc by " * 500, "Apache License v 2 0 apache license"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "cc by", 1), (1, texts[1], 1)],
                               "doc_id bigint, text string, words_ int")
    got = {r.doc_id: r for r in L.scan_licenses(df).collect()}
    assert L.scan_licenses(df).count() == len(texts) + 2
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == _base(t), t
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert got[None].base_labels == "cc-by"
    assert got[3].labels == "gpl,gpl-3,reserved"          # the name inside the versioned name is suppressed, the base stays
    assert got[9].labels == "cc-by,cc-by-nc-sa"
    assert got[12].labels == "apache,apache-2.0"
    assert got[6].labels == "" and got[6].score == 0.0 and got[6].first_word is None


def test_license_rules_are_many_and_gated():
    rules = L.signature_rules()
    assert len(rules) > 300
    assert all(f" {r.keyword} " in r.regex or r.keyword in r.regex for r in rules)


def test_quality_separates_labelled_documents_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    train, test = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    out = Q.classify(docs, train).join(test, "doc_id").toPandas()
    assert (out.kept == (out.quality == 1)).mean() > 0.95
    assert out[out.quality == 1].kept.mean() > 0.97
    again = Q.classify(docs, train).join(test, "doc_id").toPandas()
    assert out.sort_values("doc_id").gumbel_key.tolist() == again.sort_values("doc_id").gumbel_key.tolist()


def test_quality_keep_good_agrees_with_classify_and_edges(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None, None), (None, ""), (900001, "x"), (900001, "x"), (900002, "!? " * 50_000)], "doc_id bigint, text string")
    docs = docs.union(odd).selectExpr("doc_id", "text", "1 AS good", "'a' AS log_weight")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").union(spark.createDataFrame([(None, 1, 0), (1, None, 0)], "a bigint, b int, c int"))
    marked = Q.classify(docs, labels)
    assert marked.count() == docs.count()
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    want = sorted((r.doc_id for r in marked.where("kept").collect()), key=str)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == want
    assert Q.classify(docs, labels.limit(0)).where("kept").count() == docs.count()     # no labels: all stay
    assert Q.classify(docs.limit(0), labels).count() == 0
    assert Q.keep_good(docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("k", [0, 1, 2, 77, 199, 200, 500])
def test_kth_largest(spark, k):
    v = np.round(np.random.default_rng(k).normal(size=200) * 1e3, 1)
    v[:20] = v[0]
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    got = Q.kth_largest(df, "v", k)
    assert got == (float("inf") if k == 0 else np.sort(v)[::-1][min(k, 200) - 1])


def test_best_cut():
    assert Q.best_cut(np.array([-9.0, -8, 1, 2]), np.array([0, 0, 1, 1])) == -3.5
    assert Q.best_cut(np.array([1.0, 2]), np.array([1, 1])) == -np.inf
