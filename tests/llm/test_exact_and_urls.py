import hashlib
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import exact_dedup, url_filter

DOCS = "doc_id long, text string, _id string, length string, _gone string, slot string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "x", "x", "x") for i, t in rows], DOCS)


ROWS = [
    (5, "a  b"), (2, "a\tb"), (9, "a b"), (3, None), (1, ""), (4, "a b "), (7, "once"), (7, "once"),
    (None, "lost"), (6, "long " * 40_000), (8, "long " * 40_000), (10, "z" * 200 + "1"), (11, "z" * 200 + "2"),
]


def test_groups_equal_brute_force(spark):
    found = {}
    for r in exact_dedup.exact_groups(_docs(spark, ROWS), carry={"sha": exact_dedup.text_sha256(__import__("pyspark").sql.functions.col("text"))}).collect():
        found.setdefault((r.doc_id, r.sha), []).append((r.keep_id, r.group_size, r.kept))
    groups = {}
    for i, t in ROWS:
        sha = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()
        groups.setdefault(sha, []).append(i)
    assert sum(map(len, found.values())) == len(ROWS)
    for (i, sha), rows in found.items():
        ids = groups[sha]
        keep = min((x for x in ids if x is not None), default=None)
        assert all(r[:2] == (keep, len(ids)) for r in rows)
        assert sum(r[2] for r in rows) == (i == keep)


def test_one_row_of_each_group_stays_with_its_columns(spark):
    docs = _docs(spark, ROWS)
    left = exact_dedup.one_row_of_each(docs)
    assert left.columns == docs.columns
    expected = docs.select(exact_dedup.text_sha256(F.col("text"))).distinct().count()
    assert left.count() == left.select(exact_dedup.text_sha256(F.col("text"))).distinct().count() == expected


def test_one_row_of_each_text(spark):
    rows = [*ROWS, (9, "its own text")]
    left = exact_dedup.one_row_of_each(_docs(spark, rows))
    assert left.columns == _docs(spark, []).columns
    # the repeated row leaves one; 9 loses the copy, not its other text
    found = sorted((r.doc_id, r.text) for r in left.collect() if r.doc_id)
    assert [i for i, _ in found] == [1, 2, 4, 6, 7, 9, 10, 11] and (9, "its own text") in found
    assert exact_dedup.one_row_of_each(_docs(spark, [])).count() == 0


def test_empty_table(spark):
    assert exact_dedup.exact_groups(_docs(spark, [])).count() == 0


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("example.org/es/1", "", "", None, "allow"),
        ("http://A.Example.ORG/es/1?x#y", "a.example.org", "/es/1", "example.org/es/", "block"),
        ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("http://x.org?porn", "x.org", "", None, "block"),
        ("http://x.com/de/", "x.com", "/de/", "com/de/", "block"),
        ("http://x.com/fr/porn", "x.com", "/fr/porn", "com/fr/", "allow"),
        ("http://x.net/porn", "x.net", "/porn", None, "block"),
        ("http://x.net/pornographer", "x.net", "/pornographer", None, "allow"),
        ("http://casino.net/poker-bonus", "casino.net", "/poker-bonus", None, "block"),
        ("http://casino.net/casino", "casino.net", "/casino", None, "allow"),
        ("http://x.net/cheap-free", "x.net", "/cheap-free", None, "allow"),
        ("a://b://c", "b:", "//c", None, "allow"),
    ],
)
def test_urls(spark, url, host, path, rule, verdict):
    assert url_filter.split_url(url) == (host, path)
    pages = spark.createDataFrame([(1, url, "h")] * 2, "page_id long, url string, host string")
    rows = url_filter.judge_urls(pages).collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [(host, path, rule, verdict)] * 2


def test_terms_against_a_plain_search():
    terms = url_filter.automaton(url_filter.VOCABULARY)
    for text in ("xxx xxx", "sex.sexy/sex", "http://nude-nudes.com", "wwwxxxwww", "adult1 adult"):
        words = re.findall(r"[a-z0-9]+", text)
        strict = sum(w in url_filter.STRICT_TERMS for w in words)
        soft = {w for w in words if w in url_filter.SOFT_TERMS}
        assert url_filter.term_hits(text, terms)[:2] == (strict, len(soft))


def test_no_pages(spark):
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
