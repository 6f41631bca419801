import random

from filigree.llm import html_extract as h

PAGE = "<html><nav><a>home</a><a>news</a></nav><article><p>one two three four five<p>six &amp; seven</article><footer><a>x</a></footer></html>"


def test_best_region_is_the_best_of_all():
    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.randrange(-6, 6) for _ in range(rng.randrange(12))]
        sums = [(sum(scores[a:b]), a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)]
        first, end, best = h.best_region(scores)
        assert best == max([0, *(s for s, _, _ in sums)])
        assert sum(scores[first:end]) == best


def test_extract_with_fitted_weights(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "<p></p>"), (4, "<p></p>"), (None, PAGE), (5, "plain words only")], "page_id long, html string")
    weight = h.fit(pages)
    assert weight[h.WORDS] > 0 > weight["nav"]
    rows = sorted(h.extract(pages.selectExpr("*", "'x' as score"), weight).collect(), key=lambda r: (r["page_id"] is None, r["page_id"], r["content"]))
    assert len(rows) == 7
    assert rows[0]["content"].startswith("one two three four five") and "seven" in rows[0]["content"] and "home" not in rows[0]["content"]
    for r in rows[1:5]:
        assert (r["first_token"], r["end_token"], r["score"], r["content"]) == (0, 0, 0, "")
    assert rows[5]["content"] == "plain words only"


def test_no_pages_and_no_labelled_pages(spark):
    none = spark.createDataFrame([], "page_id long, html string")
    assert h.fit(none) == {}
    assert h.extract(none, {}).collect() == []
    assert h.extract_page("<div>a b c</div>", {})[3] == "a b c"


def test_very_long_page():
    first, end, score, text = h.extract_page("<div>" * 20_000 + "word " * 50_000 + "</div>" * 20_000, {h.WORDS: 100})
    assert text.count("word") == 50_000


def test_unclosed_comment_and_script():
    assert h.extract_page("a b<!-- c d", {})[3] == "a b"
    assert h.extract_page("a b<script>c d", {})[3] == "a b"
