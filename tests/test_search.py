import math

from reelrank.operators import search
from tests import fixtures as fx


def bm25_python(titles: dict, query: str, k1=1.2, b=0.75):
    import re

    def toks(s):
        return [t for t in re.split(r"[^\w]+|_", s.lower()) if t]
    docs = {i: toks(t) for i, t in titles.items() if toks(t)}
    n = len(docs)
    avgdl = sum(len(d) for d in docs.values()) / n
    out = {}
    for i, d in docs.items():
        s = 0.0
        for t in toks(query):
            tf = d.count(t)
            if tf:
                nt = sum(1 for x in docs.values() if t in x)
                idf = math.log(1 + (n - nt + 0.5) / (nt + 0.5))
                s += idf * tf / (tf + k1 * (1 - b + b * len(d) / avgdl))
        if s > 0:
            out[i] = round(s, 6)
    return sorted(out.items(), key=lambda kv: (-kv[1], kv[0]))


TITLES = {1: "The Red Balloon", 2: "Red Red Wine", 3: "Blue Velvet", 4: "The Blue Angel",
          5: "Red", 6: "Éclair de Lune", 7: "the red balloon"}


def test_bm25_matches_brute_force(spark):
    it = fx.items(spark, [(i, t, set()) for i, t in TITLES.items()])
    for q in ["red balloon", "RED", "the blue", "éclair", "nothing here", "red red"]:
        qs = spark.createDataFrame([(q,)], "query string")
        got = [(r.movieId, r.score) for r in
               search.title_search(it, qs, k=10).orderBy("rank").collect()]
        assert got == bm25_python(TITLES, q), q


def test_recommend_by_title_counts_raters_lists(spark):
    it = fx.items(spark, [(1, "alpha", set()), (2, "beta", set()), (3, "gamma", set())])
    r = fx.ratings(spark, [(10, 1, 5, 1), (11, 1, 4, 1), (12, 2, 3, 1)])
    stored = spark.createDataFrame([(10, 2), (10, 3), (11, 3), (12, 1)], "userId long, movieId long")
    qs = spark.createDataFrame([("Alpha",), ("zzz",)], "query string")
    out = search.recommend_by_title(it, qs, r, stored, k=10).orderBy("rank").collect()
    assert [(x.query, x.movieId, x.n_users) for x in out] == [("Alpha", 3, 2), ("Alpha", 2, 1)]


def test_pruned_search_equals_brute_force_on_skewed_random_titles(spark):
    import random

    rnd = random.Random(3)
    vocab = ["the"] * 30 + ["red"] * 8 + ["blue"] * 5 + ["night"] * 3 + ["day", "sun", "moon", "war", "love"]
    titles = {i: " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 4))) for i in range(1, 301)}
    it = fx.items(spark, [(i, t, set()) for i, t in titles.items()])
    qs = ["the", "the red", "red the night", "the the", "moon", "love war the", "sun day"]
    got = search.title_search(it, spark.createDataFrame([(q,) for q in qs], "query string"), k=7).collect()
    by_q = {}
    for r in got:
        by_q.setdefault(r.query, []).append((r.rank, r.movieId, r.score))
    for q in qs:
        mine = [(m, s) for _, m, s in sorted(by_q.get(q, []))]
        assert mine == bm25_python(titles, q)[:7], q


def test_common_word_query_reads_only_class_heads(spark):
    import random

    rnd = random.Random(5)
    words = ["the"] * 6 + ["red", "blue", "night", "day", "sun", "moon"]
    titles = {i: " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 3))) for i in range(1, 401)}
    it = fx.items(spark, [(i, t, set()) for i, t in titles.items()])
    k = 3
    _, postings = search.title_shapes(it, k)
    weights, doc_freq = search.term_weights(postings)
    qs = spark.createDataFrame([("the",)], "query string")
    cand, _ = search.title_candidates(postings, weights, doc_freq, qs, k)
    the_postings = postings.filter("token = 'the'")
    classes = the_postings.select("tf", "dl").distinct().count()
    assert cand.count() <= k * classes < the_postings.count()


def test_blocks_below_the_floor_are_not_read(spark):
    import random

    rnd = random.Random(8)
    common, k = ["alpha", "beta", "gamma", "delta"], 5
    titles = {}
    for i in range(1, 4001):  # each common word lies in a third of the titles
        words = [w for w in common if rnd.random() < 1 / 3] + [f"w{rnd.randrange(3000)}" for _ in range(rnd.randint(1, 12))]
        titles[i] = " ".join(words)
    it = fx.items(spark, [(i, t, set()) for i, t in titles.items()])
    q = "alpha beta gamma delta"
    qs = spark.createDataFrame([(q,), ("delta w7",), ("alpha alpha beta",)], "query string")
    got = {}
    for r in search.title_search(it, qs, k=k).collect():
        got.setdefault(r.query, []).append((r.rank, r.movieId, r.score))
    for text in (q, "delta w7", "alpha alpha beta"):
        assert [(m, s) for _, m, s in sorted(got[text])] == bm25_python(titles, text)[:k], text
    _, postings = search.title_shapes(it, k)
    weights, doc_freq = search.term_weights(postings)
    cand, _ = search.title_candidates(postings, weights, doc_freq, qs, k)
    lists = postings.filter(postings.token.isin(common)).count()
    # the plan without floors goes on with every shape of three of the four lists
    assert cand.filter(cand["query"] == q).count() < lists / 5


def test_every_title_query_gets_an_answer_or_a_reason(spark):
    import json

    from reelrank.sinks.documents import title_answer_documents

    it = fx.items(spark, [(1, "red sun", set()), (2, "blue moon", set()), (3, "lost film", set()), (4, "night", set())])
    r = fx.ratings(spark, [(7, 1, 4, 0), (8, 2, 3, 0), (7, 4, 2, 0)])
    lists = spark.createDataFrame([(7, 4), (7, 2)], "userId long, movieId long")
    asked = spark.createDataFrame([("red",), ("red",), ("lost",), ("moon",), ("nothing",), ("",), (None,)], "query string")
    rows = search.title_answers(it, asked, r, lists, 5)
    got = {x.query: (x.reason, json.loads(x.answer)) for x in title_answer_documents(rows).collect()}
    assert {q: reason for q, (reason, _) in got.items()} == {
        "red": None, "lost": "no ratings", "moon": "no recommendations", "nothing": "no such title",
        "": "no such title", None: "no such title"}
    assert [x["movieId"] for x in got["red"][1]["recommendations"]] == [2, 4]
    assert got["lost"][1] == {"movie_title": "lost", "reason": "no ratings"}
    assert got[None][1] == {"movie_title": None, "reason": "no such title"}
