import random

import numpy as np
import pyarrow as pa
import pytest

from fleetmeter.llm import url_filter as u


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    return host, rest[end:].split("?")[0].split("#")[0]


URLS = [
    "http://example.net/en/1",
    "https://a.b.EXAMPLE.net/en/",
    "https://example.net/en",
    "https://notexample.net/en/2",
    "https://example.com/de/x?y=/fr/",
    "https://example.com/fr/",
    "https://my.org/fr/1#top",
    "https://org/fr/",
    "https://other.net",
    "x://y.com?q://z.net/",
    "HTTPS://WWW.Site.COM",
    "no scheme.net/en/",
    "://",
    "",
    None,
    "https://ünï.net/en/\nline",
    "https://casino-bonus.com/",
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, x) for i, x in enumerate(URLS)], "page_id long, url string")
    pages = pages.union(pages).selectExpr("*", "1 AS score", "'q' AS `Rule 1`").repartition(3)
    rows = u.judged(pages).collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        host, path = host_path(r.url)
        assert (r.host, r.path) == (host, path)
        fits = [
            x for x in u.RULES
            if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)
        ]
        best = max(fits, key=lambda x: len(str(x)), default=None)
        assert r.rule == (str(best) if best else None)
        assert r.verdict == (best.verdict if best else "block" if r.score >= 0.5 else "allow")


def test_empty_table(spark):
    assert u.judged(spark.createDataFrame([], "url string, n int")).collect() == []


def test_scores_are_sums_over_ngrams():
    model = u._default_model()
    hosts, paths = ["abc.com", "", "é"], ["/x", "", "/日本"]
    got = model.scores(pa.array(hosts), pa.array(paths))
    for i in range(3):
        one = model.scores(pa.array(hosts[i : i + 1]), pa.array(paths[i : i + 1]))
        assert np.isclose(got[i], one[0])
    assert np.isclose(got[1], 1 / (1 + np.exp(-model.bias - _blank(model))))


def _blank(model):
    run = next(iter(u.text_runs(pa.array([""], pa.large_string()))))
    return sum(model.weights[u._features(run, salt, model.ngrams, model.bits)[1]].sum() for salt in (0, 1))


def test_unseen_names():
    """Names that the labelled table does not have."""
    model = u._default_model()
    draw = random.Random(2)
    bad = [f"{a}{s}{b}.example.org" for a in ("online", "best", "my") for s in ("", "-")
           for b in ("casino", "poker", "viagra", "porn")]
    good = ["".join(draw.choice(u.LETTER_GROUPS) for _ in range(3)) + ".org" for _ in range(200)]
    assert (model.scores(pa.array(bad), pa.array(["/"] * len(bad))) >= 0.5).mean() > 0.9
    assert (model.scores(pa.array(good), pa.array(["/"] * len(good))) < 0.5).mean() > 0.97


def test_training_on_a_given_table(spark):
    rows = [(f"https://{w}{i}.com/", int(w == "bad")) for w in ("bad", "fine") for i in range(40)]
    labelled = spark.createDataFrame([*rows, (None, 1), ("https://x.y/", None)], "url string, label int")
    model = u.train(labelled)
    scores = model.scores(pa.array(["bad77.com", "fine77.com"]), pa.array(["/", "/"]))
    assert scores[0] > 0.5 > scores[1]


@pytest.mark.parametrize("rules", [[], [u.Rule("a.com", "/", "block"), u.Rule("a.com", "/x/", "allow")]])
def test_other_rules(spark, rules):
    pages = spark.createDataFrame([("http://a.com/x/1",), ("http://a.com/y",)], "url string")
    got = [r.rule for r in u.judged(pages, rules).orderBy("url").collect()]
    assert got == (["a.com/x/", "a.com/"] if rules else [None, None])
