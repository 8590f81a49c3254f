import fnmatch
import random

from pyspark.sql import functions as F

from logweave.llm import url_rules
from logweave.llm.queries import URL_RULES


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(h + p, v) for h, p, v in URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, "allow"))
    return host, path, rule, verdict


URLS = ["http://example.org/es/1", "https://WWW.Example.ORG/en/12?x=/es/", "http://notexample.org/es/1",
        "http://a.com/de/", "http://a.com/fr", "http://com/fr/x", "http://x.org", "http://x.org?y=/",
        "ftp://x.example.org#/es/", "no scheme/org/", "", None, "://", "http://a.b/x.org/es/",
        "http://é.org/ü", "http://x.org:80/a", "a://b://c.org/", "http://example.org/en/1\n2",
        "http://x.com/de/" + "y" * 20000, "http://x.com/de/a", "http://x.com/de/a"]


def test_rows_by_brute_force(spark):
    table = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    table = table.withColumn("rule", F.lit("own")).withColumn("rest", F.lit("mine"))
    out = url_rules.judge_urls(table, URL_RULES).collect()
    assert len(out) == len(URLS) and {r.rest for r in out} == {"mine"}
    for r in out:
        assert (r.host, r.path, r.rule, r.verdict) == brute(URLS[r.page_id]), URLS[r.page_id]


def test_globs_against_fnmatch():
    rng = random.Random(2)
    for _ in range(60):
        globs = ["".join(rng.choice(["a", "b", "?", "**"]) for _ in range(rng.randrange(1, 30)))
                 for _ in range(7)]
        texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(0, 25))) for _ in range(40)]
        got = url_rules.GlobSet(globs).match([t.encode() for t in texts])
        for i, text in enumerate(texts):
            for j, glob in enumerate(globs):
                assert got[i, j] == fnmatch.fnmatchcase(text, glob.replace("**", "*")), (text, glob)


def test_single_star_stops_at_slashes_and_words_span():
    wide = "x" * 150
    fits = url_rules.GlobSet(["*.org/a", "**.org/a", wide]).match(
        [b".b.org/a", b"/q.org/a", wide.encode(), b""])
    assert fits.tolist() == [[True, True, False], [False, True, False], [False, False, True],
                             [False, False, False]]


def test_no_rules_and_empty_table(spark):
    table = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string")
    r = url_rules.judge_urls(table, [], default="block").first()
    assert (r.rule, r.verdict) == (None, "block")
    assert url_rules.judge_urls(table.limit(0), URL_RULES).count() == 0


def test_many_rules_are_several_automata(spark, monkeypatch):
    """Small automata and small parts judge like one automaton over all rules."""
    rng = random.Random(6)
    rules = [(rng.choice(["org", "x.org", "a.b.com", "com"]), "/" + "".join(
        rng.choice("ab/") for _ in range(rng.randrange(0, 6))), rng.choice(["allow", "block"])) for _ in range(120)]
    urls = [f"http://{rng.choice(['', 'w.'])}{rng.choice(['org', 'x.org', 'a.b.com', 'com', 'net'])}/"
            + "".join(rng.choice("ab/") for _ in range(rng.randrange(0, 9))) for _ in range(300)]
    globs, results = url_rules.rule_globs(rules)
    texts = ["." + u.split("://")[1] for u in urls]
    whole = url_rules.first_fits(url_rules.packed_automata(globs), [t.encode() for t in texts])
    for text, k in zip(texts, whole.tolist()):
        host, _, path = text[1:].partition("/")
        fits = [i for i, g in enumerate(globs) if (host == g[2:-2].partition("/")[0]
                or host.endswith("." + g[2:-2].partition("/")[0])) and ("/" + path).startswith("/" + g[2:-2].partition("/")[2])]
        assert k == (fits[0] if fits else -1), (text, k, fits[:1])
    monkeypatch.setattr(url_rules, "AUTOMATON_STATES", 64)
    monkeypatch.setattr(url_rules, "STATE_BYTES", 200)
    automata = url_rules.packed_automata(globs)
    assert len(automata) > 10 and (url_rules.first_fits(automata, [t.encode() for t in texts]) == whole).all()
    assert url_rules.packed_automata([]) == []
