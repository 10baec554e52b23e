import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strataspark.llm import chat_rotation, decontam, html_template, lang_id, license_scan, line_dedup, mih, mixing, ngram_join, pii, queries

DOCS = "doc_id long, text string"
WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "pe", "ru") for b in ("ba", "do", "fi", "gu", "ha", "je", "sto", "vin")]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


# op1
def page(i, extra=""):
    return f"<html><body><header>Site</header><nav><a href=x>Home</a></nav><div class='sidebar'>Other</div><article><h1>T {i}</h1><p>One &amp; {i}\n two<p>Three<br>four</article><section id=comments>Me too</section>{extra}<footer>F</footer></body></html>"


def test_extract(spark):
    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(4)] + [(4, None, None), (5, "http://z/", ""), (6, "http://y/", "<p>a<script>x</p></script><form>f</form><p>b")]
    got = {r.page_id: r for r in html_template.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[2].text == "T 2\n\nOne & 2 two\n\nThree four" and got[2].n_chars == len(got[2].text)
    assert (got[4].text, got[5].text, got[6].text) == ("", "", "a\n\nb")


def test_template_text_goes_without_article(spark):
    rows = [(i, "http://h/", f"<body><div><p>Welcome</p></div><div><p>{prose(i, 20)}</p></div><div><p>Bye</p></div></body>") for i in range(6)]
    got = html_template.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r.text == prose(r.page_id, 20) for r in got)


def test_template_text_goes_inside_the_article_of_each_layout(spark):
    body = lambda i: f"<html><body class=l{'abc'[i % 3]}><main><p>{prose(i, 12)}</p><p>Share layout {i % 3}</p><p>All rights held</p></main></body></html>"
    rows = [(i, f"http://h/{i}", body(i)) for i in range(18)]
    got = html_template.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 18 and all(r.text == prose(r.page_id, 12) for r in got)


def test_classes_are_ordered_and_nested():
    a, b = (9, [1, 2, 3]), (9, [4, 5])
    assert html_template.violations([1, 4, 5, 2, 4, 5, 3], [a, b]) == set()
    assert html_template.violations([1, 4, 2, 5, 3], [a, b]) == {4, 5}
    assert html_template.violations([4, 1, 2, 5, 3], [a, b]) == {4, 5}
    assert html_template.violations([1, 3, 2], [a]) in ({2}, {3})


def extract(spark, rows):
    got = html_template.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return {r.page_id: r.text for r in got}


def test_names_empty_no_article(spark):
    rows = ["<body class='single no-sidebar'><article><p>Body text</p></article></body>", "<article class='post comments-open'><p>Body text</p></article>",
            "<article><p class='ad-hoc'>Body text</p></article>", "<article><div class='skip-grams'>Body text</div></article>", "<article><div id='related-work'>Body text</div></article>",
            "<div class='widget'><article><p>Body text</p></article></div>", "<article><p>Body text</p><div class='share-buttons'>Share</div><section id=comments><article><p>Me too</p></article></section></article>",
            "<article><p>Body text</p></article><section class='comment-list'><article class='comment'><p>Me too</p></article></section>",
            "<article>Body text<div class='adSlot'>Buy</div></article>", "<main><div role='navigation'>Menu</div><p>Body text</p></main>"]
    assert set(extract(spark, [(i, f"http://h{i}/", r) for i, r in enumerate(rows)]).values()) == {"Body text"}
    teaser = f"<article><p>Short</p></article><div><p>{prose(1, 90)}</p></div>"
    assert extract(spark, [(1, "http://h/", teaser)])[1] == f"Short\n\n{prose(1, 90)}"
    assert extract(spark, [(1, "http://h/", "<article><p>so <math><mi>x</mi></math> is</p></article>")])[1] == "so x is"


def test_copies_are_no_template(spark):
    one = "<body><div class=top>Site</div><article><h1>A</h1><p>Long text</p></article></body>"
    near = lambda i: f"<body><article><h1>A</h1><p>{prose(7, 30)}</p><p>{prose(8, 30)}</p><p>{i}</p></article></body>"
    got = extract(spark, [(i, f"http://h/{i}", one) for i in range(8)] + [(20 + i, f"http://g/{i}", near(i)) for i in range(9)] + [(5, "http://h/5", one)])
    assert all(got[i] == "A\n\nLong text" for i in range(8)) and all(got[20 + i] == f"A\n\n{prose(7, 30)}\n\n{prose(8, 30)}\n\n{i}" for i in range(9))


def test_templates_equal_brute_force(spark):
    rng = random.Random(9)
    pages = []
    for i in range(12):
        parts = [f"<p>{w}</p>" for w in ("always one", "always two", "always three")]
        if i % 2:
            parts.insert(rng.randrange(1, 3), "<p>often</p><b>so</b>")
        pages.append((i, "http://h/", "<div>" + "".join(parts) + f"<p>{prose(i, 9)}</p></div>"))
    frame = spark.createDataFrame(pages, "page long, url string, html string").withColumn("host", F.lit("h"))
    marked = html_template.with_scopes(frame).select("by_host", "by_layout", "page", "html")
    scope = marked.first().by_host
    got = next(r for r in html_template.host_templates(marked).collect() if r.scope == scope)
    run, vectors, keys, order = html_template.hasher(), {}, {}, []
    for i, _, body in pages:
        order.append(run([t for t in html_template.tokens(body) if t[0] != "t" or t[2].strip()]))
        for h in order[-1]:
            vectors.setdefault(h, [0] * 12)[i] += 1
    for h, v in vectors.items():
        if sum(map(bool, v)) >= 6:
            keys.setdefault(tuple(v), set()).add(h)
    def crosses(strong, weak):
        """Whether an instance of the weak class has a token of the strong one between its first and last."""
        for page in order:
            spots = [k for k, h in enumerate(page) if h in weak]
            each = [spots[k: k + len(weak)] for k in range(0, len(spots), len(weak))]
            if any(h in strong for inst in each for h in page[inst[0]: inst[-1]]) and any(h in weak for h in page):
                return True
        return False

    ranked = sorted(((sum(map(bool, v)), sum(v), m) for v, m in keys.items() if len(m) > 1), key=lambda c: (-c[0], c[1], -len(c[2])))
    held = []
    for n, _, m in ranked:
        if not any(crosses(strong, m) for _, strong in held):
            held.append((n, m))
    want = {(n, frozenset(m)) for n, m in held}
    assert len(ranked) > len(held) and {(n, frozenset(m)) for n, m in html_template.unpack(got.classes)} == want and len(want) >= 2


def test_tokens_of_odd_pages_take_linear_time():
    for body in ("<a " * 40_000, "<svg>" * 20_000, "<!--" * 30_000, "<b>" * 20_000 + "<hr>" * 20_000 + "</i>" * 20_000, "<a '" * 30_000 + ">", "<option>" * 20_000 + "<p>" * 20_000, "</x>" * 30_000, "<" * 90_000):
        began = time.time()
        assert sum(1 for _ in html_template.tokens(body)) >= 0
        assert time.time() - began < 3


# op2
def brute_components(rows, k, num, den):
    sets = {i: {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if (w := (t or "").lower().split()) else set() for i, t in rows}
    comp = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    return {i: (len(sets[i]), comp[i]) for i in sets}


@pytest.mark.parametrize("k,num", [(3, 90), (5, 80)])
def test_jaccard(spark, k, num):
    rng = random.Random(3)
    rows = [(i, prose(i, 120)) for i in range(12)] + [(90, None), (91, ""), (92, "one two"), (93, "ONE two")]
    for i in range(12, 40):
        w = rows[i % 6][1].split()
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = "x"
        rows.append((i, " ".join(w)))
    got = {r.id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs(spark, rows), shingle=k, num=num).collect()}
    assert got == brute_components(rows, k, num, 100)


def test_jaccard_in_blocks(spark, monkeypatch):
    base = prose(1, 300).split()
    rows = [(i, " ".join(base[:i] + [f"w{i}"] + base[i + 1:])) for i in range(60)]
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    got = ngram_join.jaccard_components(docs(spark, rows), shingle=3, num=90).collect()
    assert {r.component_id for r in got} == {0} and len(got) == 60


def test_jaccard_edge_cases(spark):
    assert ngram_join.jaccard_components(docs(spark, [])).count() == 0
    odd = spark.createDataFrame([(None, "a b c", 1), (3, "a b c", 2), (3, "a b c", 2)], "doc_id long, text string, keys int")
    got = sorted(ngram_join.jaccard_components(odd, shingle=3).collect(), key=str)
    assert [(r.id, r.component_id) for r in got].count((3, 3)) == 2 and (None, None) in [(r.id, r.component_id) for r in got]


def test_jaccard_runs_one_python_function_in_a_task(spark, monkeypatch):
    """A task that runs one function over another's rows holds two Python workers, and the memory of both."""
    from strataspark.operators import lineage, spatial
    plans = []

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return lineage.cut(df)

    monkeypatch.setattr(spatial, "cut", watched)
    monkeypatch.setattr(ngram_join, "cut", watched)
    rows = [(i, prose(i % 9, 120)) for i in range(30)]
    assert ngram_join.jaccard_components(docs(spark, rows)).count() == 30
    parts = [part.count("MapInPandas") + part.count("MapInArrow") for plan in plans for part in plan.split("Exchange")]
    assert max(parts) == 1


@pytest.mark.parametrize("order", [(0, 1, 2), (1, 0, 2), (2, 1, 0)])
def test_jaccard_with_two_texts_under_one_id(spark, order):
    a, b = prose(1, 60), prose(2, 60)
    rows = [(7, a), (7, b), (8, b + " end"), (9, prose(3, 60)), (None, b)]
    frame = docs(spark, [rows[i] for i in order] + rows[3:]).coalesce(1)
    got = {(r.id, r.component_id) for r in ngram_join.jaccard_components(frame, shingle=3).collect()}
    assert got == {(7, 7), (8, 7), (9, 9), (None, None)}


# op3
def test_language(spark):
    en, de = "the and this with that have from", "der und nicht eine auch sich mit"
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices((en if i % 2 else de).split(), k=40)), "en" if i % 2 else "de", "h.example.org") for i in range(80)]
    rows += [(100, None, None, None), (101, "12 34", "en", ""), (102, rows[1][1], "de", "h.example.org")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in lang_id.identify(d, declared=F.col("lang"), url=F.lit("http://h.example.org/en/1"), host=F.col("source"), carry={"doc_id": F.col("doc_id")}).collect()}
    assert all(got[i].lang == ("en" if i % 2 else "de") and got[i].accepted for i in range(80))
    assert got[102].lang == "en" and not got[100].accepted and not got[101].accepted and got[100].lang is None
    assert lang_id.identify(d.limit(0), declared=F.col("lang"), carry={"doc_id": F.col("doc_id")}).count() == 0


def test_language_of_held_out_rows(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held", F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0)
    hidden = F.when(~F.col("held"), F.col("lang"))
    got = lang_id.identify(d, declared=hidden, host=F.col("source"), carry={"held": F.col("held"), "truth": F.col("lang")}).filter("held and n_grams >= 20")
    row = got.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("lang") == F.col("truth")).cast("int")).alias("right")).first()
    assert row.n > 100 and row.right >= 0.97


def test_rare_languages_are_kept(spark):
    words = [f"{a}{b}" for a in "bcdfghjklm" for b in "aeiou"]
    rng = random.Random(2)
    own = {f"l{i:02d}": [rng.choice(words) + rng.choice(words) for _ in range(12)] for i in range(70)}
    rows = [(i, " ".join(rng.choices(own["l00"], k=30)), "l00") for i in range(400)] + [(1000 + i, " ".join(rng.choices(w, k=30)), k) for i, (k, w) in enumerate(own.items())]
    rows += [(2000 + i, rows[0][1], "l00") for i in range(500)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = lang_id.identify(d, declared=F.col("lang"), carry={"truth": F.col("lang")}).filter("lang = truth").select("truth").distinct().count()
    assert got == 70


def test_language_of_pages_by_address_and_host(spark):
    words = {"en": "the and this with that have from", "de": "der und nicht eine auch sich mit"}
    rng = random.Random(1)
    page = lambda lang, text: f"<html{f' lang={lang}' if lang else ''}><body><p>{text}</p></body></html>"
    said = lambda lang: " ".join(rng.choices(words[lang].split(), k=40))
    rows = [(i, f"http://both.example.org/{lang}/{i}", page(lang, said(lang))) for i in range(80) for lang in [("en", "de")[i % 2]]]
    rows += [(100 + i, f"http://{lang}.sites.net/{i}", page(lang, said(lang))) for i in range(60) for lang in [("en", "de")[i % 2]]]
    rows += [(200 + i, f"http://www.{lang}only.com/{i}", page(lang, said(lang))) for i in range(60) for lang in [("en", "de")[i % 2]]]
    vague = "zzkk qqxx vvjj " * 8
    asked = {"http://both.example.org/en/x1": "en", "http://both.example.org/de/x1": "de",  # address suffix
             "http://en.sites.net/x1": "en", "http://de.sites.net/x1": "de",  # host
             "http://new.enonly.com/x1": "en", "http://new.deonly.com/x1": "de"}  # registered domain of a new host
    rows += [(900 + i, u, page(None, vague)) for i, u in enumerate(asked)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("lang", F.regexp_extract("html", "<html lang=([a-z]+)", 1))
    d = d.withColumn("text", F.regexp_extract("html", "<p>(.*)</p>", 1)).withColumn("host", html_template.host_of(F.col("url")))
    d = d.withColumn("lang", F.when(F.col("lang") != "", F.col("lang")))
    got = {r.url: r.lang for r in lang_id.identify(d, declared=F.col("lang"), url=F.col("url"), host=F.col("host"), carry={"url": F.col("url")}).collect()}
    assert {u: got[u] for u in asked} == asked
    blind = {r.url: r.lang for r in lang_id.identify(d, declared=F.col("lang"), carry={"url": F.col("url")}).collect()}
    assert len({blind[u] for u in asked}) == 1  # text and markup do not tell them apart


# op4
def test_mixing(spark):
    bad = lambda i: i % 4 == 0
    rows = [(i, prose(i, 60) + (" vile rotten" if bad(i) else "")) for i in range(400)] + [(900, None), (901, "")]
    labels = spark.createDataFrame([(i, 1, int(bad(i))) for i in range(0, 400, 2)] + [(401, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in mixing.mix_documents(docs(spark, rows), labels).collect()}
    assert all((got[i].rate == 0) == bad(i) for i in range(400)) and len(got) == 402
    assert mixing.mix_documents(docs(spark, []), labels).count() == 0


def test_rates_match_targets(spark):
    rng = np.random.default_rng(0)
    p = rng.dirichlet([1, 1, 1], 500)
    scored = spark.createDataFrame([(int(t), list(map(float, x))) for t, x in zip(rng.integers(10, 100, 500), p)], "tokens long, p array<double>")
    rate, history = mixing.fit_rates(scored, {"good": 0.5, "low": 0.3, "toxic": 0.2})
    total = scored.agg(F.sum("tokens")).first()[0]
    sums = scored.select(*[F.sum(rate * F.col("tokens") * F.col("p")[j]) / total for j in range(3)]).first()
    assert np.allclose(sums, [0.5, 0.3, 0.2], atol=0.01) and history


def test_rates_equal_a_dense_solver(spark):
    rng = np.random.default_rng(3)
    n = 300
    p, w = np.round(rng.dirichlet([0.4, 0.3, 0.1], n), 6), rng.integers(1, 400, n).astype(float)
    scored = spark.createDataFrame([(int(t), list(map(float, x))) for t, x in zip(w, p)], "tokens long, p array<double>")
    for goal in ({"good": 0.9, "low": 0.1, "toxic": 0.0}, {"good": 0.1, "low": 0.1, "toxic": 0.8}):
        rate, history = mixing.fit_rates(scored, goal)
        mine = np.array([r.r for r in scored.select(rate.alias("r")).collect()])
        want, b, total = np.ones(n), np.array([goal[d] for d in mixing.DOMAINS]), w.sum()
        top = 0.9 / (np.linalg.norm(p * np.sqrt(w / total)[:, None], 2) ** 2 + mixing.RIDGE)
        for _ in range(60_000):  # plain projected gradient in the weights of the rows
            grad = p @ ((want * w) @ p / total - b) + mixing.RIDGE * (want - 1)
            want = np.maximum(0, want - top * grad)
        cost = lambda r: 0.5 * (((r * w) @ p / total - b) ** 2).sum() + mixing.RIDGE / 2 * (w / total * (r - 1) ** 2).sum()  # noqa: E731,B023
        assert cost(mine) <= cost(want) * 1.01 + 1e-9 and np.abs((mine * w) @ p / total - (want * w) @ p / total).max() < 2e-3
        assert abs(max(abs(history[-1][d]) for d in mixing.DOMAINS) - np.abs((mine * w) @ p / total - b).max()) < 1e-6


# op5
def test_pii(spark):
    rows = [(1, "mail a.b@c.org, ip 10.0.0.255 or 10.0.0.256, card 4111 1111 1111 1111, +44 (20) 7946-0958"), (2, None), (3, ""), (4, "9" * 50_000)]
    got = {r.doc_id: r for r in pii.digest(pii.find_pii(docs(spark, rows))).collect()}
    assert (got[1].n_email, got[1].n_ip, got[1].n_card, got[1].n_phone) == (1, 1, 1, 1)
    assert got[2].base_sha256 == got[3].base_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def brute_base(t):
    """The contract read off a plain regular-expression engine."""
    out = []
    ascii_ = lambda p: re.compile(p, re.A)
    forms = [("email", ascii_(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")), ("ip", ascii_(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
             ("card", ascii_(r"[0-9]([\x20-]?[0-9])+")), ("phone", ascii_(r"\+[0-9][\x20().0-9-]+[0-9]"))]
    for kind, form in forms:
        for m in form.finditer(t or ""):
            d = [int(c) for c in re.sub("[^0-9]", "", m[0])]
            luhn = sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(reversed(d))) % 10 == 0
            good = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False, "card": 13 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}
            if good[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii_base_spans_of_the_test_documents_and_of_odd_ones(spark):
    rng = random.Random(5)
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    odd = [(10_000_000 + i, "".join(rng.choice(["1", "23", "4111 1111 1111 1111", ".", "@", "+", "-", " ", "a", "(", ")", "10.0.0.1", "é", "\n", "x@y.z", "😀"]) for _ in range(rng.randrange(1, 60)))) for i in range(400)]
    odd += [(20_000_000, "a@b.c " * 3000), (20_000_001, None), (20_000_001, None)]
    rows = frame.unionByName(docs(spark, odd))
    got = {r.doc_id: (r.base_sha256, r.n_email + r.n_ip + r.n_card + r.n_phone) for r in pii.digest(pii.find_pii(rows)).collect()}
    for r in rows.collect():
        spans = brute_base(r.text)
        assert got[r.doc_id] == (hashlib.sha256(",".join(spans).encode()).hexdigest(), len(spans)), r.doc_id
    assert pii.digest(pii.find_pii(docs(spark, []))).count() == 0


# labelled by hand: [[...]] marks what should be found beyond the base formats
LABELLED = """
Please email [[maria at example dot org]] before Friday.
Write to [[j.doe [at] mail [dot] net]] for the slides.
contact [[info(at)library(dot)org]] about opening hours
We met at noon at the station. The train was late.
She looked at him. Then nothing happened at all.
The call center: [[(212) 555-0187]] is open all day.
call [[415-555-2671]] or come by
phone [[020 7946 0958]] after six
his mobile [[0171 5550 113]] rings
Chapter 12.34 covers pages 120-134 of the book.
total 12.50 and 13.75 since 2019
The score was 21-19 and 21-17 since noon.
server address [[2001:0db8:85a3:0000:0000:8a2e:0370:7334]] answers
ip [[fe80:1:2:3:4:5:6:7]] pinged
The show starts 10:30:45 sharp, order 12:10:55:20 is late.
card [[4111.1111.1111.1111]] was charged
credit card [[5500/0000/0000/0004]] expired
invoice 1234.5678.9012.3456 was paid
version 1.2.3 of page 44-55
config token = "[[9f86d081884c7d659a2feaa0c55ad015a3bf4f1b]]" leaked
export api_key=[[AbC9xK2mPq7LtR4vWz]] now
the password: required field is marked
authentication = something else entirely
date 2020-01-15 and isbn 978-3-16-148410-0 here
since 1914 - 1918 the price rose
"""


def test_pii_runs_of_any_length_are_whole(spark):
    key = "aB3dE5fG7hJ9" * 25
    lines = [f"config token={key} leaked", "contact " + "x" * 90 + " [at] mail [dot] net now", "numbers " + "12 34 56 " * 20_000 + "end"]
    got = {r.doc_id: r.spans for r in pii.digest(pii.find_pii(docs(spark, list(enumerate(lines))))).collect()}
    assert got[0] == f"secret:7:{13 + len(key)}"
    assert got[1] in ("", f"email:8:{len(lines[1]) - 4}")  # whole or not at all
    assert 2 in got  # a long list of numbers is one candidate, found without recursion


def test_pii_added_spans_on_labelled_lines(spark):
    rows, want = [], {}
    for i, line in enumerate(x for x in LABELLED.strip().split("\n")):
        plain, spans, at = "", [], 0
        for m in re.finditer(r"\[\[(.*?)\]\](?!\w)", line):
            plain += line[at: m.start()]
            spans.append((len(plain), len(plain) + len(m[1])))
            plain, at = plain + m[1], m.end()
        rows.append((i, plain + line[at:]))
        want[i] = spans
    got = {r.id: r.extra for r in pii.find_pii(docs(spark, rows)).collect()}
    hit = sum(any(e.start < b and a < e.stop for e in got[i]) for i, s in want.items() for a, b in s)
    false = sum(not any(e.start < b and a < e.stop for a, b in want[i]) for i in got for e in got[i])
    total = sum(map(len, want.values()))
    assert hit / total >= 0.8 and false / max(1, hit + false) <= 0.15, (hit, total, false, [(rows[i][1], [e.hit for e in x]) for i, x in got.items()])


# op6
def test_nearest(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 16))
    x[100:140] = x[50]
    rows = [(i, list(map(float, v))) for i, v in enumerate(x)] + [(600, None), (650, [0.0] * 16), (700, [float("nan")] * 16), (750, [1.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = mih.nearest(v, v.filter("vec_id % 50 = 0").select("vec_id")).toPandas()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = total = 0
    for q in range(0, 600, 50):
        s = unit @ unit[q]
        s[q] = -2
        best = np.lexsort((np.arange(600), -np.round(s, 12)))[:5]
        mine = got[got.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == [1, 2, 3, 4, 5] and np.allclose(mine["score"], s[mine.vec_id])
        hit, total = hit + len(set(best) & set(mine.vec_id)), total + 5
    assert hit / total >= 0.9 and set(got.query_id) == set(range(0, 600, 50))
    assert list(got[got.query_id == 50].sort_values("rank").vec_id) == [100, 101, 102, 103, 104]


def test_nearest_ties_of_multiples_go_to_the_smaller_id(spark):
    rng = np.random.default_rng(6)
    x = rng.integers(-9, 10, size=(400, 12)).astype(float)
    x[:, 0] += 0.5
    for i in range(100, 130):
        x[i] = x[50] * 2.0 ** (i % 7 - 3)
    for i in range(130, 160):
        x[i] = x[50] * (i - 127)
    v = spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(x)], "vec_id long, embedding array<double>").repartition(5)
    got = mih.nearest(v, v.filter("vec_id = 50 or vec_id = 120").select("vec_id")).toPandas()
    assert list(got[got.query_id == 50].sort_values("rank").vec_id) == [100, 101, 102, 103, 104]
    assert list(got[got.query_id == 120].sort_values("rank").vec_id) == [50, 100, 101, 102, 103]


def test_nearest_with_many_ties_and_few_rows(spark):
    v = spark.createDataFrame([(i, [float(j == i % 40) for j in range(40)]) for i in range(200)], "vec_id long, embedding array<double>")
    got = mih.nearest(v, v.filter("vec_id = 0").select("vec_id")).sort("rank").collect()
    assert [(r.vec_id, round(r.score, 9)) for r in got[:4]] == [(40, 1.0), (80, 1.0), (120, 1.0), (160, 1.0)]
    assert len(got) == 5 and got[4].score == 0.0  # of the 195 at a right angle one that is in reach of the code
    few = v.filter("vec_id < 3")
    assert [r.vec_id for r in mih.nearest(few, few.select("vec_id")).sort("query_id", "rank").collect()] == [1, 2, 0, 2, 0, 1]
    assert mih.nearest(v.limit(0), v.select("vec_id")).count() == 0


# op7
def brute_lines(rows):
    seen, out = set(), {}
    for i, t in sorted(rows):
        lines, gone = t.split("\n"), set()
        for p in range(len(lines) - 2):
            w = tuple(lines[p:p + 3])
            if w in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(w)
        out[i] = "\n".join(x for p, x in enumerate(lines) if p not in gone)
    return out


def test_line_dedup(spark):
    rng = random.Random(2)
    rows = [(i, "\n".join(rng.choice("abc") for _ in range(rng.randrange(12)))) for i in range(40)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs(spark, rows)).collect()}
    assert got == brute_lines(rows)
    odd = line_dedup.dedup_lines(docs(spark, [(None, "a\nb\nc"), (1, None), (2, "")])).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in odd) == [("1", "None"), ("2", ""), ("None", "a\nb\nc")]


# op8
def edits(a, b):
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return min(row)


def test_decontam(spark):
    rng = random.Random(4)
    items = [(i, prose(50 + i, 14)) for i in range(8)]
    rows = []
    for i in range(60):
        w = list(items[i % 8][1])
        for _ in range(i // 8):
            w[rng.randrange(len(w))] = "#"
        rows.append((i, f"{prose(900 + i, 30)}\n {''.join(w) if i % 3 else ''} {prose(800 + i, 10)}"))
    rows += [(100, None), (101, "")]
    bench = spark.createDataFrame([*items, (20, None), (21, "abc")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs(spark, rows), bench).collect()}
    want = {(i, k) for i, t in rows if t for k, x in items if edits(x, decontam.normal(t)) <= int(decontam.EDIT_SHARE * len(x))}
    assert got == want and want
    assert decontam.find_leaks(docs(spark, []), bench).count() == 0


def test_decontam_short_long_and_edited_passages(spark):
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    items = [(i, "".join(rng.choice(letters) for _ in range(n))) for i, n in enumerate([3, 7, 9, 13, 15, 18, 23, 24, 30, 80, 160, 160, 400])]
    rows, n = [], 0
    for i, t in items:
        for e in range(0, int(decontam.EDIT_SHARE * min(len(t), 160)) + 2):
            for where in (0, 155, 300, 319, 477):
                w = list(t)
                for _ in range(e):
                    k = rng.randrange(len(w))
                    w[k] = rng.choice(["", w[k] + "#", "#"]) if e % 3 else w[k] + "#"
                rows.append((n, "".join(rng.choice("uvwxyz ") for _ in range(where)) + " " + "".join(w) + " " + "".join(rng.choice("uvwxyz ") for _ in range(60))))
                n += 1
    rows += [(9000, " ".join(t for _, t in rows) * 3), (None, rows[30][1]), (5, rows[5][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs(spark, rows).repartition(8), bench).collect()}
    want = set()
    for i, t in rows:
        u = decontam.normal(t)
        for k, x in items:
            if len(x) < 8:
                if re.search(rf"(?<!\w){x}(?!\w)", u):
                    want.add((i, k))
            elif i == 9000:
                if (9000, k) in got:  # too long for the plain search: only that all items are found
                    want.add((i, k))
            elif any(edits(p, u) <= int(decontam.EDIT_SHARE * len(p)) for p in decontam.passages(x)):
                want.add((i, k))
    assert got == want and {k for i, k in got if i == 9000} == set(range(len(items)))


# op9
def test_chat(spark):
    rows = [(1, 0, "system", "S"), (1, 1, "a", "hi"), (1, 2, "b", "yo <|x"), (2, 0, None, None)]
    got = {(r.conv_id, r.perspective): r for r in chat_rotation.rotate_perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    b = got[1, "b"]
    assert set(got) == {(1, "a"), (1, "b"), (2, "unknown")} and "user name=a" in b.text
    assert [b.text[m.start:m.end] for m in b.mask] == ["yo < |x<|im_end|>"]


def test_a_long_dialogue_with_repeated_turn_numbers(spark):
    rows = [(1, t % 7 if t % 5 else None, "ab"[t % 2], f"{t:04d}") for t in range(600)]
    got = chat_rotation.rotate_perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    own = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    for who in "ab":
        parts = sorted((r for r in got if r.perspective == who), key=lambda r: r.part)
        assert [(p.part, p.n_turns) for p in parts] == [(0, 512), (1, 88)]
        assert "".join(p.text for p in parts) == "".join(f"<|im_start|>{'assistant' if r[2] == who else 'user name=' + r[2]}\n{r[3]}<|im_end|>\n" for r in own)


def test_chat_parts_are_bounded_by_rows(spark):
    rng = random.Random(4)
    rows = [(None, turn, rng.choice("ab"), f"{d} {turn}") for d in range(5) for turn in range(3)]  # dialogues without id, numbers begin again
    rows += [(None, 1, "a", "same")] * 11 + [(None, None, "b", "x")]
    rows += [(7, None, "a", str(i)) for i in range(9)] + [(8, t, "c", str(t)) for t in (0, 1, 5, 6)] + [(9, None, "d", "z")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat_rotation.rotate_perspectives(frame, part_turns=4).collect()
    assert max(r.n_turns for r in got) == 4
    for conv, who in {(r[0], r[2]) for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        parts = sorted((r for r in got if (r.conv_id, r.perspective) == (conv, who)), key=lambda r: r.part)
        said = [f"<|im_start|>{'assistant' if r[2] == who else 'user name=' + r[2]}\n{r[3]}<|im_end|>\n" for r in own]
        assert "".join(r.text for r in parts) == "".join(said) and sum(r.n_turns for r in parts) == len(own)
        assert [r.part for r in parts] == list(range(-(-len(own) // 4)))
        assert [p.text[m.start:m.end] for p in parts for m in p.mask] == [f"{r[3]}<|im_end|>" for r in own if r[2] == who]


# op10
def brute_licenses(text, templates):
    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    three = lambda w: {tuple(w[i:i + 3]) for i in range(len(w) - 2)}
    w, found = words(text), set()
    for name, body in templates:
        t = words(body)
        c = max(4, 1 << (len(t) - 1).bit_length())
        for at in range(0, len(w), c // 2):
            both = three(t) & three(w[at: at + 3 * c // 2])
            if len(both) >= 0.8 * len(three(t)):
                found.add(name)
    return ",".join(sorted(found))


def test_license(spark):
    rng = random.Random(8)
    rows = [(2, prose(3, 50)), (3, None), (4, "All Rights  Reserved."), (5, ""), (6, "two words")]
    for i, (name, body) in enumerate(license_scan.TEMPLATES * 3):
        w = body.split()
        for _ in range(i // len(license_scan.TEMPLATES)):  # none, one, two words changed
            w[rng.randrange(len(w))] = "changed"
        rows.append((10 + i, f"{prose(i, rng.randrange(300))} {' '.join(w)} {prose(900 + i, rng.randrange(60))}"))
    rows += [(500, rows[6][1]), (500, rows[7][1]), (501, " ".join(rows[20 + j][1] for j in range(40))), (None, license_scan.ISC)]
    got = {r.doc_id: r.licenses for r in license_scan.scan_licenses(docs(spark, rows)).collect()}
    want: dict = {}
    for i, t in rows:
        if b := brute_licenses(t, license_scan.TEMPLATES):
            want[i] = ",".join(sorted({*want.get(i, "").split(","), *b.split(",")} - {""}))
    assert got == want and got[4] == "proprietary" and "MIT" in got[14]
    assert license_scan.scan_licenses(docs(spark, [])).count() == 0


def test_pipeline_stages(spark, tmp_path):
    leak = prose(77, 20)
    rows = [(i, prose(i, 80), "en", "s", 1) for i in range(30)]
    rows += [(40, rows[5][1] + " end", "en", "s", 1), (41, f"{prose(41, 40)} {leak}", "en", "s", 1), (42, "123", "en", "s", 1), (43, None, "en", "s", None)]
    sf = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    out = corpus_pipeline.run(spark, sf).toPandas()
    assert sorted(out.doc_id) == list(range(30)) and (out.rate > 0).all()


def test_all_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.queries() if k.startswith("op")) == list(range(1, 11))
