"""Toxicity on held-out texts; main texts of pages."""

import random

from tidemark.llm import html_text as ht
from tidemark.llm import toxicity as tx


def corpus(n=900, seed=4):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for doc in range(n):
        words = [rng.choice(plain) for _ in range(60)]
        toxic = doc % 4 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(["vile", "zork" + rng.choice(plain)])
        rows.append((doc, " ".join(words)))
        labels.append((doc, 1, int(toxic)))
    return rows, labels


def test_stems_of_held_out_texts(spark, frame):
    rows, labels = corpus()
    rows += [(9001, None), (9002, ""), (9003, "..."), (9004, "vile " * 50_000)]
    docs = frame(rows)
    marks = spark.createDataFrame(labels + [(0, 1, None)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in tx.scored(docs, tx.fit(docs, marks)).collect()}
    held = [(d, t) for d, _, t in labels if out[d].held_out]
    right = sum(out[d].predicted == t for d, t in held)
    assert len(held) > 100 and right >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out.values())
    assert out[9001].score == out[9002].score == out[9003].score and out[9001].predicted == 0
    assert out[9004].predicted == 1


def test_without_labels(spark, frame):
    docs = frame([(1, "a word"), (2, None)], "")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in tx.scored(docs, tx.fit(docs, none)).collect()] == [0, 0]
    assert tx.scored(frame([]), tx.fit(docs, none)).count() == 0


def test_rare_expressions_keep_their_counts(spark, frame):
    # "zoékel" is in 4 texts: far below a share of 1e-5 of the 600,000 words of its class
    other = lambda k: "".join(chr(97 + k // 26**j % 26) for j in range(4))
    rows = [(" ".join(other(i * 2000 + j) for j in range(2000)) + (" zoékel" if i in (0, 2, 4, 6) else ""), (i + 1) % 2) for i in range(600)]
    model = tx.fit_counts(spark.createDataFrame(rows, "text string, toxic int").repartition(3))
    words = spark.createDataFrame([("zoékel", 1), ("zoékim", 1)], "word string, n long")
    found = {r.word: r.value for r in tx.evidence(words, model).collect()}
    assert found["zoékel"] > found["zoékim"] and found["zoékel"] * tx.UNIT > 1
    entries = {r.entry for r in model.entries.collect()}
    signed = [e - (1 << 64) if e >> 63 else e for e in tx.entries_of("zoékel")]
    assert len(entries & set(signed)) >= len(signed) - 1  # an entry of no worth is not kept


def brute_force(rows):
    """``word -> log ratio``: both models straight from the definition."""
    import collections
    import math

    words = collections.defaultdict(lambda: [0, 0])
    for text, toxic in rows:
        for w in set(tx._WORD.findall(text.lower())):
            words[w][toxic] += 1

    def windows(word):
        marked = tx.START + word + tx.END
        return [marked[max(0, i - tx.HISTORY) : i + 1] for i in range(1, len(marked))]

    counts, holding = collections.defaultdict(lambda: [0, 0, 0]), collections.Counter()
    for w, (o, t) in words.items():
        for node in windows(w):
            for i, n in enumerate((o, t, o + t)):
                counts[node][i] += n
            holding[node] += 1

    def by(values):
        seen = collections.Counter(values)
        return tx.discounts(*[seen[i] for i in (1, 2, 3, 4)])

    def lowered(n, d):
        return 0.0 if n == 0 else d[min(n, 3) - 1]

    orders = {}
    for k in (0, *tx.SHORTER):
        order = collections.Counter()
        for node, n in holding.items():
            order[node[-(k + 1) :]] += n
        orders[k] = (order, by(order.values()))
    d = [by(c[i] for c in counts.values()) for i in range(3)]
    after = collections.defaultdict(list)
    for node, c in counts.items():
        after[node[:-1]].append(c)

    def shared(node, k):
        order, disc = orders[k]
        node = node[-(k + 1) :]
        if k == 0:
            return order[node] / sum(order.values())
        same = [n for x, n in order.items() if x[:-1] == node[:-1]]
        lower = shared(node, max([x for x in (0, *tx.SHORTER) if x < k]))
        return (order[node] - lowered(order[node], disc)) / sum(same) + sum(lowered(n, disc) for n in same) / sum(same) * lower

    def rest(history, i):
        own = after[history]
        n = sum(c[i] for c in own)
        return sum(lowered(c[i], d[i]) for c in own) / n if n else 1.0

    def unseen(history):
        return math.log(rest(history, 1) / rest(history, 0)) if history in after else 0.0

    def ratio(word):
        total = unseen(tx.START)
        for node in windows(word):
            if node not in counts:
                continue
            own = after[node[:-1]]
            all_ = sum(c[2] for c in own)
            p = (counts[node][2] - lowered(counts[node][2], d[2])) / all_ + sum(lowered(c[2], d[2]) for c in own) / all_ * shared(node, max(tx.SHORTER))
            given = []
            for i in (0, 1):
                n = sum(c[i] for c in own)
                given.append(((counts[node][i] - lowered(counts[node][i], d[i])) / n if n else 0.0) + rest(node[:-1], i) * p)
            total += math.log(given[1] / given[0]) - unseen(node[:-1]) + unseen(node[-tx.HISTORY :])
        return total

    return ratio


def test_ratios_are_those_of_the_definition(spark):
    rows, labels = corpus(120)
    rows = [(text, t) for (_, text), (_, _, t) in zip(rows, labels, strict=True)]
    ratio = brute_force(rows)
    model = tx.fit_counts(spark.createDataFrame(rows, "text string, toxic int").repartition(3))
    table = {r.entry: r.value for r in model.entries.collect()}
    heard = sorted({w for t, _ in rows for w in t.split()})[:300]
    for word in [*heard, "vile", "vileness", "zork", "unheard", "zorkunheard", "ü", "a" * 40]:
        found = (model.base + sum(table.get(e - (1 << 64) if e >> 63 else e, 0) for e in tx.entries_of(word))) * tx.UNIT
        assert abs(found - ratio(word)) < 1e-6, word


def test_entries_are_numbered_as_spark_does(spark):
    words = ["a", "zoékel", "ünlängst", "x" * 300, "日本語の文章"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    for r in df.select("word", tx.F.transform(tx._windows(), tx._entry).alias("e")).collect():
        assert [e % (1 << 64) for e in r.e] == tx.entries_of(r.word)


def test_joined_and_shipped_models_score_alike(spark, frame, monkeypatch):
    rows, labels = corpus(300)
    docs = frame([*rows, (9001, None), (9002, "vile " * 3000), (9003, ""), (9003, "")], "")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = tx.fit(docs, marks)
    shipped = sorted(tuple(r) for r in tx.scored(docs, model).collect())
    assert model.table is not None
    joined = tx.replace(model, table=None)
    assert sorted(tuple(r) for r in tx.scored(docs, joined).collect()) == shipped
    monkeypatch.setattr(tx, "SHIPPED", 0)
    again = tx.fit(docs, marks)
    assert again.table is None and (again.neutral, again.weight, again.bias) == (model.neutral, model.weight, model.bias)


def test_words_are_read_to_their_end(spark):
    rows = [(f"schwachsinnig{i % 5} gut", 1) for i in range(40)] + [(f"schwachstelle{i % 5} gut", 0) for i in range(40)]
    rows = [(t.replace("0", "a").replace("1", "b").replace("2", "c").replace("3", "d").replace("4", "e"), y) for t, y in rows]
    model = tx.fit_counts(spark.createDataFrame(rows, "text string, toxic int"))
    words = spark.createDataFrame([("schwachsinnig", 1), ("schwachstelle", 1), ("unterschwachsinnig", 1)], "word string, n long")
    found = {r.word: r.value for r in tx.evidence(words, model).collect()}
    assert found["schwachsinnig"] > 0 > found["schwachstelle"] and found["unterschwachsinnig"] > 0


def test_toxicity_leaves_clashing_columns_alone(spark, frame):
    rows, labels = corpus(200)
    docs = frame(rows)
    wide = docs.withColumns({c: tx.F.lit("mine") for c in ("score", "ratio", "row", "word", "n", "entry", "toxic", "held_out")})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", tx.F.lit("mine"))
    model = tx.fit(wide, marks)
    assert sorted(map(tuple, tx.scored(wide, model).collect())) == sorted(map(tuple, tx.scored(docs, tx.fit(docs, marks)).collect()))


def test_discounts_follow_the_counts_of_counts():
    y = 100 / (100 + 2 * 40)
    assert tx.discounts(100, 40, 20, 10) == (1 - 2 * y * 0.4, 2 - 3 * y * 0.5, 3 - 4 * y * 0.5)
    assert tx.discounts(5, 0, 0, 0) == (0.5, 1.0, 1.5)


def test_calibration_fold_counts_beyond_the_chosen_texts(spark, frame, monkeypatch):
    rows, labels = corpus()
    docs, marks = frame(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    calibration = {r.doc_id for r in docs.filter(tx.fold() == tx.CALIBRATION_FOLD).collect()}
    seen = []
    whole = tx.fit_counts
    monkeypatch.setattr(tx, "CALIBRATION_ROWS", 40)
    monkeypatch.setattr(tx, "fit_counts", lambda r: seen.append(r.count()) or whole(r))
    tx.fit(docs, marks)
    held = docs.filter(tx.fold() == 0).count()
    assert seen == [len(rows) - held - 40] and len(calibration) > 100


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="home">
<header><h1>Site</h1></header><div id="cookie-notice">We use cookies</div><div class="wrap">
<div class="links"><a href=1>One page</a> <a href=2>Two pages</a> <a href=3>Three</a></div>
<div class="post-%d content"><h1>Title %d</h1><p>Para  one &lt;ok&gt; &eacute;&nbsp;x.</p>
<script>var t = "</p>"; if (a < b) {}</script><ul><li>first item</li><li>second <a href=x>link</a> item</li></ul>
<div class="ad-slot">Buy</div><blockquote>Quote &amp;amp; text</blockquote><p>unclosed <i>para<p>next<br>line</div>
<div class="sidebar">Side text that is long enough to count for something</div>
<section id="comments"><p>Great post! I really loved it</p></section><form><input><p>Subscribe</p></form></div>
<footer>foot</footer></body></html>"""
TEXT = "Title %d\n\nPara one <ok> é x.\n\nfirst item\n\nsecond link item\n\nQuote &amp; text\n\nunclosed para\n\nnext line"


def test_pages(spark):
    rows = [(i, f"https://Host.example:80/{i}", PAGE % (i, i), "x") for i in range(6)]
    rows += [(10, None, None, "x"), (11, "", "", "x"), (12, "http://h/", "no markup at all", "x")]
    rows += [(13, "http://h/2", "<p>a<p>b <broken", "x"), (14, "http://host.example/x", "<body><main><p>Other layout</main>", "x")]
    rows += [(15, "http://h/3", "<div><p>" + "long text " * 50_000 + "</div>", "x"), (16, "http://h/4", "<div" * 50, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, path string")
    out = {r.page_id: r for r in ht.main_texts(df).collect()}
    for i in range(6):
        assert out[i].text == TEXT % i and out[i].path == "/body/div.wrap/div.post-#.content"
    assert (out[10].text, out[10].n_chars, out[11].text) == ("", 0, "")
    assert out[12].text == "no markup at all" and out[13].text == "a\n\nb" and out[14].text == "Other layout"
    assert out[15].n_chars == len("long text " * 50_000) - 1
    assert ht.main_texts(df.limit(0)).count() == 0


def test_a_host_of_two_templates(spark):
    teaser, story = "a short teaser", "long text of the story " * 20
    one = f"<body><nav>{'menu of the site ' * 10}</nav><article><p>{story}</article></body>"
    two = f"<body><article><p>{teaser}</article><div class=story><p>{story}</div></body>"
    three = "<body>" + f"<article><p>{story}</article>" * 3 + "</body>"
    rows = [(i, f"http://h.example/{i}", one) for i in range(9)] + [(10, "http://h.example/x", two), (11, "http://h.example/y", three)]
    # without a host: nothing in common
    rows += [(20 + i, None if i % 2 else "no address", one) for i in range(4)] + [(30, None, two)]
    out = {r.page_id: r for r in ht.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(out) == len(rows) and out[0].path == "/body/article"
    for k in (10, 30):
        assert story.strip() in out[k].text and out[k].path != "/body/article"
    assert out[11].text.count(story.strip()) == 3 and out[11].path == "/body/article"


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    out = ht.main_texts(pages).collect()
    assert len(out) == pages.count() and {r.path for r in out} == {"/body/article"}
    assert all(r.text and "&copy;" not in r.text and "\n\n\n" not in r.text for r in out)


STORY = "The bridge was closed on Monday because of the flood that reached the lower town. " * 6


def text(source):
    return ht.text_of(source, None)[0]


def test_boilerplate_inside_or_beside_never_empties_a_page():
    story = STORY.strip()
    for inner in (200, 800, 5000):
        comments = f"<section class='comments'><p>{'I think so too. ' * (inner // 16)}</p></section>"
        assert text(f"<body><article><p>{STORY}</p>{comments}</article></body>") == story
        half = f"<div class='intro'><p>{STORY}</p></div><p>{STORY}</p>"
        assert text(f"<body><article>{half}{comments}</article></body>") == f"{story}\n\n{story}"
    assert text(f"<body><h1>T</h1><p>{STORY}</p><footer>{'Imprint and more. ' * 100}</footer></body>") == f"T\n\n{story}"
    assert text(f"<body><article><nav>{'<a href=x>menu entry</a> ' * 99}</nav><p>Short.</p></article></body>") == "Short."


def test_names_alone_do_not_skip_an_article():
    for name in ("legal", "side", "notice", "tags", "comment", "share-price", "copyright"):
        page = f"<body><nav>Home</nav><article><h1>T</h1><div class='{name}'><p>{STORY}</p><p>{STORY}</p></div></article></body>"
        assert text(page) == "\n\n".join(["T", STORY.strip(), STORY.strip()]), name
        both = f"<body><article><p>{STORY}</p><div class='{name}'><p>Buy now! {STORY}</p></div></article></body>"
        assert text(both) == STORY.strip(), name
    nothing = f"<body><nav>Home</nav><div class='cookie-notice'><p>{STORY}</p></div><footer>x</footer></body>"
    assert text(nothing) == ""


def test_a_list_of_links_in_an_article_stays_and_a_menu_goes():
    links = "<ul><li><a href=a>First source</a></li><li><a href=b>Second source</a></li><li><a href=c>Third source</a></li></ul>"
    assert text(f"<body><article><p>{STORY}</p>{links}</article></body>").endswith("First source\n\nSecond source\n\nThird source")
    assert text(f"<body>{links}<article><p>{STORY}</p></article></body>") == STORY.strip()


def test_pages_with_clashing_columns_nulls_and_copies(spark):
    page = f"<body><article><p>{STORY}</p></article></body>"
    long_ = "<body><article>" + f"<p>{STORY}</p>" * 5000 + "</article></body>"
    rows = [(1, "http://a.b/1", page), (1, "http://a.b/1", page), (2, None, page), (3, "http://a.b/3", None), (4, "http://a.b/4", ""), (None, "http://a.b/5", long_)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df = df.withColumns({c: tx.F.lit("mine") for c in ("path", "host", "text", "n_chars", "vote")})
    got = sorted(((r.page_id, r.text) for r in ht.main_texts(df).collect()), key=repr)
    whole = "\n\n".join([STORY.strip()] * 5000)
    assert got == sorted([(1, STORY.strip())] * 2 + [(2, STORY.strip()), (3, ""), (4, ""), (None, whole)], key=repr)
    assert ht.main_texts(df.where("false")).count() == 0
