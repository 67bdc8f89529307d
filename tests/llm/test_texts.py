import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import markup, mixing, neardup, packing, subjects, tokens, words

DOC = "doc_id long, text string, lang string, source string, n_chars long, key string"
VOCABULARY = [f"word{i}" for i in range(400)] + ["naïve", "Straße", "ЖУК", "x²", "über", "l'eau"]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None, "x") for i, t, s in rows], DOC)


def shingles(text, k):
    w = re.findall(r"[^\W_]+", text.lower())
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


# --- words and phrases ---


def test_phrases_equal_brute_force():
    r = random.Random(1)
    texts = [" ".join(r.choices(VOCABULARY, k=r.randint(0, 60))) + r.choice(["", "!", " _a_b", "\n"]) for _ in range(300)] + ["", " ", "İstanbul'da bir iki üç", "a" * 300_000, "\U0001f600 a b c"]
    for k in (1, 3, 5):
        p, bounds = words.phrases(texts, k)
        want = [shingles(t, k) for t in texts]
        assert [int(b - a) for a, b in zip(bounds, bounds[1:], strict=False)] == [len(w) for w in want]
        sets = [set(p[a:b].tolist()) for a, b in zip(bounds, bounds[1:], strict=False)]
        for i, j in itertools.combinations(range(40), 2):
            assert len(sets[i] & sets[j]) == len(want[i] & want[j])


def test_blocks_do_not_change_hashes(monkeypatch):
    r = random.Random(8)
    texts = [" ".join(r.choices(VOCABULARY, k=50)), "x" * 500, "", "a b", "y" * 333 + " z"]
    whole = words.word_hashes(texts)
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(words, "BLOCK", size)
        assert all((a == b).all() for a, b in zip(whole, words.word_hashes(texts), strict=True))


def test_groups_cover_all():
    texts = ["x" * n for n in (0, 1, words.GROUP * 2, 5, words.GROUP - 1, 7)]
    spans = list(words.groups(texts))
    assert spans[0][0] == 0 and spans[-1][1] == len(texts) and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert list(words.groups([])) == []


# --- near duplicates ---


@pytest.mark.parametrize("crowd", [256, 2])
def test_pairs_equal_brute_force(spark, crowd):
    r = random.Random(4)
    rows, n = [], 0
    for _ in range(60):
        base = r.choices(VOCABULARY, k=r.randint(25, 120))
        for _ in range(r.randint(1, 4)):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 25))):
                w[r.randrange(len(w))] = r.choice(VOCABULARY)
            n += 1
            rows.append((n, " ".join(w), "a"))
    rows += [(n + 1, rows[0][1], "a"), (n + 2, rows[0][1].replace(" ", ", ") + "!", "b"), (n + 3, None, None), (n + 4, "", None), (n + 5, "too short", "a"), (None, rows[0][1], "a"), rows[3]]
    cfg = neardup.NearDup(phrase=3, threshold=0.7, min_phrases=20, crowd=crowd)
    members, links = neardup.near_duplicates(docs(spark, rows), cfg)
    got = sorted(map(tuple, neardup.expand(members, links).collect()))
    sets = {i: s for i, t, _ in rows if i and t and len(s := shingles(t, 3)) >= 20}
    want = sorted((a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= 0.7 * len(sets[a] | sets[b]))
    assert got == want and len(want) > 50
    classes = {tuple(x) for x in members.collect()}
    assert (n + 1, 1) in classes and (n + 2, 1) in classes
    assert neardup.near_duplicates(docs(spark, []), cfg)[1].count() == 0


def test_texts_of_one_template_are_not_paired(spark):
    """Two hundred texts share two thirds of their wording: no link, and hardly a candidate, though all meet in the buckets; real copies among them are found."""
    r = random.Random(9)
    frame = r.choices(VOCABULARY, k=150)
    rows = [(i, " ".join(frame + [f"own{i}x{k}" for k in range(75)]), "a") for i in range(1, 201)]
    rows += [(300 + i, rows[i][1].replace(f"own{i + 1}x7 ", ""), "a") for i in (3, 50)]
    cfg = neardup.NearDup(phrase=3, threshold=0.7, crowd=20)
    rare = neardup._over_rare_phrases(docs(spark, rows), cfg)
    assert sorted((x["a"], x["b"]) for x in rare.collect()) == [(4, 303), (51, 350)]
    members, links = neardup.near_duplicates(docs(spark, rows), cfg)
    assert sorted(map(tuple, links.collect())) == [(4, 303), (51, 350)] and members.count() == 202


def test_equal_hashes_within_a_text_are_not_in_common():
    p, bounds = words.whole_phrases(["a b c a b c a b c", "", "a b c"], 3)
    assert np.diff(bounds).tolist() == [3, 0, 1] and p[bounds[2]] in p[: bounds[1]] and (np.diff(p[:3].astype(np.float64)) > 0).all()
    assert len(words.whole_phrases(["a b"], 3)[0]) == 0


def test_likelihood_is_close():
    r, cfg = np.random.RandomState(0), neardup.NearDup(bands=64)
    for share in (0.1, 0.5, 0.9):
        common, each = int(1000 * share), int(1000 * (1 - share) / 2)
        u = r.randint(0, 1 << 44, common + 2 * each).astype(np.uint64)
        a, b = np.sort(u[: common + each]), np.sort(np.r_[u[:common], u[common + each :]])
        k = [neardup.sketch(x, np.array([0, len(x)]), cfg) for x in (a, b)]
        j = neardup.likelihood(k[0], k[1], np.array([float(len(a))]), np.array([float(len(b))]), cfg)[0]
        assert abs(j - share) < 0.12
        both = np.unique(np.r_[a, b])  # registers of a union are the greater ones
        assert (neardup.sketch(both, np.array([0, len(both)]), cfg) == np.maximum(*k)).all()


def test_long_texts_are_cut_into_steps():
    p = np.unique(np.random.RandomState(1).randint(0, 1 << 44, 100_000).astype(np.uint64))
    cfg = neardup.NearDup(bands=4)
    parts = [neardup.sketch(x, np.array([0, len(x)]), cfg) for x in np.array_split(p, 9)]
    assert (neardup.sketch(p, np.array([0, len(p)]), cfg) == np.maximum.reduce(parts)).all()


# --- packing ---


def test_fill_is_the_best_subset():
    r = random.Random(2)
    for _ in range(200):
        items = [r.randint(1, 30) for _ in range(r.randint(0, 9))]
        room = r.randint(0, 60)
        counts = {n: items.count(n) for n in items}
        used = packing.fill(room, counts, sorted(counts, reverse=True))
        best = max(sum(c) for k in range(len(items) + 1) for c in itertools.combinations(items, k) if sum(c) <= room)
        assert sum(n * k for n, k in used.items()) == best and all(k <= counts[n] for n, k in used.items())


def test_containers(spark):
    r = random.Random(3)
    items = [(i, r.choice([r.randint(1, 100), r.randint(1, 600), 512])) for i in range(600)] + [(1000, 5000), (1001, 0), (1002, None), (None, 7), (5, 9)]
    df = spark.createDataFrame([(i, n, "x") for i, n in items], "doc_id long, n_tokens long, item string")
    sizes = spark.createDataFrame([("s", 512), ("m", 2048), ("none", 0), (None, 5), ("null", None)], "container_kind string, capacity_tokens long")
    out = packing.pack(df, sizes)
    rows = out.collect()
    for kind, cap in (("s", 512), ("m", 2048)):
        mine = [x for x in rows if x["container_kind"] == kind]
        assert sum(x["n_tokens"] for x in mine) == sum(n or 0 for _, n in items)
        load, cuts = {}, {}
        for x in mine:
            load[x["container"]] = load.get(x["container"], 0) + x["n_tokens"]
            cuts.setdefault(x["doc_id"], []).append((x["token_begin"], x["n_tokens"]))
        assert max(load.values()) <= cap
        assert sorted(cuts[1000]) == [(b, min(cap, 5000 - b)) for b in range(0, 5000, cap)]
        assert all(len(cuts[i]) == 1 for i, n in items[:600] if n <= cap and i != 5)
        assert sum(load.values()) / (len(load) * cap) > 0.97
    assert {x["container_kind"] for x in rows} == {"s", "m"}
    assert packing.pack(df.limit(0), sizes).count() == 0 and packing.pack(df, sizes.limit(0)).count() == 0


# --- mixing ---


def test_deviation_below_one_block():
    r = random.Random(5)
    for _ in range(20):
        parts = mixing.parts_of({f"s{i}": r.random() + 0.001 for i in range(r.randint(1, 12))}, 200)
        slots, total = mixing.schedule(parts), sum(parts.values())
        done = dict.fromkeys(parts, 0)
        for t, s in enumerate(slots, 1):
            done[s] += 1
            assert all(abs(done[x] - t * n / total) < 1 for x, n in parts.items())
        assert done == parts


def test_shares(spark):
    r = random.Random(6)
    rows = [(i, r.choice(["a", "a", "a", "A ", "b", "c", None, "other"]), r.choice([0, None, 40, 70])) for i in range(2000)]
    counts = spark.createDataFrame([(i, s, n, "x") for i, s, n in rows], "doc_id long, source string, n_tokens long, slot string")
    targets = spark.createDataFrame([("a", 0.2, 1), (" B", 0.5, 4), ("c", 0.2, None), ("absent", 0.1, 3), (None, 0.1, 1)], "source string, target_share double, max_repeats long")
    mix, report = mixing.draws(counts, targets, block_tokens=500)
    got = {x["source"]: x for x in report.collect()}
    for s, w in (("a", 0.2), ("b", 0.5), ("c", 0.2)):
        assert abs(got[s]["actual_share"] - w / 0.9) < 0.01 and got[s]["most_repeats"] <= {"a": 1, "b": 4, "c": 1}[s]
    assert got["absent"]["tokens_drawn"] == 0 and got["other"]["draws"] == 0
    used = {}
    for x in mix.collect():
        used[x["doc_id"], x["repeat"]] = used.get((x["doc_id"], x["repeat"]), 0) + 1
    assert set(used.values()) == {1}
    slots = mix.groupBy("slot").agg(F.countDistinct("source").alias("n"), F.countDistinct("block").alias("b")).collect()
    assert all(x["n"] == 1 and x["b"] == 1 for x in slots)
    assert mixing.draws(counts.limit(0), targets)[0].count() == 0 and mixing.draws(counts, targets.limit(0))[0].count() == 0


def test_deviation_in_long_runs(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE", 3000)
    counts = spark.range(12_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), F.lit(1).alias("n_tokens"))
    for shares in ({"a": 0.14, "b": 0.85}, {"a": 0.141414, "b": 0.12345671}):  # a period of 99 slots; one longer than the run
        targets = spark.createDataFrame([(s, w, 9) for s, w in shares.items()] + [("absent", 0.01, 1)], "source string, target_share double, max_repeats long")
        mix = mixing.draws(counts, targets, budget=10_000, block_tokens=1)[0]
        got = [r["source"] for r in mix.orderBy("slot").select("source", "slot").collect()]
        slots = mix.agg(F.countDistinct("slot"), F.max("slot")).first()
        assert len(got) == slots[0] and 10_000 <= slots[0] <= 10_002
        for s, w in shares.items():
            done = np.cumsum([x == s for x in got])[:10_000]
            assert np.abs(done - np.arange(1, 10_001) * w / sum(shares.values())).max() < 1
        assert mix.select("doc_id", "repeat").distinct().count() == len(got)


def test_token_counts(spark):
    e = tokens.encoding(tokens.VOCABULARY)
    texts = ["Hello  world\n\n", "", None, "<|endoftext|>", "é" * 1000, "a" * 50_000, "日本語"]
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(docs(spark, [(i, t, "s") for i, t in enumerate(texts)]), ["doc_id"]).collect()}
    assert got == {i: len(e.encode_ordinary(t)) if t else 0 for i, t in enumerate(texts)}
    assert got[3] > 1 and e.decode(e.encode_ordinary(texts[0])) == texts[0]


# --- markup ---

CASES = {
    "The price fell from $3 to $9, x < 2 and y > 1, 3 * 4 * 5, note [12], C:\\drop\\run1, R&D; rank #2": set(),
    "* one\n* two\n\nplain words": set(),
    "== Head ==\n\n* one\n* two [[link]] '''b'''": {("wiki", "any"), ("wiki", "heading"), ("wiki", "list")},
    "# Head\n\nwords **bold** and [a](/b) `c`\n\n- one\n- two": {("markdown", "any"), ("markdown", "heading"), ("markdown", "list")},
    "Head\n====\n\n**b** [a](/b)\n\n```py\n<div>[[x]] # y\n```\n": {("markdown", "any"), ("markdown", "heading"), ("markdown", "code")},
    "<h2>H</h2><p>a&nbsp;b</p><ul><li>x</li></ul><pre>[[no]] '''no'''</pre>": {("html", "any"), ("html", "heading"), ("html", "list"), ("html", "code")},
    "<p>x</p> <math><mi>E</mi><mo>=</mo><mn>2</mn></math>": {("html", "any"), ("html", "formula")},
    "[[a]] <math>x^2 \\alpha</math> <ref>b</ref>": {("wiki", "any"), ("wiki", "formula")},
    "\\section{S} \\textbf{x} $a_{1} > 0$ costs $5\n\\begin{itemize}\n\\item one\n\\end{itemize}\n\\begin{verbatim}\n[[q]] <b>\n\\end{verbatim}": {("latex", e) for e in ("any", "heading", "list", "formula", "code")},
    "<div><table><tr><td><ul><li>one<ul><li>two</li></ul></li></ul></td></tr></table></div>": {("html", "any"), ("html", "list")},
    "<div class=a><h2>Title with <b>bold</b></h2><p>Rank #3, $5 &ndash; 2 * 3</p></div>": {("html", "any"), ("html", "heading")},
    "The <b>court</b> said <i>no</i>.<br/>It was [[late]].": {("html", "any"), ("wiki", "any")},
    "Some `code` here, see [this](http://x.example).\n\n1. first\n2. second": {("markdown", "any"), ("markdown", "list")},
    "{\\bf Bold} words with~\\cite{a} and 5\\% of $x_{1}$": {("latex", "any"), ("latex", "formula")},
    "{| class=x\n! a !! b\n|-\n| 1 || 2\n|}\n<math>x_1</math>": {("wiki", "any"), ("wiki", "formula")},
    "Cost: $12.50 (was $15); see C:/tmp/a_b.txt & note [3].": set(),
    "<p>An <a href=/x>anchor</a></p><pre><code># not a heading\n* no list</code></pre>": {("html", "any"), ("html", "code")},
    "words [[broken words\n\nand &lt;b&gt; too </div>": {("wiki", "any"), ("html", "any")},
    "": set(), " \n ": set(), "no markup at all": set(),
}


@pytest.fixture(scope="module")
def model():
    return markup.trained()


@pytest.mark.parametrize("text", list(CASES))
def test_constructs(model, text):
    ((nodes, classes),) = markup.analyse([text], model)
    assert markup.constructs(nodes, classes) == CASES[text]


def test_held_out_accuracy(model):
    maker, good, found, true = markup._Maker(777), 0, 0, 0
    for _ in range(600):
        text, spans = maker.text()
        feats, nodes = markup.lex(text)
        want = markup.constructs(nodes, markup._labels(nodes, feats, spans))
        ((n, c),) = markup.analyse([text], model)
        got = markup.constructs(n, c)
        good, found, true = good + len(got & want), found + len(got), true + len(want)
    assert good / found > 0.95 and good / true > 0.95


def test_blocks_silence_their_inside(model):
    text = "[[a]] '''b'''\n\n<source lang=x>\n[[no]] $x_1$ ```\n# no\n</source>\n"
    ((nodes, classes),) = markup.analyse([text], model)
    spans = [(n[1], n[6]) for n, c in zip(nodes, classes, strict=True) if c and markup.ELEMENTS[(c - 1) % 5] in ("code", "formula")]
    assert len(spans) == 1
    assert not any(c for n, c in zip(nodes, classes, strict=True) if spans[0][0] < n[1] < spans[0][1])


def test_clean_text(spark):
    wiki = "== Head ==\n\nOne [[two|three]] '''four'''<ref>gone</ref> {{x|y}} &amp; five\n\n* a\n** b\n\n<syntaxhighlight lang=py>\nx = [[1]]\n</syntaxhighlight>\n\n<math>x^2</math> costs $5"
    rows = [(1, wiki, "a"), (2, None, "a"), (3, "", "a"), (4, "plain $3 text", "a"), (5, "[[" * 40_000, "a"), (6, "\\textbf{x} caf\\'e \\cite{gone} 5\\% \\emph{y}", "a"), (6, "same", "a")]
    got = {}
    for r in markup.clean_texts(docs(spark, rows)).collect():
        got.setdefault(r["doc_id"], []).append(r["clean_text"])
    out = got[1][0]
    for want in ("## Head", "One three four  & five", "- a\n  - b", "```py\nx = [[1]]\n```", "$x^2$ costs $5"):
        assert want in out, out
    assert got[3] == [""] and got[4] == ["plain $3 text"] and sorted(got[6]) == ["same", "x café  5% y"] and 2 not in got
    assert markup.find_markup(docs(spark, [])).count() == 0


def test_elements_are_parents():
    feats, nodes = markup.lex("<div><ul><li>a</li><li><b>b</b></li></ul></div> <p>open <i>x</i>")
    at = {n[1]: i for i, n in enumerate(nodes)}
    of = lambda tag, k=0: nodes.index([n for n in nodes if markup._TAG_NAME.match("<div><ul><li>a</li><li><b>b</b></li></ul></div> <p>open <i>x</i>", n[1]).group() == tag][k])
    div, ul, li, b, p, i = of("<div"), of("<ul"), of("<li", 1), of("<b"), of("<p"), of("<i")
    assert nodes[ul][5] == div and nodes[li][5] == ul and nodes[b][5] == li and nodes[div][5] == nodes[p][5] == nodes[i][5] == -1 and len(at) == len(nodes)
    assert feats[b][markup.NESTING] == 3 and feats[b][markup.DEPTH] == 0 and feats[li][markup.SIBLINGS] == 2 and feats[ul][markup.DENSITY] == 3


def test_no_headings_or_lists_in_a_heading():
    nodes = [["tag", 0, 4, 4, 4, -1, 20], ["tag", 5, 9, 9, 9, 0, 9]]
    c = markup.cls
    logp = np.full((2, markup.N_CLASSES), -50.0)
    logp[0, c("html", "heading")], logp[0, c("html")] = -0.1, -3
    logp[1, c("html", "list")], logp[1, c("html")] = -0.1, -1
    assert markup.decode(nodes, logp) == [c("html", "heading"), c("html")]  # together likelier than the best of each
    logp[0, c("html")], logp[1, c("html")] = -0.5, -9
    assert markup.decode(nodes, logp) == [c("html"), c("html", "list")]


def test_clean_text_keeps_depth_and_language(model):
    def of(text):
        ((nodes, classes),) = markup.analyse([text], model)
        return markup.clean(text, nodes, classes)

    assert [x for x in of("<p>x</p><ul><li>a<ul><li>b<ol><li>c</li></ol></li></ul></li><li>d</li></ul>").split("\n") if x] == ["x", "- a", "  - b", "    - c", "- d"]
    for text in ("<p>x</p><pre><code class=\"hljs language-rust\">let x = 1;</code></pre>", "# H\n\n```rust\nlet x = 1;\n```\n", "[[a]]\n<syntaxhighlight lang=\"rust\" line>\nlet x = 1;\n</syntaxhighlight>",
                 "\\section{H}\n\\begin{lstlisting}[language=rust, numbers=left]\nlet x = 1;\n\\end{lstlisting}", "\\section{H}\n\\begin{minted}{rust}\nlet x = 1;\n\\end{minted}"):
        assert "```rust\nlet x = 1;\n```" in of(text), text
    assert "# H\n\n````\n```\n&lt;\n````" in of("# H\n\n~~~\n```\n&lt;\n~~~\n")  # a fence inside, entities as they are
    assert of("\\emph{a} {\\bf b {\\it c}} d") == "a b c d"


def test_many_open_tags_and_deep_lists(model):
    """More open tags than any bound: the element that was opened first is still closed."""
    text = "<div>" + "<b>" * 500 + "x" + "</div>" + "</nosuch>" * 3
    feats, nodes = markup.lex(text)
    assert feats[0][markup.CLOSED] == 1 and nodes[0][6] == text.index("</div>")
    deep = "== H ==\n" + "\n".join("*" * k + " item" for k in range(1, 60))
    ((n, c),) = markup.analyse([deep], model)
    assert markup.clean(deep, n, c).split("\n")[-1] == "  " * 58 + "- item"


def test_long_constructs_are_read_whole():
    import time

    def first(text):
        feats, nodes = markup.lex(text)
        return nodes[0][0], feats[0][markup.CLOSED], feats[0][markup.CONTENT]

    for a, b in ("()", "[]"):
        assert first(f"\\{a}" + "x^2 + " * 1000 + f"[[y]]\\{b}") == ("math", 1, 2) and first(f"\\{a}" + "x^2 + " * 1000)[1] == 0
    for a, b in (("<math>", "</math>"), ("$$", "$$")):
        assert first(a + "word " * 500 + "<mi>x</mi>" + b)[2] == 4 and first(a + "word " * 500 + b + "<mi>x</mi>")[2] == 3
    assert first("**" + "word " * 60 + "end** of it")[0] == "stars"
    began = time.time()
    markup.lex("\\( x " * 20_000 + "\\)")
    assert time.time() - began < 10


def test_tables_become_plain_cells(model):
    def of(text):
        ((nodes, classes),) = markup.analyse([text], model)
        return markup.clean(text, nodes, classes), markup.constructs(nodes, classes)

    table = '{| class="wikitable"\n|+ style="x" | The caption\n! Register !! n\n|-\n| [[Ju|wen]] || 4\n|-\n| style="a" | x || width=2 | {{t||u}}y\n| one\n| two\n|}\n\nplain | text || stays'
    out = of(table)[0]
    assert [x for x in out.split("\n") if x] == ["The caption", "Register\tn", "wen\t4", "x\ty", "one", "two", "plain | text || stays"]
    assert of(table.replace("\n|}", ""))[0] == out  # broken off
    assert of("end of a row\n| Juwen || 4\n! Head !! n") == ("end of a row\nJuwen\t4\nHead\tn", {("wiki", "any")})
    assert of("! stop it, now !\na | b\n| c | d |")[0] == "! stop it, now !\na | b\n| c | d |"
    assert of("# Head\n\n| a || b |\n\n**b** [a](/b)")[1] == {("markdown", "any"), ("markdown", "heading")}  # a Markdown row with an empty cell
    for sign in ("a=", " ", "|| ", "! ", "!!", "| a", "|| a ||\n"):
        assert isinstance(of("{|\n| " + sign * 20_000)[0], str) and isinstance(of("| " + sign * 20_000)[0], str)
    code = "```\n| a || b\n```\n\n# Head\n\n**b** [a](/b)"
    assert "| a || b" in of(code)[0] and ("wiki", "any") not in of(code)[1]


def test_endless_openings_take_linear_time(model):
    import time

    for sign in ("<!-- ", "<pre>", "```\n", "\\( ", "$$ x", "\\begin{verbatim}", "[[", "{{", "<ref>", "**", "<b>", "* ", "`", "$a", "<a b='"):
        text = sign * 20_000
        began = time.time()
        ((nodes, classes),) = markup.analyse([text], model)
        assert isinstance(markup.clean(text, nodes, classes), str) and time.time() - began < 10, sign


# --- subjects ---


def _corpus(n, seed):
    r = random.Random(seed)
    terms = {"law": ["court", "statute", "judge"], "music": ["chord", "melody", "violin"], "sport": ["goal", "racket", "match"]}
    rows = []
    for i in range(n):
        chosen = r.sample(list(terms), r.choice([0, 1, 1, 1, 2]))
        count = r.randint(3, 12)
        about = [r.choice([*chosen, *chosen, None]) if chosen else None for _ in range(count)]
        said = [f"Few writers mention that the {r.choice(terms[a])} near {r.choice(VOCABULARY)} stayed." if a else f"I have reverted the page of {r.choice(VOCABULARY)} again." for a in about]
        true = {a for a in chosen if about.count(a) * 3 >= count}
        rows.append((i, "== Head ==\n\n" + " ".join(said), true))
    return rows


def test_subjects(spark):
    rows = _corpus(700, 1)
    r = random.Random(2)
    labels = [(i, s, f"r{r.randint(1, 3)}") for i, _, true in rows[:350] for s in (true or {"none"}) if r.random() > 0.05]
    labels += [(1, None, "r1"), (None, "law", "r1"), (99999, "law", None), (2, "law", None)]
    table = docs(spark, [(i, t, "talk") for i, t, _ in rows] + [(5000, None, None), (5001, "", None), (5002, "\n\n", "x"), (None, "court", "x"), (5003, "x" * 200_000, None)])
    lab = spark.createDataFrame(labels, "doc_id long, subject string, annotator string")
    subj = spark.createDataFrame([("law", ""), ("music", ""), ("sport", None), (None, "")], "subject string, description string")
    model = subjects.fit(table, lab, subj)
    got = {tuple(x) for x in subjects.assign(table, model).collect()}
    want = {(i, s) for i, _, true in rows for s in true}
    held = {x for x in got if x[0] >= 350}, {x for x in want if x[0] >= 350}
    hit = len(held[0] & held[1])
    assert hit / len(held[0]) > 0.93 and hit / len(held[1]) > 0.93
    assert not {x for x in got if x[0] >= 5000}
    assert subjects.assign(table, subjects.fit(table, lab.limit(0), subj)).count() >= 0
    assert subjects.assign(table.limit(0), model).count() == 0


def test_every_source_counts():
    """More sources than columns, and more than any list: each has a column, and the model can tell them."""
    texts = [f"The court of {VOCABULARY[i % 400]} met." for i in range(200)]
    for n in (40, 100):
        model = subjects.train(texts, [f"s{i % n}" for i in range(200)], ["en"] * 200, [{"law"} if i % n == n - 1 else set() for i in range(200)], ["law"])
        assert len(model.sources) == n and len(set(model.sources.values())) == min(n, subjects.SOURCE_COLUMNS)
        x = subjects.features(texts[:2], [f"s{n - 1}", "unknown"], model.index, model.weights, model.sources)
        assert x[0, -min(n, subjects.SOURCE_COLUMNS) :].sum() == 1 and x[1, -min(n, subjects.SOURCE_COLUMNS) :].sum() == 0


def test_sample_is_bounded_but_never_empty(spark, monkeypatch):
    rows = _corpus(60, 3)
    table = docs(spark, [(i, t, "talk") for i, t, _ in rows] + [(900, "court " * 5000, "talk")])
    lab = spark.createDataFrame([(i, s, "r") for i, _, true in rows for s in (true or {"none"})] + [(900, "law", "r")], "doc_id long, subject string, annotator string")
    subj = spark.createDataFrame([("law", ""), ("music", ""), ("sport", "")], "subject string, description string")
    taken = []
    monkeypatch.setattr(subjects, "train", lambda texts, *_: taken.append(sorted(map(len, texts))))
    for limit, want in ((10**9, 61), (10_000, None), (1, 1)):
        monkeypatch.setattr(subjects, "SAMPLE_CHARACTERS", limit)
        subjects.fit(table, lab, subj)
        assert len(taken[-1]) == want if want else 5 < len(taken[-1]) < 61 and sum(taken[-1]) <= limit
    monkeypatch.setattr(subjects, "SAMPLE_CHARACTERS", 10**9)
    subjects.fit(table, lab, subj, sample=7)
    assert len(taken[-1]) == 7


def test_closings_end_however_far():
    far = "<pre>code. here.</pre" + " " * 500 + "> After it."
    assert subjects.plain(far).split() == ["After", "it."]
    assert subjects.plain("\\begin{align" + "*}x. y.\\end{align*} After.").split() == ["After."]


def test_short_items_and_headings():
    count = lambda t: len(subjects._sentences([t])[2])
    assert count("# Only a heading of six words\n\nText here.") == 1 and count("# one\n# two\n# three") == 3
    assert count("* a\n* b c\n\t* d") == 3 and count("1. x\n2. y") == 2 and count("## Two words\n\n- z") == 1


def test_sentences_count_items_but_not_headings():
    text = "== Head line here ==\n\nOne two three. Four five!\n\n* item one two three\n* item four five six\n\n<pre>\ncode here. more.\n</pre>\n{| class=x\n| a b c d\n|}\nloose line without stop\n"
    _, number, of = subjects._sentences([text, "", "Only one."])
    assert of.tolist() == [0, 0, 0, 0, 2] and number.max() == 4
