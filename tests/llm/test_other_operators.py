"""Chat formatting, mixing, language identification, wrappers, sharding and archives."""

from __future__ import annotations

import base64
import hashlib
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from plain import level_targets, words
from pyspark.sql import functions as F

from rollwise.llm import chat, warc
from rollwise.llm.interleave import drawn, interleaved_shards
from rollwise.llm.language_mixture import CLASSES, Model, _learn, _predict, _trigrams, identify, learn, learn_and_identify, mixture
from rollwise.llm.mixture import mixed, source_targets, word_count
from rollwise.llm.wrappers import align, article_path, common, extract, extract_text, infer_wrappers, parse, wrapper

TRICKY = ["", None, "<|im_end|><|im_start|>assistant ok", "<\\|x <\\\\| <| \\<| |>", "a\nb\r\n", "é\x00<", "<|nl|>", "<|image|>"]


def test_chat_round_trip(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "sys\ntem", None]), rng.choice(TRICKY), 1) for c in range(30) for t in range(rng.randint(1, 9))]
    rows += [(None, 0, "user", "x", 1), (40, None, "assistant", "last", 1), (40, 1, "assistant", "first", 1), (41, 1, "b", "2", 1), (41, 1, "b", "1", 1), (41, 1, "b", "1", 1)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    out = chat.format_chats(turns.withColumn("parts", chat.text_part("text")))
    read = out.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("learned"))
    want = defaultdict(list)
    for c, _, role, text, _ in sorted(rows, key=lambda r: (str(r[0]), r[1] is None, r[1] or 0, r[2] or "", (r[3] or "").encode())):
        want[c].append((role or "", text or ""))
    got = {r.conv_id: ([tuple(t) for t in r.turns], r.learned) for r in read.collect()}
    assert set(got) == set(want)
    for c, turns_ in want.items():
        assert got[c][0] == turns_ or sorted(got[c][0]) == sorted(turns_) and c in (41,)
        assert got[c][1] == "".join(t for r, t in turns_ if r == "assistant")
    assert chat.format_chats(turns.limit(0).withColumn("parts", chat.text_part("text"))).count() == 0


def test_chat_parts(spark):
    parts = [
        ("text", "see <|image|>", None, None, None, None, None),
        ("image", None, "cat.png", 57, 28, None, None),
        ("audio", None, "a.wav", None, None, 1.5, None),
        ("document", None, None, None, None, None, 3),
        (None, " end", None, None, None, None, None),
    ]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", parts[1:2]), (2, 0, "user", None)]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    one, two = chat.format_chats(turns).orderBy("conv_id").collect()
    assert "see <\\|image|><|image|><|audio|><|document|> end" in one.formatted
    assert [tuple(a) for a in one.attachments] == [("image", "cat.png", 3), ("audio", "a.wav", 38), ("document", None, 768), ("image", "cat.png", 3)]
    text_tokens = 6 + 1  # see < | image | > and end
    assert one.tokens == 3 + 38 + 768 + 3 + text_tokens
    assert [one.formatted[s.start - 1 : s.start - 1 + s.length] for s in one.loss] == ["<|image|>"]
    assert (two.attachments, two.loss, two.tokens) == ([], [], 0)


def test_mixture_targets_and_copies(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40])), rng.choice(["a", "b", "é", "Z", "zz", None] + ["hot"] * 4), 1) for i in range(3000)]
    rows += [(None, "w w w", "a", 1), (None, None, "none", 1), (7, "w w", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    sizes = Counter()
    for _, text, source, _ in rows:
        sizes[source] += len(words(text))
    targets = source_targets(docs.select("source", word_count("text").alias("size")))
    got = {r.source: (r.source_size, r.target) for r in targets.collect()}
    want = level_targets(sizes)
    assert {s: n for s, (n, _) in got.items()} == dict(sizes)
    assert all(got[s][1] == pytest.approx(want[s]) for s in want)
    out = mixed(docs)
    assert out.columns == docs.columns
    taken = Counter()
    repeats = Counter()
    for r in out.collect():
        taken[r.source] += len(words(r.text))
        repeats[r.doc_id, r.text, r.source] += 1
    given = Counter((d, t, s) for d, t, s, _ in rows)
    for key, n in repeats.items():
        assert n <= 2 * given[key]
    for s, target in want.items():
        assert abs(taken[s] - target) <= max(60, 0.08 * target), s
        whole, part = divmod(target / sizes[s], 1) if sizes[s] else (0, 0)
        for key, n in given.items():
            if key[2] == s:
                assert n * whole <= repeats[key] <= n * (whole + (part > 0))
    assert sorted(map(str, mixed(docs).collect())) == sorted(map(str, out.collect()))
    assert mixed(docs.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None, "a", 1), (2, " ", None, 1)], docs.schema)
    assert mixed(blank).count() == 0


def test_languages(spark):
    rng = random.Random(5)
    letters = {"aa": "abcdef", "bb": "efghij", "cc": "ijklmé"}
    speak = lambda lang, n: " ".join("".join(rng.choices(letters[lang], k=rng.randint(2, 7))) for _ in range(n))
    rows = [(i, speak(lang := rng.choice(sorted(letters)), rng.randint(20, 80)), rng.choice([lang] * 9 + [None]), lang) for i in range(400)]
    odd = [(1000, None, "aa", None), (1001, "", "aa", None), (1002, "123 %%% \n", "bb", None), (None, speak("bb", 40), "bb", "bb"), (1003, speak("cc", 60).upper() + " !!", None, "cc"), (1004, speak("aa", 20_000), None, "aa")]
    schema = "doc_id long, text string, lang string, score string"
    found = {r.doc_id: r for r in learn_and_identify(spark.createDataFrame(rows + odd, schema)).collect()}
    assert len(found) == len(rows) + len(odd)
    for doc, text, _, true in rows + odd:
        r = found[doc]
        assert r.held_out == (zlib.crc32(str("" if doc is None else doc).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        if true is None:
            assert (r.lang_pred, r.score) == ("und", 0.0)
    right = [found[d].lang_pred == true for d, _, _, true in rows + odd if true]
    assert sum(right) >= 0.99 * len(right)
    model = learn(spark.createDataFrame(rows, schema))
    both = mixture(pa.array([speak("aa", 300) + " " + speak("cc", 100), speak("bb", 200)]), model)
    assert (both[0] > 0).tolist() == [True, False, True] and both[0][0] == pytest.approx(0.75, abs=0.08)
    assert (both[1] > 0).tolist() == [False, True, False]
    none = identify(spark.createDataFrame(rows[:3], schema).select("doc_id", "text"), Model([], mixture_table()))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    assert learn_and_identify(spark.createDataFrame(rows, schema).limit(0)).count() == 0


def test_language_tasks_take_memory_by_the_slice():
    import numpy as np

    texts = [f"Wort{i % 977} und mehr Text der Zeile {i}, " * 100 for i in range(1500)]
    batch = pa.record_batch({"text": pa.array(texts), "lang": pa.array([("de", "en")[i % 2] for i in range(1500)])})
    assert batch.nbytes > 4 << 20
    model = Model(["de", "en"], np.full((CLASSES, 2), 1 / CLASSES, np.float32))
    for task in (lambda: _learn(iter([batch]), CLASSES), lambda: _predict(iter([batch]), model)):
        tracemalloc.start()
        for _ in task():
            pass
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 64 << 20


@pytest.mark.parametrize("spoken", [4, 5, 7])
def test_mixture_of_many_languages(spoken):
    import numpy as np

    rng = random.Random(spoken)
    letters = {lang: "".join(rng.sample("abcdefghijklmnopqrstuvwxyz", 8)) for lang in "ABCDEFGH"}
    speak = lambda lang, n: " ".join("".join(rng.choices(letters[lang], k=rng.randint(2, 7))) for _ in range(n))
    languages = sorted(letters)
    counts = np.zeros((CLASSES, len(languages)))
    for i, lang in enumerate(languages):
        classes, count, _, _ = _trigrams(pa.array([speak(lang, 20_000)]), CLASSES)
        counts[classes, i] = count
    model = Model(languages, ((counts + 0.5) / (counts.sum(0) + 0.5 * CLASSES)).astype(np.float32))
    texts = [" ".join(speak(lang, 300) for lang in languages[:spoken]), speak("A", 300), speak("B", 3), " ".join(speak(lang, 300) for lang in languages[-spoken:])]
    shares = mixture(pa.array(texts), model)
    assert (shares[0] > 0).tolist() == [i < spoken for i in range(8)]
    assert (shares[3] > 0).tolist() == [i >= 8 - spoken for i in range(8)]
    assert shares[[0, 3]].max() == pytest.approx(1 / spoken, abs=0.05)
    assert (shares[1] > 0).tolist() == [i == 0 for i in range(8)] and shares[2].argmax() == 1
    assert shares.sum(1) == pytest.approx(np.ones(4), abs=1e-3)


def mixture_table():
    import numpy as np

    return np.zeros((16, 0), np.float32)


PAGE = """<!DOCTYPE html><html><head><title>{t}</title><style>p {{ }}</style><script>var a = "</p><article>no</article>";</script></head>
<body class="home"><header><h1>The site</h1></header><nav><ul><li>a<li>b</ul></nav><div class="cookie-notice">we use</div>
{open}<h1>{t}</h1>{body}<aside>aside</aside><form>f<input></form><!-- <p>no</p> -->{close}
<section id="comments"><p>a reader</p></section><div class='sidebar'>x</div><footer>&copy; us"""


def page(title, body, kind="article"):
    return PAGE.format(t=title, body=body, open=f"<{kind}>", close=f"</{kind.split()[0]}>")


def test_extraction_rules():
    body = "<p>one <b>two\n three</b>four<p>&lt;five&gt; &amp; caf&eacute;<br>six<ul><li>s</li><li>t</ul><table><tr><td>u<td>v</table>"
    want = "T one two threefour <five> & café six s t u v"
    assert extract(page("T", body), None) == want
    assert extract(page("T", body, "main"), None) == want
    assert extract(page("T", body, "div class=x"), None) == want
    assert extract("", None) == "" and extract("just text", None) == "just text"
    assert extract("<article><p>open <i>ended", None) == "open ended"
    assert extract("</p></div><article>a</b>b</article>tail", None) == "ab"
    assert extract("<p " + "x" * 100_000, None) == "<p " + "x" * 100_000
    assert len(extract(page("T", "<p>" + "long " * 100_000), None)) > 499_000


def test_layout_containers_are_not_boilerplate():
    text = "<h1>T</h1><p>" + "the whole story " * 20 + "</p>"
    want = ("T " + "the whole story " * 20).strip()
    frame = "<body><nav>menu</nav><div class='sidebar'>links</div>{}<footer>us</footer>"
    for words in ("page no-sidebar", "content with-sidebar", "elementor-widget", "search-results", "wrapper navbar-fixed"):
        for inner in ("<article>{}</article>", "<main>{}</main>", "<div>{}</div>", "<div class='text'><main>{}</main></div>"):
            assert extract(frame.format(f"<div class='{words}'>{inner.format(text)}</div>"), None) == want
    assert extract(frame.format(f"<main><div class='content with-sidebar'><article>{text}</article></div></main>"), None) == want
    assert extract(frame.format(f"<form action='/x'><div class='header'>site</div><article>{text}</article></form>"), None) == want
    assert extract(frame.format(f"<form><div>{text}</div></form>"), None) == want
    # Many comments stay out beside a short article.
    short = "<div><p>short</p></div><div id='comments'><article>" + "a reader says " * 90 + "</article></div>"
    assert extract(frame.format(short), None) == "short"


def test_pages_that_lost_text():
    frame = "<body><nav>menu</nav>{}<footer>us</footer>"
    deep = extract("<div>" * 10_000 + "<p>inner</p>" + "</div>" * 10_000 + "<p>after</p>", None)
    assert deep == "inner after"
    assert extract(frame.format("<nav>" * 3000 + "x" + "</nav>" * 3000 + "<article><p>kept</p></article>"), None) == "kept"
    assert extract(frame.format("<article>" + "<b>" * 2000 + "text" + "<nav>links</nav> end</article>"), None) == "text end"
    article = "<article><h1>T</h1><p>before</p>{}<p>after</p></article>"
    for raw in ('<svg class="i"/>', "<noscript><img></noscript>", "<svg><title>x</title></svg>", "<iframe src=a></iframe>", "<script src='a'/>", "<div><noscript>no script</div>", "<div><svg><path></div>"):
        assert extract(frame.format(article.format(raw)), None) == "T before after", raw
    story = "<div><h2>S</h2><p>" + "the story goes on " * 70 + "</p></div>"
    assert extract(frame.format(story + "<article><h3>Teaser</h3></article>"), None) == ("S " + "the story goes on " * 70).strip()
    for words in ("share-price", "search-results", "ad-hoc", "notice-board", "table-of-contents", "alert-level"):
        assert extract(frame.format(article.format(f"<div class='{words}'>body</div>")), None) == "T before body after", words
    for words in ("ad", "ads top", "ad-slot", "advert-box", "social-share", "share-buttons", "notice", "cookie-notice", "related-posts", "newsletter-signup", "post-comments", "ad-1", "widget"):
        assert extract(frame.format(article.format(f"<div class='{words}'>not this</div>")), None) == "T before after", words


def test_common_subsequence_is_longest():
    rng = random.Random(18)
    for _ in range(300):
        a, b = (rng.choices("abcd", k=rng.randrange(9)) for _ in range(2))
        length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                length[i + 1][j + 1] = length[i][j] + 1 if a[i] == b[j] else max(length[i][j + 1], length[i + 1][j])
        found = common(a, b)
        assert len(found) == length[-1][-1] and all(a[i] == b[j] for i, j in found)
        assert all(x < u and y < v for (x, y), (u, v) in zip(found, found[1:]))
    long = [str(i % 700) for i in range(6000)]
    assert len(common(long, long[::2])) == 3000


def test_template_of_a_host(spark):
    """Two templates on one host; texts by hand. What all pages of a template's place share goes, headings stay."""
    first = "<body><div class='top-bar'>Shop</div><div class='story'><h1>{t}</h1><div>All prices include <b>tax</b> and everything else that the law asks us to print on every page</div><h2>Details</h2><p>{a}</p><p>{b}</p></div><div class='x12 col'>Call us</div></body>"
    second = "<body><article id='post-{i}' class='post-{i}'><h1>{t}</h1><p>{a}</p><div class='more'>{b}</div></article><div class='latest'>other news of this day</div></body>"
    rows, want = [], {}
    for i in range(24):
        values = {"i": i, "t": f"title {i}", "a": f"one {i} " + "long enough to count " * 3, "b": f"two {i} " + "and some more " * 2}
        host, template = ("one.example", first) if i % 3 else ("two.example", second)
        rows.append((i, f"https://{host}/{i}", template.format(**values)))
        parts = [values["t"], *(["Details"] if i % 3 else []), values["a"], values["b"]]
        want[i] = " ".join(" ".join(parts).split())
    for parts, fan in ((1, 32), (7, 32), (5, 2)):
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
        assert {r.page_id: r.text for r in extract_text(pages).collect()} == want
        rules = sorted(map(tuple, infer_wrappers(pages, fan).select("host", "path", "template").collect()))
        assert [r[0] for r in rules] == ["one.example", "two.example"]


def test_wrappers_do_not_depend_on_how_pages_are_dealt(spark):
    rng = random.Random(19)
    rows = [(i, "http://h/", page(f"t{i}", "".join(rng.choice(["<p>x</p>", "<h2>y</h2>", "<ul><li>z</ul>", f"<div class='c{i % 5}'>v</div>"]) for _ in range(rng.randrange(6))))) for i in range(80)]
    found = set()
    for parts in (1, 3, 8):
        pages = spark.createDataFrame(rng.sample(rows, len(rows)), "page_id long, url string, html string").repartition(parts)
        found.add(infer_wrappers(pages, fan=4).first()["wrapper"])
    assert len(found) == 1


def test_wrappers_align_pages():
    pages = [wrapper(parse(page(f"title {i}", "".join(f"<p>{i} {k}</p>" for k in range(i)) + "<h2>Same</h2>" * (i % 2)))) for i in range(6)]
    whole = pages[0]
    for p in pages[1:]:
        whole = align(whole, p)
    body = whole[6][0][6][1]
    article = next(x for x in body[6] if x[0] == "article")
    kinds = {x[0]: x for x in article[6]}
    assert kinds["p"][1:3] == [True, True] and kinds["h2"][1] and not kinds["h1"][1]
    assert kinds["h1"][6][0][4] is None and kinds["h2"][6][0][4] == "Same"
    assert article_path(whole) == ["", "html", "body.home", "article"]
    pairs = wrapper(parse("<dl>" + "<dt>k</dt><dd>v</dd>" * 5 + "</dl>"))
    assert pairs[6][0][6][0][0] == "(dt dd)" and pairs[6][0][6][0][2]
    many = wrapper(parse("<div>" + "".join(f"<x{i % 70}>a</x{i % 70}>" for i in range(700)) + "</div>"))
    assert len(many[6][0][6]) <= 70


def test_extraction_over_hosts(spark):
    rows = [(i, f"https://h{i % 3}.example/{i}", page(f"t{i}", f"<p>body {i}", ["article", "main", "div class=text"][i % 3]), 1) for i in range(60)]
    rows += [(None, None, None, 1), (100, "u", "", 1), (0, rows[0][1], rows[0][2], 1), (101, rows[1][1], "<p>other shape</p>", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int").repartition(4)
    got = sorted(map(tuple, extract_text(pages).collect()), key=str)
    text = {None: "", 100: "", 101: "other shape"} | {i: f"t{i} body {i}" for i in range(60)}
    assert got == sorted([(i, u, text[i], len(text[i])) for i, u, _, _ in rows], key=str)
    assert {r.host for r in infer_wrappers(pages).collect()} == {"", "h0.example", "h1.example", "h2.example"}
    assert extract_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("shards, chunk", [(40, 4096), (7, 16), (1, 5)])
def test_shards_match_the_mixture(spark, shards, chunk):
    rng = random.Random(6)
    rows = [(i, rng.choice(["a"] * 5 + ["b", "c", None]), "t" * rng.randint(0, 3), 9) for i in range(700)]
    rows += [(None, "a", None, 9), (None, None, None, 9), (5, "b", "t", 9), (5, "b", "t", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, shard int")
    out = interleaved_shards(docs, shards, chunk_rows=chunk)
    assert out.columns == ["doc_id", "source", "text", "shard", "slot"]
    got = out.collect()
    assert Counter((r.doc_id, r.source, r.text) for r in got) == Counter(r[:3] for r in rows)
    slots = defaultdict(list)
    mix = defaultdict(Counter)
    for r in got:
        slots[r.shard].append(r.slot)
        mix[r.shard][r.source] += 1
    assert set(slots) == set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    whole = Counter(r[1] for r in rows)
    for shard in slots:
        for source, n in whole.items():
            assert abs(mix[shard][source] - n / shards) <= 2
    again = interleaved_shards(docs.repartition(5), shards, chunk_rows=chunk).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
    assert interleaved_shards(docs.limit(0), shards).count() == 0


def test_shards_follow_the_draws(spark):
    """Every row's shard and slot worked out again from the numbers drawn, in plain Python."""
    rng = random.Random(16)
    rows = [(i if i % 9 else None, rng.choice(["a"] * 4 + ["b", None]), f"t{i % 50}", i) for i in range(500)] + [(3, "a", "same", 1)] * 90
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, n int").repartition(4)
    keys = drawn(docs, 7, "source", "doc_id", 10**6).select("row.*", "source", "tie", "at").collect()
    order = sorted(((r.source is not None, (r.source or "").encode()), r.at, r.tie, i) for i, r in enumerate(keys))
    whole, rank, placed = Counter(x[0] for x in order), Counter(), []
    for source, at, tie, i in order:
        rank[source] += 1
        placed.append(((2 * rank[source] - 1) / (2 * whole[source]), source, at, tie, i))
    placed.sort()
    want, sizes = [], Counter()
    for position, (*_, i) in enumerate(placed):
        shard = position * 7 // len(placed)
        want.append((str(tuple(keys[i])[:4]), shard, sizes[shard]))
        sizes[shard] += 1
    for chunk in (1000, 6):
        got = [(str(tuple(r)[:4]), r.shard, r.slot) for r in interleaved_shards(docs, 7, chunk_rows=chunk).collect()]
        # The 90 equal rows are drawn apart once they are more than a chunk.
        single = [x for x in got if "same" not in x[0]]
        assert len(got) == len(want)
        if chunk > 90:
            assert sorted(got) == sorted(want)
        else:
            assert sorted(x[0] for x in got) == sorted(x[0] for x in want) and len(single) == 500
            assert max(Counter(x[1] for x in got).values()) - min(Counter(x[1] for x in got).values()) <= 1


def test_shards_take_columns_of_any_name_and_type(spark):
    names = ["doc_id", "source", "text", "_hash", "_source", "_n", "_rank", "rank", "at", "chunk", "band", "row", "SHARD", "a.b", "c`d"]
    docs = spark.range(60).select(
        *[F.col("id").cast("string").alias(n) for n in names], F.create_map(F.lit(1), F.col("id")).alias("map"), F.array("id").alias("list"), F.struct("id").alias("struct")
    )
    out = interleaved_shards(docs, 3)
    kept = [c for c in docs.columns if c != "SHARD"]
    assert out.columns == [*kept, "shard", "slot"]
    assert sorted(str(tuple(r)[:-2]) for r in out.collect()) == sorted(str(tuple(x for x, c in zip(r, docs.columns) if c != "SHARD")) for r in docs.collect())


def test_archives_round_trip(spark):
    rng = random.Random(8)
    big = "é€x" * 30_000
    bodies = ["", None, "a", "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n", "0\r\n\r\n", big, big + "!", "﻿\x00é"]
    rows = [(i, f"http://h/{i}\r\nx", rng.choice(bodies), 1) for i in range(80)]
    rows += [(None, None, "only here", 1), (None, "u", "a", 1), (200, "u", big + "?", 1), (200, "u", big + "?", 1), (200, "u", "a", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(3)
    first = {}
    for i, _, html, _ in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    want = []
    for i, _, html, _ in rows:
        body = (html or "").encode()
        refers = first.get(html or "") if first.get(html or "") != i else None
        want.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if refers is not None else "response", refers))
    assert sorted(map(tuple, warc.archived(pages).collect()), key=str) == sorted(want, key=str)
    path = warc.new_path(spark, "warc-test")
    warc.write_archives(pages, path, least=10)
    records = warc.read_records(spark, path)
    assert records.filter("type = 'continuation'").count() > 0
    whole = warc.reassembled(records).collect()
    assert len(whole) == len(rows) and {r.type for r in whole} == {"response", "revisit"}
    assert all(r.type == "response" for r in whole if int(r.length) < 10)
    assert warc.archived(pages.limit(0)).count() == 0
    lost = records.filter("segment IS NULL OR segment <> 2")
    with pytest.raises(Exception, match="segments missing"):
        warc.reassembled(lost).collect()


def test_chunked_framing():
    body = ("é" * 9000).encode()
    framed = warc._chunked(body).encode()
    assert warc.unchunked(framed) == body and warc.unchunked(b"3;x=y\r\nabc\r\n0\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"2\r\nabc\r\n0\r\n\r\n")
