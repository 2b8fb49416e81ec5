"""Personal data, benchmark leaks, licenses and main text against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm import decontaminate, html_main, licenses, pii


def slow_spans(text: str) -> list:
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        if 16 <= len(digits) <= 19 and sum(x // 10 + x % 10 for x in twice) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="a@.b14 52+-3(%é", max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == slow_spans(text)


CARD = "4111 1111 1111 1111"


def test_entities_of_odd_texts():
    assert pii.base_spans(f"{CARD}, 4111111111111112, 300.1.1.1 1.2.3.4.5.6.7.8 +1 (017) 555-7713") == [
        ("ip", 49, 56),
        ("ip", 57, 64),
        ("card", 0, 19),
        ("phone", 65, 82),
    ]
    assert pii.base_spans(f"{CARD} {CARD}") == []  # one run of 32 digits
    assert pii.base_spans("a" * 50_000 + "1" * 5_000 + "@" * 5_000) == []


def test_terms_that_disclose_an_entity(spark, no_docs):
    pick = random.Random(4)
    words = [a + b + c for a in "bdfg" for b in ("ana", "ebe", "ili") for c in ("lo", "mi", "tu", "ra")]
    rows = []
    for i in range(400):
        rows.append((i, " ".join(pick.choices(words, k=40))))
    for i in range(6):  # the nickname stands beside the address, and nowhere else
        text = " ".join(pick.choices(words, k=15))
        rows.append((1000 + i, f"{text} Zorro writes from don.diego@vega.example now {text}"))
    rows += [(2000 + i, "copy lonely beside solo@copies.example always") for i in range(50)]
    rows += [(3000, None), (3001, ""), (None, "x@y.example"), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    assert docs.count() == pii.find_personal_data(docs).count()
    for i, text in rows:
        spans = slow_spans(text or "")
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert found[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [getattr(found[i], f"n_{k}") for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert found[i].spans.startswith(base)
        terms = [s.split(":") for s in found[i].spans.split(",") if s.startswith("term")]
        named = {text[int(a) : int(b)].lower() for _, a, b in terms}
        # Copies of one text are one context, which discloses nothing.
        assert ("zorro" in named) == (i is not None and 1000 <= i < 2000)
        assert not (i is not None and 2000 <= i < 3000 and named)
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "Zorro" not in clean[1000] and "don.diego" not in clean[1000] and "<email>" in clean[1000]
    assert clean[5] == rows[5][1]
    assert pii.find_personal_data(no_docs).count() == 0


def test_chance_bounds_the_poisson_tail(spark):
    cases = [(k, e) for k in (1, 2, 5, 30) for e in (1e-4, 0.1, 0.9, 4.0, 40.0)]
    frame = spark.createDataFrame(cases, "met bigint, expected double")
    got = frame.withColumn("p", pii.chance(F.col("met"), F.col("expected"))).collect()
    for r in got:
        tail = 1 - sum(math.exp(-r.expected) * r.expected**i / math.factorial(i) for i in range(r.met))
        assert tail <= r.p + 1e-12
        if r.met > 2 * r.expected:
            assert r.p <= 2 * tail + 1e-12


@pytest.mark.parametrize("size", [300, 3000])
def test_words_that_meet_entities_by_chance_stay(spark, size):
    pick = random.Random(size)
    words = ["".join(pick.choices("abcdefgh", k=5)) for _ in range(500)]
    rows = []
    for i in range(size):
        text = pick.choices(words, k=60)
        if i % 10 == 0:  # every such address stands in two documents, beside any words
            text.insert(pick.randrange(20, 40), f"u{i % (size // 2)}@x.example")
        rows.append((i, " ".join(text)))
    near = [text for _, text in rows if "@" in text][:20]  # near copies: one word before the address differs
    rows += [(size + i, text.replace(" ", " changed ", 1)) for i, text in enumerate(near)]
    for i in range(5):
        rows.append((2 * size + i, " ".join([*pick.choices(words, k=15), "Zorro don.diego@vega.example", *pick.choices(words, k=15)])))
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    texts = dict(rows)
    flagged = Counter()
    for r in found:
        for _, a, b in (x.split(":") for x in r.spans.split(",") if x.startswith("term")):
            flagged[texts[r.doc_id][int(a) : int(b)]] += 1
    assert flagged.pop("Zorro") == 5
    assert len(flagged) <= 1  # the number that chance may be expected to bring


def test_disclosing_terms_go_wherever_they_stand(spark):
    pick = random.Random(9)
    words = [a + b + c for a in "bdfg" for b in ("ana", "ebe", "ili") for c in ("lo", "mi", "tu", "ra")]
    rows = [(i, " ".join(pick.choices(words, k=40))) for i in range(400)]
    for i in range(2):  # two contexts
        text = " ".join(pick.choices(words, k=30))
        rows.append((1000 + i, f"{text} Zorro from don.diego@vega.example now {text} zorro again"))
    rows += [(2000, "mail zorro@other.example or ask ZORRO of the hills"), (2000, "mail zorro@other.example or ask ZORRO of the hills")]
    rows += [(2001, "Zorro! Zorro?"), (2002, "zorros")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = pii.find_personal_data(docs).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in rows)
    texts = dict(rows)
    for r in found:
        text = texts[r.doc_id]
        spans = [x.split(":") for x in r.spans.split(",") if x.startswith("term")]
        got = [(int(a), int(b)) for _, a, b in spans if text[int(a) : int(b)].lower() == "zorro"]
        assert got == [m.span() for m in re.finditer(r"\bzorro\b(?!@)", text, re.IGNORECASE)]
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "orro" not in clean[1000] and "ORRO" not in clean[2000] and "Zorro" not in clean[2001]
    assert clean[2002] == "zorros" and clean[5] == texts[5]


def items_of(seed: int = 2) -> list[tuple]:
    pick = random.Random(seed)
    names = [f"{a}{b}" for a in ("ka", "lo", "mi", "ru", "se") for b in ("ban", "dor", "fil", "gus", "hem", "jat")]
    rows = [(i, " ".join(pick.choices(names, k=pick.choice([12, 12, 25, 60])))) for i in range(20)]
    return [*rows, (20, "only four words here"), (21, None), (22, "!!"), (23, rows[0][1])]


def planted(seed: int = 3) -> list[tuple]:
    pick, items = random.Random(seed), items_of()
    filler = "river stone under house making water light".split()
    rows = []
    for i in range(90):
        lead, tail = pick.choices(filler, k=pick.randint(0, 30)), pick.choices(filler, k=pick.randint(0, 30))
        body = (items[pick.randrange(20)][1] or "").split()
        kind = i % 6
        if kind == 1:
            body[len(body) // 2] = "changed"
        elif kind == 2:
            body[0] = "Changed,"
        elif kind == 3:
            body = body[: len(body) // 2]
        elif kind == 4:
            body = [w.upper() + "!" for w in body]
        elif kind == 5:
            body = []
        rows.append((i, " ".join([*lead, *body, *tail])))
    return [*rows, (500, "see Only four words here, so"), (501, None), (502, ""), (0, rows[0][1])]


def slow_leaks(docs: list[tuple], items: list[tuple]) -> Counter:
    """Every window of every document against every item, overlapping ones of an item resolved."""
    out: Counter = Counter()
    for i, text in docs:
        words = re.findall(r"\w+", (text or "").lower())
        for key, item in items:
            target = re.findall(r"\w+", (item or "").lower())
            if not target:
                continue
            want = Counter(decontaminate.shingles_of(target, 5))
            hits = []
            for start in range(len(words) - len(target) + 1):
                have = Counter(decontaminate.shingles_of(words[start : start + len(target)], 5))
                if (like := decontaminate.similarity(have, want)) >= 0.8:
                    hits.append((-like, start))
            taken: list[int] = []
            for unlike, start in sorted(hits):
                if all(abs(start - t) >= len(target) for t in taken):
                    taken.append(start)
                    out[(i, key, round(-unlike, 9))] += 1
    return out


@pytest.mark.parametrize("per_pass", [2000, 7])
def test_leaks_equal_brute_force(spark, per_pass):
    docs = spark.createDataFrame(planted(), "doc_id bigint, text string")
    items = spark.createDataFrame(items_of(), "item_id bigint, text string")
    got = decontaminate.find_leaks(docs, items, per_pass=per_pass).collect()
    want = slow_leaks(planted(), items_of())
    assert Counter((r.doc_id, r.item_id, round(r.similarity, 9)) for r in got) == want
    assert sum(want.values()) > 40
    texts = dict(planted())
    for r in got:
        if r.similarity == 1.0:
            held = re.findall(r"\w+", texts[r.doc_id][r.start : r.end].lower())
            assert held == re.findall(r"\w+", dict(items_of())[r.item_id].lower())


def test_clean_documents_stay(spark, docs, no_docs):
    mine = spark.createDataFrame(planted(), "doc_id bigint, text string")
    items = spark.createDataFrame(items_of(), "item_id bigint, text string")
    leaked = {i for i, _, _ in slow_leaks(planted(), items_of())}
    kept = decontaminate.keep_clean(mine, items)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _ in planted() if i not in leaked)
    assert decontaminate.keep_clean(docs, items).columns == docs.columns
    assert decontaminate.keep_clean(docs, items).count() == docs.count()
    assert decontaminate.find_leaks(no_docs, items).count() == 0
    assert decontaminate.find_leaks(mine, items.limit(0)).count() == 0


def test_texts_shorter_than_an_item_leak(spark):
    pick = random.Random(12)
    names = [f"{a}{b}" for a in ("ka", "lo", "mi", "ru", "se") for b in ("ban", "dor", "fil", "gus", "hem", "jat")]
    items = [(i, " ".join(pick.choices(names, k=n))) for i, n in enumerate([59, 59, 30, 12, 6, 4])]
    docs = []
    for i, text in items:
        words = text.split()
        for cut in range(1, len(words)):
            docs += [(100 * i + cut, " ".join(words[:-cut])), (1000 + 100 * i + cut, " ".join(words[cut:]))]
    want = Counter()
    for i, text in docs:
        words = text.split()
        for key, item in items:
            target = item.split()
            # A text of fewer words is one window.
            windows = [words[a : a + len(target)] for a in range(max(1, len(words) - len(target) + 1))]
            have = [Counter(decontaminate.shingles_of(w, 5)) for w in windows]
            like = max(decontaminate.similarity(h, Counter(decontaminate.shingles_of(target, 5))) for h in have)
            if like >= 0.8:
                want[(i, key, round(like, 9))] += 1
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.find_leaks(frame, bench).collect()
    assert Counter((r.doc_id, r.item_id, round(r.similarity, 9)) for r in got) == want
    assert {(3, 0), (103, 1), (1003, 0)} <= {(i, key) for i, key, _ in want}
    assert all((r.start, r.end) == (0, len(dict(docs)[r.doc_id])) for r in got)
    kept = {r.doc_id for r in decontaminate.keep_clean(frame, bench).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _, _ in want}


def test_blocks_find_every_item_within_the_radius():
    index = decontaminate.ItemIndex(items_of()[:20], 5, 0.8, 9, 4)
    pick = random.Random(8)
    for n, value in enumerate(index.prints.tolist()):
        for _ in range(50):
            near = value
            for bit in pick.sample(range(64), 9):
                near ^= 1 << bit
            found = set()
            for block, (shift, mask) in enumerate(index.blocks):
                code = block << 56 | int(index.lengths[n]) << 24 | (near >> shift) & mask
                found |= set(index.owners[index.entries == code].tolist())
            assert n in found


def slow_alignment(template, words):
    """Best matched words of any local alignment, without a band."""
    row, best = [(0, 0)] * (len(words) + 1), (0, 0)
    for term in template:
        new = [(0, 0)]
        for j, word in enumerate(words):
            step = (row[j][0] + 2, row[j][1] + 1) if term == word else (row[j][0] - 1, row[j][1])
            up, left = (row[j + 1][0] - 1, row[j + 1][1]), (new[j][0] - 1, new[j][1])
            new.append(max((0, 0), step, up, left, key=lambda c: c[0]))
            best = max(best, new[-1])
        row = new
    return best[1]


def test_licenses_equal_unbanded_alignment(spark, docs, no_docs):
    pick = random.Random(6)
    filler = "river stone under house making water".split()
    names = sorted(licenses.TEMPLATES)
    rows = []
    for i in range(60):
        words = re.findall(r"\w+", licenses.TEMPLATES[pick.choice(names)])
        if i % 4 == 1 and len(words) > 20:
            del words[10:12]
        if i % 4 == 2 and len(words) > 20:
            words[9:9] = ["extra", "words"]
        if i % 4 == 3:
            words = words[: len(words) // 2]
        rows.append((i, " ".join([*pick.choices(filler, k=9), *words, *pick.choices(filler, k=9)])))
    rows += [(100, None), (101, ""), (102, "licensed under"), (0, rows[0][1])]
    mine = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = Counter((r.doc_id, r.license, r.matched) for r in licenses.scan_licenses(mine).collect())
    want: Counter = Counter()
    for i, text in rows:
        words = licenses.words_of(text or "")
        for name in names:
            template = licenses.words_of(licenses.TEMPLATES[name])
            if (matched := slow_alignment(template, words)) >= 0.8 * len(template):
                want[(i, name, matched)] += 1
    assert got == want
    assert licenses.scan_licenses(docs).count() == 0
    assert licenses.scan_licenses(no_docs).count() == 0


def test_licenses_that_resemble_are_told_apart(spark):
    names = "BSD-2-Clause BSD-3-Clause GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 AGPL-3.0 MPL-2.0 CC0-1.0 Unlicense".split()
    assert all(any(t.startswith(name) for t in licenses.TEMPLATES) for name in names)
    order = sorted(licenses.TEMPLATES)
    rows = [(i, f"river stone {licenses.TEMPLATES[name]} water") for i, name in enumerate(order)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = licenses.scan_licenses(docs, best=True).collect()
    assert Counter((r.doc_id, r.license, r.coverage) for r in found) == Counter((i, n, 1.0) for i, n in enumerate(order))


@pytest.mark.parametrize("times", [2, 3, 7])
def test_repeated_notices_are_each_reported(spark, times):
    filler = "river stone under house making water".split()
    names = sorted(licenses.TEMPLATES)
    rows = []
    for i, name in enumerate(names):
        rows.append((2 * i, " ".join([licenses.TEMPLATES[name]] * times)))
        rows.append((2 * i + 1, " ".join([*filler, *[licenses.TEMPLATES[name] + " stone"] * times, *filler])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = [r for r in licenses.scan_licenses(docs).collect() if r.license == names[r.doc_id // 2]]
    assert Counter(r.doc_id for r in found) == Counter({i: times for i, _ in rows})
    texts = dict(rows)
    for r in found:
        assert licenses.words_of(texts[r.doc_id][r.start : r.end]) == licenses.words_of(licenses.TEMPLATES[r.license])


def test_winnowing_guarantees_shared_fingerprints():
    pick = random.Random(7)
    for _ in range(100):
        shared = [str(pick.randrange(50)) for _ in range(licenses.GRAM + licenses.WINDOW - 1)]
        sides = []
        for _ in range(2):
            words = [*(str(pick.randrange(50)) for _ in range(20)), *shared, *(str(pick.randrange(50)) for _ in range(20))]
            hashes = licenses.run_hashes(words)
            sides.append({int(hashes[i]) for i in licenses.winnow(hashes)})
        assert sides[0] & sides[1]


ARTICLE = "<h1>T &amp; U</h1><p>one <b>two</b>three<br>four\n\tfive</p><p>six seven eight nine ten</p>"
TEXT = "T & U one twothree four five six seven eight nine ten"
PAGES = {
    "article": f"<body><nav>menu</nav><article>{ARTICLE}</article><footer>&copy; f</footer>",
    "classes": f"<html><body><div id='topMenu'><a>a</a></div><div class='wrap w-1'><div class='post post-77'>{ARTICLE}</div>"
    "<div class='sidebar'>side side</div><div class='comments'><article class='comment'>mine!</article></div></div>",
    "main": f"<div class=cookie-notice>ok</div><main>{ARTICLE}<aside>x</aside><form>f<input></form></main><script>if(a<b)'</p>'</script>",
    "links": f"<div><a href=1>l one</a> <a href=2>l two</a></div><div>{ARTICLE}</div><style>p{{}}</style>",
    "unclosed": f"<article>{ARTICLE}<p>last",
}


def test_main_text():
    for name, source in PAGES.items():
        page = html_main.Page(source)
        assert page.extract({page.best()}) == (TEXT + " last" if name == "unclosed" else TEXT), name


LINKS = "<ul><li><a href=1>first link of the list</a></li><li><a href=2>second link</a></li></ul>"
NAMED = {
    "wrapper": f"<body><div class='layout has-sidebar'><div>{ARTICLE}</div><div class='sidebar'>side side</div></div>",
    "with": f"<body><div class='with-sidebar'>{ARTICLE}<div class='comments'>{'mine! ' * 40}</div></div><div id='topMenu'>m</div>",
    "untitled": f"<body><div id='search'>{ARTICLE.replace('h1', 'b')}</div>",
    "sections": "<article><h1>T &amp; U</h1><section id='discussion'>one twothree four</section><div class='alert'>five six</div>"
    "<section id='related-work'>seven eight</section><div id='search'>nine ten</div><div class='comments'>mine!</div></article>",
    "links in main": f"<nav>menu</nav><main>{ARTICLE}{LINKS}</main><ul><li><a>home</a></li></ul>",
    "links in a div": f"<div id='topMenu'>m</div><div class='post'>{ARTICLE}{LINKS}</div><ul><li><a>home</a></li></ul>",
}


@pytest.mark.parametrize("name", sorted(NAMED))
def test_names_do_not_outvote_scores(name):
    page = html_main.Page(NAMED[name])
    want = TEXT + " first link of the list second link" if "links" in name else TEXT
    assert page.extract({page.best()}) == want


SENTENCE = "<p>the story goes on for some more words here</p>"
AFTER = " the story goes on for some more words here"


@pytest.mark.parametrize(
    "aside",
    [
        "<section id='comments'><h2>Replies</h2><p>mine!</p></section>",
        "<div class='reader-comments'><p>mine!</p></div>",
        "<section class='user-comments'><p>mine!</p></section>",
        "<div id='comments-section'><p>mine!</p></div>",
        "<div class='advert-box'>buy</div>",
        "<div class='promo-box'>buy</div>",
        "<div class='cookie-bar'>ok?</div>",
        "<div class='sidebar-left'>side</div>",
        "<div class='site-notice'>closed on Monday</div>",
        "<div role='navigation'><a href=1>a</a></div>",
        "<div role='complementary'>side</div>",
        "<p class='ad'>buy</p>",
        "<p hidden>unseen</p>",
        "<p hidden=''>unseen</p>",
        "<ul><li class='comment'>mine!</li></ul>",
        "<p><span class='ad'>buy</span></p>",
        "<p><span style='display: none'>unseen</span></p>",
        "<button>Share</button>",
        "<p><button>Share</button></p>",
        "<select><option>one<option>two</select>",
        "<video><p>no video here</p></video>",
        "<object><object>deep</object>none</object>",
        "<svg><text>drawn</text></svg>",
        "<template><div>later</div></template>",
        "<iframe>old</iframe><noscript>turn it on</noscript>",
    ],
)
def test_asides_inside_an_article(aside):
    page = html_main.Page(f"<body><nav>menu</nav><article>{ARTICLE}{aside}{SENTENCE}</article>")
    assert page.extract({page.best()}) == TEXT + AFTER


@pytest.mark.parametrize("tag", ["button", "select", "object", "video", "audio", "canvas", "svg", "template"])
def test_unclosed_elements_do_not_swallow_the_article(tag):
    page = html_main.Page(f"<article>{ARTICLE}<{tag}>label{SENTENCE}<p>and on</p></article>")
    assert page.extract({page.best()}) == TEXT + AFTER + " and on"
    # Closed only behind the article: its container ends it.
    page = html_main.Page(f"<body><article>{ARTICLE}<div><{tag}>label</div>{SENTENCE}</article><div></{tag}></div>")
    assert page.extract({page.best()}) == TEXT + AFTER


def test_character_references_of_any_length():
    assert html_main.decoded("&#" + "5" * 5000 + ";x") == "\ufffdx"
    assert html_main.decoded("&#" + "0" * 5000 + "65;&#x41;&#00000000066;&#12345678;&amp;") == "AAB\ufffd&"
    assert html_main.Page("<p>&#" + "5" * 5000 + ";").blocks == [(0, "\ufffd")]


def test_long_comments_stay_asides():
    page = html_main.Page(f"<div class='post'>{ARTICLE}</div><div class='comments-area'><h2>Replies</h2>{'mine! ' * 400}</div>")
    assert page.extract({page.best()}) == TEXT


def test_named_container_on_the_winning_path():
    page = html_main.Page(f"<h1>Shop</h1><div class='x'>few</div><div class='c' id='search'>{ARTICLE.replace('h1', 'p')}</div>")
    path = html_main.Page(f"<div class='c'>{ARTICLE}</div>").path[1]
    assert page.extract(page.on_path(path)) == TEXT


def test_consensus_of_the_host(spark):
    good = "<body><div class='c9'>{}</div><div class='x'>{}</div>"
    long, short = "<p>" + "main words " * 20 + "</p>", "<p>few</p>"
    rows = [(i, f"http://A.example:80/{i}", good.format(long, short), "clash") for i in range(30)]
    # Its own best container is the other one; the host knows better.
    rows.append((99, "http://user@a.example/odd", good.format("<p>the story</p>", "<p>" + "noise " * 40 + "</p>"), "clash"))
    rows.append((100, "http://b.example/", good.format("<p>the story</p>", "<p>" + "noise " * 40 + "</p>"), "clash"))
    rows += [(200, None, f"<article>{ARTICLE}</article>", ""), (201, "http://a.example", None, ""), (202, "?", "", "")]
    rows += [(203, "http://c.example", "plain &lt;b&gt; text", ""), (99, *rows[30][1:])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string")
    found = html_main.extract_main(pages).collect()
    assert Counter(r.page_id for r in found) == Counter(r[0] for r in rows)
    text = {r.page_id: r.text for r in found}
    assert text[99] == "the story" and text[100].startswith("noise")
    assert text[200] == TEXT and text[201] == "" and text[202] == "" and text[203] == "plain <b> text"
    assert all(r.n_chars == len(r.text) for r in found)
    assert html_main.extract_main(pages.limit(0)).count() == 0


def test_hostile_pages_end():
    for source in ("<div>" * 20_000 + "x", "<" * 50_000, "<a " * 20_000, "<a b=\"" * 20_000, "<!--" * 20_000, "</p>" * 9_000, "<button>" * 20_000, "<p hidden>x" * 9_000, "&#" + "9" * 90_000):
        page = html_main.Page(source)
        page.extract({page.best()})


def test_long_runs_of_digits():
    zeros = "0" * 5000 + ".1.1.1"
    assert pii.base_spans(zeros) == [("ip", 0, len(zeros))]
    assert pii.base_spans("7" * 5000 + ".1.1.1") == [] == pii.base_spans("0" * 5000 + "256.1.1.1")
    assert ("ip", 0, 11) in pii.base_spans("000.0.0.255")
