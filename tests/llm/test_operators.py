"""Each operator on small, awkward inputs, against plain Python."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagmatch.llm import (
    components,
    decontaminate,
    html_text,
    line_dedup,
    near_dup,
    packing,
    pii,
    quality,
    repeats,
    sharding,
    suffixes,
    toxicity,
)
from tests.llm import brute

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string"


def frame(spark, rows, clash="n"):
    """Documents with a further column of a clashing name and one of an odd type."""
    return spark.createDataFrame(rows, DOCS).withColumns(
        {clash: F.lit("mine"), "extra": F.array(F.struct(F.lit(1).alias("x")))}
    )


def noise(seed, alphabet, length):
    return "".join(random.Random(seed).choice(alphabet) for _ in range(length))


AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "word"), (6, "a" * 30_000), (7, "x y " * 3000),
    (8, "\n" * 500), (9, "É é 😀 ñ"), (9, "É é 😀 ñ"), (None, "no id"), (None, None),
]


def test_pii(spark):
    rows = [(i, noise(i, "ab1234567890.@-+ ()x_%é😀\n", i % 200)) for i in range(300)]
    rows += [(2002, "4111 1111 1111 1111"), (2002, "4111 1111 1111 1111"), (2003, "a@b.c_d@e.f")]
    rows += [(2004, "1.2.3.4.5.6.7.8 999.1.1.1"), (2006, "a@b" + ".c" * 5000), (2007, "1.2.3.4 " * 3000)]
    rows += [(3000 + i, f"you can call +1 (555) 555-{1000 + i} today") for i in range(30)]
    rows += [(4000, "and they can call 555-9010 today"), (4001, "about 555-9010 today")] + AWKWARD
    found = pii.with_pii(frame(spark, rows, "spans")).collect()
    assert len(found) == len(rows)
    for row in found:
        base = [tuple(s) for s in row.base_spans]
        assert base == brute.base_spans(row.text)
        assert set(base) <= {tuple(s) for s in row.spans}
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [
            sum(s[0] == k for s in base) for k in pii.KINDS
        ]
    extra = {row.doc_id: [tuple(s) for s in row.spans] for row in found}
    assert extra[4000] == [("phone", 18, 26)] and extra[4001] == []
    assert pii.with_pii(frame(spark, rows, "spans").limit(0)).count() == 0


def test_line_dedup(spark):
    rng = random.Random(1)
    rows = [(i, "\n".join(rng.choice("abcdef") * rng.choice([1, 8]) for _ in range(rng.randrange(30)))) for i in range(60)]
    rows += [(100, rows[5][1]), (101, "\n" * 300), (102, "x" * 50_000), (103, "x" * 50_000)]
    for chars in (1, 12, 40):
        got = line_dedup.line_dedup(frame(spark, rows, "gone"), chars).collect()
        assert {r.doc_id: r.text for r in got} == brute.line_dedup(rows, chars)
        assert all(r.gone == "mine" for r in got)
    awkward = line_dedup.line_dedup(frame(spark, AWKWARD, "n_lines")).collect()
    blank = brute.line_dedup([(8, "\n" * 500)], line_dedup.MIN_CHARS)
    want = [(d or 0, blank[8] if d == 8 else t or "") for d, t in AWKWARD]
    assert sorted((r.doc_id or 0, r.text or "") for r in awkward) == sorted(want)
    assert line_dedup.line_dedup(frame(spark, rows).limit(0)).count() == 0


def test_quality(spark):
    plain = "the cat of the house and a dog in the garden that is for all of it to be with us as on "
    rows = [(i, noise(i, "ab c\n#", 200)) for i in range(40)] + AWKWARD
    rows += [(500 + i, " ".join(random.Random(i).sample((plain * 4).split(), 70))) for i in range(80)]
    rows += [(700, " ".join(f"w{i}###" for i in range(300)))]
    lang = F.when(F.col("doc_id") >= 500, "en").otherwise("xx")
    docs = frame(spark, rows, "kept").withColumn("lang", lang)
    judged = quality.quality_rules(docs).collect()
    assert len(judged) == len(rows)
    for r in judged:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality_base(r.text)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert not next(r for r in judged if r.doc_id == 700).kept
    assert sum(r.kept for r in judged if 500 <= (r.doc_id or 0) < 600) >= 70
    assert quality.quality_rules(docs.limit(0)).count() == 0
    assert quality.quality_rules(docs.withColumn("lang", F.lit(None).cast("string"))).count() == len(rows)


def test_quality_of_rare_languages(spark):
    rng = random.Random(5)
    common = "the of and to in house garden".split() + [noise(i, "abcdefg", 6) for i in range(300)]
    rare = [noise(i, "абвгдежз", 6) for i in range(300)]
    rows = [(i, " ".join(rng.choices(common, k=60)), "en") for i in range(2500)]
    rows += [(7000 + i, " ".join(rng.choices(rare, k=300)), "ru") for i in range(20)]  # under 1 % of documents
    rows += [(8000 + i, " ".join(rng.choices(rare, k=120)), "bg") for i in range(3)]  # few documents
    rows += [(9000, " ".join(f"#{k}$" for k in range(300)), "ru")]
    docs = spark.createDataFrame(rows, f"{DOCS}, lang string")
    kept = {r.doc_id: r.kept for r in quality.quality_rules(docs).select("doc_id", "kept").collect()}
    assert [d for d in kept if d >= 7000 and not kept[d]] == [9000]
    assert sum(kept[d] for d in kept if d < 7000) >= 2450
    fewer = quality.quality_rules(docs.filter("doc_id >= 7000")).select("doc_id", "kept").collect()
    assert all(kept[r.doc_id] == r.kept for r in fewer)


@pytest.mark.parametrize("plain", [10, 40, 60, 400])
def test_quality_verdict_does_not_switch_with_the_size_of_a_language(spark, plain):
    rng = random.Random(6)
    words = "the of and to in house garden".split() + [noise(i, "abcdefg", 6) for i in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=80)), "en") for i in range(plain)]
    rows.append((9000, " ".join(f"#{k % 10}$" + "%" * (k % 7) for k in range(300)), "en"))
    docs = spark.createDataFrame(rows, f"{DOCS}, lang string")
    kept = {r.doc_id: r.kept for r in quality.quality_rules(docs).select("doc_id", "kept").collect()}
    assert [d for d in kept if not kept[d]] == [9000]


def near_rows():
    rng, rows = random.Random(2), []
    vocabulary = [f"w{i}" for i in range(400)]
    for group in range(6):
        base = [rng.choice(vocabulary) for _ in range(60)]
        for copy in range(40):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(60)] = rng.choice(vocabulary)
            rows.append((group * 100 + copy, " ".join(words)))
    shared = " ".join(rng.choice(vocabulary) for _ in range(30))
    rows += [(1000 + i, shared + " " + " ".join(rng.choice(vocabulary) for _ in range(30))) for i in range(60)]
    return rows + [(2000, "one two"), (2001, "ONE  two"), (2002, "one two three four")]


def test_near_duplicates(spark):
    rows = near_rows()
    got = near_dup.near_duplicates(frame(spark, rows, "component_id")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.near_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    awkward = near_dup.near_duplicates(frame(spark, AWKWARD, "kept")).collect()
    assert len(awkward) == len(AWKWARD)
    assert {r.component_id for r in awkward if r.text == "word"} == {4}
    assert all(r.component_id == r.doc_id and r.kept for r in awkward if r.n_shingles == 0)
    assert near_dup.near_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    links += [(999, i) for i in range(400, 500)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            one, other = find(a), find(b)
            parent[max(one, other)] = min(one, other)
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted((r.node, r.root) for r in got) == sorted((n, find(n)) for n in parent)


def test_decontaminate(spark):
    rng = random.Random(4)
    vocabulary = [f"t{i}" for i in range(30)]
    items = [(f"i{n}", " ".join(rng.choice(vocabulary) for _ in range(n % 25))) for n in range(40)]
    items += [("p", "two three"), ("q", "Solo"), ("s", None), ("t", "!!"), (None, "word here"), ("p", "four five")]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(40))) for i in range(30)]
    rows += [(100 + n, "x, " + (text or "").upper() + ". y") for n, (_, text) in enumerate(items)]
    rows += [(300, "two two three word here"), (301, "SOLO é")] + AWKWARD
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    got = decontaminate.decontaminate(frame(spark, rows, "n_hit"), benchmark).collect()
    want = brute.contamination(rows, items)
    assert sorted((r.doc_id or -1, r.n_words, r.n_hit, r.item_ids) for r in got) == sorted(
        (d or -1, *rest) for d, *rest in want
    )
    assert all(r.contaminated == (r.n_hit > 0) for r in got)
    clean = decontaminate.decontaminate(frame(spark, rows), benchmark.limit(0))
    assert clean.agg(F.sum("n_hit")).first()[0] == 0 and clean.count() == len(rows)


def test_decontaminate_repeated_rows(spark):
    items = [("a", " ".join(f"a{i}" for i in range(10))), ("b", "b0 b1 b2 b3 b4")]
    rows = [(1, "so " + items[0][1])] * 3 + [(None, "and " + items[0][1])] * 2
    rows += [(2, items[1][1] + " then")] * 2 + [(3, items[0][1]), (4, "a0 a1 a2")] + [(5, "a8 a9 b0")] * 2
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    got = decontaminate.decontaminate(spark.createDataFrame(rows, DOCS), benchmark).collect()
    want = brute.contamination(rows, items)
    assert sum(hit > 0 for _, _, hit, _ in want) == 8
    assert sorted((r.doc_id or -1, r.n_words, r.n_hit, r.item_ids) for r in got) == sorted(
        (d or -1, *rest) for d, *rest in want
    )


@pytest.mark.parametrize("copies", [2, 13])
def test_decontaminate_repeated_items(spark, copies):
    text = " ".join(f"w{i}" for i in range(10))
    items = [("a", text)] * copies + [(None, text.replace("w", "v"))] * copies
    often = "w5 w6 w7 v5 v6 v7"  # frequent words, so they are compared last
    rows = [(1, text.replace("w6", "x")), (2, text.replace("w", "v").replace("v6", "x"))]
    rows += [(3, text), (4, text.replace("w", "v"))] + [(10 + i, often) for i in range(9)]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    got = decontaminate.decontaminate(spark.createDataFrame(rows, DOCS), benchmark).collect()
    want = brute.contamination(rows, items)
    assert {doc for doc, _, hit, _ in want if hit} == {3, 4}
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in got) == sorted(want)


def test_toxicity(spark):
    rng = random.Random(5)
    plain = [f"w{i}word" for i in range(200)]

    def text(bad):
        words = [rng.choice(plain) for _ in range(40)]
        if bad:
            words[rng.randrange(40)] = rng.choice(["vilething", "nastyone"]) + rng.choice(["", "s", "ish"])
        return " ".join(words)

    rows = [(i, text(i % 4 == 0)) for i in range(400)] + [(i, t) for i, t in AWKWARD]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(10, 300)], "doc_id long, toxic int")
    docs = frame(spark, rows, "score")
    lexicon = toxicity.learn(docs, labels)
    assert any(w.startswith("vile") for w in lexicon.weights) and any(w.startswith("nast") for w in lexicon.weights)
    got = toxicity.with_toxicity(docs, lexicon).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held_out = [r for r in got if r.doc_id is not None and r.doc_id >= 300]
    assert all(r.predicted == (r.doc_id % 4 == 0) for r in held_out)
    matcher = toxicity.Matcher(toxicity.Lexicon({"clown": 3.0, "idiot": 3.0}))
    assert matcher.total("1d10t! 1D10TS сlоwn") == 9.0
    assert matcher.total("a clown fish, an xclown") == 0.0
    assert toxicity.learn(docs, labels.limit(0)).weights == {}
    assert toxicity.with_toxicity(docs.limit(0), lexicon).count() == 0


DISGUISED = {
    "clown fish": 0, "clown\nfish": 0, "Clown  Fishs": 0, "clown-fish": 0, "clown fishing": 3, "trash cannot": 3,
    "trash cans": 0, "CLÓWN": 3, "c\u200blo\u00adwn": 3, "\U0001d41c\U0001d425\U0001d428\U0001d430\U0001d427": 3,
    "\uff43\uff4c\uff4f\uff57\uff4e": 3, "!d!ot": 3, "1d|ot": 0, "c|own!": 3, "xclown": 0, "clown clowns": 6,
}


@pytest.mark.parametrize("text", DISGUISED)
def test_toxic_words_in_disguise(text):
    matcher = toxicity.Matcher(toxicity.Lexicon({"clown": 3.0, "idiot": 3.0, "trash": 3.0}))
    assert matcher.total(text) == DISGUISED[text]


def test_toxic_sums_equal_a_search_place_by_place():
    weights, rng = {"clown": 2.0, "idi": 3.5, "idiot": 1.0, "trash": 4.0, "sore": 2.5}, random.Random(3)
    parts = ["clown", "idiot", "proof", "fish", "trash", "can", "cans", "sore", "loser", "x", "s", " ", " ", " ", "-", "\n",
             "1", "!", "\u200b", "é", "о"]
    matcher = toxicity.Matcher(toxicity.Lexicon(weights))
    phrases = [toxicity.fold(p) for p in toxicity.EXCEPTIONS]
    totals = Counter()
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        want = brute.toxic_total(toxicity.fold(text), weights, phrases)
        assert matcher.total(text) == want, text
        totals[want] += 1
    assert len(totals) > 10


def test_toxicity_learns_alike_from_doubled_ids(spark):
    rows = [(i, f"plain words here {'vilething' if i % 4 == 0 else 'finething'} n{i}") for i in range(80)]
    doubled = rows + [(i, "another text") for i, _ in rows]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(80)], "doc_id long, toxic int")
    lexicons = [toxicity.learn(frame(spark, order), labels) for order in (doubled, doubled[::-1])]
    assert lexicons[0] == lexicons[1] and lexicons[0].weights


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">menu</a></li></ul></nav>
<div id="cookie-notice">We use cookies, ok?</div><!-- ad --><div class="ad">Buy this, now.</div>
<article><h1>A &amp; B</h1><p><b>First line, of the   text.<br><p>Second&nbsp;one, longer than the first; surely.</p>
<ul><li>One thing, indeed.</li></ul></article><aside><p>See also, this, and that.</p></aside>
<div class="comments"><p>First comment, nice.</p></div><form><p>Name</p></form><footer>&copy; me</footer></body></html>"""


def test_html_text(spark):
    want = "A & B\n\nFirst line, of the text.\n\nSecond one, longer than the first; surely.\n\nOne thing, indeed."
    pages = [(1, PAGE, want), (2, PAGE[: PAGE.index("</ul></article>")], want), (3, None, ""), (4, "", ""),
             (5, "<p", ""), (6, "<p>a<p>b", "a\n\nb"), (7, "<div>" * 3000 + "deep.", "deep.")]
    rows = spark.createDataFrame(pages, "page_id long, html string, want string").withColumn("n_chars", F.lit("x"))
    for r in html_text.extract(rows).collect():
        assert r.text == r.want and r.n_chars == len(r.want)
    assert html_text.extract(rows.limit(0)).count() == 0


TITLED = "<h1><a href='/a'>A linked headline</a></h1><p>First line, of some length, of the text.</p>"


@pytest.mark.parametrize("name", ["layout with-sidebar", "container no-sidebar", "post has-comments", "search-results", "sidebar"])
def test_html_text_keeps_what_is_in_an_article(name):
    want = "A linked headline\n\nFirst line, of some length, of the text."
    menu = "<ul><li><a href='/m'>menu</a></li></ul><div class='sidebar-left'><p>Beside it, a box.</p></div>"
    assert html_text.main_text(f"<body>{menu}<div class='{name}'><article>{TITLED}</article></div></body>") == want
    for head in ("header class='entry-header'", "div class='article-header'"):
        titled = TITLED.replace("<h1>", f"<{head}><h1>").replace("</h1>", f"</h1></{head.split()[0]}>")
        assert html_text.main_text(f"<body>{menu}<article>{titled}</article></body>") == want
    out = "<div class='related-posts'><p>Another, quite long story, with marks.</p></div><div id='comments'><p>Nice, nice.</p></div>"
    assert html_text.main_text(f"<body><article>{TITLED}{out}</article></body>") == want


def test_sharding(spark):
    rows = [(1, "same text")] * 1000 + [(i, f"t{i}" * (i % 9)) for i in range(300)] + AWKWARD
    got = sharding.shard(frame(spark, rows, "slot"), columns=["text", "slot"]).collect()
    assert len(got) == len(rows)
    by_shard = {}
    for r in got:
        data = (r.text or "").encode()
        assert r.size == len(data) + 1 and r.text_crc32 == zlib.crc32(data)
        by_shard.setdefault(r.shard, []).append(r)
    assert all(sorted(r.slot for r in own) == list(range(len(own))) for own in by_shard.values())
    even = sharding.shard(spark.createDataFrame([(i, f"text {i:05d}") for i in range(4000)], DOCS))
    sizes = [r[0] for r in even.groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 22
    assert sharding.shard(frame(spark, rows).limit(0)).count() == 0


def test_suffix_array():
    rng = random.Random(6)
    for _ in range(200):
        letters = rng.choice([1, 2, 3, 5])
        text = np.array([rng.randrange(letters) for _ in range(rng.randrange(50))], dtype=np.uint16)
        order = suffixes.suffix_array(text, letters)
        want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert order.tolist() == want
        shared = suffixes.common_prefixes(text, order)
        for a, b in zip(want, want[1:]):
            same = 0
            while max(a, b) + same < len(text) and text[a + same] == text[b + same]:
                same += 1
            assert shared[b] == same


@pytest.mark.parametrize("limit", [8_000_000, 20_000])
def test_repeats(spark, monkeypatch, limit):
    monkeypatch.setattr(repeats, "ANCHOR_BYTES", limit)
    base = noise(7, "abcé ", 900)
    rows = [(1, base), (1, base), (3, "a" * 3000), (4, "b" * 199), (5, "b" * 200), (6, base[:400] + "X" + base[401:])]
    rows += [(7, "ab" * 400)] + AWKWARD
    rows += [(100 + i, noise(i, "xyz", i) + base[100 : 400 + i % 50] + noise(i + 1, "xyz", 50)) for i in range(100)]
    got = repeats.with_repeats_removed(frame(spark, rows, "ranges"))
    got = got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, brute.repeats(rows)))
    assert repeats.with_repeats_removed(frame(spark, rows).limit(0)).count() == 0


def test_packing(spark):
    rows = [(i, noise(i, "abc de,.\n", i * 37 % 9000)) for i in range(80)] + AWKWARD
    rows += [(500, "a <|endoftext|> b  c"), (501, "it's 1 234\r\n  x y")]
    pieces = packing.pack(frame(spark, rows, "offset"), TOKENIZER).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = {}
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        want.setdefault(doc, []).append(ids)
    for doc, versions in want.items():
        own = sorted((p for p in pieces if p.doc_id == doc), key=lambda p: (p.start, p.sequence_id, p.offset))
        assert sum(p.length for p in own) == sum(map(len, versions))
        if len(versions) == 1:
            (ids,), at = versions, 0
            for p in own:
                assert p.start == at and p.doc_tokens == len(ids)
                part = np.array(ids[at : at + p.length], dtype="<u4").tobytes()
                assert p.ids_crc32 == zlib.crc32(part)
                at += p.length
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= packing.CAPACITY
    total = sum(p.length for p in pieces)
    assert len(sequences) <= total / packing.CAPACITY * 1.05 + 1
    assert packing.pack(frame(spark, rows).limit(0), TOKENIZER).count() == 0
