"""Tokens, scores, contamination, page text and chat turns against libraries, held-out labels and plain Python."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logharbor.llm import bpe, chat, contamination, pages, quality, toxicity
from logharbor.llm.common import read_table, written
from logharbor.llm.mincut import label
from logharbor.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import shingles

SF = "/root/testdata/sf0.01"


# ---- tokens --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.TOKENIZER)


def odd_texts(library) -> list[str | None]:
    draw = random.Random(1)
    names = [n.replace("</w>", "") for n in library.get_vocab()]
    texts: list[str | None] = [None, "", " ", "a" * 40000, "ba" * 200, "x<|endoftext|><|startoftext|y", "ΑΣ İstanbul ÉCOLE é"]
    for _ in range(1500):
        kind = draw.randrange(4)
        if kind == 0:
            texts.append("".join(draw.choice("abcdei'st1 .,<|>éßµ¼²") for _ in range(draw.randrange(40))))
        elif kind == 1:
            texts.append("".join(draw.choice(names) for _ in range(draw.randrange(1, 6))))
        elif kind == 2:
            texts.append("".join(chr(draw.choice([draw.randrange(0x250), draw.randrange(0x3000), draw.randrange(0xD7FF), draw.randrange(0x10000, 0x20000)])) for _ in range(12)))
        else:
            texts.append("".join(chr(draw.randrange(128)) for _ in range(30)) + draw.choice(["ȩ́ İ", "̈́", "aͅb"]))
    return texts


def test_encode_and_decode_agree_with_the_library(llm, library):
    texts = odd_texts(library)
    frame = llm.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, token_ids int")
    coded = bpe.decode(bpe.encode(frame, decoded="at_once"))
    got = {r.doc_id: (r.token_ids, r.decoded, r.text) for r in coded.collect()}
    assert coded.where("at_once <> decoded").count() == 0
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i] == (ids, library.decode(ids, skip_special_tokens=False), text)
    assert bpe.decode(bpe.encode(frame.limit(0))).count() == 0


def test_decode_leaves_unknown_ids_out(llm, library):
    frame = llm.createDataFrame([([512, -1, 99_999_999, 513],), ([],), (None,)], "token_ids array<int>")
    assert [r.decoded for r in bpe.decode(frame).collect()] == [library.decode([512, 513]), "", ""]


def test_token_query_over_documents(llm, library):
    texts = {r.doc_id: r.text for r in read_table(llm, SF, "documents").select("doc_id", "text").collect()}
    for row in QUERIES["op1_bpe"](llm, SF).collect():
        ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want = [len(ids), *(hashlib.sha256(t.encode()).hexdigest() for t in (" ".join(map(str, ids)), decoded))]
        assert [row.n_tokens, row.ids_sha256, row.decoded_sha256] == want


# ---- scores --------------------------------------------------------------------------------------


def rank_quality(scores: np.ndarray, labels: np.ndarray) -> float:
    """Share of (1, 0) pairs of labels that the scores put in order."""
    one, zero = scores[labels == 1], np.sort(scores[labels == 0])
    below, upto = np.searchsorted(zero, one, "left"), np.searchsorted(zero, one, "right")
    return float((below + upto).mean() / 2 / len(zero))


@pytest.mark.parametrize(("query", "column", "least"), [("op7_toxicity", "toxic", 0.9), ("op5_quality", "quality", 0.97)])
def test_held_out_labels_are_ranked(llm, query, column, least):
    labels = {r.doc_id: r[column] for r in read_table(llm, "/root/testdata/sf0.1", "labels").collect()}
    rows = QUERIES[query](llm, "/root/testdata/sf0.1").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    tested = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    scores, truth = np.array(tested).T
    assert rank_quality(scores, truth) > least


def test_scores_without_labels_and_of_empty_texts(llm):
    docs = llm.createDataFrame([(1, None), (2, ""), (None, "stupid"), (4, "words " * 50000)], "doc_id long, text string")
    none = llm.createDataFrame([], "doc_id long, toxic int, quality int")
    toxic = toxicity.score(docs.withColumn("toxicity", F.lit("x")), toxicity.train(docs, none)).collect()
    assert [round(r.toxicity, 6) for r in toxic] == [0.0] * 4
    good = quality.score(docs, quality.train(docs, none)).collect()
    assert [r.quality_score for r in good] == [0.5] * 4
    one_kind = llm.createDataFrame([(1, 1, 1), (2, 1, 1), (None, 0, 0), (4, None, None)], "doc_id long, toxic int, quality int")
    assert all(r.quality_score > 0.99 for r in quality.score(docs, quality.train(docs, one_kind)).collect())
    assert quality.score(docs.limit(0), quality.train(docs, none)).count() == 0


def test_memory_of_the_fit_for_each_entry(monkeypatch):
    """The driver fits the model; its arrays besides the input take a bounded number of bytes for an entry."""
    monkeypatch.setattr(toxicity, "STEPS", 2)
    draw, texts, each = np.random.default_rng(1), 8000, 250
    number = draw.integers(0, 20_000, texts * each).astype(np.int32)
    owner = np.repeat(np.arange(texts, dtype=np.int32), each)
    tracemalloc.start()
    try:
        toxicity.fit(number, owner, draw.random(texts) < 0.25, 0.2)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 33 * len(number)


def test_repeated_rows_and_null_ids_do_not_bend_the_toxicity_model(llm):
    """One clean row 3000 times, and the same texts under one id, leave the sample of ids and the model as they were."""
    docs, labels = read_table(llm, SF, "documents").select("doc_id", "text"), read_table(llm, SF, "labels")
    plain = toxicity.train(docs, labels, unlabelled_rows=300)
    clean = labels.join(docs, "doc_id").where("toxic = 0 and crc32(cast(doc_id as string)) % 5 <> 0").orderBy("doc_id").select("doc_id", "text").limit(1)
    repeats = clean.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("n")
    bent = toxicity.train(docs.unionByName(repeats), labels, unlabelled_rows=300)
    texts = docs.limit(300).toArrow().column("text").combine_chunks()
    assert np.allclose(toxicity.sigmoid(plain.logits(texts)), toxicity.sigmoid(bent.logits(texts)), atol=1e-3)
    # without ids every text is named by itself, so there is something to learn from
    nameless = docs.withColumn("doc_id", F.when(F.col("doc_id").isin([r[0] for r in labels.where("toxic = 1").select("doc_id").collect()]), F.col("doc_id")))
    model = toxicity.train(nameless, labels, unlabelled_rows=300)
    assert (model.weights != 0).sum() > 10


def test_the_non_negative_risk_finds_the_toxic_word():
    draw = np.random.default_rng(1)
    n, bad = 600, 7
    toxic = np.arange(n) < 100
    hidden = np.arange(n) < 130  # thirty of the unlabelled ones are toxic
    words = [np.unique(np.concatenate([draw.integers(20, 60, 12), [bad] if t else []])).astype(np.int64) for t in hidden]
    owner = np.repeat(np.arange(n), [len(w) for w in words])
    model = toxicity.fit(np.concatenate(words), owner, toxic, 30 / 500)
    assert int(np.argmax(model.weights)) == bad
    logits = model.bias + np.bincount(owner, model.weights[np.concatenate(words)], n)
    assert (logits[hidden] > 0).mean() > 0.95 and (logits[~hidden] > 0).mean() < 0.02


def test_rules_are_the_same_in_numpy_and_in_columns(llm):
    draw = np.random.default_rng(2)
    values = draw.random((500, len(quality.STATISTICS)))
    good = ((values[:, 0] > 0.4) & (values[:, 2] < 0.7)).astype(float)
    model = quality.fit(values, good)
    frame = llm.createDataFrame([tuple(map(float, v)) for v in values], ", ".join(f"{c} double" for c in quality.STATISTICS))
    got = frame.select(F.struct(*quality.STATISTICS).alias("s")).select(model.column("s").alias("p")).toPandas()["p"].to_numpy()
    logit = model.bias + sum(r.weight * r.holds(values) for r in model.rules)
    assert np.allclose(got, 1 / (1 + np.exp(-logit))) and ((got > 0.5) == good).mean() > 0.98


# ---- contamination -------------------------------------------------------------------------------


@pytest.mark.parametrize("index_shingles", [10**6, 0])
def test_contained_items(llm, index_shingles):
    draw = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    items = [(k, " ".join(draw.choice(words) for _ in range(n))) for k, n in enumerate([1, 3, 4, 5, 6, 9, 17, 40, 80, 80])]
    items += [(50, None), (51, " "), (52, items[7][1]), (7, items[7][1]), (None, items[6][1])]
    docs: list[tuple] = [(1, None), (2, ""), (3, items[0][1]), (4, items[1][1].upper())]
    for k, (_, text) in enumerate(items):
        tokens = (text or "").split()
        for changes in range(4):
            passage = list(tokens)
            for _ in range(changes * len(passage) // 20):
                passage[draw.randrange(len(passage))] = draw.choice(words)
            around = [draw.choice(words) for _ in range(draw.choice([0, 30, 3000]))]
            docs.append((100 + 4 * k + changes, " ".join([*around, *passage, *around[:20]])))
    docs.append(docs[-1])
    frame = llm.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("item", "key", "found", "content")})
    bench = llm.createDataFrame(items, "item_id long, text string")
    found = contamination.contained_items(frame, bench, index_shingles=index_shingles)
    for row in found.collect():
        own = shingles(row.text)
        want = {(i, len(shingles(t) & own), len(shingles(t))) for i, t in items if shingles(t) and 100 * len(shingles(t) & own) >= 75 * len(shingles(t))}
        assert {tuple(f) for f in row.found} == want and len(row.found) == len(want)
    assert contamination.contained_items(frame, bench.limit(0), index_shingles=index_shingles).where("size(found) > 0").count() == 0
    assert contamination.contained_items(frame.limit(0), bench, index_shingles=index_shingles).count() == 0


def test_shingles_are_not_broadcast_as_if_each_text_had_one(llm, small_broadcasts):
    draw = random.Random(6)
    words = [f"w{k}" for k in range(5000)]
    items = [(i, " ".join(draw.choices(words, k=40))) for i in range(15000)]
    docs = [(i, f"{items[i][1]} and more") for i in range(40)] + [(i, " ".join(draw.choices(words, k=100))) for i in range(40, 4000)]
    bench = written(llm.createDataFrame(items, "item_id long, text string"), "test")
    frame = written(llm.createDataFrame(docs, "doc_id long, text string"), "test")
    found = contamination.contained_items(frame, bench, index_shingles=0)
    assert {r.doc_id: [f.item for f in r.found] for r in found.collect()} == {i: [i] if i < 40 else [] for i, _ in docs}


# ---- pages ---------------------------------------------------------------------------------------


def test_minimum_cuts():
    draw = random.Random(2)
    for _ in range(1500):
        n = draw.randrange(1, 8)
        scores = [draw.randrange(-6, 7) for _ in range(n)]
        edges = [(draw.randrange(n), draw.randrange(n), draw.randrange(5)) for _ in range(draw.randrange(12))]

        def cost(sides):
            return sum(abs(s) for s, side in zip(scores, sides) if s and (s > 0) != side) + sum(w for a, b, w in edges if sides[a] != sides[b])

        assert cost(label(scores, edges)) == min(cost(sides) for sides in product((False, True), repeat=n))


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header class=site><a href=/>Site</a>
<div id=top-search><form><input><button>Go</button></form></div></header><div class="layout sidebar-right menu-closed"><div class="breadcrumb"><a>Home</a></div>
<main class="site-main"><article class="post type-post comments-open has-ads"><header><h1>The &amp; title</h1></header><p>First <b>bold</b> para &nbsp; with
 text.<p>Second para&#33;<ul><li>One<li>Two</ul><div class="ad-slot">Buy now!</div><table><tr><td>a<td>b</table><aside>Related</aside></article>
<section id="comments"><article class="comment"><p>Nice post, thanks for sharing this. I agree.</p></article></section></main>
<div class="sidebar"><p>About us, we are a company. Great.</p></div></div><div class="cookieNotice">We use cookies. Accept.</div>
<footer>&copy; x</footer><script>if (a<b) "</p>"</script></body></html>"""
PLAIN = """<div><div>Home | About</div><div><p>This is a long paragraph of text without any semantic tags. It has sentences.</p>
<p>Short one.</p><p>Another long paragraph of text without any tags. It has sentences too.</p></div><div><a>Link one</a> <a>Link two</a></div></div>"""


def test_main_text_of_pages(llm):
    rows = [(1, PAGE), (2, PLAIN), (3, None), (4, ""), (5, "<p>" * 3000), (6, "<!-- open <p>text"), (7, PAGE), (8, "<a href='x")]
    frame = llm.createDataFrame(rows, "page_id long, html string").withColumns({c: F.lit(1) for c in ("text", "rows", "value")})
    got = {r.page_id: r.text for r in pages.main_text(frame, weights=pages.PRIOR).collect()}
    assert got[1] == got[7] == "The & title First bold para with text. Second para! One Two a b"
    assert got[2].startswith("This is a long") and got[2].endswith("sentences too.") and "Short one." in got[2] and "Link" not in got[2]
    assert got[3] == got[4] == got[5] == got[6] == got[8] == ""
    assert pages.main_text(frame.limit(0)).count() == 0


def test_main_text_keeps_what_stands_in_and_after_foreign_elements(llm):
    tail = "<p>A second paragraph of the article, with a sentence. And one more.</p></article><nav><a>Home</a></nav>"
    after = "A second paragraph of the article, with a sentence. And one more."
    first = {
        "<p>The sum <math><mi>x</mi><mo>=</mo><mn>1</mn><mspace/></math> holds for all.</p>": "The sum x=1 holds for all.",
        "<object data=a.swf><param name=a><p>The film shows a bird. It flies.</p></object>": "The film shows a bird. It flies.",
        "<p>The icon <svg viewBox='0 0 1 1'><path d=M0/><title/><title>T</title><text>Zoom</text></svg>, as said.</p>": "The icon , as said.",
        "<ul><li>One<template><li>Row</li></template> item</li></ul>": "One item",
        "<p>Open <svg><path d='M0'/> ends here.</p>": "Open ends here.",
        "<p>Open <math><mi>y</mi> ends here.</p>": "Open y ends here.",
        "<object data=a><p>Open object, not closed.</p>": "Open object, not closed.",
        "<template><p>Open template, not closed.</p>": "Open template, not closed.",
        "<svg><g><p>Open drawing, left by a paragraph.</p>": "Open drawing, left by a paragraph.",
        "<p>Before <noembed>old</noembed><noframes>older</noframes>after.</p>": "Before after.",
    }
    rows = [(k, f"<body><article>{part}{tail}") for k, part in enumerate(first)]
    # a later drawing that is closed does not close an earlier one
    rows.append((len(rows), "<body><article><p>Open <svg><path d='M0'/></p>" + tail + "<svg><text>Zoom</text></svg>"))
    frame = llm.createDataFrame(rows, "page_id long, html string")
    got = {r.page_id: r.text for r in pages.main_text(frame, weights=pages.PRIOR).collect()}
    assert got == dict(enumerate([f"{text} {after}" for text in first.values()] + ["Open " + after]))


def test_main_text_of_the_given_pages(llm):
    import html
    import re

    rows = {r.page_id: r for r in QUERIES["op9_main_text"](llm, SF).collect()}
    for page in read_table(llm, SF, "pages").collect():
        article = re.search(r"<article>(.*)</article>", page.html, re.S)[1]
        bare = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)[^>]*>", " ", article))
        want = " ".join(html.unescape(bare).split())
        assert (rows[page.page_id].text, rows[page.page_id].n_chars) == (want, len(want))


ARTICLE = """<body><nav><a href=x>Home</a></nav><article><h1>A title</h1><p>Some text that is here to be read. And more of it.</p>
{}<p>The last words of the article are these.</p></article><footer>Copyright</footer>"""


def test_a_word_inside_a_class_name_does_not_take_article_text_out():
    inner = "<p>The price rose by three points today, they said.</p>"
    for name in ("share-price", "login-error", "related-work", "ad-hoc", "comment-on-law", "headerFile", "widget_theory"):
        for tag in ("p", "section", "div"):
            part = f'<{tag} class="{name}">{inner}</{tag}>' if tag != "p" else inner.replace("<p>", f'<p class="x {name}">')
            assert "three points" in " ".join(pages.content(ARTICLE.format(part), pages.PRIOR)), (name, tag)
    for name in ("share-buttons", "newsletter-signup", "commentList", "ad", "related-posts", "cookie_notice_box", "alert"):
        assert "three points" not in " ".join(pages.content(ARTICLE.format(f'<div class="{name}">{inner}</div>'), pages.PRIOR)), name


@pytest.mark.parametrize(
    "page",
    ["<div>{n}x", "<b>{n}<p>{n}x", "<i><div><b>{n}</i>{n}x", "</p>{n}", "<a{n}", "<ul><li>{n}x", "<article></article>{n}", "<div class='ad-x'>{n}x", "<em><p>{n}</em>{n}"],
)
def test_pages_of_very_many_tags_take_time_in_proportion(page):
    import re
    import time

    many = lambda n: re.sub(r"(</?\w+(?: [^>]*)?>?)\{n\}", lambda m: m[1] * n, page)
    pages.content(many(100), pages.PRIOR)
    began = time.process_time()
    pages.content(many(100_000), pages.PRIOR)
    assert time.process_time() - began < 8  # hours where it grows with the square


def test_main_text_without_semantic_tags(llm):
    import re
    from collections import Counter

    given = read_table(llm, SF, "pages")
    weights = pages.train(given)
    both = Counter()
    for page in given.collect():
        bare = re.sub(r'\s(class|id|role)="[^"]*"', "", page.html)
        bare = re.sub(r"<(/?)(nav|article|aside|footer|header|main|section|form)\b[^>]*>", r"<\1div>", bare)
        want, got = (Counter(" ".join(pages.content(t, weights)).split()) for t in (page.html, bare))
        both.update(found=sum(got.values()), wanted=sum(want.values()), right=sum((got & want).values()))
    assert both["right"] > 0.99 * both["found"] and both["right"] > 0.99 * both["wanted"]


def test_repeated_and_null_page_ids_in_training(llm):
    rows = [(i % 40, ARTICLE.format(f"<p>Text number {i % 40} is here.</p>")) for i in range(80)]
    more = [(3, ARTICLE.format("<p>Another text of the same id.</p>"))] * 300 + [(None, rows[0][1]), (None, None)]
    plain, bent = (pages.train(llm.createDataFrame(r, "page_id long, html string"), bound=40) for r in (rows, rows + more))
    assert plain.shape == (2, len(pages.FEATURES)) and np.abs(plain - bent).max() < 0.2


# ---- chat ----------------------------------------------------------------------------------------


def test_best_paths_do_not_depend_on_blocks(llm, monkeypatch):
    lines = chat.with_signs(chat.transcript_lines(read_table(llm, SF, "conversations"))).cache()
    model = chat.train(lines)

    def turns(block):
        monkeypatch.setattr(chat, "BLOCK_TURNS", block)
        found: dict[tuple, list] = {}
        for r in sorted(chat.recover_turns(lines, model).collect(), key=lambda r: (r.conv, r.turn, r.line_no)):
            found.setdefault((r.conv, r.start_turn, r.start_line, r.role), []).append(r)
        return {k: (sum(r.n_lines for r in v), sum(r.n_right for r in v), "\n".join(r.text for r in v)) for k, v in found.items()}

    whole = turns(1000)
    assert whole == turns(2)
    monkeypatch.setattr(chat, "FAN", 3)
    assert whole == turns(2)
    assert sum(v[1] for v in whole.values()) > 0.98 * sum(v[0] for v in whole.values())

    shown: dict[int, list] = {}
    for r in lines.orderBy("conv", "turn", "role", "tie", "line_no").collect():
        shown.setdefault(r.conv, []).append(r.sign)
    for conv, signs in list(shown.items())[:60]:  # the path's score is that of plain Viterbi
        best = model.step[chat.N] + model.seen[:, signs[0]]
        for sign in signs[1:]:
            best = np.maximum((best[:, None] + model.step[: chat.N]).max(0), -(10**18)) + model.seen[:, sign]
        path = []
        for (_, _, _, role), (n, _, _) in sorted((i for i in whole.items() if i[0][0] == conv), key=lambda i: i[0][:3]):
            path += [chat.STATES.index((role, True))] + [chat.STATES.index((role, False))] * (n - 1)
        score = model.step[chat.N, path[0]] + sum(model.seen[s, sign] for s, sign in zip(path, signs))
        assert score + sum(model.step[a, b] for a, b in zip(path, path[1:])) == best.max()


@pytest.mark.parametrize("fan", [7, 1024])
def test_a_transcript_of_very_many_blocks_is_combined_in_a_tree(llm, monkeypatch, fan):
    monkeypatch.setattr(chat, "FAN", fan)
    draw = np.random.default_rng(fan)
    sizes, rows, want = {"-": 3000, "5": 1, "6": 8}, [], {}
    for name, n in sizes.items():
        scores = draw.integers(-(10**9), 0, (n, chat.N + 1, chat.N))
        begun = np.where(draw.random((n, chat.N + 1, chat.N)) < 0.2, 1, -1)
        turns = np.arange(n)[:, None, None] * 100 + np.arange(chat.N)
        turns = np.broadcast_to(turns, begun.shape)
        rows += [(name, k, *(x[k].ravel().tolist() for x in (scores, begun, turns, turns + 1))) for k in range(n)]
        total, came = scores[0][chat.N], []
        for block in scores[1:]:
            reach = total[:, None] + block[: chat.N]
            came.append(reach.argmax(0))
            total = reach.max(0)
        leaves = [int(total.argmax())]
        for before in came[::-1]:
            leaves.append(int(before[leaves[-1]]))
        leaves.reverse()
        enters, opened = chat.N, (None, None)
        for k, leave in enumerate(leaves):
            want[name, k] = (enters, leave, *opened)
            if begun[k, enters, leave] >= 0:
                opened = (int(turns[k, enters, leave]), int(turns[k, enters, leave]) + 1)
            enters = leave
    kind = "name string, nth long, scores array<long>, begun array<long>, turns array<long>, lines array<long>"
    got = chat.chained(llm.createDataFrame(rows, kind).repartition(4)).collect()
    assert {(r.name, r.nth): (r.enters, r.leaves, r.open_turn, r.open_line) for r in got} == want


def test_odd_conversations(llm):
    rows = [(1, 0, "user", None), (1, 1, None, "x\n\ny"), (None, 0, "user", "hello?"), (None, None, "assistant", ""), (2, 0, "user", "a"), (2, 0, "user", "a"), (3, 0, "tool", "z" * 50000)]
    frame = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("line", F.lit(1))
    lines = chat.with_signs(chat.transcript_lines(frame))
    turns = chat.rendered(chat.recover_turns(lines, chat.train(lines))).collect()
    assert {r.conv for r in turns} == {1, 2, 3, None} and sum(r.n_lines for r in turns) == 7
    empty = chat.with_signs(chat.transcript_lines(frame.limit(0)))
    assert chat.recover_turns(empty, chat.train(empty)).count() == 0


def one_turn_model() -> chat.Model:
    """Every transcript is one turn of the assistant, whatever its lines show."""
    begins, goes_on = (chat.STATES.index(("assistant", b)) for b in (True, False))
    first, step = np.zeros(chat.N), np.zeros((chat.N, chat.N))
    first[begins] = step[begins, goes_on] = step[goes_on, goes_on] = 1e6
    return chat.Model(first, step, np.zeros((chat.N, chat.SIGNS)))


def test_turns_keep_all_of_their_text(llm):
    inner = "Here it is\nAnswer: 42\n\n\nContext: none\n<q> Question: ?\n\n"
    rows = [(1, 0, "assistant", "Sure\n" + inner), (1, 1, "user", "Me: no"), (2, 0, "user", "\n\nhello"), (3, 0, None, "\n\n")]
    frame = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    shown = {r.turn: r.line for r in chat.transcript_lines(frame.where("conv_id = 1")).where("line_no = 0").collect()}
    turns = chat.recover_turns(chat.with_signs(chat.transcript_lines(frame)), one_turn_model()).collect()
    got = {r.conv: r.text for r in turns}
    assert got[1] == "Sure\n" + inner + "\n\n" + shown[1] and shown[1].endswith("Me: no")
    assert got[2].endswith("\n\nhello") and got[3] == "\n\n"


def test_blocks_are_cut_by_lines_not_by_turn_numbers(llm, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_TURNS", 10)
    rows = [(c, t, "user", f"text {k}\nmore\n\nof it") for k in range(40) for c, t in ((None, k % 2), (5, None), (6, k))]
    rows.append((7, 0, "user", "\n".join(map(str, range(95)))))
    frame = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    lines = chat.with_signs(chat.transcript_lines(frame))
    turns = chat.recover_turns(lines, one_turn_model()).collect()
    for conv, n in ((None, 120), (5, 120), (6, 120), (7, 95)):
        pieces = [r for r in turns if r.conv == conv]
        assert sum(r.n_lines for r in pieces) == n and max(r.n_lines for r in pieces) <= 10
        assert sum(r.opens for r in pieces) == 1 and len({(r.start_turn, r.start_line) for r in pieces}) == 1


def test_every_query_and_oracle_is_named_after_its_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)
