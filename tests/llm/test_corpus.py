"""Operators 1, 2, 4, 6, 7, 8, 9 and 10 on small tables with nulls, empties, ties and repeated rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcela.llm import jaccard, maxscore
from parcela.llm.bpe import encode_digests, encode_texts, vocabulary_path
from parcela.llm.components import components
from parcela.llm.decontaminate import drop_contaminated, matches
from parcela.llm.lines import dedup_lines, remove_repeats
from parcela.llm.pages import Page, extract, site_templates
from parcela.llm.toxicity import classify, drop_toxic, fit, terms
from parcela.llm.words import slices
from parcela.llm.urls import judge, rule_table

from .conftest import corpus, prose


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path())
    texts = [t for _, t, _ in corpus()] + ["<|endoftext|>A<|startoftext|>", "ΑΣ ΣΑΣ İ ǅ ﬁ ½²Ⅷ don't WE'LL", "aaaaaaa hahahaha",
                                           "日本語 한국어 👩‍👩‍👧", "x\x1cy\x85z\u00a0w", "e\u0301 É"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = {r.doc_id: r for r in encode_texts(frame, vocabulary_path()).collect()}
    digests = {r.doc_id: r for r in encode_digests(frame, vocabulary_path()).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (whole[i].ids, whole[i].decoded) == (ids, decoded)
        assert digests[i].n_tokens == len(ids)
        assert digests[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_decontamination(spark, no_docs):
    item = "A train travels 60 km in 2 hours while Maria walks slowly along the quiet river bank near the old stone bridge"
    other = item.replace("60", "75").replace("Maria", "Peter")
    twisted = "Maria bought 3 apples and 3 pears at the small market then went home along the very long road"
    benchmark = spark.createDataFrame([(1, item), (1, item), (2, "of 3 " + twisted), (3, None), (4, "too short")], "item_id long, text string")
    rows = [(1, prose(1, 20) + " " + item), (2, prose(2, 20) + " and " + other), (3, prose(3, 40)), (4, None), (5, ""),
            (6, prose(4, 9) + " of 3 " + twisted.replace("3 pears", "9 pears")), (7, "one " * 200), (1, prose(1, 20) + " " + item)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in matches(frame, benchmark).collect()}
    assert found[(1, 1)].exact and not found[(2, 1)].exact
    # 6: one value of the item stands for two of the document, but the windows behind it are the item's
    assert set(found) == {(1, 1), (2, 1), (6, 2)}
    extra = frame.withColumn("tk", F.lit("kept"))
    assert sorted(r.doc_id for r in drop_contaminated(extra, benchmark).collect()) == [3, 4, 5, 7]
    assert drop_contaminated(extra, benchmark).columns == extra.columns
    assert matches(no_docs, benchmark).count() == 0
    assert drop_contaminated(frame, benchmark.where("item_id < 0")).count() == len(rows)


def test_decontamination_word_for_word(spark):
    items = ["If 12 boys and 8 girls share the sweets then how many sweets does every child get at the end of day",
             "Compute 12 + 8 * 3 - 40 / 5 and 17", "Die Stadt Berlin hat viele alte Brücken", "Anna Bert Carl Dora Emil Frieda Gustav",
             "Which river flows through the old town"]
    texts = [items[0].replace("12", "10").replace("8", "10"), items[1], "so " + items[2], "with " + items[3], "he asked which river flows through the old town",
             items[1].replace("17", "18"), "with Anna Bert Carl Dora Emil Frieda Hans", items[0].replace("12", "10").replace("sweets does", "pears does")]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame([(i, prose(i, 20) + " " + t + " " + prose(i + 40, 20)) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in matches(docs, benchmark).collect()}
    assert {k for k in found if k[0] < 7} == {(i, i) for i in range(5)}
    assert [found[(i, i)].exact for i in range(5)] == [False, True, True, True, True]
    assert all(found[(i, i)].n_windows == found[(i, i)].item_windows for i in range(1, 5))  # the first word of 0 looks like a name


def test_urls(spark):
    urls = ["http://a.example.net/en/x?q#f", "https://EXAMPLE.NET/en/", "http://example.net/fr/", "http://net", "http://net/", None, "", "no host",
            "ftp://x.org/fr/1", "http://org/frx", "http://notexample.net/en/", "http://example.com/de/#", "a://b.example.com/de/x", "http://u.net/"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls * 2)], "page_id long, url string, host string")
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

    def expected(url):
        rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
        m = re.match(r"([^/?#]*)([^?#]*)", rest, re.S)
        host = re.sub("[A-Z]", lambda c: c[0].lower(), m[1])
        fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and m[2].startswith(r[1])]
        best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
        return host, m[2], best and best[0] + best[1], best[2] if best else "allow"

    for zones in (1, 7):
        found = {r[0]: tuple(r[1:]) for r in judge(pages, rule_table(spark, rules), zones=zones).collect()}
        assert found == {i: expected(u) for i, u in enumerate(urls * 2)}
    assert judge(pages.where("page_id < 0"), rule_table(spark)).count() == 0


def test_a_control_character_in_a_host_is_no_dot(spark):
    hosts = ["example\x00x.net", "net\x00", "a\x00net", "a.net", "x\x01.example.net", "\x01\x01.net", "net.\x00", "b.net\x00.net"]
    pages = spark.createDataFrame([(i, f"http://{h}/en/") for i, h in enumerate(hosts)], "page_id long, url string")
    found = {r["page_id"]: r["rule"] for r in judge(pages, rule_table(spark), zones=3).collect()}
    rules = {"net": "net/", "example.net": "example.net/en/"}
    want = {}
    for i, h in enumerate(hosts):
        fits = [r for r in rules if h == r or h.endswith(f".{r}")]
        want[i] = rules[max(fits, key=len)] if fits else None
    assert found == want


def test_toxicity(spark, no_docs):
    rows, marks = [], []
    for i in range(600):
        toxic = i % 5 == 0
        rows.append((i, prose(i, 60) + (" you idiot moron" if toxic else ""), 1))
        marks.append((i, int(toxic)))
    rows += [(1000, None, 1), (1001, "", 1), (1001, "", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([*marks, (0, None), (None, 1)], "doc_id long, toxic int")
    found = classify(frame, labels).collect()
    truth = dict(marks)
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert drop_toxic(frame, labels).columns == frame.columns
    assert {r.score for r in classify(frame, labels.where("doc_id < 0")).collect()} == {0.0}
    assert classify(no_docs, labels).count() == 0


def test_toxicity_learns_pairs_of_terms_that_are_neutral_alone():
    """Two words as often toxic as any text, and always toxic together, among texts with an insult of its own."""
    rnd, texts, kinds = random.Random(2), [], []
    for _ in range(16_000):
        words, draw = [f"w{rnd.randrange(3000)}" for _ in range(8)], rnd.random()
        kind = 0
        if draw < 0.38:
            words.insert(3, "zork" if draw < 0.18 or draw >= 0.36 else "blim")
        if 0.36 <= draw < 0.38:
            words.insert(5, "blim")
            kind = 2
        elif 0.38 <= draw < 0.46:
            words.insert(7, "idiot")
            kind = 1
        texts.append(" ".join(words))
        kinds.append(kind)
    found = []
    for _, end, raw, offsets in slices(pa.array(texts)):
        rows, dims = terms(raw, offsets)
        cuts = np.searchsorted(rows, np.arange(len(offsets)))
        found += [dims[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    kinds = np.array(kinds)
    machine = fit(found[:12_000], (kinds[:12_000] > 0).astype(float))
    held, kind = found[12_000:], kinds[12_000:]
    scores = machine.scores(np.repeat(np.arange(len(held)), [len(t) for t in held]), np.concatenate(held), len(held))
    assert (scores[kind == 2] >= 0.3).mean() > 0.7 and (scores[kind == 1] >= 0.3).mean() > 0.97
    assert (scores[kind == 0] >= 0.3).mean() < 0.005


def test_top_k_with_vectors_of_any_size(spark):
    """Wide components are scored in whole numbers; none is left out for its size."""
    rnd = random.Random(4)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(4)]) for i in range(60)]
    rows += [(100, [4e7, 1.0, 0.0, 3.0]), (101, [4e7, 1.0, 0.0, 3.0]), (120, [-3e9, 2.5e9, 1e9, 0.25]), (121, [2.0**40, 1.0, 0.0, 0.0]),
             (140, [1e200, 1.0, 1.0, 1.0]), (141, [float("nan"), 1.0, 1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = maxscore.top_k(frame.select("vec_id", maxscore.scaled("embedding").alias("terms")), F.col("vec_id") % 20 == 0, 5, 16, 4)
    whole = {i: [math.floor(64 * x) if abs(x) < 1e100 else 64 * int(x) for x in v] for i, v in rows if v[0] == v[0]}
    expected = []
    for q in (i for i in whole if i % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)[:5]
        expected += [(q, min(max(-s, -2**63), 2**63 - 1)) for s, i in scores]
    assert sorted((r["query_id"], r["score"]) for r in found.collect()) == sorted(expected)


def test_top_k(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(0, 0.2, (300, 16))
    data[40:80] = data[0]  # ties
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(data)]
    rows += [(500, None, 1), (520, [None, 1.0], 1), (540, [float("nan")] * 16, 1), (None, [1.0] * 16, 1), rows[7], (560, [0.5] * 3, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    found = maxscore.top_k(frame.select("vec_id", maxscore.scaled("embedding").alias("terms")), F.col("vec_id") % 20 == 0,
                           shard_rows=64, block_queries=4).collect()
    whole = {i: np.floor(64 * v).astype(int) for i, v in enumerate(data)} | {560: np.array([32] * 3 + [0] * 13)}
    expected = set()
    for q in (i for i in whole if i % 20 == 0):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:20]
        expected |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    assert set(map(tuple, found)) == expected and len(found) == len(expected)
    assert maxscore.top_k(frame.where("vec_id < 0").select("vec_id", F.lit(None).cast("array<double>").alias("terms")), F.lit(True)).count() == 0


def test_lines(docs, no_docs):
    def chunks(text):
        lines = text.split("\n")
        marks = [hashlib.md5(x.encode()).hexdigest() for x in lines]
        out = []
        for i, line in enumerate(lines):
            if i == 0 or hashlib.md5((marks[i - 1] + marks[i]).encode()).hexdigest()[0] < "4":
                out.append([])
            out[-1].append(line)
        return out

    seen, expected = set(), {}
    for doc, text in sorted({(i, t) for i, t, _ in corpus() if t is not None}):
        kept = []
        for c in chunks(text):
            if len(c) > 1 and tuple(c) in seen:
                continue
            if len(c) > 1:
                seen.add(tuple(c))
            kept.append("\n".join(c))
        expected[doc] = "\n".join(kept)
    rows = dedup_lines(docs).collect()
    assert len(rows) == len(corpus()) and dedup_lines(docs).columns == docs.columns
    assert all(r.text == expected.get(r.doc_id) for r in rows)
    assert all(r.n_chars == len(r.text or "") and r.tk == "key" for r in rows)
    assert any(len(expected[i]) < len(t or "") for i, t, _ in corpus() if t)
    assert dedup_lines(no_docs).count() == 0
    plan = remove_repeats(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pages(spark):
    menu = "<div><a href='/a'>Home</a> <a href='/b'>News</a></div>"
    rows = [(i, f"http://h.example/{i}", f"<html><head><title>T</title></head><body>{menu}<nav>N</nav><h1>Title {i}</h1><p>Body &amp; soul\n {i}<br>x"
             f"<p class='ad'>Buy</p><script>if (a<b) c('</p>')</script><footer>F</footer></body>") for i in range(12)]
    rows += [(20, None, "<article>Q &lt; R<!-- c --><div class=comments>bad</div></article><p>out</p>"), (21, "u", None), (22, "u", ""), (23, "u", "plain  text"),
             (24, "u", "<p>open <b>bold</p> tail"), rows[0]]
    frame = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, host string")
    found = {r.page_id: r.text for r in extract(frame).collect()}
    assert all(found[i] == f"Title {i}\n\nBody & soul {i} x" for i in range(12))
    assert (found[20], found[21], found[22], found[23], found[24]) == ("Q < R", "", "", "plain text", "open bold\n\ntail")
    assert extract(frame).count() == len(rows) and extract(frame.where("page_id < 0")).count() == 0


def test_pages_with_a_box_inside_the_article(spark):
    box = "<div class=k7><b>Weekly picks</b><ul><li>Ten tips</li></ul></div>"
    shell = "<html><body><div class=wrap><main>{}</main><div>Imprint</div></div></body>"
    rows = [(i, f"http://h.example/{i}", shell.format(f"<h1>Title {i}</h1><p>Body {i}</p>{box}<table><tr><td>row {i}<td>0</table>")) for i in range(30)]
    # one story under many addresses is no template, nor is a part of few articles
    rows += [(100 + i, f"http://h.example/c{i}", f"<!-- {i} -->" + shell.format(f"<h1>Copy</h1><p>Same</p>{box}")) for i in range(20)]
    rows += [(200 + i, f"http://h.example/d{i}", shell.format(f"<p>Seen twice</p><p>Own {200 + i}</p>")) for i in range(2)]
    found = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == ({i: f"Title {i}\n\nBody {i}\n\nrow {i}\n\n0" for i in range(30)} | {100 + i: "Copy\n\nSame" for i in range(20)}
                     | {200 + i: f"Seen twice\n\nOwn {200 + i}" for i in range(2)})


def main_text(source):
    return Page(source).text(set())


def test_pages_never_lose_the_article():
    long = " ".join(f"word{i}" for i in range(60))
    article = f"<article><h1>T</h1><p>{long}</p></article>"
    expected = f"T\n\n{long}"
    for shell in ("<div class='layout has-sidebar'>{}<aside>x</aside></div>", "<div class='sidebar-wrap'>{}</div>", "<form action=/s>{}<input></form>",
                  "<div class=widget><nav>n</nav>{}</div><article class=tease>Short one</article>", "<div id=search><section class='menu'>{}</section></div>"):
        assert main_text(f"<body><nav>menu</nav>{shell.format(article)}<footer>f</footer></body>") == expected
    assert main_text(f"<body><div class='post comments-open'><p>{long}</p></div></body>") == long
    assert main_text(f"<body><div class=post><p>{long}</p></div><article>Teaser</article></body>") == f"{long}\n\nTeaser"
    assert main_text(f"<body><form><p>{long}</p></form></body>") == long  # nothing else is left
    # comments are no article, however they are marked
    assert main_text(f"<body>{article}<section class=comments><article>{long}</article><article>{long} more</article></section></body>") == expected


def test_pages_with_letters_that_change_length_in_lower_case():
    page = "<article>" + "<p>İstanbul İ</p>" * 60 + "<script>if (a<b) {}</SCRIPT><p>one</p><style>x</style><p>two</p></article>"
    assert main_text(page).endswith("İ\n\none\n\ntwo")


def test_deep_pages_take_time_in_proportion():
    for tag in ("b", "div", "li", "p", "article", "td"):
        start = time.perf_counter()
        text = main_text("<article>" + f"<{tag}>x " * 100_000)
        assert time.perf_counter() - start < 5 and text.count("x") == 100_000
    assert main_text("<ul>" + "<li>a<b>" * 20_000).count("a") == 20_000
    assert main_text("<p>" + "</div></q>" * 50_000 + "end") == "end"


def test_template_counts_equal_brute_force(spark):
    """Hosts' templates against hashes counted page by page, with repeated pages and tied counts."""
    rnd = random.Random(8)
    boxes = [f"<div class=b{i}><p>Box {i}</p></div>" for i in range(12)]
    rows = []
    for i in range(120):
        chosen = [b for j, b in enumerate(boxes) if rnd.random() < (j + 1) / 14]
        rows.append((i, f"http://h{i % 3}.example/{i}", f"<body>{''.join(chosen)}<p>Own {i % 100}</p></body>"))
    rows += [(500, "http://h0.example/0", rows[0][2])] * 3
    counts, pages = Counter(), Counter()
    for host, source in {(u.split("/")[2], h) for _, u, h in rows}:
        pages[host] += 1
        counts.update((host, x) for x in Page(source).template_hashes()[0])
    want = {(h, x) for (h, x), n in counts.items() if n >= 5 and n >= 0.1 * pages[h]}
    found = site_templates(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()
    assert {(r["host"], x) for r in found for x in r["template"]} == want and want


def shingle_components(rows, width, num, den):
    sets = {}
    for doc, text, _ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))
        sets[doc] = {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def variants(n: int) -> list[tuple[int, str, str]]:
    """Near copies in a chain: neighbours are linked, the ends are not."""
    words = prose(50, 200).split()
    out = []
    for i in range(n):
        words[i % 200] = f"changed{i}"
        out.append((100 + i, " ".join(words), "v"))
    return out


@pytest.mark.parametrize("width,num,den", [(3, 90, 100), (5, 80, 100)])
def test_jaccard(spark, docs, no_docs, width, num, den, monkeypatch):
    rows = corpus() + variants(40)
    frame = docs.select("doc_id", "text", "source").union(spark.createDataFrame(variants(40), "doc_id long, text string, source string"))
    expected = shingle_components(rows, width, num, den)
    for block, paired in ((jaccard.BLOCK_SETS, jaccard.PAIRED), (8, 2)):
        monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
        monkeypatch.setattr(jaccard, "PAIRED", paired)
        found = jaccard.join(frame, width, num, den).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == Counter((d, *expected[d]) for d, _, _ in rows)
    kept = jaccard.keep_one(docs, width, num, den)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _, _ in corpus() if expected[d][1] == d}
    assert jaccard.join(no_docs, width, num, den).count() == 0


def test_jaccard_deals_what_is_apart_into_blocks(spark, monkeypatch):
    """A chain whose ends are far from the leader; no task takes all sets that are apart from it."""
    rows = variants(180)
    expected = shingle_components(rows, 3, 90, 100)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 16)
    monkeypatch.setattr(jaccard, "LIST_SETS", 48, raising=False)
    largest = []
    search = jaccard._search

    def watched(members, *others):
        cell = [c for c in ("comp", "block", "asking") if c in members.columns]
        largest.append(members.groupBy(*cell).count().agg(F.max("count")).first()[0])
        return search(members, *others)

    monkeypatch.setattr(jaccard, "_search", watched)
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r.component_id for r in jaccard.join(frame, 3, 90, 100).collect()}
    assert found == {d: c for d, (_, c) in expected.items()} and set(found.values()) == {100}
    assert len(largest) == 2 and max(largest) <= 80


def test_linked_to_an_asking_leader_still_searches():
    """The first set asks and is linked to the second; only the second is linked to the third, which does not ask."""
    words = np.arange(1, 41, dtype=np.uint64)
    sets = [words[:36], words[2:38], words[4:40]]
    args = (np.array([True, True, False]), np.arange(3), np.zeros(3, bool))
    assert jaccard.linked(sets, *args, 85, 100) == [0, 0, 0]
    assert jaccard.linked(sets, np.ones(3, bool), *args[1:], 85, 100) == [0, 0, 0]


def test_components(spark):
    path = [(i, i + 1) for i in range(30)] + [(100, 101), (5, 5), (5, 4)]
    found = {r.node: r.root for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(31)}, 100: 100, 101: 100}


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "encoding"]
    rows = [(i, t, "en", s, len(t or "")) for i, t, s in corpus()]
    item = "a plain question about nothing in particular that every model should surely have answered long before now"
    rows.append((30, prose(70, 20) + " " + item, "en", "src", 1))
    tables = {"documents": spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"),
              "labels": spark.createDataFrame([], "doc_id long, quality int, toxic int"),
              "benchmark": spark.createDataFrame([(1, item)], "item_id long, text string")}
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    found = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert 30 not in found and {1, 5, 6, 14}.issubset(found) and not found & {2, 3}
