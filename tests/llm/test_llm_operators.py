"""The dealt operators against brute force, and on nulls, empty tables, repeats and clashing names."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from apexlake.llm import bpe, decontaminate, html_text, kneser_ney, licenses, passages, pii, quality, simhash
from apexlake.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, key string, words string, fp string"  # extra columns named like inner ones
rng = np.random.default_rng(5)
VOCABULARY = ["the", "of", "and", "a"] + ["".join(rng.choice(list("abcdeéöñ"), rng.integers(2, 7))) for _ in range(300)]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(VOCABULARY, n))


PASSAGE = prose(70, 1000)
EDITED = " ".join(w if i % 23 else "changed" for i, w in enumerate(PASSAGE.split()))
LONG = prose(6000, 1001)
TEXTS = [
    None, "", " \t\n ", "One", "AA bb Cc dd", prose(40, 1), prose(40, 1), prose(40, 1).upper(), prose(80, 2), LONG, LONG + " end",
    f"{prose(30, 3)}\n{PASSAGE}\n{prose(30, 4)}", f"{prose(20, 5)} {EDITED} {prose(45, 6)}", f"{prose(25, 7)} {PASSAGE}",
    "of " * 120, "to " * 90 + "be " * 80, "x! <|endoftext|> It's 12½ ΣΑΣ 漢字 🙂\x1cz ǅ   “q” aaaa", "€" * 30,
    "Released under the MIT License. " + prose(20, 8), "line one here\n" * 6 + "other",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "k", "w", "f") for i, t in enumerate(TEXTS)] + [(3, "One", "k", "w", "f"), (3, "Two under one id", "k", "w", "f"), (None, "no id", "k", "w", "f")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


# Encoding and counts

def test_bpe_equals_the_library(docs, empty):
    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    for row in bpe.encode(docs, PATH).collect():
        expected = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["token_ids"] == expected
        assert row["decoded"] == library.decode(expected, skip_special_tokens=False)
    for row in bpe.encode_digest(docs, PATH).collect():
        expected = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["n_tokens"] == len(expected)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, expected)).encode()).hexdigest()
    for row in bpe.count_tokens(docs, PATH).collect():
        assert row["n_tokens"] == len(library.encode(row["text"] or "", add_special_tokens=False).ids)
    assert bpe.encode(empty, PATH).count() == 0 and bpe.count_tokens(empty, PATH).count() == 0


def test_decode_is_the_inverse(docs):
    encoded = bpe.encode(docs, PATH)
    assert bpe.decode(encoded.withColumnRenamed("decoded", "before"), PATH).where("NOT decoded <=> before").count() == 0


def test_whole_tokens_are_single(spark):
    vocabulary = bpe.Vocabulary(bpe.read_vocabulary(PATH))
    library = Tokenizer.from_file(PATH)
    whole = bpe.whole_tokens(vocabulary)
    assert len(whole) > 30_000
    for word in whole[::97]:
        if vocabulary.pre_tokens(word) == [word]:
            assert len(library.encode(word, add_special_tokens=False).ids) == 1


def test_memory_that_forgets_gives_the_same(docs, monkeypatch):
    vocabulary = bpe.Vocabulary(bpe.read_vocabulary(PATH))
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    memory = bpe.Memory({}, lambda missing: [len(ids) for ids in vocabulary.merge(missing)])
    for text in TEXTS[3:12]:
        memory.know([vocabulary.pre_tokens(text)])
        assert all(memory[w] == len(vocabulary.merge([w])[0]) for w in vocabulary.pre_tokens(text))


# Near-duplicates

def simple_fingerprint(text):
    own = words(text)
    shingles = [" ".join(own[i:i + 4]) for i in range(max(1, len(own) - 3))] if own else []
    ones = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash_components(docs, empty):
    rows, classes = simhash.near_duplicates(docs)
    prints = {(r["doc_id"], r["text_hash"]): r["fp"] & (1 << 64) - 1 for r in rows.collect()}
    expected = {(r["doc_id"], r["h"]): simple_fingerprint(r["text"]) for r in docs.withColumn("h", F.xxhash64("text")).collect()}
    assert prints == expected
    found = {r["fp"] & (1 << 64) - 1: r["component_id"] for r in classes.collect()}
    distinct = sorted(set(prints.values()))
    root = union([(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 4], distinct)
    for fp, component in found.items():
        ids = [d for (d, _), other in prints.items() if root[other] == root[fp] and d is not None]
        assert component == (min(ids) if ids else None)
    assert [part.count() for part in simhash.near_duplicates(empty)] == [0, 0]


def test_representatives_with_clashing_names(spark):
    clashing = spark.createDataFrame(
        [(1, "a b c d e f", 5, 6, 7), (1, "a b c d e f", 5, 6, 7), (2, "u v w x y z", 8, 9, 9)], "doc_id long, text string, n int, text_hash int, fp int")
    assert sorted(tuple(r) for r in simhash.representatives(clashing).collect()) == [(1, "a b c d e f", 5, 6, 7), (2, "u v w x y z", 8, 9, 9)]


def test_unrelated_texts_under_one_id_are_both_kept(spark):
    one, two = prose(60, 81), prose(60, 82)
    docs = spark.createDataFrame([(1, one), (1, two), (2, one), (3, two), (3, two)], "doc_id long, text string")
    assert sorted(tuple(r) for r in simhash.representatives(docs).collect()) == sorted([(1, one), (1, two)])


def test_one_row_of_each_group_stays(docs):
    rows, classes = simhash.near_duplicates(docs)
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert kept.count() == rows.join(classes, "fp").select("root").distinct().count()


@pytest.mark.parametrize("crowd", [40, 3000])
def test_links_of_close_fingerprints(spark, crowd):
    own = np.random.default_rng(crowd)
    values = set()
    for base in [int(x) for x in own.integers(0, 1 << 62, 60)]:
        for _ in range(4):
            values.add(base ^ sum(1 << int(b) for b in own.choice(62, own.integers(0, 6), replace=False)))
    centre = int(own.integers(0, 1 << 62))
    for _ in range(crowd):
        values.add(centre ^ sum(1 << int(b) for b in own.choice(62, own.integers(0, 4), replace=False)))
    values = sorted(values)
    frame = spark.createDataFrame([(v,) for v in values], "fp long").repartition(3)
    links = simhash.link_fingerprints(frame, 4)
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    array = np.array(values, np.uint64)
    pairs = [(values[i], values[i + 1 + int(j)]) for i in range(len(values)) for j in np.flatnonzero(np.bitwise_count(array[i + 1:] ^ array[i]) <= 4)[:50]]
    expected = union(pairs, values) if crowd < 100 else None
    if expected:
        assert {v: roots.get(v, v) for v in values} == expected
    for r in links.limit(2000).collect():
        assert ((r["u"] ^ r["v"]) & (1 << 64) - 1).bit_count() <= 4
    near = [v for v in values if (v ^ centre).bit_count() <= 3]
    assert len({roots.get(v, v) for v in near}) == 1


# Language model

def test_kneser_ney_against_brute_force(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(kneser_ney, "SHARD_BYTES", 8_000)
    training = docs.where(F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 != 1, F.lit(True)))
    model = kneser_ney.train(training)
    assert model.n_shards > 4
    texts = [r["text"] for r in docs.collect() if r["doc_id"] is None or crc32(str(r["doc_id"]).encode()) % 5 != 1]
    count, triples = Counter(), Counter()
    for t in texts:
        own = words(t) + [None]
        count.update(own)
        padded = ["\n", "\n", *own]
        triples.update(zip(padded, padded[1:], padded[2:]))
    pairs = Counter((v, w) for _, v, w in triples)
    last = Counter(w for _, w in pairs)
    n, size = sum(count.values()), len(count)

    def contexts(counts, key):
        out = defaultdict(lambda: [0, 0, 0, 0])
        for gram, c in counts.items():
            out[key(gram)][0] += c
            out[key(gram)][min(c, 3)] += 1
        return out

    orders = [(last, contexts(last, lambda g: 0)), (pairs, contexts(pairs, lambda g: g[0])), (triples, contexts(triples, lambda g: g[:2]))]
    ds = [kneser_ney.discounts(np.array([sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)])) for counts, _ in orders]

    def chance(u, v, w):
        p = 1 / (size + 1)
        for (counts, context), d, gram, key in zip(orders, ds, (w, (v, w), (u, v, w)), (0, v, (u, v))):
            if key in context:
                f, c = context[key], counts.get(gram, 0)
                p = (max(c - (0, *d)[min(c, 3)], 0) + sum(x * y for x, y in zip(f[1:], d)) * p) / f[0]
        return p

    for r in kneser_ney.score(model, docs).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        if r["doc_id"] == 3:
            continue  # two texts under one id
        own = words(r["text"]) + [None]
        padded = ["\n", "\n", *own]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(count[w] > 0 for w in own), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (size + 1))) for w in own))
        assert r["score"] == pytest.approx(sum(math.log10(chance(*g)) for g in zip(padded, padded[1:], padded[2:])))
    nothing = kneser_ney.train(empty)
    assert kneser_ney.score(nothing, empty).count() == 0
    assert kneser_ney.score(nothing, docs).agg(F.min("score")).first()[0] == 0


# Pages

def test_differencing_without_a_marked_article(spark):
    template = "<body><div>Site</div><p>{}</p><div>All rights</div>"
    pages = spark.createDataFrame([
        (1, "http://h.x/a/1", template.format("First &amp; own<br>text")), (2, "http://h.x/a/2", template.format("Second")),
        (3, "http://other.x/", "<p>alone"), (4, None, None), (5, "http://h.x/b", ""),
        (6, "http://h.x/z", "<article><h1>T</h1><nav>menu</nav><p><b>x <p>y&lt;</article><div>Site</div>"),
        (7, "http://e.x/1", "<p>same</p>"), (8, "http://e.x/2", "<p>same</p>"),
    ], "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_text.extract(pages.withColumn("text", F.lit("clash"))).collect()}
    assert found == {1: "First & own text", 2: "Second", 3: "alone", 4: "", 5: "", 6: "T\nx\ny<", 7: "same", 8: "same"}
    assert html_text.extract(pages.limit(0)).count() == 0


def test_marked_articles_are_differenced_too(spark):
    page = "<nav>menu</nav><article><h1>{}</h1><p>{} own words of it</p><p>Tell your friends</p></article><footer>f</footer>"
    pages = spark.createDataFrame([
        (1, "http://h.x/a/1", page.format("T1", "first")), (2, "http://h.x/a/2", page.format("T2", "second")),
        (3, "http://copy.x/1", page.format("C", "copied")), (4, "http://copy.x/2", page.format("C", "copied").replace("menu", "other")),
        (5, "http://mixed.x/1", page.format("T5", "fifth")), (6, "http://mixed.x/2", "<p>open text of a page of its own</p><p>Tell your friends</p>"),
        (7, "http://mixed.x/2", "<p>open text of a page of its own</p><p>Tell your friends</p>"), (8, None, page.format("T8", "lone")),
    ], "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    own = {k: f"{t}\n{w} own words of it" for k, t, w in ((1, "T1", "first"), (2, "T2", "second"), (3, "C", "copied"), (5, "T5", "fifth"), (8, "T8", "lone"))}
    shared = "\nTell your friends"
    assert found == {
        **own, 3: own[3] + shared, 4: own[3] + shared, 6: "open text of a page of its own" + shared, 7: "open text of a page of its own" + shared, 8: own[8] + shared}


def test_whole_hosts_against_plain_differencing(spark):
    own = np.random.default_rng(5)
    hosts = {}
    for number in range(120):
        lines = [f"line {k}" * (1 + k % 3) for k in own.integers(0, 30, own.integers(0, 9))]
        body = "".join(f"<p>{line}</p>" for line in lines)
        hosts.setdefault(number % 7, []).append((f"/{own.integers(0, 4)}/{number}", number, number % 3 > 0, lines, body))
    expected = {}
    for held in hosts.values():
        held.sort()
        for path, number, marked, lines, _ in held:
            near = [p for p in held if p[3] and (marked or not p[2])]
            at = next((k for k, p in enumerate(near) if p[1] == number), None)
            near = [] if at is None else near[max(at - 1, 0):at] + near[at + 1:at + 2]
            sizes = [len(line) for line in lines]
            pairs = [(p[0], p[3]) for p in near if not marked or not html_text.is_copy(lines, sizes, p[3], sum(map(len, p[3])))]
            kept = html_text.differenced(lines, path, pairs)
            expected[number] = "\n".join(line for line, left in zip(lines, kept) if left)
    pages = spark.createDataFrame([
        (number, f"http://h{host}.x{path}", f"<article>{body}</article>" if marked else body)
        for host, held in hosts.items() for path, number, marked, _, body in held], "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    assert found == expected
    whole = {number: "\n".join(lines) for held in hosts.values() for _, number, _, lines, _ in held}
    assert {number % 3 > 0 for number in found if found[number] != whole[number]} == {True, False}


@pytest.mark.parametrize("page, expected", [
    ('<body><div class="site no-sidebar"><article><p>text</p></article></div>', "text"),
    ('<div class="layout has-sidebar"><main><p>text</p></main><div class="sidebar">side</div></div>', "text"),
    ('<div id="page-with_sidebar"><p>open</p><div class="menu">m</div></div>', "open"),
    ('<div class="sidebar-layout"><p>outside</p><article><p>text</p><div class="share">s</div></article></div>', "text"),
    ('<article><div class="entry-header"><h1>Title</h1></div><p>text</p><div class="entry-footer">f</div></article>', "Title\ntext"),
    ('<html><head><title>t</title><meta name="a"><body><p>text</p>', "text"),
    ("<html><head><title>t</title><script>x</script><p>text</p>", "text"),
    ("<head><link rel=x>\n text", "text"),
    ('<article><p>text</p></article><div class="related"><article>teaser</article></div>', "text"),
    ('<p>open</p><div id="comments"><article>reply</article></div>', "open"),
    ('<div class="widget"><article>text</article></div>', "text"),
    ('<div class="header footer">f</div><nav class="no-menu"><article>n</article></nav><p>open', "open"),
])
def test_names_do_not_hide_articles(page, expected):
    article, rest, marked = html_text.lines_of(page)
    assert "\n".join(article if marked else rest) == expected


def test_shared_lines_are_a_longest_common_subsequence():
    own = np.random.default_rng(2)
    for _ in range(300):
        a, b = (["abcd"[k] for k in own.integers(0, 4, own.integers(0, 9))] for _ in range(2))
        length = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                length[i + 1, j + 1] = length[i, j] + 1 if x == y else max(length[i, j + 1], length[i + 1, j])
        shared = [x for x, k in zip(a, html_text.shared_lines(a, b)) if k]
        rest = iter(b)
        assert all(x in rest for x in shared) and len(shared) == length[-1, -1]


# Licenses

def test_license_spans(docs, empty):
    found = licenses.scan(docs).collect()
    assert [(r["doc_id"], r["license"], TEXTS[18][r["start_char"]:r["end_char"]]) for r in found] == [
        (18, "MIT-statement", "Released under the MIT License")]
    assert licenses.scan(empty).count() == 0


def test_edited_license_is_aligned(spark):
    notice = licenses.TEMPLATES["MIT"].split()
    edited = " ".join(w for i, w in enumerate(notice) if i % 12 != 5)
    rows = licenses.scan(spark.createDataFrame([(1, f"é {edited} end"), (2, " ".join(notice[:30]))], "doc_id long, text string")).collect()
    assert [(r["doc_id"], r["license"]) for r in rows] == [(1, "MIT")]
    assert 0.85 < rows[0]["coverage"] < 1 and rows[0]["start_char"] == 2


def test_every_occurrence_of_a_license(spark):
    listed = " ".join(f"{name}.js Released under the MIT License." for name in "abcdefgh")
    close = "Licensed under CC BY-NC 4.0. " * 5
    long = (licenses.TEMPLATES["ISC"] + " ") * 3
    rows = licenses.scan(spark.createDataFrame([(1, listed), (2, close), (3, long)], "doc_id long, text string")).collect()
    spans = {k: sorted((r["start_char"], r["end_char"]) for r in rows if r["doc_id"] == k) for k in (1, 2, 3)}
    assert [listed[s:e] for s, e in spans[1]] == ["Released under the MIT License"] * 8 and len(set(spans[1])) == 8
    assert [close[s:e] for s, e in spans[2]] == ["Licensed under CC BY-NC 4.0"] * 5 and len(set(spans[2])) == 5
    assert len(set(spans[3])) == 3 and all(r["coverage"] == 1 for r in rows)


def test_neighbouring_licenses_are_told_apart(spark):
    lines = {
        "Licensed under CC BY-SA 4.0.": [], "Licensed under CC BY-NC-SA 4.0.": [], "Licensed under CC BY-NC 3.0.": [],
        "This work is licensed under the GNU General Public License, version 2.": [],
        "This work is licensed under the GNU Lesser General Public License, version 3.": [],
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": [],
        "Released under the BSD License.": [], "Licensed under the Apache License, Version 1.1.": [],
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": ["CC-BY-SA-4.0-statement"],
        "This work is licensed under the terms of the GNU General Public License, version 3.": ["GPL-3.0-statement"],
        "Released under the MIT Licence.": ["MIT-statement"],
        "Licensed under the Apache License, Version 2.": ["Apache-2.0-statement"],
        **{licenses.TEMPLATES[k]: [k] for k in licenses.TEMPLATES if k != "Apache-2.0-header" and k.endswith(("statement", "header"))},
    }
    rows = licenses.scan(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()
    assert {text: [r["license"] for r in rows if r["doc_id"] == i] for i, text in enumerate(lines)} == lines


def test_long_notices_of_neighbours_are_told_apart(spark):
    """Every template, in a text of its own, is named as itself and as nothing else, also with a few words changed."""
    rows, expected = [], {}
    for k, (name, notice) in enumerate(licenses.TEMPLATES.items()):
        for edited in (False, True):
            own = notice.split()
            if edited and len(own) > 40:
                own = [w if i % 29 or w.lower().strip(",.;") in ("lesser", "affero", "library", "2.1") or any(c.isdigit() for c in w) else "changed" for i, w in enumerate(own, 1)]
            rows.append((len(rows), f"{prose(30, k)}\n{' '.join(own)}\n{prose(20, k + 99)}"))
            expected[len(rows) - 1] = {name}
    found = defaultdict(set)
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found[r["doc_id"]].add(r["license"])
    told = {"MIT-statement", "Apache-2.0-statement"}
    assert {i: f - told if len(f) > 1 else f for i, f in found.items()} == expected


def test_licenses_without_a_template_have_no_other_name(spark):
    texts = [
        licenses.TEMPLATES["GPL-header"].replace("version 3", "version 1"), licenses.TEMPLATES["MPL-2.0-header"].replace("2.0", "3.0"),
        licenses.TEMPLATES["LGPL-2.1-header"].replace("2.1", "2"), "SPDX-License-Identifier: EUPL-1.2", "SPDX-License-Identifier: GPL-1.0-only"]
    found = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [tuple(r)[:3] for r in found] == []


def test_many_notices_in_one_text_are_found_at_once():
    import time

    import pyarrow as pa

    text = " ".join(f"file{i} Released under the MIT License." for i in range(8000))
    started = time.time()
    found = licenses.scan_texts(pa.array([text]), licenses.Index(licenses.TEMPLATES), 0.8)
    assert len(found) == 8000 and time.time() - started < 10
    own = [(int(n), 0, int(a), int(a + w)) for n, a, w in zip(rng.integers(1, 50, 300), rng.integers(0, 100, 300), rng.integers(0, 30, 300))]
    kept = []
    for m in own:
        if not any(k[2] <= m[2] and m[3] <= k[3] for k in kept):
            kept.append(m)
    assert licenses._outermost(own) == kept


def test_end_tags_that_close_nothing_cost_nothing():
    import time

    started = time.time()
    article, _, marked = html_text.lines_of("<article>" + "<div>" * 32_000 + "text" + "</b>" * 32_000 + "</article>")
    assert marked and article == ["text"] and time.time() - started < 2


# Word ids of the language model

def test_word_ids_that_would_overflow_raise():
    assert kneser_ney.checked_words(4_000_000_000) == 4_000_000_000
    with pytest.raises(OverflowError, match="32 bits"):
        kneser_ney.checked_words(1 << 32)


# Passages

def test_shared_passages(docs, empty):
    found = {(r["doc_id"], r["other_doc_id"]): r for r in passages.shared_passages(docs).collect()}
    linked = {frozenset(k) for k in found}
    for a, b in ((9, 10), (11, 13), (11, 12)):
        assert frozenset((a, b)) in linked or any({a, x} in linked and {b, x} in linked for x in range(20))
    assert not any(8 in pair for pair in linked)
    for (doc, other), r in found.items():
        a, b = words(TEXTS[doc])[r["start_word"]:r["end_word"]], words(TEXTS[other])[r["other_start_word"]:r["other_end_word"]]
        assert r["n_matched"] >= 50 and r["similarity"] >= 0.8 and passages.matched_words(np.array(a), np.array(b), 10_000) >= r["n_matched"]
    assert passages.shared_passages(empty).count() == 0


def test_runs_of_one_word_are_linked(spark):
    """Each text ends in a run of one word of another length; all of 50 words or more are linked to one of them."""
    lengths = [*range(30, 75), 400, 7000]
    rows = [(n, f"{prose(n % 7, n)} " + "same " * n + prose(n % 5, n + 1)) for n in lengths]
    found = passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert all(r["n_matched"] >= 50 for r in found)
    with_each = {o: {o} | {r["doc_id"] for r in found if r["other_doc_id"] == o} for o in {r["other_doc_id"] for r in found}}
    assert max(with_each.values(), key=len) == set().union(*with_each.values()) == {n for n in lengths if n >= 50}


def test_parts_of_a_chain_are_judged_alone(spark):
    """300 words put into the middle of a copy, and two passages with other words between them."""
    text, middle = prose(1000, 50).split(), prose(300, 51).split()
    copy = text[:500] + middle + text[500:]
    one, two = prose(80, 52).split(), prose(80, 53).split()
    texts = {1: text, 2: copy, 3: [*one, *prose(60, 54).split(), *two], 4: [*one, *prose(60, 55).split(), *two]}
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in texts.items()], "doc_id long, text string")
    found = defaultdict(list)
    for r in passages.shared_passages(docs).collect():
        found[frozenset((r["doc_id"], r["other_doc_id"]))].append((r["n_matched"], r["similarity"]))
    assert set(found) == {frozenset((1, 2)), frozenset((3, 4))}
    assert all(len(rows) == 2 and all(s >= 0.8 for _, s in rows) for rows in found.values())
    assert sum(n for n, _ in found[frozenset((1, 2))]) >= 990 and sum(n for n, _ in found[frozenset((3, 4))]) >= 155


@pytest.mark.parametrize("every, least", [(10, 40), (8, 40), (6, 38)])
def test_passages_with_changed_words(spark, every, least):
    """40 passages of 66 words, one word in ``every`` changed: similarity 0.83 to 0.9."""
    rows = []
    for k in range(40):
        passage = np.random.default_rng(5000 + k).integers(0, 1 << 40, 66).astype(str).tolist()
        edited = [f"new{k}" if i % every == every - 1 else w for i, w in enumerate(passage)]
        rows += [(2 * k, f"{prose(20, k)} {' '.join(passage)} {prose(20, k + 100)}"), (2 * k + 1, f"{prose(15, k + 200)} {' '.join(edited)} {prose(9, k + 300)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    found = {frozenset((r["doc_id"], r["other_doc_id"])) for r in passages.shared_passages(docs).collect()}
    assert len(found & {frozenset((2 * k, 2 * k + 1)) for k in range(40)}) >= least


@pytest.mark.parametrize("others, piece, size, every, least", [
    (8, 12, 60, 0, 40), (20, 12, 60, 0, 40), (8, 20, 60, 0, 40), (20, 20, 60, 0, 38), (20, 12, 66, 8, 37)])
def test_passages_made_of_phrases_that_others_use(spark, others, piece, size, every, least):
    """40 passages that two texts share, parts of which stand in many other texts."""
    own = np.random.default_rng(9)
    rows, pairs = [], set()
    for k in range(40):
        passage = own.integers(0, 1 << 40, size).astype(str).tolist()
        edited = [f"new{k}" if every and i % every == every - 1 else w for i, w in enumerate(passage)]
        n = len(rows)
        rows += [(n, f"{prose(20, n)} {' '.join(passage)} {prose(20, n + 1)}"), (n + 1, f"{prose(15, n + 2)} {' '.join(edited)} {prose(9, n + 3)}")]
        pairs.add(frozenset((n, n + 1)))
        for _ in range(others):
            at = int(own.integers(0, size - piece + 1))
            rows.append((len(rows), f"{prose(12, len(rows) + 9)} {' '.join(passage[at:at + piece])} {prose(12, len(rows) + 10_009)}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {frozenset((r["doc_id"], r["other_doc_id"])) for r in passages.shared_passages(docs).collect()}
    assert found <= pairs and len(found) >= least


def test_copies_are_named_once(spark):
    """Equal texts: a row each with the first; what they share with others stands under the first."""
    long, short = prose(80, 71), prose(20, 72)
    rows = [(4, long), (9, long), (2, long), (None, long), (2, long), (7, f"{prose(9, 73)} {long}"), (5, short), (6, short)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = passages.shared_passages(docs).collect()
    copies = [r for r in found if 7 not in (r["doc_id"], r["other_doc_id"])]
    assert sorted((str(r["doc_id"]), r["other_doc_id"], r["start_word"], r["end_word"], r["n_matched"]) for r in copies) == [
        ("4", 2, 0, 80, 80), ("9", 2, 0, 80, 80), ("None", 2, 0, 80, 80)]
    assert [{r["doc_id"], r["other_doc_id"]} for r in found if r not in copies] == [{2, 7}]


def brute_pairs(texts, n):
    """Pairs of texts that share a run of ``n`` words."""
    runs = defaultdict(set)
    for i, text in enumerate(texts):
        own = words(text)
        for at in range(len(own) - n + 1):
            runs[tuple(own[at:at + n])].add(i)
    return {frozenset((a, b)) for held in runs.values() for a in held for b in held if a < b}


def test_recall_on_the_test_tables(spark):
    """Texts linked by exact runs of 50 words lie in one class of the reported links, at least 99 in 100 of the pairs."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    parent = {r["doc_id"]: r["doc_id"] for r in rows}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for r in passages.shared_passages(docs.repartition(4)).collect():
        parent[root(r["doc_id"])] = root(r["other_doc_id"])
    pairs = [[rows[i]["doc_id"] for i in pair] for pair in brute_pairs([r["text"] for r in rows], 50)]
    joined = sum(root(a) == root(b) for a, b in pairs)
    assert len(pairs) > 100 and joined >= 0.99 * len(pairs)


def test_every_two_texts_with_a_passage_are_linked(spark, monkeypatch):
    """Seven texts hold the same 60 words, five more hold them changed: each two are a row, in one block or in many."""
    passage = np.random.default_rng(31).integers(0, 1 << 40, 60).astype(str).tolist()
    rows = []
    for k in range(12):
        own = passage if k < 7 else [f"new{k}" if i == 9 * (k - 6) else w for i, w in enumerate(passage)]
        rows.append((k, f"{prose(20, k + 500)} {' '.join(own)} {prose(12, k + 600)}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted(tuple(r) for r in passages.shared_passages(docs).collect())
    assert {frozenset(r[c] for c in (0, 3)) for r in found} == {frozenset((a, b)) for b in range(12) for a in range(b)}
    monkeypatch.setattr(passages, "BLOCK_WORDS", 300)
    assert sorted(tuple(r) for r in passages.shared_passages(docs).collect()) == found


def test_passages_with_a_single_seed(spark):
    """65 words of which 53 are equal, and never five in a row but once; others have no six equal words in a row."""
    rows, pairs = [], set()
    for k in range(40):
        passage = np.random.default_rng(7000 + k).integers(0, 1 << 40, 65 if k % 2 else 72).astype(str).tolist()
        changed = [i for i in range(len(passage)) if (i % 5 == 4 if i < 32 else i % 5 == 0)] if k % 2 else range(5, 72, 6)
        edited = [f"new{k}" if i in changed else w for i, w in enumerate(passage)]
        runs = [len(run) for run in "".join("x" if i in changed else "." for i in range(len(passage))).split("x")]
        assert max(runs) == 5 and (k % 2 == 0 or runs.count(5) == 1)
        rows += [(2 * k, f"{prose(20, k)} {' '.join(passage)} {prose(20, k + 100)}"), (2 * k + 1, f"{prose(15, k + 200)} {' '.join(edited)} {prose(9, k + 300)}")]
        pairs.add(frozenset((2 * k, 2 * k + 1)))
    found = passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {frozenset((r["doc_id"], r["other_doc_id"])) for r in found} == pairs


def test_every_place_of_a_passage_is_linked(spark):
    """A passage that stands three times in one text and once in the other, whichever of the two is the first."""
    rows, expected = [], set()
    for k in range(10):
        passage = " ".join(np.random.default_rng(8000 + k).integers(0, 1 << 40, 60).astype(str))
        rows += [(2 * k, " ".join(f"{prose(70, 10 * k + n)} {passage}" for n in range(3))), (2 * k + 1, f"{prose(30, k + 9000)} {passage}")]
        expected |= {(2 * k, at, at + 60, 2 * k + 1, 30, 90) for at in (70, 200, 330)}
    found = passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    sides = [tuple(r)[:6] if r["doc_id"] % 2 == 0 else tuple(r)[3:6] + tuple(r)[:3] for r in found]
    assert {(a, s, e, b, p, q) for a, s, e, b, p, q in sides if (s, p) != (s // 130 * 130 + 70, 30)} == set()
    assert set(sides) == expected and len(sides) == len(expected)


def test_widest_passages_stand_for_those_in_them():
    whole, shifted, other = (1, 2, 0, 100, 10, 110, 100, 1.0), (1, 2, 20, 80, 40, 100, 60, 1.0), (1, 2, 90, 150, 100, 160, 60, 1.0)
    assert passages._widest({whole, (1, 2, 5, 70, 15, 80, 65, 1.0), shifted, other}) == [whole, shifted, other]


def test_passages_take_rows_by_bytes(spark, monkeypatch):
    """However many rows a table has, Python holds some bytes of them at once, and the session's setting comes back."""
    limit = 40_000

    def bounded(make):
        def made(*args):
            def run(batches):
                for batch in batches:
                    assert batch.num_rows <= 1 or batch.nbytes <= 2 * limit, f"{batch.num_rows} rows, {batch.nbytes} bytes"
                    yield from make(*args)(iter([batch]))

            return run

        return made

    docs = spark.createDataFrame([(k, f"{prose(400, k)} {prose(80, 7)}") for k in range(60)], "doc_id long, text string").coalesce(1)
    found = sorted(tuple(r) for r in passages.shared_passages(docs).collect())
    assert len(found) >= 60 * 59 // 2
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting, None)
    monkeypatch.setattr(passages, "_postings", bounded(passages._postings))
    monkeypatch.setattr(passages, "_block_passages", bounded(passages._block_passages))
    monkeypatch.setattr(passages, "BLOCK_WORDS", 5_000)
    monkeypatch.setattr(passages, "BATCH_BYTES", limit, raising=False)
    assert sorted(tuple(r) for r in passages.shared_passages(docs).collect()) == found
    assert spark.conf.get(setting, None) == before


def test_matches_do_not_depend_on_batches(monkeypatch):
    """Every earlier text of a seed, whatever the cuts between batches; equal postings of copies count once."""
    import pyarrow as pa

    own = np.random.default_rng(6)
    rows = sorted((int(a), int(b), int(c)) for a, b, c in zip(own.integers(0, 200, 600), own.integers(0, 6, 600), own.integers(0, 4, 600)))
    expected, kept = set(), []
    for seed in sorted({r[0] for r in rows}):
        held = sorted({r[1:] for r in rows if r[0] == seed})
        keys = sorted({k for k, _ in held})
        at = {k: min(p for q, p in held if q == k) for k in keys}
        if len(keys) > 1:
            kept += [(seed, k, place, keys.index(k)) for k, place in held]
        expected |= {(seed, m, k, at[m], place) for k, place in held for m in keys if m < k}
    for size in (1, 2, 7, 600):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64()), pa.array([r[2] for r in part], pa.int32())], names=["seed", "key", "place"])
                   for part in (rows[i:i + size] for i in range(0, len(rows), size))]
        assert [tuple(r.values()) for batch in passages._shared(batches) for r in batch.to_pylist()] == kept
    pairs = defaultdict(list)
    for _, a, b, x, y in sorted(expected):
        pairs[a, b].append((y, x))
    seeds, owners, places, _ = (np.array(c) for c in zip(*kept))
    for at_once in (1, 50, 10_000):
        monkeypatch.setattr(passages, "AT_ONCE", at_once)
        for sides in (None, np.arange(6) % 2):
            got = defaultdict(list)
            for part in passages._matched(seeds, owners, places, sides):
                for a, b, x, y in zip(*(c.tolist() for c in part)):
                    got[a, b].append((y, x))
            assert got == {p: sorted(m) for p, m in pairs.items() if len(m) > 1 and (sides is None or sides[p[0]] != sides[p[1]])}


def test_extended_many_is_extended():
    own = np.random.default_rng(12)
    words = own.integers(0, 3, 4000).astype(np.uint64)
    words[2000:3000] = words[:1000]
    words[own.integers(2000, 3000, 60)] = 7
    x, y = own.integers(100, 900, 300), own.integers(2100, 2900, 300)
    y[:200] = x[:200] + 2000
    rooms = own.integers(0, 100, (2, 300))
    for way in (1, -1):
        got = passages._extended_many(words, x, rooms[0], y, rooms[1], way, 0.8)
        for k in range(300):
            a, b = (words[at[k]::way][:room[k]] for at, room in ((x, rooms[0]), (y, rooms[1])))
            assert got[k] == passages._extended(a, b, 0.8)[2]


def test_chained_are_chains():
    """Matches of many pairs at once: the same chains of two matches or more as pair by pair."""
    own = np.random.default_rng(14)
    rows, expected = [], []
    for a in range(300):
        places = sorted({(int(y), int(x)) for x, y in zip(own.integers(0, 80, 5), own.integers(0, 80, 5))})
        if a % 2:
            places = list(zip(sorted(y for y, _ in places), sorted(x for _, x in places)))
        rows += [(a, a + 1, x, y) for y, x in places]
        xs, ys = [x for _, x in places], [y for y, _ in places]
        expected += [(a, a + 1, xs[c[0]], xs[c[-1]] + passages.K, ys[c[0]], ys[c[-1]] + passages.K) for c in passages.chains(xs, ys) if len(c) > 1]
    got = passages._chained(*(np.array(c) for c in zip(*rows)))
    assert sorted(map(tuple, got.tolist())) == sorted(expected)


def test_matched_words_are_a_longest_common_subsequence():
    own = np.random.default_rng(8)
    for _ in range(300):
        x, y = own.integers(0, 6, own.integers(0, 25)), own.integers(0, 6, own.integers(0, 25))
        table = np.zeros((len(x) + 1, len(y) + 1), int)
        for i, a in enumerate(x):
            for j, b in enumerate(y):
                table[i + 1, j + 1] = table[i, j] + 1 if a == b else max(table[i, j + 1], table[i + 1, j])
        length = int(table[-1, -1])
        needed = len(x) + len(y) - 2 * length
        assert passages.matched_words(x, y, needed) == length
        assert needed == 0 or passages.matched_words(x, y, needed - 1) == -1


def test_chains_are_best():
    own = np.random.default_rng(4)
    for _ in range(200):
        places = sorted({tuple(own.integers(0, 25, 2).tolist()) for _ in range(own.integers(1, 12))}, key=lambda t: (t[1], t[0]))
        a, b = [x for x, _ in places], [y for _, y in places]
        best = []
        for i in range(len(a)):
            best.append(passages.WEIGHT + max([0] + [best[j] - passages.GAP * (a[i] - a[j] + b[i] - b[j]) for j in range(i) if a[j] < a[i] and b[j] < b[i]]))
        chain = passages.chains(a, b)[0]
        score = passages.WEIGHT * len(chain) - passages.GAP * sum(a[q] - a[p] + b[q] - b[p] for p, q in zip(chain, chain[1:]))
        assert score == pytest.approx(max(best))


# Decontamination

def test_contamination_against_brute_force(spark, docs, empty):
    items = spark.createDataFrame([
        (1, " ".join(PASSAGE.split()[10:40])), (2, "AA bb-cc"), (3, None), (3, "..."), (4, prose(20, 77)), (None, "no id"), (5, LONG[:3000]), (5, LONG[:3000]),
    ], "item_id long, text string")
    token = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    phrases = defaultdict(set)
    for item, text in [(r["item_id"], r["text"]) for r in items.collect()]:
        own = token.findall((text or "").translate(LOWER))
        for i in range(max(1, len(own) - 12) if own else 0):
            phrases[tuple(own[i:i + 13])].add(item)
    texts = {(r["doc_id"], r["k"]): r["text"] for r in decontaminate.keyed(docs, "doc_id", "text").select("doc_id", F.col("key").alias("k"), "text").collect()}
    rows = decontaminate.contamination(docs, items).collect()
    assert len(rows) == docs.count()
    for r in rows:
        own, hit, ids = token.findall((texts[r["doc_id"], r["key"]] or "").translate(LOWER)), set(), set()
        for phrase, names in phrases.items():
            for i in range(len(own) - len(phrase) + 1):
                if tuple(own[i:i + len(phrase)]) == phrase:
                    hit.update(range(i, i + len(phrase)))
                    ids |= names
        assert (r["n_words"], r["n_hit"], r["item_ids"]) == (len(own), len(hit), sorted(str(i) for i in ids if i is not None))
        assert r["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(own))
    assert decontaminate.contamination(empty, items).count() == 0
    assert decontaminate.contamination(docs, items.limit(0)).where("n_hit > 0").count() == 0


def test_items_of_the_same_words_are_looked_up_once(spark, monkeypatch):
    """Thirty items of the same words, written in three ways, and another under one of their ids."""
    looked_up, exact = [], decontaminate.exact_matches
    monkeypatch.setattr(decontaminate, "exact_matches", lambda docs, items, window: looked_up.append(items.count()) or exact(docs, items, window))
    one, two = prose(20, 501), prose(20, 502)
    items = spark.createDataFrame(
        [(k, (one, "".join(c.upper() if c.isascii() else c for c in one), one.replace(" ", ", "))[k % 3]) for k in range(30)] + [(7, two), (None, one)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"{prose(9, 503)} {one}"), (2, f"{two} {prose(9, 504)}"), (3, prose(40, 505))], "doc_id long, text string")
    found = {r["doc_id"]: (r["n_hit"], r["item_ids"]) for r in decontaminate.contamination(docs, items).collect()}
    assert found == {1: (20, sorted(map(str, range(30)))), 2: (20, ["7"]), 3: (0, [])}
    assert looked_up == [2]


def test_very_long_item(spark):
    """Windows of a long item carry their own words only; a text that holds its middle is hit there."""
    item = prose(6000, 77)
    middle = " ".join(item.split()[3000:3040])
    docs = spark.createDataFrame([(1, f"{prose(50, 78)} {middle} {prose(50, 79)}"), (2, prose(60, 80))], "doc_id long, text string")
    found = {r["doc_id"]: r for r in decontaminate.contamination(docs, spark.createDataFrame([("a", item)], "item_id string, text string")).collect()}
    assert found[1]["n_hit"] >= 40 and found[1]["contaminated"] and found[2]["n_items"] == 0


def test_proximity(spark):
    texts = spark.createDataFrame([(1, "x rare y strange z odd"), (2, "rare " + "w " * 30 + "strange odd")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "odd strange rare")], "item_id long, text string")
    found = decontaminate.near_matches(decontaminate.keyed(texts, "doc_id", "text"), items, within=6)
    assert [(r["item_id"], r["first"], r["last"]) for r in found.collect()] == [(7, 1, 5)]


# Quality

def test_measures_against_brute_force(docs, empty):
    for r in quality.measure(docs).collect():
        own, text = WORD.findall(r["text"] or ""), r["text"] or ""
        windows = Counter(tuple(own[i:i + 5]) for i in range(len(own) - 4))
        covered = {i + k for i in range(len(own) - 4) if windows[tuple(own[i:i + 5])] > 1 for k in range(5)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
    voted = quality.vote(quality.measure(empty))
    assert quality.judge(voted, quality.fit(voted)).count() == 0


def test_posterior_separates_planted_junk(spark):
    good = [(i, prose(60, 100 + i)) for i in range(80)]
    junk = [(100 + i, " ".join(w + "***" for w in prose(60, 300 + i).split())) for i in range(15)]
    voted = quality.vote(quality.measure(spark.createDataFrame(good + junk, "doc_id long, text string")))
    model = quality.fit(voted)
    kept = {r["doc_id"] for r in quality.judge(voted, model).where("kept").collect()}
    assert kept == {i for i, _ in good}
    assert all(quality.LEAST_RIGHT <= a <= quality.MOST_RIGHT for a in model.accuracy.values())


# Pseudonyms

PRIVATE = {
    "email": "jane.doe+7@mail.example.com", "card": "4111 1111 1111 1111", "ip": "192.168.4.77", "phone": "+1 (415) 555-0137",
    "ssn": "123-45-6789", "iban": "GB82 WEST 1234 5698 7654 32", "date": "2019-02-28", "secret": "9f86d081884c7d659a2feaa0c55ad015",
}


def test_pseudonyms_keep_format_and_link(spark, empty):
    line = " ; ".join(f"token = {v}" if k == "secret" else v for k, v in PRIVATE.items())
    rows = [(1, line), (2, line + " again"), (3, None), (4, ""), (5, "4111 1111 1111 1112, 300.1.2.3, 2019-02-30, 000-12-3456, plain 12345")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r for r in pii.pseudonymise(docs, "secret").collect()}
    assert sorted(out[1]["pii_kinds"]) == sorted(PRIVATE)
    assert out[2]["text"] == out[1]["text"] + " again"
    assert out[3]["text"] is None and out[4]["text"] == "" and out[5]["text"] == rows[4][1]
    assert not any(v in out[1]["text"] for v in PRIVATE.values())
    shape = lambda t: re.sub(r"\d", "9", re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", t)))
    before, after = line.split(" ; "), out[1]["text"].split(" ; ")
    for kind, a, b in zip(PRIVATE, before, after):
        if kind not in ("ip", "secret"):
            assert shape(a) == shape(b)
    again = pii.pseudonymise(spark.createDataFrame([(1, out[1]["text"])], "doc_id long, text string"), "secret", invert=True)
    assert again.first()["text"] == line
    assert pii.pseudonymise(docs, "other").where("doc_id = 1").first()["text"] != out[1]["text"]
    assert pii.pseudonymise(empty, "secret").count() == 0


def test_cards_and_ibans_beside_other_groups(spark):
    card, iban, address = PRIVATE["card"], "AT61 1904 3002 3457 3201", "anna@example.com"
    around = ["{} 123", "{} 12/25", "12 {}", "123456 {}", "2019-02-30 {} 12a", "{0} {0}", "AB12 CDEF GHIJ {}", "{} VISA", "{} 192.168.4.77 x"]
    rows = [(c, card, w) for c, w in enumerate(around)]
    rows += [(20 + c, iban, w) for c, w in enumerate(["{} BIC BKAUATWW", "{} EUR 12", "REF {}", "XX99 ABCD EFGH {}", "{0} {0}", "IBAN {} Bank"])]
    rows += [(40 + c, address, w) for c, w in enumerate(["_{}_", "-{}", "..{}", "a _{}_ b"])]
    rows += [(60, "1234567890123456", "token={}"), (61, "4111 11111111 1111", "{} 77")]
    docs = spark.createDataFrame([(i, w.format(v)) for i, v, w in rows] + [(-1, card), (-2, iban), (-3, address)], "doc_id long, text string")
    changed = pii.pseudonymise(docs, "secret")
    out = {r["doc_id"]: r["text"] for r in changed.collect()}
    new = {card: out[-1], iban: out[-2], address: out[-3]}
    for i, value, w in rows:
        assert value not in out[i], (i, out[i])
        if value in new and "192" not in w:
            assert out[i] == w.format(new[value])
    assert "192.168.4.77" not in out[8]
    back = pii.pseudonymise(changed.drop("pii_kinds"), "secret", invert=True)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {r["doc_id"]: r["text"] for r in docs.collect()}


def test_permutations_have_no_collisions(spark):
    numbers = spark.range(1000).select(F.lpad("id", 3, "0").alias("d"))
    assert numbers.select(pii.feistel_digits(F.col("d"), "k", "t").alias("p")).distinct().count() == 1000


LONG_SHAPES = {
    "labels": "write a@b" + ".c" * 500_000,
    "local part": "a.b-" * 10_000 + "@example.com",
    "leading marks": "._%+-" * 200_000 + "a@example.com",
    "digit groups": "4111 " * 600,
    "one number": "1" * 1_000_000,
    "iban groups": "AB12 " * 600,
    "secret": "token: " + "ab12" * 10_000,
    "octets": "1.2.3.4." * 60_000,
    "phones": "+1 " * 600 + "(020) " * 3_000,
    "dates": "2019-02-28 " * 3_000,
}


def test_no_text_ends_the_jvm(spark):
    """Long texts of every shape a pattern repeats over; columns named like inner ones pass through."""
    rows = [(i, t, "own", "kept") for i, t in enumerate(LONG_SHAPES.values())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _pii_found string, _words string").repartition(4)
    out = pii.pseudonymise(docs, "secret").select("doc_id", F.length("text").alias("n"), "_pii_found").collect()
    assert sorted((r["doc_id"], r["n"], r["_pii_found"]) for r in out) == [(i, len(t), "own") for i, t, *_ in rows]
    longer = spark.createDataFrame([(part * 200_000,) for part in ("4111 ", "AB12 ", "4111-", "+1 ", "A ")], "text string")
    assert longer.where(F.size(F.regexp_extract_all("text", F.lit(pii.ANY), F.lit(0))) >= 0).count() == 5
    assert {r["_words"] for r in quality.measure(docs).select("n_words", "_words").collect()} == {"kept"}
