import collections
import hashlib
import itertools
import json
import math
import random
import re
import struct
import time

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from cases import LONG, TEXTS, documents, nothing, pairs
from pyspark.sql import functions as F

from gridsieve.llm import boilerplate, chat, decontam, licenses, queries, resample, surrogates

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


# Licence scan ------------------------------------------------------------------------------


def plain_base(text):
    words = words_of(text)
    places = [
        (i, label)
        for phrase, label in licenses.BASE_PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_licence_places_match_plain_search(spark):
    rows = TEXTS + [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(500, "cc by cc by-sa cc"), (501, "GNU Lesser General Public License; general public\nlicense"), (502, "cc-by " * 2000)]
    found = licenses.scan(documents(spark, rows))
    key = lambda r: tuple((v is not None, v) for v in r)
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert pairs(found, *columns) == sorted(((i, *plain_base(t)) for i, t in rows), key=key)
    for r in found.collect():
        assert 0 <= r["score"] <= 1
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert r["labels"] == ",".join(sorted(set(r["labels"].split(","))))
    assert licenses.scan(nothing(spark)).count() == 0


@pytest.mark.parametrize(
    "expression, freedom, names",
    [
        ("MIT", 1.0, ("mit",)),
        ("GPL-3.0-only AND MIT", 0.3, ("gpl-3.0-only", "mit")),
        ("GPL-3.0-only OR MIT", 1.0, ("gpl-3.0-only", "mit")),
        ("MIT OR GPL-2.0 AND LGPL-2.1", 1.0, ("mit", "gpl-2.0", "lgpl-2.1")),
        ("(MIT OR GPL-2.0) AND LGPL-2.1", 0.5, ("mit", "gpl-2.0", "lgpl-2.1")),
        ("GPL-2.0 WITH Classpath-exception-2.0", 0.65, ("gpl-2.0",)),
        ("((MIT)", 1.0, ("mit",)),
        ("Nonsense OR", None, ()),
        ("MIT and more words", 1.0, ("mit",)),
        ("MIT.", 1.0, ("mit",)),
        ("MIT - this text mitigates nothing; not GPL-3.0 and not proprietary", 1.0, ("mit",)),
        ("mitigated risks", None, ()),
        ("iscsi driver", None, ()),
        ("GPL-2.0-or-later WITH mitten", 0.65, ("gpl-2.0-or-later",)),
        ("MIT WITH GPL-3.0", 1.0, ("mit",)),
        ("'Apache-2.0' or \"GPL-2.0+\", proprietary", 1.0, ("apache-2.0", "gpl-2.0+")),
        ("BSD-3-Clause AND CC-BY-NC-SA-4.0.", 0.2, ("bsd-3-clause", "cc-by-nc-sa-4.0")),
        ("GPL-next OR gpl", None, ()),
        ("Unknown-1.0 AND MIT; GPL-2.0", 1.0, ("mit",)),
        ("", None, ()),
    ],
)
def test_licence_expressions(expression, freedom, names):
    found = licenses.evaluate(expression)
    assert found.names == names
    assert found.freedom == pytest.approx(freedom) if freedom is not None else found.freedom is None


def test_licence_labels_and_score():
    tagged = licenses.scan_text("// SPDX-License-Identifier: (MPL-2.0 OR Apache-2.0) AND ISC\ncode")
    assert tagged["labels"] == "apache-2.0,isc,mpl-2.0" and tagged["score"] == 1.0
    assert licenses.scan_text("under the GNU Lesser General Public License")["score"] == 0.5
    assert licenses.scan_text("All Rights Reserved")["score"] == 0.0
    assert licenses.scan_text("nothing here")["score"] == licenses.UNSTATED


@pytest.mark.parametrize("text, labels, expressions", [
    ("SPDX License Identifier: GPL-3.0-only\nMIT", "gpl-3.0-only", ["GPL-3.0-only"]),
    ("é \ud800 SPDX_License_Identifier = MIT é\r\nGPL-2.0", "mit", ["MIT é"]),
    ("licence: expression (MIT OR ISC)", "isc,mit", ["(MIT OR ISC)"]),
    ("License-Expression: MIT; license expression: GPL-3.0-only", "gpl-3.0-only,mit", ["MIT;", "GPL-3.0-only"]),
    ("SPDX-License-Identifier:", "", []),
])
def test_licence_tags_in_all_spellings(text, labels, expressions):
    found = licenses.scan_text(text)
    assert (found["labels"], found["expressions"]) == (labels, expressions)


def test_licence_scan_of_very_many_places_is_linear():
    started = time.monotonic()
    found = licenses.scan_text("é SPDX-License-Identifier: MIT cc by\n" * 40_000)
    assert (found["n_base"], found["first_word"], found["last_word"], found["labels"]) == (40_000, 5, 7 * 40_000 - 2, "cc-by,mit")
    assert time.monotonic() - started < 20


# Decontamination -----------------------------------------------------------------------------


def test_seeded_hits_match_brute_force(spark):
    rng = np.random.default_rng(11)
    vocabulary = [f"w{k}" for k in range(4000)]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(k, text(n)) for k, n in enumerate([20, 37, 59, 15, 8, 5, 4, 0, 12, 400])] + [(50, None)]
    docs = []
    for k, (item, passage) in enumerate(items):
        words = (passage or "").split()
        for changed in (0, 1, 3):
            copy = list(words)
            for place in range(2, len(copy), max(1, len(copy) // (changed + 1)))if changed else ():
                copy[place] = "changed"
            docs.append((100 * k + changed, f"{text(30)} {' '.join(copy).upper()}! {text(300)}"))
        docs.append((100 * k + 50, " ".join(words[:9]) + " " + text(40)))
        docs.append((100 * k + 51, " ".join(words[3:])))
    docs += [(10_000 + k, text(200)) for k in range(100)] + TEXTS
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, h int")
    found = decontam.contaminated(documents(spark, docs), benchmark)

    seeds = collections.defaultdict(list)
    expected = set()
    masks = decontam.masks_for([len(words_of(t)) for _, t in items])
    for doc_id, doc in docs:
        words = [w.encode() for w in words_of(doc)]
        for item_id, passage in items:
            item = [w.encode() for w in words_of(passage)]
            hit = set()
            for number, mask in enumerate(masks):
                span = decontam.SPAN if number < len(decontam.MASKS) else len(mask)
                if (len(item) < span) if number < len(decontam.MASKS) else len(item) != span:
                    continue
                table = collections.defaultdict(list)
                for p in range(len(item) - span + 1):
                    table[tuple(item[p + m] for m in mask)].append(p)
                for d in range(len(words) - span + 1):
                    hit |= {d - p for p in table.get(tuple(words[d + m] for m in mask), ())}
            for shift in hit:
                if decontam.best_overlap(item, words, shift):
                    expected.add((doc_id, item_id))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == expected
    assert {(100 * k + c, k) for k in (0, 1, 2, 9) for c in (0, 1)} <= expected
    assert not any(10_000 <= d for d, _ in expected if d)
    assert seeds == {}


def test_decontamination_of_nothing(spark):
    benchmark = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p")], "item_id long, text string")
    assert decontam.contaminated(nothing(spark), benchmark).count() == 0
    assert decontam.contaminated(documents(spark), benchmark.where("item_id < 0")).count() == 0


def test_overlaps_tolerate_substitutions():
    item = [str(k).encode() for k in range(30)]
    other = list(item)
    other[10] = other[20] = b"x"
    assert decontam.best_overlap(item, [b"y", *other], 1) == (0, 30, 28)
    assert decontam.best_overlap(item, item[:12], 0) is None
    assert decontam.best_overlap(item[:10], item[:8] + [b"x", b"x"], 0) == (0, 8, 8)


def widest(same, need):
    """Most equal words of any run with four fifths equal, then the shortest, then the first; by trying all."""
    runs = [
        (sum(same[a:b]), a - b, -a)
        for a in range(len(same)) for b in range(a + 1, len(same) + 1) if 5 * sum(same[a:b]) >= 4 * (b - a)
    ]
    equal, length, begin = max(runs, default=(0, 0, 0))
    return (-begin, -length, equal) if equal >= need else None


def test_every_substitution_the_rule_allows_is_verified():
    for n in range(5, 21):
        item = [str(k).encode() for k in range(n)]
        need = min(13, -(-4 * n // 5))
        for changed in (1, 2, 3):
            for places in itertools.combinations(range(n), changed):
                other = [b"x" if k in places else w for k, w in enumerate(item)]
                found = decontam.best_overlap(item, [b"y", *other], 1)
                if n < 17:
                    assert (found is not None) == (n - changed >= need), (n, places)
                if n in (9, 12, 15) or n > 16 and changed < 3:
                    assert found == widest([k not in places for k in range(n)], need), (n, places)
    rng = np.random.default_rng(3)
    for _ in range(400):
        same = rng.random(int(rng.integers(5, 60))) < 0.8
        item = [str(k).encode() for k in range(len(same))]
        other = [w if s else b"x" for w, s in zip(item, same)]
        assert decontam.best_overlap(item, other, 0) == widest(same.tolist(), min(13, -(-4 * len(same) // 5)))


def seedless(n, changed, shapes, live=None):
    """Patterns of substitutions in n words, as bits, of which no window under any shape is free."""
    bits = np.array([sum(1 << k for k in c) for c in itertools.combinations(range(n), changed)], np.int64)
    for width, most in live or ():  # leave out what holds a shorter run within the rule
        for k in range(n - width + 1):
            bits = bits[np.bitwise_count((bits >> k) & ((1 << width) - 1)) > most]
    for shape in shapes:
        for k in range(n - shape[-1]):
            bits = bits[(bits & sum(1 << (k + p) for p in shape)) != 0]
    return len(bits)


def test_every_accepted_substitution_shares_a_seed():
    for n in range(5, 17):
        shapes = [s for s, lengths in decontam.shapes_for([n]).items() if min(n, decontam.SPAN) in lengths]
        assert seedless(n, n - min(13, -(-4 * n // 5)), shapes) == 0, n
    # Longer items: runs of up to 16 words with 13 equal are those above.  A run of 32 or more words within the rule holds
    # a shorter one, because two parts of 16 or more that break it have more substitutions than the whole may have.
    shapes = list(decontam.shapes_for([]))
    for n in range(17, 32):
        for changed in range(4, n // 5 + 1):
            assert seedless(n, changed, shapes, [(w, w // 5) for w in range(16, n)]) == 0, (n, changed)


def test_substituted_and_cut_items_are_found(spark):
    items = {n: [f"i{n}w{k}" for k in range(n)] for n in (5, 6, 7, 8, 9, 10, 11, 12, 15, 16, 18)}
    docs, expected = [], set()
    for n, item in items.items():
        spare = n // 5
        for places in ({0}, {n - 1}, {n // 2}, {*range(0, n, -(-n // spare))}, {*range(2, n, -(-n // spare))}):
            if len(places) <= spare:
                docs.append((len(docs), " ".join(["a b", *("x" if k in places else w for k, w in enumerate(item)), "c d"])))
                expected.add((len(docs) - 1, n))
        docs += [(len(docs), " ".join(item[spare:])), (len(docs) + 1, " ".join(item[: n - spare]))]
        expected |= {(len(docs) - 2, n), (len(docs) - 1, n)}
    benchmark = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    found = decontam.contaminated(documents(spark, docs), benchmark)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == expected


# Quality ---------------------------------------------------------------------------------------


def test_kth_largest_is_exact(spark, monkeypatch):
    monkeypatch.setattr(resample, "_COLLECTED", 5)
    rng = np.random.default_rng(0)
    values = np.r_[rng.normal(size=900), np.full(300, 0.25), -1e9, 1e12]
    frame = spark.createDataFrame(pa.table({"v": values}))
    for k in (1, 2, 150, 400, 700, 1201, 1202):
        assert resample.kth_largest(frame, "v", k) == np.sort(values)[-k]
    assert resample.kth_largest(frame, "v", 1203) == float("-inf")
    assert resample.kth_largest(frame.where("v is null"), "v", 3) == float("-inf")


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    found = resample.resample(docs, labels)
    assert found.count() == docs.count()
    sample = resample.sample_labels(labels)
    kept = {r["doc_id"]: r["kept"] for r in found.collect()}
    good, bad = ([kept[i] for i in sample[k].tolist()] for k in ("good", "bad"))
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1
    assert resample.drawn(docs, labels).count() == sum(kept.values())


def test_model_counts_match_plain_counts(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + TEXTS
    target = np.array(sorted({1, 4, 5, 10, 33}), np.int64)
    model = resample.fit(documents(spark, rows), target)
    counts = np.zeros((2, resample.BUCKETS))
    for doc_id, text in rows:
        bucket, _ = resample.features(pa.array([text]))
        own = np.bincount(bucket, minlength=resample.BUCKETS)
        n = len(re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|[!-/:-@\[-`{-~]+", text or ""))
        assert len(bucket) == max(0, 2 * n - 1)
        counts[0] += own
        counts[1] += own if doc_id in target.tolist() else 0
    p = (counts + resample.SMOOTHING) / (counts.sum(1, keepdims=True) + resample.SMOOTHING * resample.BUCKETS)
    assert np.allclose(model.log_ratio, np.log(p[1] / p[0]))


def test_quality_of_awkward_tables(spark):
    labels = spark.createDataFrame(
        [(4, 1, 0), (5, 1, None), (6, 0, 0), (6, 1, 0), (None, 1, 0), (7, None, None), (8, 0, 1)], "doc_id long, quality int, toxic int"
    )
    assert resample.resample(documents(spark), labels).count() == len(TEXTS)
    assert resample.resample(documents(spark), labels.where("doc_id < 0")).where("kept").count() == len(TEXTS)
    assert resample.resample(nothing(spark), labels).count() == 0
    assert resample.drawn(documents(spark), labels).columns == documents(spark).columns
    assert resample.drawn(nothing(spark), labels).count() == 0


def plain_mixed(x):
    x = (x ^ x >> 31) * 0x7FB5D329728EA185 % 2**64
    x = (x ^ x >> 27) * 0x81DADEF4BC2DD44D % 2**64
    return x ^ x >> 33


def plain_buckets(text):
    """Buckets of words, runs of signs and pairs of neighbours, by the hash as it is defined."""
    single = []
    for token in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|[!-/:-@\[-`{-~]+", text or ""):
        single.append(plain_mixed(sum((b + 1) * pow(0x9E3779B97F4A7C15, i, 2**64) for i, b in enumerate(token.encode())) % 2**64))
    double = [plain_mixed((a * 0x9FB21C651E98DF25 + b) % 2**64) for a, b in itertools.pairwise(single)]
    return [h >> 50 for h in single + double]


def plain_resample(rows, labels):
    """(doc_id, log weight, key, kept) of every row, without Spark or arrays."""
    told = collections.defaultdict(list)
    for doc_id, quality, toxic in labels:
        if doc_id is not None and quality is not None:
            told[doc_id].append((quality, toxic or 0))
    held_out, target = {}, set()
    for doc_id, marks in told.items():
        fourth = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=42) % 4 == 0
        if min(q for q, _ in marks) <= 0:
            if fourth:
                held_out[doc_id] = False
        elif max(t for _, t in marks) == 0:
            if fourth:
                held_out[doc_id] = True
            else:
                target.add(doc_id)
    cut = [plain_buckets(text) for _, text in rows]
    raw = collections.Counter(b for own in cut for b in own)
    wanted = collections.Counter(b for (doc_id, _), own in zip(rows, cut, strict=True) if doc_id in target for b in own)
    spread = resample.SMOOTHING * resample.BUCKETS
    ratio = {
        b: math.log((wanted[b] + resample.SMOOTHING) / (wanted.total() + spread))
        - math.log((n + resample.SMOOTHING) / (raw.total() + spread))
        for b, n in raw.items()
    }
    weights = [math.fsum(ratio[b] for b in own) for own in cut]
    keys = []
    for (doc_id, _), weight in zip(rows, weights, strict=True):
        x = plain_mixed(((-1 if doc_id is None else doc_id) * 0xD6E8FEB86659FD93 + resample.SEED) % 2**64)
        keys.append(weight - math.log(-math.log(((x >> 11) + 0.5) / 2**53)))
    of_id = {}
    for (doc_id, _), weight in zip(rows, weights, strict=True):
        if doc_id in held_out:
            of_id[doc_id] = min(weight, of_id.get(doc_id, math.inf))
    good, bad = ({w for i, w in of_id.items() if held_out[i] is kind} for kind in (True, False))
    cutoff = -math.inf
    if good and bad and target:
        tried = sorted(good | bad)
        right = [sum(w >= t for w in good) / len(good) + sum(w < t for w in bad) / len(bad) for t in tried]
        at = right.index(max(right))
        cutoff = (tried[at] + tried[at - 1]) / 2 if at else tried[0]
    k = sum(w >= cutoff for w in weights)
    least = sorted(keys, reverse=True)[k - 1] if k else math.inf
    return [(i, w, key, key >= least) for (i, _), w, key in zip(rows, weights, keys, strict=True)]


def test_the_whole_draw_matches_plain_python(spark):
    columns = "doc_id long, quality int, toxic int"
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    labels += [(4, 0, 0), (15, 1, 1), (16, None, 0), (None, 1, 0), (9, 0, None), (-5, 0, 1)]
    # ids that repeat with other texts, one of them very often, count once in the cutoff
    told = sorted({i for i, *_ in labels if i is not None})
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + TEXTS
    rows += [(i, f"again {i} and again") for i in told[:20]] + [(told[3], f"hot {n}") for n in range(300)]
    found = resample.resample(documents(spark, rows), spark.createDataFrame(labels, columns)).collect()
    expected = plain_resample(rows, labels)
    assert len(found) == len(expected) and 0 < sum(e[3] for e in expected) < len(expected)

    def ordered(result):
        return sorted(result, key=lambda r: (r[0] is None, r[0] or 0, round(r[1], 6), round(r[2], 6)))

    for a, b in zip(ordered([tuple(r) for r in found]), ordered(expected), strict=True):
        assert a[0] == b[0] and a[3] == b[3]
        assert math.isclose(a[1], b[1], rel_tol=1e-9, abs_tol=1e-7) and math.isclose(a[2], b[2], rel_tol=1e-9, abs_tol=1e-7)


def test_toxic_documents_of_good_quality_are_not_held_out(spark):
    labels = spark.range(4000).selectExpr("id AS doc_id", "1 AS quality", "CAST(id % 2 AS INT) AS toxic")
    sample = resample.sample_labels(labels)
    assert not any(i % 2 for kind in sample.values() for i in kind.tolist())
    assert len(sample["target"]) > 1300 and len(sample["good"]) > 400 and not len(sample["bad"])


def test_gumbel_variates():
    drawn = resample.gumbel(np.arange(100_000))
    assert abs(drawn.mean() - 0.5772) < 0.02 and abs(drawn.var() - np.pi**2 / 6) < 0.05


# Main text -------------------------------------------------------------------------------------


def test_main_text_of_generated_pages(spark):
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inside = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)[1]
        inside = re.sub(r"<[a-z/]*$", "", inside)
        inside = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1)>", "\n\n\n", inside.replace("<br>", " ")))
        blocks = (" ".join(boilerplate.entities.unescape(b).split()) for b in inside.split("\n\n\n"))
        assert boilerplate.main_text(r["html"]) == "\n".join(b for b in blocks if b)


def test_main_text_leaves_out_what_is_around():
    page = """<html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header>
      <nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies on this site to do things for you</div>
      <main><article><h1>Title &amp; more</h1><p>First <b>bold</b>text&nbsp;here<script>var x = "<p>";</script></p>
      <p>Second<br>line &eacute;&#233;<ul><li>one<li>two</ul><div class='ad'>Buy</div><form>Name <input></form>
      <table><tr><td>a<td>b</table><p>Last</article><aside>Aside text</aside></main>
      <section id="comments"><p>A long comment by a reader that is of no use to anyone at all, really.</p></section>
      <footer>&copy; us</footer></body></html>"""
    assert boilerplate.main_text(page).split("\n") == [
        "Title & more", "First boldtext here", "Second line éé", "one", "two", "a", "b", "Last",
    ]


@pytest.mark.parametrize("page", ["", "<", "<p", "<a" * 20_000, "<p>" * 5000 + "x", '<div class="' * 5000, "<script>" * 3000, "<!--" * 3000, "</p>" * 5000])
def test_main_text_of_broken_pages_ends(page):
    assert boilerplate.main_text(page) == ""


@pytest.mark.parametrize("page", [
    "<article><p title=it's>hello</p><p>rest</p></article>",
    "<article><p title=it's>hello</p><p>rest</p><p class=it's></article>",
    '<article><p><a href="x"">hello</a></p><p>rest</p></article>',
    '<article><p class="x>hello</p><p>rest</p></article>',
    '<article><p " \' title = "a > b" alt=\'>\' data==x>hello</p><p>rest</p></article>',
    '<article><p title=>hello</p><p a= >rest</p></article>',
    '<article><p><a href=x?q="y>hello</a></p><p class="z">rest</p></article>',
])
def test_stray_quotes_drop_no_text(page):
    assert boilerplate.main_text(page) == "hello\nrest"


@pytest.mark.parametrize("page", ["<p =\"" * 5000, "<p a='>" * 3001, "<p a=\">" * 5001, "<p =" * 20_000])
def test_open_quotes_end(page):
    assert boilerplate.blocks_of(page) == []


@pytest.mark.parametrize("page", [
    "<div class='layout has-sidebar'><article>{}</article></div>", "<div class=sidebar><main>{}</main></div>",
    "<form id=form1><div role=search><article>{}</article></div></form>", "<div class='post category-legal'>{}</div>",
    "<div data-id=search data-role='menu'>{}</div>", "<div title='has class=ad in it'>{}</div>",
])
def test_names_of_wrappers_drop_no_text(page):
    assert boilerplate.main_text(page.format("<p>" + "word " * 40 + "</p>")) == " ".join(["word"] * 40)


@pytest.mark.parametrize("attributes", ["class=ad", "class='wide ad-slot'", 'ID="sidebar2"', "x=1 role = navigation", 'a="b"class="cookie_notice"'])
def test_boilerplate_names_still_mark(attributes):
    page = "<div {}>{}</div><article><p>{}</p><div {}>{}</div></article>".format(attributes, "ad " * 40, "word " * 40, attributes, "ad " * 40)
    assert boilerplate.main_text(page) == " ".join(["word"] * 40)


CHINESE = "这是一篇没有空格的文章正文它有很多字也有逗号，句号。" * 20
ARTICLE = "<article><h1>Title of it</h1><p>" + "word " * 40 + "</p>{}<p>" + "last " * 30 + "</p></article>"


@pytest.mark.parametrize("page, expected", [
    # scripts without spaces
    (f"<div><a href=/>首页</a></div><div><a href=/x>关于</a></div><p>{CHINESE}</p><p>{CHINESE}</p><p>{CHINESE}</p><footer>版权所有</footer>", "\n".join([CHINESE] * 3)),
    # a page as it was, with nothing more in it
    (ARTICLE.format(""), None),
    # drawings and templates that are never closed, formulas
    (ARTICLE.format("<svg>"), None), (ARTICLE.format("<template>"), None), (ARTICLE.format("<object>"), None), (ARTICLE.format("<math>"), None),
    (ARTICLE.format("<svg><title>icon</title><svg><text>x</text></svg> y</svg><template><p>unused</p></template>"), None),
    (ARTICLE.format("<p>where <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds"), "where x=1 holds"),
    # comments of readers as articles
    (ARTICLE.format("") + "<section class=comments><article class=comment><p>" + "mine " * 50 + "</p></article></section>", None),
    (ARTICLE.format("<article class=comment><p>" + "mine " * 50 + "</p></article>"), None),
    (ARTICLE.format("") + "<aside><article><h2>Other</h2><p>" + "teaser " * 30 + "</p></article></aside>", None),
    # names by their last word
    *[(ARTICLE.format(f"<div class='{name}'><p>" + "mine " * 50 + "</p></div>"), None) for name in (
        "post-comments", "userComments", "commentlist", "site-header", "comment-17", "mainMenu", "entry-footer", "siteFooter", "post-share")],
    *[(ARTICLE.format(f"<div class='{name}'><p>mine</p></div>"), "mine") for name in (
        "article-header", "comments-open", "has-comments", "commentary", "category-ads", "with-sidebar")],
    # forms
    (ARTICLE.format("<p>W <button>Share now</button></p>"), "W"), (ARTICLE.format("<p>W <label for=a>Name</label></p>"), "W"),
    (ARTICLE.format("<label>"), None), (ARTICLE.format("<button>"), None),
    # cards that are links as a whole
    ("<p>" + "word " * 40 + "</p><p>" + "word " * 40 + "</p>" + ("<a href=/><div>" + "card " * 25 + "</div></a>") * 3, "\n".join(["word " * 39 + "word"] * 2)),
    # hidden elements
    *[(ARTICLE.format(f"<div {mark}><p>" + "mine " * 50 + "</p></div>"), None) for mark in (
        "hidden", "style='color: red; display:none'", "style=visibility:hidden", 'aria-hidden="true"')],
    (ARTICLE.format("<p>seen <span hidden>unseen</span></p>"), "seen"), (ARTICLE.format("<p aria-hidden=false>seen</p>"), "seen"),
])
def test_main_text_of_hostile_markup(page, expected):
    if page.startswith("<article>"):
        middle = [expected] if expected else []
        expected = "\n".join(["Title of it", " ".join(["word"] * 40), *middle, " ".join(["last"] * 30)])
    assert boilerplate.main_text(page) == expected


@pytest.mark.parametrize("page", [
    "<b>" * 20_000 + "<p>x" * 20_000, "<p><div>" + "<i>" * 20_000 + "</b>" * 20_000, "<b><div>" + "<i>" * 20_000 + "</b>" * 20_000,
    "<li><ul>" + "<b>" * 20_000 + "<li></li>" * 20_000, "<svg>" * 20_000, "<svg " * 20_000, "<label>" * 20_000, "<a href=x>" * 20_000 + "<div>" * 20_000,
])
def test_many_open_elements_take_linear_time(page):
    started = time.monotonic()
    boilerplate.blocks_of(page)
    assert time.monotonic() - started < 5


def test_pages_table(spark):
    rows = [(1, "u", None, 1), (2, None, "", 1), (None, "u", "<article>x y</article>", 1), (3, "u", "<article>x y</article>", 1), (3, "u", "<article>x y</article>", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    assert pairs(boilerplate.extract(pages), "page_id", "text", "n_chars") == [(None, "x y", 3), (1, "", 0), (2, "", 0), (3, "x y", 3), (3, "x y", 3)]
    assert boilerplate.extract(pages.where("page_id < 0")).count() == 0


# Surrogates --------------------------------------------------------------------------------------

PRIVATE = (
    "Mrs Anna Smith met Mr. SMITH and Dr José-Luis Gómez; mail the.72@Mail3.example.com, +1 (017) 555-7713, 123-45-6789, "
    '4111 1111 1111 1111 at 126.40.69.100. token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" GB82 WEST 1234 5698 7654 32, '
    "password: hunter2hunter2, Г-жа Иванова, Herr 王小明"
)


def test_surrogates_keep_format_and_hide_entities():
    text, kinds = surrogates.replace(PRIVATE, {})
    assert collections.Counter(kinds) == {
        "first_f": 1, "surname": 5, "first_n": 1, "email": 1, "phone": 1, "ssn": 1, "card": 1, "ip": 1, "secret": 2, "account": 1,
    }
    for part in ("Anna", "Smith", "SMITH", "Gómez", "the.72", "555-7713", "123-45-6789", "4111", "126.40.69.100", "04dbeb", "GB82", "hunter2", "Иванова", "王小明"):
        assert part not in text
    shape = lambda s: re.sub(r"\d", "9", s)
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}, \d{3}-\d{2}-\d{4}, \d{4} \d{4} \d{4} \d{4} at", text)
    first, second = re.search(r"Mrs \w+ (\w+) met Mr\. (\w+)", text).groups()
    assert first.upper() == second
    assert surrogates._luhn(re.sub(r"\D", "", re.search(r"(?:\d{4} ){3}\d{4}", text)[0])) == 0
    assert surrogates._mod_97(re.search(r"GB\d\d(?: \w{4}){4} \w\w", text)[0]) == 1
    assert shape("9") == "9" and surrogates.replace(PRIVATE, {})[0] == text
    assert surrogates.replace("nothing private here", {}) == ("nothing private here", [])


def test_surrogates_are_distinct_and_coreferent(spark, monkeypatch):
    # Names of two sounds only collide all the time, so many have to be drawn again.
    monkeypatch.setattr(surrogates, "_name", lambda entity, kind, draw: draw.among("ab") + draw.among("abcdefghijklmnop"))
    rows = [(k, f"Mr {chr(65 + k % 9)}{chr(97 + k % 9) * 3} wrote, and Mr {chr(65 + k % 9)}{chr(97 + k % 9) * 3} again") for k in range(18)]
    found = surrogates.anonymise(documents(spark, [*rows, *TEXTS]))
    names = {r["doc_id"]: re.findall(r"Mr (\w+)", r["text"]) for r in found.collect() if "Mr" in r["text"]}
    assert all(len(set(n)) == 1 for n in names.values())
    assert [names[k] for k in range(9)] == [names[k + 9] for k in range(9)]
    assert len({names[k][0] for k in range(9)}) == 9


def test_names_are_hidden_wherever_they_stand():
    text, kinds = surrogates.replace("Anna left. Mrs Anna Smith came. Smith said SMITH's and Anna-Smith's smith, Smithy. A Dr Smith", {})
    first, last = re.match(r"(\w+) left\. Mrs \1 (\w+) came", text).groups()
    assert text == f"{first} left. Mrs {first} {last} came. {last} said {last.upper()}'s and {first}-{last}'s smith, Smithy. A Dr {last}"
    assert collections.Counter(kinds) == {"first_f": 3, "surname": 5}


@pytest.mark.parametrize("text, kind", [
    ("Dr Anna Smith and Mrs Anna Smith, Anna", "first_f"), ("Dr Anna and Mrs Anna Smith; Mrs Anna", "first_f"),
    ("Dr Anna Smith, Anna; Dr Anna", "first_n"), ("Mr Anna, Dr Anna: Anna's", "surname"), ("Herr Anna Smith met Anna and Dr Anna Smith", "first_m"),
])
def test_one_kind_for_a_name_in_a_document(text, kind):
    assert [k for *_, k, e in surrogates.find_entities(text) if e == "anna"] == [kind] * 3


@pytest.mark.parametrize("text, hidden", [
    ("Frau Dr. Schmidt kam", ["Schmidt"]), ("Prof. Dr. Anna Schmidt kam", ["Anna", "Schmidt"]),
    ("Herr Ludwig van Beethoven kam", ["Ludwig", "Beethoven"]), ("Mr John Paul George Ringo sang", ["John", "Paul", "George", "Ringo"]),
    ("Mr J. R. Tolkien wrote", ["J", "R", "Tolkien"]), ("Mr J.R.R. Tolkien wrote", ["J", "R", "R", "Tolkien"]),
    ("Sra María de la Cruz García vino", ["María", "Cruz", "García"]), ("Frau Prof. Dr. med. Eva von der Leyen sprach", ["Eva", "Leyen"]),
    ("Mr John Smith Jr. The end", ["John", "Smith"]), ("Mme d'Artagnan est là", ["d'Artagnan"]), ("Mr Don Smith left", ["Don", "Smith"]),
    ("Mr and Mrs Smith came", ["Smith"]), ("Dr. no name", []),
])
def test_whole_names_are_found(text, hidden):
    found = surrogates.find_entities(text)
    assert [text[a:b] for a, b, *_ in found] == hidden
    new, _ = surrogates.replace(text, {})
    assert not {w for w in re.findall(r"\w+", new)} & {h for h in hidden if len(h) > 1}
    assert surrogates.find_entities(text + " " + " ".join(hidden))[len(found) :] or not hidden


def test_names_of_all_kinds_are_distinct(spark):
    rng = random.Random(11)
    sounds = ["".join(rng.choice(p) for p in ("bdfgklmnprst", "aeiou", "bdfgklmnprst", "aeiou", "nrst")).capitalize() for _ in range(1500)]
    rows = [(k, f"{rng.choice(['Mrs', 'Mr', 'Dr'])} {a} {b} came") for k, (a, b) in enumerate(zip(sounds, sounds[::-1]))]
    done = surrogates.attempts(surrogates.mentions(documents(spark, rows))).toArrow().to_pylist()
    assert {r["kind"] for r in done} == {"first_f", "first_m", "first_n", "surname"}
    new = [r["surrogate"] for r in done]
    assert len(new) > 2500 and len(set(new)) == len(new) and not set(new) & {r["entity"] for r in done}


def test_the_table_matches_plain_replacement(spark):
    """Plain Python: one table of entities, drawn again until no two names, or others of a kind, agree."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(10_000 + k, f"Mrs Ba{v} Smi{v} met Mr Smi{v}") for k, v in enumerate("aeiou")]
    entities = {(k, e): 0 for _, t in rows for _, _, k, e in surrogates.find_entities(t or "")}
    family = lambda kind: "name" if kind == "surname" or kind.startswith("first") else kind
    while True:
        drawn = {key: surrogates.surrogate(*key, attempt) for key, attempt in entities.items()}
        owners = collections.defaultdict(list)
        for (kind, entity), new in drawn.items():
            owners[family(kind), new].append((entities[kind, entity], entity, kind))
        real = {(family(kind), entity) for kind, entity in entities}
        clash = [key for key, new in drawn.items() if (family(key[0]), new) in real or min(owners[family(key[0]), new])[1:] != key[::-1]]
        if not clash:
            break
        for key in clash:
            entities[key] += 1
    found = {r["doc_id"]: r["text"] for r in surrogates.anonymise(documents(spark, rows)).collect()}
    assert found == {i: surrogates.replace(t or "", entities)[0] for i, t in rows}


def test_names_of_two_persons_stay_apart():
    found = surrogates.find_entities("Mrs Kim Lee and Mr Kim Park; Kim agreed. Mrs Kim Lee and Dr Kim")
    assert [k for *_, k, e in found if e == "kim"] == ["first_f", "first_m", "first_m", "first_f", "first_f"]
    assert surrogates.find_entities("Dr A Smith. A dog") == [(3, 4, "first_n", "a"), (5, 10, "surname", "smith")]


def test_more_entities_than_a_format_holds(spark):
    # All addresses of one-digit octets, all mails of one-letter parts, and a secret without letters to change.
    letters = "abcdefghijklmnopqrstuvwxyz"
    ips = [".".join(f"{k:04d}") for k in range(10_000)]
    mails = [f"{a}@{b}.net" for a in letters for b in letters]
    names = ["".join(n).capitalize() for n in itertools.product("bdfgkl", "aeiou", "bdfgk", "aeiou", "bdfg")]
    said = ips + mails + [f"Mrs {n} Smith" for n in names] + ['token: "------------"', "password: ____________"]
    rows = [(k, " , ".join(said[at : at + 500])) for k, at in enumerate(range(0, len(said), 500))]
    done = surrogates.attempts(surrogates.mentions(documents(spark, rows))).toArrow().to_pylist()
    kinds = collections.Counter(r["kind"] for r in done)
    assert kinds == {"ip": 10_000, "email": 676, "first_f": len(names), "surname": 1, "secret": 2}
    for kind, n in kinds.items():
        new = {r["surrogate"] for r in done if r["kind"] == kind}
        assert len(new) == n and not new & {r["entity"] for r in done if r["kind"] == kind}


@pytest.mark.parametrize("kind, original", [
    ("phone", "(017) 555-7713"), ("ssn", "123-45-6789"), ("card", "4111 1111 1111 1111"), ("account", "GB82 WEST 1234 5698 7654 32"),
    ("email", "The.72@Mail3.example.com"), ("ip", "1.2.3.4"), ("surname", "Smith"), ("surname", "王小明"), ("secret", "0123456789abcdef" * 2),
])
def test_later_draws_grow(kind, original):
    entity = next(e for *_, k, e in surrogates.find_entities("Mr " + original) if k == kind)
    drawn = [surrogates.in_format(original, kind, surrogates.surrogate(kind, entity, k)) for k in (0, 7, 20, 30)]
    assert len(drawn[2]) > len(drawn[1]) or kind == "ip"
    assert len(drawn[3]) > len(drawn[2])
    if kind == "card":
        assert surrogates._luhn(re.sub(r"\D", "", drawn[3])) == 0
    if kind == "account":
        assert surrogates._mod_97(drawn[3]) == 1


def test_surrogates_of_awkward_rows(spark):
    found = surrogates.anonymise(documents(spark, [*TEXTS, (20, PRIVATE), (None, PRIVATE), (20, PRIVATE)]))
    assert found.count() == len(TEXTS) + 3
    untouched = pairs(found.where("n_entities = 0"), "doc_id", "text")
    assert untouched == sorted(((i, t or "") for i, t in TEXTS), key=lambda r: tuple((v is not None, v) for v in r))
    assert found.where("n_entities > 0").select("text").distinct().count() == 1
    assert surrogates.anonymise(nothing(spark)).count() == 0


@pytest.mark.parametrize("text", ["@" * 30_000, "1" * 60_000, "1." * 30_000, "a" * 100_000, "= " * 30_000, "Mr " * 20_000, LONG])
def test_finding_entities_in_odd_texts_ends(text):
    found = surrogates.find_entities(text)
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))


# Chat ----------------------------------------------------------------------------------------------


def test_chat_round_trip_of_hostile_turns(spark):
    bits = ["\\", "</turn>", "### User: ", "### Assistant: ", "### @x: ", "### @###", "\n", "text", " ", "</turn", "### "]
    rng = np.random.default_rng(4)
    said = ["".join(rng.choice(bits, rng.integers(0, 9))) for _ in range(400)]
    roles = ["user", "assistant", "system", "we:ird\n", "", None, "Assistant", "tool"]
    rows = [(k // 5, k % 5, roles[int(rng.integers(8))], t, 1) for k, t in enumerate(said)]
    rows += [(None, None, None, None, 1), (7, None, "user", "x", 1), (7, None, "user", "x", 1)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, source int")
    done = {r["conv_id"]: r for r in chat.format_conversations(turns).withColumn("loss", chat.masked_text(F.col("formatted"), F.col("loss_mask"))).collect()}
    groups = collections.defaultdict(list)
    for conv, turn, role, text, _ in rows:
        groups[conv].append(((turn is not None, turn), role or "", text or ""))
    assert set(done) == set(groups)
    for conv, expected in groups.items():
        expected = [(role, text) for _, role, text in sorted(expected)]
        assert done[conv]["identical"]
        assert [(t["role"], t["text"]) for t in done[conv]["parsed"]] == expected
        assert done[conv]["loss"] == "".join(t for role, t in expected if role == "assistant")
    assert chat.format_conversations(turns.where("conv_id < -5")).count() == 0


def test_queries_match_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "conversations", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    for name, sql in queries.ORACLES.items():
        frame = queries.QUERIES[name](spark, SF)
        expected = con.sql(sql).to_arrow_table()
        assert sorted(frame.columns) == sorted(expected.column_names)
        columns = sorted(frame.columns)
        assert pairs(frame, *columns) == sorted(tuple(r[c] for c in columns) for r in expected.to_pylist()), name
    probe = [r for r in queries.op9_chat(spark, SF).collect() if r["conv_id"] == -7][0]
    said = r"\### Assistant: </turn> ok"
    assert probe["loss_chars"] == len(said) and probe["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert json.loads(json.dumps(probe.asDict()))["n_turns"] == 2


def test_long_runs_of_backslashes(spark):
    signs = "\\" * 1_000_000
    texts = [signs, signs + "</turn>", "a" + signs + "### User: b"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.unescape(chat.escape(F.col("t"))).alias("back"))
    assert frame.where("t <> back").count() == 0
    assert frame.select(chat.escape(F.col("t")).alias("e")).where("length(e) > 1000000 + 7").count() == 2


def test_an_item_repeated_very_often_in_one_document(spark):
    words = "the quick brown fox jumps over a lazy dog while seven wizards brew soup".split()
    rows = [(1, " ".join(words * 20_000)), (2, " ".join(["before", *words, "after"])), (3, "clean")]
    benchmark = spark.createDataFrame([(7, " ".join(words)), (8, "an item that no document holds at all in this small table here")], "item_id long, text string")
    started = time.monotonic()
    found = decontam.contaminated(documents(spark, rows), benchmark)
    assert pairs(found, "doc_id", "item_id", "doc_word", "item_word", "overlap_words", "equal_words", "n_passages") == [
        (1, 7, 0, 0, 14, 14, 20_000), (2, 7, 1, 0, 14, 14, 1),
    ]
    assert time.monotonic() - started < 60


def test_running_starts_around_the_parts(spark):
    sizes = [0, 1, 2, chat.PART - 1, chat.PART, chat.PART + 1, 3 * chat.PART + 5]
    rows = [(n, [(7 * k) % 11 for k in range(n)]) for n in sizes]
    frame = spark.createDataFrame(rows, "n int, lengths array<bigint>").select("n", chat.running_starts(F.col("lengths")).alias("at"))
    found = {r["n"]: r["at"] for r in frame.collect()}
    assert found == {n: [sum(lengths[:k]) for k in range(n)] for n, lengths in rows}


def test_masks_around_the_pages(spark):
    rows = [(k, 0, "assistant", "é😀</turn>"[: k % 10] * (k // 3)) for k in range(0, 900, 7)]
    rows += [(5000, 0, "user", "z" * 3 * chat.PAGE), (5000, 1, "assistant", ""), (5000, 2, "assistant", "y" * 2 * chat.PAGE), (5000, 3, "user", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    done = chat.format_conversations(turns)
    found = {r["conv_id"]: r for r in done.withColumn("loss", chat.masked_text(F.col("formatted"), F.col("loss_mask"))).collect()}
    for conv in {r[0] for r in rows}:
        assert found[conv]["identical"]
        assert found[conv]["loss"] == "".join(t for c, _, role, t in rows if c == conv and role == "assistant")


def test_a_conversation_of_very_many_turns(spark):
    n = 20_000
    role = F.when(F.col("id") % 2 == 0, "user").otherwise("assistant")
    turns = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.concat(F.lit("é </turn> "), F.col("id").cast("string")).alias("text"))
    started = time.monotonic()
    row = chat.format_conversations(turns).withColumn("loss", chat.masked_text(F.col("formatted"), F.col("loss_mask"))).collect()[0]
    assert time.monotonic() - started < 60
    assert row["identical"] and len(row["parsed"]) == n
    assert row["loss"] == "".join(f"é </turn> {k}" for k in range(1, n, 2))
