"""Corpus operators do the whole job: bounds that were lowered, rows and blocks that were left out."""

import math
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dividax.llm import cotraining, line_quality, secrets, sharding
from dividax.llm.common import text_bytes
from dividax.llm.decontam import contained_items, drop_contaminated
from dividax.llm.html_blocks import Block, label_blocks, main_text, page_blocks
from dividax.llm.line_quality import without_shared_lines


def test_cotraining_takes_12000_labelled_rows(spark):
    docs = spark.range(12_500).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), "id").alias("text"), F.lit("s").alias("source"), F.lit("en").alias("lang"), F.lit(5).alias("n_chars"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    assert sum(r["good"] is not None for r in cotraining.sample_rows(docs, labels)) == 12_000


def test_pool_teaches_words_that_no_labelled_row_has(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(6000):
        bad = i % 3 == 0
        words = [f"w{rng.randrange(60)}" for _ in range(30)] + ["rubbish"] * bad
        # the spam source of unlabelled rows brings its own word
        words += ["zzgamble"] * (bad and i >= 1200)
        rows.append((i, " ".join(words), "en", "spam" if bad else "site", 100))
        if i < 1200:
            labels.append((i, int(not bad), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sample = cotraining.sample_rows(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    model = cotraining.fit(sample)
    assert sum(r[0] for r in model.exchanged) > 4_000  # more than the old pool's bound
    of = lambda text: set(cotraining._text_features(*text_bytes(pa.table({"t": [text]}), "t"))[1].tolist())
    assert all(model.text.weights[f] < 0 for f in of("zzgamble w1") - of("w1"))


PROSE = "The house of the man is on the hill and it was there for a long time, as they say in the town. " * 4


def test_marked_pages_keep_prose_outside_the_mark():
    cards = "".join(f"<article><h2>Card {i}</h2><p>See more</p></article>" for i in range(3))
    page = f"<body>{cards}<div><h2>Between</h2><p>{PROSE}</p><p>A short one.</p><p>{PROSE}</p></div><p>Imprint, contact</p></body>"
    text = main_text(page)
    assert text.count("The house of the man") == 8 and "A short one." in text and "Imprint" not in text


def test_layout_names_do_not_make_a_wrapper_boilerplate():
    for name in ("no-sidebar", "has-sidebar", "page with-sidebar wide"):
        assert "The house" in main_text(f'<body><div class="{name}"><article><h1>T</h1><p>{PROSE}</p></article></div></body>')
    assert "The house" not in main_text(f'<body><div class="left sidebar"><p>{PROSE}</p></div><article><p>{"Und das ist der Text von dem Haus. " * 9}</p></article></body>')


def test_stop_words_count_on_marked_pages():
    list_ = "Alpha9 Beta8 Gamma7 Delta6 Epsilon5 " * 4
    blocks, marks = page_blocks(f"<body><article><div><a href=x>Go</a></div><p>{list_}</p><p><a href=x>Top</a></p><h2>Rest</h2><p>{PROSE}</p></article></body>")
    label_blocks(blocks, marks)
    assert blocks[1].label == "bad" and blocks[-1].label == "good"  # no stop words, between links


def test_shared_lines_of_a_hot_host(spark, monkeypatch):
    passage, foot = " ".join(f"passage{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)), "Share this page"
    word = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    rows = []
    for i in range(4000):  # footer in 120 (3 %), passage in 5 documents of one host; the rest is clean
        lines = [f"own text {word(i)}", *([foot] if i < 120 else []), *([passage] if 200 <= i < 205 else []), *(["said twice"] if i in (300, 301) else [])]
        rows.append((i, "\n".join(lines), "hot"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r.text for r in without_shared_lines(docs).collect()}
    assert found == {i: "\n".join(x for x in t.split("\n") if x not in (foot, passage)) for i, t, _ in rows}
    for most in (200_000, 0):  # broadcast, salted
        monkeypatch.setattr(line_quality, "BROADCAST_LINES", most)
        lost = {r.doc_id: r.removed_lines for r in line_quality.quality_rules(docs).collect()}
        assert lost == {i: sum(x in (foot, passage) for x in t.split("\n")) for i, t, _ in rows}


def test_short_items_inside_long_documents_are_all_found(spark):
    rng = random.Random(31)
    items, rows = [], []
    for n in range(1, 21):  # words of an item
        for j in range(100):
            item = [f"item{n}x{rng.randrange(10**6)}" for _ in range(n)]
            filler = [f"w{rng.randrange(3000)}" for _ in range(300)]
            at = rng.randrange(300)
            items.append((len(items), " ".join(item)))
            rows.append((len(rows), " ".join(filler[:at] + item + filler[at:])))
            rows.append((len(rows), " ".join(filler[:at] + item[:-1] + ["other"] + filler[at:]) if n < 9 else " ".join(filler)))  # no item
    docs, tests = spark.createDataFrame(rows, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in contained_items(docs, tests).collect()}
    assert found == {(2 * i, i) for i in range(len(items))}
    kept = drop_contaminated(docs, tests, item_block_bytes=20_000)
    assert {r.doc_id for r in kept.collect()} == {i for i in range(len(rows)) if i % 2}
    assert "Exchange" not in drop_contaminated(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), tests)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["site header-fixed", "page menu-closed", "content-area sidebar-right", "nav-open", "legal-news", "social-science", "site widget nav-open sidebar-left"])
def test_wrappers_named_like_boilerplate_are_reopened(name):
    foot, comments = "<footer>Imprint of the site</footer>", f'<section class="comments"><p>Readers: {PROSE[:150]}</p></section>'
    for body in (f"<article><h1>Title</h1><p>{PROSE}</p></article>", f"<h1>Title</h1><p>{PROSE}</p><p>{PROSE}</p><p>Short end.</p>"):
        text = main_text(f'<body><nav><a href=1>Home</a></nav><div class="{name}"><div class="menu-open">{body}{comments}</div>{foot}</div></body>')
        assert text.startswith("Title\n\nThe house") and "Readers" not in text and "Imprint" not in text and "Home" not in text
    assert "The house" not in main_text(f'<body><div class="{name}"><p>{PROSE}</p></div><article><p>{PROSE.replace("house", "home") * 3}</p></article></body>')


@pytest.mark.parametrize("name", ["entry-header", "post-header", "article-header"])
def test_headers_of_an_article_keep_its_title(name):
    assert main_text(f'<article><div class="{name}"><h1>Title</h1></div><p>{PROSE}</p></article>').startswith("Title")


def test_stop_words_decide_on_the_given_pages(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()]
    assert all(main_text(h) for h in pages)
    assert sum(main_text(h) != main_text(h, frozenset()) for h in pages) > 0.8 * len(pages)


@pytest.mark.parametrize("broken", ["<a " * 300_000, "<b>" * 50_000 + "</i>" * 50_000, "<div>" * 50_000, "<a '" * 100_000 + ">", "<script" * 100_000, "<li>" * 30_000 + "</ul>" * 30_000, "<div class=ad>" * 30_000 + "x"], ids=lambda b: b[:8])
def test_broken_markup_takes_linear_time(broken):
    began = time.process_time()
    main_text(broken)
    assert time.process_time() - began < 8


@pytest.mark.parametrize("seed", range(40))
def test_labels_against_a_plain_reading_of_the_rules(seed):
    """Unmarked and marked pages of random blocks: each ambiguous block looks for its neighbours one by one."""
    rng = random.Random(seed)
    marked = seed % 2
    stop, other = "the of and that with".split(), "alpha beta gamma delta kappa".split()
    blocks = []
    for _ in range(rng.randint(1, 25)):
        words = rng.choices(stop, k=rng.choice([0, 1, 4, 9])) + rng.choices(other, k=rng.choice([1, 4, 12, 40]))
        rng.shuffle(words)
        text = " ".join(words)
        blocks.append(Block(text, rng.choice([0, 0, 0, len(text)]), marked, None, rng.random() < 0.1))
    label_blocks(blocks, [])
    short, long_, few, many, links = (30, 70, 0.05, 0.12, 0.5) if marked else (70, 200, 0.15, 0.25, 0.33)
    share = lambda b: sum(w in stop for w in b.text.split()) / len(b.text.split())
    page = sum(sum(w in stop for w in b.text.split()) for b in blocks) / sum(len(b.text.split()) for b in blocks)
    first = []
    for b in blocks:
        prose = len(b.text) >= long_ and (share(b) >= many or page < 0.02)
        if b.linked > links * len(b.text):
            first.append("bad")
        elif len(b.text) < short or b.heading:
            first.append("?")
        else:
            first.append("good" if prose else "?" if marked or share(b) >= few or page < 0.02 else "bad")
    for i, b in enumerate(blocks):
        label = first[i]
        for d in range(1, len(blocks)):
            if label != "?":
                break
            near = [first[j] if 0 <= j < len(blocks) else "?" for j in (i - d, i + d)]
            known = [x for x in near if x != "?"]
            if known:
                label = near[1] if b.heading and near[1] != "?" else "good" if "good" in known else "bad"
        assert b.label == ("good" if label == "?" else label)


@pytest.mark.parametrize("most", [100_000, 0])
def test_repeats_of_one_row_spread_over_all_shards(spark, monkeypatch, most):
    monkeypatch.setattr(sharding, "BROADCAST_REPEATS", most)
    rng = random.Random(4)
    rows = [(i, "x" * rng.randint(1, 200)) for i in range(3000)] + [(7_000_000, "y" * 300)] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for found in (sharding.sharded(docs), sharding.sharded(docs, keep_columns=True).withColumn("size", F.length("text") + 1)):
        full = {r.shard: r.b for r in found.groupBy("shard").agg(F.sum("size").alias("b")).collect()}
        assert set(full) == set(range(8)) and sum(full.values()) == sum(len(t) + 1 for _, t in rows)
        assert max(full.values()) - min(full.values()) <= 1000
    slots = [r.slot for r in sharding.sharded(docs).where("shard = 3").collect()]
    assert sorted(slots) == list(range(len(slots)))


def test_a_stored_map_is_edited_when_data_or_shards_are_added(spark, tmp_dir):
    rng = random.Random(5)
    rows = [(i, "x" * rng.randint(1, 300)) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    shard_of = lambda found: {r.doc_id: r.shard for r in found.collect()}
    old = shard_of(sharding.sharded(docs.where("doc_id < 3500"), map_path=f"{tmp_dir}/map1"))
    more = shard_of(sharding.sharded(docs, previous=spark.read.parquet(f"{tmp_dir}/map1"), map_path=f"{tmp_dir}/map2"))
    assert sum(more[i] != k for i, k in old.items()) < 0.1 * len(old)  # few slots move
    grown = sharding.sharded(docs, shards=9, previous=spark.read.parquet(f"{tmp_dir}/map2"), map_path=f"{tmp_dir}/map3")
    moved = {i: k for i, k in shard_of(grown).items() if k != more[i]}
    assert set(moved.values()) == {8} and 0.08 < len(moved) / len(rows) < 0.15
    versions = spark.read.parquet(f"{tmp_dir}/map3")
    assert sorted(r[0] for r in versions.select("map_version").distinct().collect()) == [0, 1, 2, 3] and versions.count() == 4 * sharding.SLOTS
    with pytest.raises(ValueError):
        sharding.sharded(docs, shards=4, previous=versions)


def _identifiers(rng, n):
    words = ("get set user name value item list order report total account date rate tax index table column build read write "
             "merge window group filter parse text line page model score token count batch stream source target config "
             "session worker queue cache buffer handler service client server request response error message time zone").split()
    styles = (lambda w: "".join(x.title() for x in w), lambda w: "_".join(w), lambda w: "-".join(w), lambda w: "/".join(w),
              lambda w: "".join(x.title() for x in w) + str(rng.randint(0, 99)), lambda w: "".join(w), lambda w: "_".join(w).upper())
    return [rng.choice(styles)([rng.choice(words) for _ in range(rng.randint(5, 9))]) for _ in range(n)]


def test_secrets_are_reported_and_identifiers_are_not(spark):
    """The battery and the false-discovery step against their plain forms, on keys of each encoding."""
    rng = random.Random(17)
    alphabets = {"hex": "0123456789ABCDEF", "BASE32": secrets.ENCODINGS[1][2], "base32": secrets.ENCODINGS[1][2].lower(),
                 "base36": secrets.ENCODINGS[2][2].lower(), "base62": secrets.ENCODINGS[3][2], "base64": secrets.ENCODINGS[4][2]}
    texts = [("words", t) for t in _identifiers(rng, 5000)]
    texts += [(name, "".join(rng.choices(letters, k=rng.randint(36, 64)))) for name, letters in alphabets.items() for _ in range(200)]
    schema = "doc_id long, text string"
    found = {r.doc_id: r.n_random for r in secrets.scan_secrets(spark.createDataFrame([(i, f"x {t} y") for i, (_, t) in enumerate(texts)], schema)).collect()}
    hits = Counter(name for i, (name, _) in enumerate(texts) if found[i])
    assert hits["words"] < 0.05 * 5000
    assert all(hits[name] > 0.9 * 200 for name in alphabets), hits

    def plain(t):
        name, letters = next((n, a) for n, p, a in secrets.ENCODINGS if re.search(p, t))
        if len(t) * math.log2(len(letters)) < secrets.MIN_BITS:
            return None
        read = t.upper() if name in ("base32", "base36") else t.replace("-", "+").replace("_", "/") if name == "base64" else t
        v, n, k = np.array([letters.index(c) for c in read]), len(t), len(letters)
        parts = secrets._parts(name, letters)
        half = sum((sum(c in part for c in read) - n * len(part) / k) ** 2 / (n * len(part) / k) for part in parts) / 2
        ps = [math.exp(-half) * (1 + half if len(parts) == 5 else 1)]
        high = v * 2 >= k
        ups, turns = int(high.sum()), int((high[1:] != high[:-1]).sum())
        q = 2 * ups * (n - ups)
        ps.append(1e-12 if q <= n else math.erfc(abs(turns - q / n) / math.sqrt(q * (q - n) / (n * n * (n - 1))) / math.sqrt(2)))
        centred = v - (k - 1) / 2
        ps.append(math.erfc(abs((centred[1:] * centred[:-1]).sum() / ((k * k - 1) / 12) / math.sqrt(n - 1)) / math.sqrt(2)))
        x = -sum(math.log(max(p, 1e-12)) for p in ps)
        battery = math.exp(-x) * (1 + x + x * x / 2)
        f, r = (sum(c in s for c in t.lower()) for s in (secrets.FREQUENT, secrets.RARE))
        w = secrets.WORD_SHARE
        if name == "hex":
            word = 1e-12
        else:
            word = 1.0 if f >= (f + r) * w else math.exp(-(f * math.log(f / ((f + r) * w)) if f else 0) - (r * math.log(r / ((f + r) * (1 - w))) if r else 0))
        return name, battery, word

    tested = {i: plain(t) for i, (_, t) in enumerate(texts)}
    levels = {i: (p[0], int(math.log2(len(texts[i][1]))), p[1], math.floor(-10 * math.log10(max(p[2] if p[1] >= secrets.ALPHA else 1.0, 1e-12)) + 1e-9))
              for i, p in tested.items() if p}
    by_stratum = {}
    for i, (name, size, battery, level) in levels.items():
        by_stratum.setdefault((name, size), []).append((level, i, battery))
    expected = set()
    for group in by_stratum.values():
        cuts = [level for level, _, _ in group if len(group) * 10 ** (-level / 10) <= secrets.FDR * sum(x >= level for x, _, _ in group)]
        expected |= {i for level, i, _ in group if cuts and level >= min(cuts)}
    near = {i for i, p in tested.items() if p and abs(p[1] - secrets.ALPHA) < 1e-5}  # the error function is approximated
    based = {i for i, (_, t) in enumerate(texts) if re.search(secrets.HEX + "|" + secrets.ACCESS, t)}
    assert {i for i, n in found.items() if n} - near - based == expected - near - based
