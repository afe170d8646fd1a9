"""Operators 11 to 13 against brute force, on odd rows (NULLs, empty and long texts, repeats, clashing names) and on none."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dividax.llm import alignment, language_id, merkle

SF = "/root/testdata/sf0.001"
NAMES = "doc_id long, text string, lang string, source string, n_chars long, h string, idx string, tree string, codes string, n string"
ODD_TEXTS = [
    None, "", " ", "a▁b", "<|endoftext|> <s></s>", "  two  spaces\t\n\n x", "日本語のテキスト😀👩‍👩‍👧", "é" * 50, "x" * 3000, "\x00\x01",
    " lead", "trail ", "ﬁ①", "don't stop 123456 " + "word And " * 9000, "0" * 40000, "\r\n" * 100, "Same Text", "Same Text",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, ("en", None, "fr", "ü")[i % 4], None if i == 3 else f"s{i % 2}", len(t or ""), "h", "i", "t", "c", "n") for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[4], rows[4], (None, "NoId", None, None, None, "h", "i", "t", "c", "n"), (None,) * 10, (None,) * 10, (900, "Alone", "xx", "s", 5, *"hitcn")]
    rows += [(1000 + i, f"Row Number {i}", "en", "s", i, *"hitcn") for i in range(150)]
    return spark.createDataFrame(rows, NAMES).repartition(4).cache()


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def ends(ids, sizes):
    return np.cumsum([sizes[i] for i in ids], dtype=int).tolist()


def brute_alignment(texts):
    """Plain groups from the sets of end offsets; texts are encoded whole."""
    pair = alignment.tokenizer_pair(alignment.BYTE_LEVEL, alignment.PIECES)
    out, linked = [], Counter()
    for text in texts:
        a, b = (pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)) if text else ([], [])
        if any(b"".join(of[i] for i in ids) != (" " + (text or "")).encode() for ids, of in ((a, pair.a_bytes), (b, pair.b_bytes))):
            a, b = [], []
        at_a, at_b = ({e: i + 1 for i, e in enumerate(ends(ids, size))} for ids, size in ((a, pair.a_size), (b, pair.b_size)))
        cuts = sorted(set(at_a) & set(at_b))
        groups = [(a[at_a.get(s, 0) : at_a[e]], b[at_b.get(s, 0) : at_b[e]]) for s, e in zip([0, *cuts], cuts)]
        linked.update((x[-1], y[-1]) for x, y in groups)
        out.append((len(a), len(b), groups, cuts))
    most = Counter()
    for (_, y), n in linked.items():
        most[y] = max(most[y], n)
    for n_a, n_b, groups, cuts in out:
        pairs = [(x[-1], y[-1]) for x, y in groups]
        joined = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(joined.encode()).hexdigest() if groups else ""
        yield (n_a, n_b, len(groups), len(pairs), sum(linked[p] == most[p[1]] for p in pairs), sum(linked[p] for p in pairs), digest), groups, cuts


@pytest.mark.parametrize("table", ["odd", "given"])
def test_alignment_against_end_offsets(table, odd, given):
    docs = odd if table == "odd" else given
    rows = docs.select("doc_id", "text").collect()
    expected = list(brute_alignment([r.text for r in rows]))
    found = alignment.alignment_digests(docs)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, found.collect())) == Counter((r.doc_id, *e[0]) for r, e in zip(rows, expected))
    if table == "odd":
        groups = alignment.aligned(docs).select("doc_id", "groups").collect()
        key = lambda i, g: (i, str([(list(x), list(y), c) for x, y, c in g]))
        assert Counter(key(r.doc_id, [(g.a, g.b, g.end) for g in r.groups]) for r in groups) == Counter(key(r.doc_id, [(*g, c) for g, c in zip(e[1], e[2])]) for r, e in zip(rows, expected))
        assert alignment.alignment_digests(docs.where("false")).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_cuts_of_random_ends(seed):
    rng = random.Random(seed)
    a_ends, b_ends, a_first, b_first, base = [], [], [], [], 0
    for _ in range(rng.randint(1, 6)):
        size = rng.choice([1, 2, 30, 400])
        a_first.append(len(a_ends))
        b_first.append(len(b_ends))
        dense = rng.choice([0.02, 0.3, 0.9])
        zone = (rng.random() * size, rng.random() * size)  # nothing but the ends is common inside
        for x in range(1, size + 1):
            shared = min(zone) <= x <= max(zone)
            if x == size or rng.random() < dense and not (shared and x % 2):
                a_ends.append(base + x)
            if x == size or rng.random() < dense and not (shared and x % 2 == 0):
                b_ends.append(base + x)
        base += size
    a, b = alignment.common_cuts(*(np.array(x, np.int64) for x in (a_ends, b_ends, a_first, b_first)))
    assert [a_ends[i] for i in a] == [b_ends[i] for i in b] == sorted(set(a_ends) & set(b_ends))


def test_units_encode_as_the_whole_text(given):
    pair = alignment.tokenizer_pair(alignment.BYTE_LEVEL, alignment.PIECES)
    texts = [r.text for r in given.select("text").limit(60).collect()] + [t or "" for t in ODD_TEXTS]
    texts += ["Word and 12 it's\n\n über " * 6000, "it' s 't \u00a0 x\u2003 y \u0085 z", "a ' s ,, . !? -- 1 2", "\u1680 \u3000"]
    for text in texts:
        assert " ".join(pair.units(text)) == text
        (a, _), (b, _), _ = pair.encode([text])
        assert a.tolist() == pair.a.encode(" " + text, add_special_tokens=False).ids
        assert not text or b.tolist() == pair.b.encode(text)


def brute_merkle(rows, fanout=8):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    def leaf(r, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i : i + fanout])) for i in range(0, len(out[-1]), fanout)])
        return out

    langs = sorted({r.lang for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    members = {x: sorted((r for r in rows if r.lang == x), key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text))) for x in langs}
    trees = {x: levels([leaf(r, r.text) for r in members[x]]) for x in langs}
    top = levels([trees[x][-1][0] for x in langs])
    for place, x in enumerate(langs):
        for i, r in enumerate(members[x]):
            hit = zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 3 == 0
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text) if hit and r.text is not None else r.text
            h, siblings = leaf(r, text), []
            for tree, at in ((trees[x], i), (top, place)):
                for level in tree[:-1]:
                    run, slot = level[at - at % fanout :][:fanout], at % fanout
                    siblings += run[:slot] + run[slot + 1 :]
                    h, at = sha("".join(run[:slot] + [h] + run[slot + 1 :])), at // fanout
            yield r.doc_id, leaf(r, r.text), trees[x][-1][0], top[-1][0], sha("".join(siblings)), h, h == top[-1][0]


@pytest.mark.parametrize("table", ["odd", "given"])
def test_manifest_against_plain_trees(table, odd, given):
    docs = odd if table == "odd" else given
    found = merkle.manifest_digests(docs)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, found.collect())) == Counter(brute_merkle(docs.collect()))


@pytest.mark.parametrize("fanout", [2, 3])
def test_manifest_of_other_fanouts(fanout, odd):
    found = merkle.merkle_manifest(odd, fanout=fanout)
    proofs = found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")))
    assert Counter(map(tuple, proofs.collect())) == Counter(r[:5] for r in brute_merkle(odd.collect(), fanout))
    assert found.where("verified").count() == odd.count()


def test_manifest_of_no_rows_or_groups_joined_by_shuffle(odd, monkeypatch):
    assert merkle.manifest_digests(odd.where("false")).collect() == []
    expected = Counter(map(tuple, merkle.manifest_digests(odd).collect()))
    monkeypatch.setattr(merkle, "BROADCAST_RUNS", 0)
    assert Counter(map(tuple, merkle.manifest_digests(odd).collect())) == expected


def test_languages_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language_id.fit_languages(docs, ~held)
    found = docs.where(held).join(language_id.predict_languages(docs.drop("lang", "source"), model), "doc_id")
    right, known, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg((~F.col("ambiguous")).cast("int")), F.count("*")).first()
    assert n > 300 and right > 0.99 and known > 0.95
    mixed = " ".join("the and this thing with of les des que vous pour avec".split() * 5)
    rows = [(1, None), (2, ""), (3, " 12 -+\n"), (4, "日本"), (5, "the thing that is on the other " * 30), (6, "DES LES QUE DANS POUR " * 3), (6, "x"), (None, "x"), (7, "the of " * 200_000), (8, mixed)]
    odd = spark.createDataFrame([(*r, "n", "l", "m") for r in rows], "doc_id long, text string, score string, lang_pred string, margins string")
    got = {(r.doc_id, r.text): r for r in language_id.predict_languages(odd, model).withColumn("text", F.lit("")).collect()}
    found = sorted(language_id.predict_languages(odd, model).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert len(found) == len(rows) and got
    assert all(r.lang_pred == "und" and r.score == 0 and r.ambiguous for r in found[:3])
    assert [r.lang_pred for r in found if r.doc_id in (5, 6, 7)][0::3] == ["en", "en"] and found[5].lang_pred == "fr"
    assert all(r.lang_pred in ("de", "en", "es", "fr") and 0 <= r.score <= 1 for r in found[3:])


def test_languages_without_or_with_few_rows(spark):
    schema = "doc_id long, text string, lang string"
    none = spark.createDataFrame([(1, "a", None), (2, None, "en")], schema)
    assert language_id.fit_languages(none, F.lit(True)) is None
    assert [tuple(r)[:3] for r in language_id.predict_languages(none, None).orderBy("doc_id").collect()] == [(1, "und", 0.0), (2, "und", 0.0)]
    one = language_id.fit_languages(spark.createDataFrame([(1, "abc", "en")], schema), F.lit(True))
    assert [r.lang_pred for r in language_id.predict_languages(none, one).orderBy("doc_id").collect()] == ["en", "und"]
    two = spark.createDataFrame([(i, ("abc abd " if i % 2 else "xyz xyw ") * 5 + str(i), "ab" if i % 2 else "xy") for i in range(40)], schema)
    model = language_id.fit_languages(two, F.lit(True))
    assert language_id.predict_languages(two, model).join(two, "doc_id").where("lang = lang_pred").count() == 40


def test_bits_against_plain_counts(spark):
    """Weights and margins of a tiny corpus, n-gram by n-gram."""
    rows = [(0, "Ab, c!", "p"), (1, "abba éa", "q"), (2, "ab  ab", "r")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    source = docs.select("text", "lang")
    (batch,) = source.toArrow().combine_chunks().to_batches()
    norm = ["".join(c if c.isalpha() else " " for c in r[1].lower()) for r in rows]
    norm = [" " + " ".join(t.split(" ")).replace("  ", " ").strip(" ") for t in norm]
    grams = []
    for text in norm:
        raw = text.encode() + b" "
        grams.append(Counter(raw[i : i + n] for n in language_id.ORDERS for i in range(len(raw) - n + 1)))
    number = Counter()
    bucket_of = {}
    for bucket, text in language_id.ngram_buckets(*language_id.letters_and_spaces(batch, "text")):
        for t, b in zip(text.tolist(), bucket.tolist()):
            number[t] += 1
            bucket_of.setdefault(t, Counter())[b] += 1
    assert all(abs(number[t] - sum(g.values())) <= len(language_id.ORDERS) for t, g in enumerate(grams))
    assert bucket_of[0] == bucket_of[3] and bucket_of[0] != bucket_of[1]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 20])
def test_codewords_differ(n):
    code = language_id.codebook(n)
    assert code.shape[0] == n and all(0 < c.sum() < n for c in code.T)
    least = min((int((code[i] != code[j]).sum()) for i in range(n) for j in range(i)), default=0)
    assert least == language_id._least_distance(code) and (n < 2 or least >= 2 ** (n - 2) or n > 5 and least >= 5)


def test_loss_weighted_decoding():
    code = language_id.codebook(4)
    model = language_id.LanguageModel(list("abcd"), code, np.zeros((7, 1)), np.ones(7), np.zeros(7), np.full((4, 7), 1 / 7))
    margins = np.where(code > 0, 6.0, -6.0)
    best, _, score, ambiguous = model.decode(margins)
    assert best.tolist() == [0, 1, 2, 3] and (score > 0.9).all() and not ambiguous.any()
    flipped = margins.copy()
    flipped[:, 2] *= -1  # one wrong bit is corrected
    assert model.decode(flipped)[0].tolist() == [0, 1, 2, 3]
    assert model.decode(np.zeros((1, 7)))[3].all()  # undecided bits
    distrust = np.full((4, 7), 1.0)
    distrust[:, 2] = 0.01
    model.loss_weights = distrust / distrust.sum(1, keepdims=True)
    assert model.decode(flipped)[2].min() > 0.9  # a bit that is often wrong hardly counts


def test_frequent_units_stay_and_new_ones_are_encoded_together(monkeypatch):
    from dividax.llm import alignment as A

    odd = ["", "a", " ", "  x  y ", "ﬁ ① Å é x y", "<|endoftext|> a <s> </s>", "日本語 テスト a b", "😀 a 😀", "\t\n a", "a\x00b c", "▁ x ▁y", "é È ɏ z", "İ ½ ² a"]
    pair = A.Pair(A.BYTE_LEVEL, A.PIECES)
    sent, encode = [], pair.a.encode_batch_fast

    class Counted:
        def encode_batch_fast(self, texts, **how):
            sent.append(len(texts))
            return encode(texts, **how)

    pair.a = Counted()
    pair.encode([" ".join(f"word{i}" for i in range(320))])
    assert sum(sent) <= 20  # units of a run go together
    monkeypatch.setattr(A, "STORE_MOST", 100)
    for turn in range(4):
        texts = [f"the of the of u{turn}-{i} the {o}" for i, o in enumerate(odd * 8)] + odd
        found, alone = A.Aligned(pair, [t.encode() for t in texts]), A.Aligned(A.Pair(A.BYTE_LEVEL, A.PIECES), [t.encode() for t in texts])
        assert all((getattr(found, n) == getattr(alone, n)).all() for n in ("a", "b", "n_a", "n_b", "cut_a", "cut_b"))
    pair.drop_rare()
    assert "the of" not in pair.known and {"the", "of"} <= set(pair.known) and len(pair.known) <= 50
    again = A.Aligned(pair, [b"the of the"])
    assert again.digests() == A.Aligned(A.Pair(A.BYTE_LEVEL, A.PIECES), [b"the of the"]).digests()
