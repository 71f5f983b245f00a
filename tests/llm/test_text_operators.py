"""Small tests of the operators on texts against brute force: nulls, empties, ties, repeats, clashing columns."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import Row
from pyspark.sql import functions as F

from caselattice.llm import bpe, common, decontaminate, line_dedup, lm_score, ngram_join, quality, secret_scan, toxicity

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, node string"


def frame(spark, texts, first=0, source="s"):
    rows = [(first + i, t, "en", f"{source}{i % 3}", len(t or ""), 0.5, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def lower(text):
    return (text or "").encode().translate(bytes(range(256)).lower())


def shingles(text, size=5):
    words = lower(text).split()
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))} if words else set()


def sentence(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def odd_texts(rnd):
    return [None, "", " \t\n", "one", "Two words", "a b c d", "a b c d e", "é" * 50, sentence(rnd, 30_000, 5000), "x" * 5000, "\n\n\n", "<>&#*$%|"]


@pytest.fixture(scope="module")
def reference_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(spark, reference_encoding):
    rnd = random.Random(3)
    texts = odd_texts(rnd)[:8] + ["".join(rnd.choice("abé中 \n'stх1　😀") for _ in range(rnd.randrange(200))) for _ in range(60)] + ["<|endoftext|> it's", "qz" * 400]
    found = bpe.encode(frame(spark, texts), RANKS, public_tokenizers.PATTERN, outputs=("ids", "n_tokens", "ids_sha256", "decoded", "decoded_sha256"))
    assert "score" in found.columns
    for r in found.collect():
        ids = reference_encoding.encode_ordinary(texts[r.doc_id] or "")
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert bytes(r.decoded) == (texts[r.doc_id] or "").encode()
    back = bpe.decode(found.select("doc_id", "ids"), RANKS)
    assert all(bytes(r.decoded) == (texts[r.doc_id] or "").encode() for r in back.collect())


def test_bpe_appends_and_edits(reference_encoding):
    rnd = random.Random(1)
    encoder = bpe.PrefixEncoder(bpe.read_ranks(open(RANKS, "rb").read()))
    for _ in range(100):
        text = bpe.EncodedText(encoder, public_tokenizers.PATTERN, "".join(rnd.choice("ab \n'sé1 x") for _ in range(rnd.randrange(40))))
        for _ in range(5):
            i = rnd.randint(0, len(text.text))
            j = rnd.randint(i, min(len(text.text), i + 4))
            text.edit(i, j, "".join(rnd.choice("ab \n'sé1 ") for _ in range(rnd.randrange(5))))
            text.append(rnd.choice(["", "ing", " the", "  "]))
            assert text.ids() == reference_encoding.encode_ordinary(text.text)
    piece = b" unbelievable"
    last = []
    for k in range(1, len(piece) + 1):
        encoder.extend(piece[:k], last)
        assert list(encoder.tokens(last)) == reference_encoding.encode_ordinary(piece[:k].decode())


def test_bpe_keeps_what_is_used(reference_encoding, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 40)
    rnd = random.Random(67)
    encoder = bpe.PrefixEncoder(bpe.read_ranks(open(RANKS, "rb").read()))
    for _ in range(60):
        pieces = [["often", " the"] + ["".join(rnd.choice("abcdé ") for _ in range(rnd.randrange(1, 9))) for _ in range(15)]]
        known = encoder.learn(pieces)
        assert all(list(known[p]) == reference_encoding._encode_single_piece(p.encode()) for p in pieces[0])
        assert len(encoder._pieces) + len(encoder._older) <= 40 + 2 * 17 and "often" in encoder._pieces
    assert list(encoder.encode_piece(" unseen")) == reference_encoding._encode_single_piece(b" unseen")


def test_bpe_empty_table(spark):
    assert bpe.encode(frame(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_word_and_shingle_hashes_follow_equality():
    rnd = random.Random(5)
    texts = [lower(t) for t in ["", "a", "A  b", "a\tb c d", "b a", sentence(rnd, 50), "ab cd ef gh ij", "abc d ef gh ij"]]
    words, begins = common.word_hashes(texts)
    seen = {}
    for i, t in enumerate(texts):
        own = t.split()
        assert begins[i + 1] - begins[i] == len(own)
        for w, h in zip(own, words[begins[i] : begins[i + 1]]):
            assert seen.setdefault(w, h) == h
    assert len(set(map(int, seen.values()))) == len(seen)
    hashes, offsets = common.shingle_hashes(words, begins)
    for i, t in enumerate(texts):
        assert len(set(map(int, hashes[offsets[i] : offsets[i + 1]]))) == len(shingles(t.decode()))


def test_quality_counts(spark):
    rnd = random.Random(7)
    texts = odd_texts(rnd) + [sentence(rnd, 12) + " " + "p q r s t u v w x " * 3, "l one\nl one\n l one\nl one", "ab! " * 40] + [sentence(rnd, 60) for _ in range(30)]
    got = {r.doc_id: r for r in quality.quality_filter(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        w = WORD.findall(t or "")
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        windows = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = {j for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
        expected = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
        assert not (r.kept and r.base_failed)
    assert all(got[i].kept for i in range(len(texts) - 30, len(texts)))
    assert quality.quality_filter(frame(spark, [])).count() == 0
    lost = frame(spark, texts[-30:]).withColumn("lang", F.lit(None).cast("string")).withColumn("source", F.lit(None).cast("string"))
    assert quality.quality_filter(lost).where("kept").count() == 30


def test_quality_without_a_passing_row(spark):
    rows = quality.quality_filter(frame(spark, [None, "", "too short", "a b " * 50])).collect()
    assert len(rows) == 4 and all(r.base_failed and not r.kept and not r.failed_rules for r in rows)


def brute_fences(values, groups, prior, spread):
    """Fences of one measure by sorted lists: percentiles of a group, drawn to its language's and these to all rows'."""
    rounded = [1.01 ** math.ceil(math.log(v) / math.log(1.01)) if v > 0 else 0.0 for v in values]

    def found(keep):
        own = sorted(v for v, g in zip(rounded, groups) if keep(g))
        return len(own), [own[math.ceil(len(own) * q / 100) - 1] for q in (10, 50, 75)]

    out, (_, top) = {}, found(lambda g: True)
    for group in set(groups):
        n, own = found(lambda g: g == group)
        m, lang = found(lambda g: g[0] == group[0])
        low, mid, high = ((n * a + prior * (m * b + prior * c) / (m + prior)) / (n + prior) for a, b, c in zip(own, lang, top))
        width = spread * max(mid - low, 1.9 * (high - mid))
        out[group] = (mid - width, mid + width)
    return out


def test_quality_verdicts_equal_brute_force(spark):
    rnd = random.Random(47)
    rows = []
    for i in range(400):
        words = sentence(rnd, rnd.randrange(15, 200), 3000).split()
        for _ in range(rnd.choice([0, 0, 0, 1, 2, 60])):
            words[rnd.randrange(len(words))] = rnd.choice(["#", "!!", "WORD", "x" * 30, words[0]])
        rows.append((i, " ".join(words), rnd.choice(["en", "de", None]), rnd.choice(["a", "b"]) if i % 9 else f"rare{i % 4}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.quality_filter(docs, prior_rows=30, spread=3, errors=2).collect()}
    passing = [r for r in got.values() if not r.base_failed]
    groups = [(r.lang, r.source) for r in passing]
    fences = {m: brute_fences([r[m] for r in passing], groups, 30, 3) for m in quality.MEASURES}
    n_failed = 0
    for r, group in zip(passing, groups):
        text = rows[r.doc_id][1]
        n, chars = len(text.split()), len(text.replace(" ", ""))
        pairs = sum(a == b for a, b in zip(text.split(), text.split()[1:]))
        counted = {
            "symbol_ratio": (text.count("#"), n, 1), "dup_line_ratio": (0, 1, 1), "repeat_ratio": (r.n_repeat_words, n, 16), "echo_ratio": (pairs, n, 1),
            "upper_ratio": (sum(c.isupper() for c in text), chars, 1), "mark_ratio": (text.count("!"), n, 1),
        }
        expected = {f"high_{m}" for m, (c, of, unit) in counted.items() if c / of - 2 * math.sqrt(c * unit) / of > fences[m][group][1]}
        mean = chars / n
        strays = 2 * mean / (2 * math.sqrt(n))
        low, high = fences["mean_word_chars"][group]
        expected |= {"high_mean_word_chars"} if mean - strays > high else {"low_mean_word_chars"} if mean + strays < low else set()
        assert set(r.failed_rules) == expected and r.kept == (not expected)
        n_failed += bool(expected)
    assert 0 < n_failed < len(passing) / 2


def test_quality_fences_follow_the_group(spark):
    """A source whose texts have symbols keeps them, though its median is 0; an outlier of a narrow one goes."""
    rnd = random.Random(37)
    body = lambda: sentence(rnd, 100, 3000)
    code = [body() + (" a|b" * rnd.randrange(40, 61) if i % 5 < 2 else "") for i in range(150)]
    prose = [" ".join("A" + w if k % 50 == 0 else w for k, w in enumerate(body().split())) for _ in range(150)]
    shouted = " ".join(w.upper() if k % 2 else w for k, w in enumerate(body().split()))
    texts = [(t, "code") for t in [*code, body() + " ||||||" * 3000]] + [(t, "prose") for t in [*prose, shouted]]
    docs = spark.createDataFrame([(i, t, "en", s) for i, (t, s) in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: list(r.failed_rules) for r in quality.quality_filter(docs, repeat_percent=100).collect()}
    assert all(not got[i] for i in range(150)) and "high_symbol_ratio" in got[150]
    assert all(not got[i] for i in range(151, 301)) and got[301] == ["high_upper_ratio"]


def brute_lines(texts, sources, min_sites, min_words=3, copy_percent=None):
    sites = collections.defaultdict(set)
    for t, s in zip(texts, sources):
        for line in (t or "").split("\n"):
            b = line.strip(" \t\n\x0b\f\r")
            if len(WORD.findall(b)) >= min_words:
                sites[b].add(s or "")
    spread = {b for b, s in sites.items() if len(s) >= min_sites}
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        hit = [x.strip(" \t\n\x0b\f\r") in spread for x in lines]
        words = sum(len(WORD.findall(x)) for x in lines)
        copy = copy_percent is not None and 100 * sum(len(WORD.findall(x)) for x, h in zip(lines, hit) if h) > copy_percent * words
        out.append((sum(hit), copy, t if copy or not any(hit) else "\n".join(x for x, h in zip(lines, hit) if not h)))
    return out


def test_line_spread(spark):
    rnd = random.Random(11)
    common_lines = [sentence(rnd, 4) for _ in range(6)]
    texts = [None, "", "\n"] + ["\n".join([sentence(rnd, 9), rnd.choice(common_lines), sentence(rnd, 6), " " + rnd.choice(common_lines), sentence(rnd, 8)]) for _ in range(60)] + [common_lines[0]] * 3
    sources = [rnd.choice(["a", "b", "c", "d", None]) for _ in texts]
    docs = spark.createDataFrame([(i, t, s, 1) for i, (t, s) in enumerate(zip(texts, sources))], "doc_id long, text string, source string, n_spread int")
    for percent in (None, 50, 80):
        got = {r.doc_id: (r.n_spread, r.is_copy, r.text) for r in line_dedup.remove_boilerplate(docs, min_sites=4, copy_percent=percent).collect()}
        for i, expected in enumerate(brute_lines(texts, sources, 4, copy_percent=percent)):
            assert got[i] == expected
    nameless = docs.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id") % 8).cast("string"))
    assert sorted(str(r.text) for r in line_dedup.remove_boilerplate(nameless, min_sites=4).collect()) == sorted(str(e[2]) for e in brute_lines(texts, sources, 4))
    assert line_dedup.remove_boilerplate(docs.limit(0)).count() == 0


def test_sketch_band_is_settled_exactly(spark):
    rows = [(i, f"one two three {k}\nfiller {i} here", f"site{i}") for k, n in enumerate((95, 99, 100, 101, 140)) for i in range(1000 * k, 1000 * k + n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.text.split("\n")[0] for r in line_dedup.remove_boilerplate(docs.unionByName(docs), min_sites=100).collect() if r.n_spread == 0}
    assert got == {"one two three 0", "one two three 1"}


def test_containment_search_equals_brute_force(spark):
    rnd = random.Random(13)
    items = [sentence(rnd, n, 3000) for n in (5, 6, 9, 12, 20, 33, 34, 60, 61, 120, 200)] + ["one two", "", None, "One  TWO"]
    texts = odd_texts(rnd)
    for i, item in enumerate(items[:11]):
        words = item.split()
        edited = list(words)
        edited[len(words) // 2] = "changed"
        for body in (words, edited, [w.upper() for w in words], words[: len(words) * 9 // 10]):
            for before in (0, 40, 3000):
                texts.append(f"{sentence(rnd, before, 3000)}\n{' '.join(body)}\t{sentence(rnd, 50 * (i % 3), 3000)}")
    texts += ["one two", "ONE two "]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in decontaminate.find_leaks(frame(spark, texts), bench).collect()}
    blocked = decontaminate.find_leaks(frame(spark, texts), bench, block_bytes=500)
    assert {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in blocked.collect()} == got
    expected = set()
    for d, t in enumerate(texts):
        own = shingles(t)
        for k, item in enumerate(items):
            want = shingles(item)
            if want and len(own & want) >= 0.8 * len(want):
                expected.add((d, k, len(want), len(own & want)))
    assert got == expected
    assert decontaminate.find_leaks(frame(spark, []), bench).count() == 0
    assert decontaminate.find_leaks(frame(spark, texts), bench.limit(0)).count() == 0


def brute_classes(texts, threshold=0.8):
    sets = [shingles(t) for t in texts]
    links = collections.defaultdict(set)
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= threshold * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                links[i].add(j)
                links[j].add(i)
    cls = list(range(len(sets)))
    changed = True
    while changed:
        changed = False
        for i in links:
            low = min(cls[j] for j in links[i] | {i})
            if low < cls[i]:
                cls[i], changed = low, True
    rep = [min([j for j in range(len(sets)) if sets[j] == sets[i]] or [i]) if sets[i] else i for i in range(len(sets))]
    return {i: (cls[i], rep[i], len(links[i])) for i in range(len(sets))}


def edited(rnd, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"e{rnd.randrange(10**6)}"
    return " ".join(words)


def test_similarity_classes_equal_brute_force(spark, monkeypatch):
    rnd = random.Random(17)
    base = [sentence(rnd, n) for n in (8, 40, 120, 300, 2000)]
    texts = odd_texts(rnd)
    for b in base:
        texts += [b, b.upper(), b.replace(" ", "\n")] + [edited(rnd, b, k) for k in (1, 1, 2, 3, 4, 6, 9) for _ in range(2)]
    shared = sentence(rnd, 60)
    texts += [shared + " " + sentence(rnd, n) for n in range(2, 120, 2)]
    texts += [edited(rnd, base[3], 2) for _ in range(90)]  # a group larger than a leaf
    monkeypatch.setattr(ngram_join, "LEAF", 8)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    got = {r.doc_id: (r.class_id, r.rep_id, r.n_links) for r in ngram_join.similarity_classes(frame(spark, texts)).collect()}
    assert got == brute_classes(texts)


def test_similarity_of_repeated_and_missing_rows(spark):
    text = "a b c d e f g"
    rows = spark.createDataFrame([(1, text), (1, text), (2, text), (3, None), (4, ""), (5, "z y x w v")], "doc_id long, text string")
    got = sorted(tuple(r) for r in ngram_join.similarity_classes(rows).collect())
    assert got == [(1, 1, 1, 2), (1, 1, 1, 2), (2, 1, 1, 2), (3, 3, 3, 0), (4, 4, 4, 0), (5, 5, 5, 0)]
    assert ngram_join.similarity_classes(rows.limit(0)).count() == 0


def test_runs_reach_the_recall():
    f = 1.0
    for _ in range(60):
        f = 1 - (1 - 0.8 * f) ** 2
    assert (1 - f) ** ngram_join.runs_needed(0.8, 0.9999) <= 1e-4


def test_components(spark):
    rnd = random.Random(19)
    edges = [(i, i + 1) for i in range(0, 40)] + [(rnd.randrange(100, 200), rnd.randrange(100, 200)) for _ in range(70)] + [(500, x) for x in range(501, 560)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(x, x) == find(x) for x in list(parent))


def test_context_trees_equal_one_table(spark):
    rnd = random.Random(23)
    texts = odd_texts(rnd)[:8] + [sentence(rnd, rnd.randrange(80)).upper() for _ in range(60)]
    docs = frame(spark, texts)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2
    got = {r.doc_id: r for r in lm_score.score(docs.repartition(3), held, shard_bytes=500, owner_bytes=50).collect()}
    own = [lower(t) for t in texts]
    learnt = np.array([zlib.crc32(str(i).encode()) % 7 != 2 for i in range(len(texts))])
    grams, lengths = lm_score.byte_grams(own, 5)
    values, counts = np.unique(grams[np.repeat(learnt, lengths)], return_counts=True)
    levels = lm_score.build_levels(values, counts, 5, 0)
    scores = np.bincount(np.repeat(np.arange(len(own)), lengths), lm_score.log10_bytes(grams, levels))
    counter = collections.Counter()
    for t, ok in zip(own, learnt):
        if ok:
            counter.update([*t.split(), None])
    n, v = sum(counter.values()), len(counter)
    for i, t in enumerate(own):
        words = [*t.split(), None]
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(words), sum(counter[w] > 0 for w in words), n, not learnt[i])
        assert r.base_score == pytest.approx(sum(np.log10((counter[w] + 1) / (n + v + 1)) for w in words))
        assert r.score == pytest.approx(scores[i], rel=1e-4)
    # all continuations of one context sum to one
    context = _context(own[9], 5)
    every = np.array([context << 8 | b for b in range(256)], np.uint64)
    assert (10 ** lm_score.log10_bytes(every, levels)).sum() == pytest.approx(1)


def _context(text, depth):
    return int.from_bytes(text[:depth].rjust(depth, lm_score.BEFORE), "big")


def test_context_trees_weigh_like_the_definition():
    """One root with two contexts: mixture of its own estimate and its children's, by direct products."""
    bits = [(0, 1), (0, 1), (1, 0), (0, 1), (1, 0), (1, 1)]

    def kt(sequence):
        n, p = [0, 0], 1.0
        for b in sequence:
            p *= (n[b] + 0.5) / (sum(n) + 1)
            n[b] += 1
        return p

    own = kt([b for _, b in bits])
    children = kt([b for c, b in bits if c == 0]) * kt([b for c, b in bits if c == 1])
    below = lm_score.Level(np.array([1, 257], np.uint64), np.array([0.0, 2.0]), np.array([3.0, 1.0]), None)
    keys, weighted = below.parents(1)
    top = lm_score.Level(np.array([1], np.uint64), np.array([2.0]), np.array([4.0]), (keys, weighted))
    assert np.exp(top.weighted[0]) == pytest.approx(0.5 * own + 0.5 * children)
    assert top.share[0] == pytest.approx(own / (own + children))


def brute_trees(texts, depth):
    """log10 of a text's bytes and end under context trees learnt from ``texts``, node by node."""

    def decisions(text):
        whole = b"\xfe" * depth + text + b"\xff"
        for i in range(depth, len(whole)):
            for k in range(8):
                yield whole[i - depth : i], f"{whole[i]:08b}"[:k], int(f"{whole[i]:08b}"[k])

    counts = collections.defaultdict(lambda: [0, 0])
    for t in texts:
        for context, bits, one in decisions(t):
            for d in range(depth + 1):
                counts[context[depth - d :], bits][one] += 1
    below = collections.defaultdict(list)
    for context, bits in counts:
        if context:
            below[context[1:], bits].append((context, bits))

    def kt(zeros, ones):
        steps = [(i + 0.5) / (i + 1) for i in range(zeros)] + [(i + 0.5) / (zeros + i + 1) for i in range(ones)]
        return math.fsum(map(math.log, steps))

    weights, shares = {}, {}
    for node in sorted(counts, key=lambda n: -len(n[0])):
        own = kt(*counts[node])
        if len(node[0]) == depth:
            weights[node], shares[node] = own, 1.0
        else:
            rest = math.fsum(weights[c] for c in below[node])
            top = max(own, rest)
            weights[node] = top + math.log(0.5 * math.exp(own - top) + 0.5 * math.exp(rest - top))
            shares[node] = math.exp(own - top) / (math.exp(own - top) + math.exp(rest - top))

    def score(text):
        total = 0.0
        for context, bits, one in decisions(text):
            p = None
            for d in range(depth, -1, -1):
                node = (context[depth - d :], bits)
                if node in counts:
                    n = counts[node]
                    own = (n[one] + 0.5) / (sum(n) + 1)
                    p = own if p is None else shares[node] * own + (1 - shares[node]) * p
            total += math.log10(0.5 if p is None else p)
        return total

    return score


def test_context_trees_equal_brute_force(spark):
    rnd = random.Random(59)
    texts = [None, "", "a", "a\0", "a\0\0", "\0", "é中", "Ab ab AB"] + [" ".join(rnd.choice(["ab", "abc", "cab", "b\0c", "ü"]) for _ in range(rnd.randrange(12))) for _ in range(30)]
    docs = frame(spark, texts)
    for depth in (2, 3):
        got = {r.doc_id: r for r in lm_score.score(docs.repartition(4), F.col("doc_id") % 5 == 2, depth=depth, shard_bytes=60, owner_bytes=50).collect()}
        expected = brute_trees([lower(t) for i, t in enumerate(texts) if i % 5 != 2], depth)
        assert len(got) == len(texts)
        for i, t in enumerate(texts):
            assert got[i].score == pytest.approx(expected(lower(t)), rel=1e-5)


def test_scores_without_rows_or_training(spark):
    assert lm_score.score(frame(spark, []), F.lit(False)).count() == 0
    rows = lm_score.score(frame(spark, ["ab", None]), F.lit(True)).orderBy("doc_id").collect()
    assert [r.n_known for r in rows] == [0, 0] and rows[0].score == pytest.approx(-3 * 8 * np.log10(2), rel=1e-6) and rows[0].train_tokens == 0


def test_toxicity_learns_and_takes_odd_rows(spark):
    rnd = random.Random(29)
    bad = ["vilgor", "snurk", "blatha"]
    texts, toxic = [], []
    for i in range(600):
        words = sentence(rnd, 60, 3000).split()
        t = i % 6 == 0
        if t:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(bad) + rnd.choice(["", "a", "os", "um"]))
        texts.append(" ".join(words))
        toxic.append(int(t))
    docs = frame(spark, texts + [None, "", "x" * 3000, "you idiot"])
    labels = spark.createDataFrame([(i, y) for i, y in enumerate(toxic)] + [(0, toxic[0]), (10**9, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    rows = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((rows[i] >= 0.3) == bool(toxic[i]) for i in held) >= 0.98 * len(held)
    assert all(0 <= s <= 1 for s in rows.values()) and rows[600] == rows[601] < 0.3
    empty = toxicity.fit(frame(spark, []), labels.limit(0))
    assert toxicity.score(frame(spark, ["a", None]), empty).count() == 2


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.2
    on1, on0 = np.array([0.7, 0.5, 0.6, 0.6]), np.array([0.02, 0.01, 0.05, 0.05])
    votes = (rng.random((4000, 4)) < np.where(y[:, None], on1, on0)).astype(float)
    votes[:, 3] = votes[:, 2]  # a copy of another voter
    model = toxicity.LabelModel(votes, np.ones(4000), np.where(votes.sum(axis=1) > 0, 0.9, 0.01))
    assert np.abs(model.on1[:2] - on1[:2]).max() < 0.1 and model.weight[3] < 0.7 < model.weight[0]
    assert ((model.post > 0.5) == y).mean() > 0.9


def test_secrets(spark):
    key, token = "AKIA" + "4QZ7XMP2LW9VT3RB", hashlib.sha1(b"z").hexdigest()
    texts = [None, "", f"prose with {key} inside", f'token = "{token}" end', f"commit: {token} end", "order 4929381723450011 paid", "internationalizationing words only", "placeholder xxxxxxxxxxxxxxxxxxxx0", f"password={hashlib.md5(b'q').hexdigest()[:18]} x", f"{key} {key}"]
    docs = frame(spark, texts)
    rows = secret_scan.scan(docs).collect()
    judged = collections.defaultdict(list)
    for r in rows:
        judged[r.doc_id].append(r.is_secret)
    assert judged[2] == [True] and judged[3] == [True] and judged[8] == [True] and judged[9] == [True, True]
    assert judged[4] == [False] and judged[5] == [False] and judged[7] == [False] and 6 not in judged and 0 not in judged
    assert secret_scan.scan(frame(spark, [])).count() == 0
    own = secret_scan.labelled_findings(spark, 800)
    again = secret_scan.scan(docs, labelled=own).collect()
    assert sorted((r.doc_id, r.position) for r in again) == sorted((r.doc_id, r.position) for r in rows)
    assert sorted(map(str, secret_scan.scan(docs, labelled=own).collect())) == sorted(map(str, again))


def test_secrets_by_context_and_blocks(spark):
    body = ["MIIEpAIBAAKCAQEA0Z3VS5JJcds3xfn/ygWyF8PbnGy0AHB7MaXFvSrq1eP2", "bU9i9f8q9A=="]
    block = lambda name: f"x\n-----BEGIN {name}-----\n" + "\n".join(body) + f"\n-----END {name}-----\ny"
    texts = ['password: "Tr0ub4dor&3" x', "password: required", block("RSA PRIVATE KEY"), block("CERTIFICATE"), "pwd=hunter2x9!, and key=id", "-----BEGIN nothing", 'token="${TOK}"', "auth: =", "note: 12345x!", "passwd = abc"]
    got = collections.defaultdict(dict)
    for r in secret_scan.scan(frame(spark, texts)).collect():
        got[r.doc_id][r.candidate] = r.is_secret
    assert got[0] == {"Tr0ub4dor&3": True} and got[1] == {"required": False} and got[4] == {"hunter2x9!": True} and got[6] == {"${TOK}": False}
    assert got[2]["".join(body)] and not got[3]["".join(body)] and not any(got[i] for i in (5, 7, 8, 9))
    rows = {(r.doc_id, r.position, r.candidate, r.key) for r in secret_scan.candidates(frame(spark, texts), least=3).collect()}
    assert {(0, 1, "Tr0ub4dor&3", '"'), (2, 1, "".join(body), "RSA PRIVATE KEY-----:"), (4, 0, "hunter2x9!", "pwd="), (9, 2, "abc", "")} <= rows


def test_findings_left_out_of_the_forest(spark):
    pieces = secret_scan.dictionary(frame(spark, ["the data file of the user", None]))
    found = secret_scan.held_out(secret_scan.labelled_findings(spark, 2000), pieces).first()
    assert 300 < found.n < 500 and found.precision > 0.95 and found.recall > 0.95
    with pytest.raises(ValueError):
        secret_scan.train(secret_scan.labelled_findings(spark, 100).limit(0), pieces)


def test_toxic_evidence_equals_brute_force(spark):
    """Shared passages count once, near copies of a label teach once, and all stems are tested."""
    rnd = random.Random(61)
    passage, copied = sentence(rnd, 30, 3000), sentence(rnd, 60, 3000)
    texts = [sentence(rnd, 40, 3000) + (" " + passage if i % 3 == 0 else "") + (f" vilgor{i % 4}" if i % 2 else "") for i in range(40)] + [copied, copied, edited(rnd, copied, 1), None, "", "few words"]
    rows = spark.createDataFrame([(t, i, 1) for i, t in enumerate(texts)], "text string, __row long, __y int")
    seen, own = set(), []
    for t in texts:
        words = lower(t).decode().split()
        grams = [tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))] if words else []
        gone = {j for i, g in enumerate(grams) if g in seen for j in range(i, i + 5)}
        own.append(" ".join(w for j, w in enumerate((t or "").split()) if j not in gone))
        seen.update(grams)
    assert sorted(r.text for r in toxicity._own_words(rows).collect()) == sorted(own)
    apart = {r["__row"] for r in toxicity._apart(rows).collect()}
    assert apart == set(range(len(texts))) - {41, 42, 44}
    assert {r["__row"] for r in toxicity._apart(rows.withColumn("__y", F.col("__row").cast("int") % 2)).collect()} >= {40, 41}
    clean = [sentence(rnd, 40, 3000) for _ in range(200)]
    mined = toxicity.mine_stems(rows.select("text"), spark.createDataFrame([(t,) for t in clean], "text string"), len(texts), len(clean), most=50)
    on = lambda docs, name: sum(name in toxicity.features_of(set(toxicity.words_of(t))) for t in docs)
    assert mined and all((t, c) == (on(texts, name), on(clean, name)) for name, t, c in mined) and any(name.startswith("vilgor") for name, _, _ in mined)


def test_sparse_rows_equal_dense_ones():
    rng = np.random.default_rng(3)
    sets, dense = [sorted(rng.choice(7, rng.integers(0, 5), replace=False).tolist()) for _ in range(9)], rng.random((9, 2))
    full = np.hstack([[[float(c in s) for c in range(7)] for s in sets], dense])
    table, w, r = toxicity.Sparse(sets, 7, dense), rng.random(9), rng.random(9)
    assert np.allclose(table.times(w), full @ w) and np.allclose(table.transposed_times(r), full.T @ r)
    assert np.allclose(table.square_sums(), (full**2).sum(axis=1)) and np.allclose(table.first_columns(4), full[:, :4])
