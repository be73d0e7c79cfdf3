"""Each operator against a brute-force version on small tables with nulls, empty texts, copies,
rows that repeat an id and further columns."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnmill.llm import chat_format, context_tree, linking, personal_data, quality, url_filter
from turnmill.llm.components import connected_components
from turnmill.llm.decontamination import find_contamination, is_contaminated, remove_hit_spans
from turnmill.llm.jaccard_join import jaccard_components
from turnmill.llm.pieces import (
    MARKER,
    Encoder,
    Piece,
    build_model,
    decode,
    decode_pieces,
    encode_pieces,
    piece_digests,
)
from turnmill.llm.queries import URL_RULES
from turnmill.llm.substring_dedup import repeated_passages

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "Über", "x.y"]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    texts = [None, "", " \t\n", "one", "ONE", "a b c", "a b c d e", "A b\tc d  e"]
    for _ in range(12):
        own = words(rng.randint(60, 140))
        texts.append(" ".join(own))
        for _ in range(rng.randint(1, 4)):
            near = list(own)
            for _ in range(rng.randint(0, 4)):
                near[rng.randrange(len(near))] = rng.choice(vocabulary)
            texts.append(" ".join(near))
    texts += [texts[9], "z " * 3000]
    rows = [(i, text, "clash") for i, text in enumerate(texts)]
    return [*rows, (None, "a b c d e", "clash"), (5, "another text with this id", "clash")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), "doc_id long, text string, node string")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, node string")


def shingles(text):
    words = SPACED.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def components(sets, ids):
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    least = {}
    for own, i in zip(label, ids, strict=True):
        least[own] = min((x for x in (least.get(own), i) if x is not None), default=None)
    return [least[own] for own in label]


def test_jaccard_components_are_those_of_all_pairs(docs):
    rows = corpus()
    sets = [shingles(text) for _, text, _ in rows]
    expected = [
        (i, len(s), c if s else i)
        for (i, _, _), s, c in zip(rows, sets, components(sets, [r[0] for r in rows]), strict=True)
    ]
    found = [tuple(row) for row in jaccard_components(docs).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_no_rows_give_no_rows(spark, none):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert jaccard_components(none).count() == 0
    assert repeated_passages(none).count() == 0
    assert find_contamination(none, benchmark).count() == 0
    assert context_tree.score_texts(none).count() == 0
    assert personal_data.find_personal_data(none).count() == 0
    assert quality.filter_quality(none).count() == 0


def test_components_of_a_path_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    labels = {row.node: row.label for row in found.collect()}
    assert labels == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)}


def test_chats_are_read_back_with_their_mask(spark):
    marks = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>", "\\<|", "\\\\", "", None, "é😀\n<s>"]
    turns = [(1, i, "assistant" if i % 2 else "user", text, 9) for i, text in enumerate(marks)]
    turns += [(2, 0, None, "x", 9), (2, 0, None, "x", 9), (None, 0, "a\nb<|im_sep|>", "y", 9)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, place int")
    formatted = chat_format.format_chats(df)
    rows = formatted.select(
        "conv_id", "formatted", "turns", chat_format.read_chat(F.col("formatted")).alias("read"),
        chat_format.masked_text(F.col("formatted"), F.col("turns")).alias("masked"),
    ).collect()
    for row in rows:
        own = [(r or "", t or "") for c, _, r, t, _ in turns if c == row.conv_id]
        assert [tuple(turn) for turn in row.read] == own
        assert row.masked == "".join(t for r, t in own if r == "assistant")
        cut = "".join(row.formatted[s.start : s.end] for s in row.turns if s.loss)
        assert re.sub(r"(?s)\\(.)", r"\1", cut) == row.masked
        assert row.formatted.count("<|im_end|>") == len(own)


def test_content_parts_become_placeholders(spark):
    parts = [
        ("text", "see <|image|>", None, None, None, None, None),
        ("image", None, "a.png", 56, 29, None, None),
        ("audio", None, "b.wav", None, None, 2.5, None),
        (None, "end", None, None, None, None, None),
        ("document", None, "c.pdf", None, None, None, 3),
        ("video", None, "d", None, None, None, None),
    ]
    df = spark.createDataFrame([(1, 0, "user", parts), (2, 0, "user", None)], f"conv_id long, turn long, role string, parts {chat_format.PARTS.simpleString()}")
    row, empty = chat_format.format_chats(df).orderBy("conv_id").collect()
    assert row.formatted == "<|im_start|>user<|im_sep|>see <\\|image|><|image|><|audio|>end<|document|><|attachment|><|im_end|>\n"
    assert [(a.type, a.ref, a.tokens) for a in row.attachments] == [
        ("image", "a.png", 5), ("audio", "b.wav", 63), ("document", "c.pdf", 1536), ("video", "d", 1)
    ]
    assert row.attachment_tokens == 1605
    assert empty.attachments == []


def test_scores_are_those_of_counts_and_a_distribution(docs):
    rows = corpus()
    held = [zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i, _, _ in rows]
    tokens = [[*SPACED.findall((t or "").translate(LOWER)), None] for _, t, _ in rows]
    counts = Counter(word for own, out in zip(tokens, held, strict=True) if not out for word in own)
    total, different = sum(counts.values()), len(counts)
    expected = [
        (i, out, len(own), sum(counts[w] > 0 for w in own), total,
         sum(math.log10((counts[w] + 1) / (total + different + 1)) for w in own))
        for (i, _, _), out, own in zip(rows, held, tokens, strict=True)
    ]
    for limit in (500_000, 5):
        found = context_tree.score_texts(docs, max_frequent=limit).collect()
        assert sorted((tuple(r)[:5] for r in found), key=repr) == sorted((e[:5] for e in expected), key=repr)
        by_key = {(r.doc_id, r.n_tokens): r for r in found}
        assert all(math.isclose(by_key[e[0], e[2]].base_score, e[5], rel_tol=1e-9) for e in expected)
        assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_context_trees_predict_as_sequential_mixing_does():
    """The ratio of weighted probabilities of counts with and without one more bit."""
    rng = np.random.default_rng(1)
    zeros, ones = rng.integers(0, 6, 8), rng.integers(0, 6, 8)

    def weighted(a, b):
        if len(a) == 1:
            return float(context_tree._log_kt(a * 1.0, b * 1.0)[0])
        half = len(a) // 2
        own = float(context_tree._log_kt(np.array([a.sum() * 1.0]), np.array([b.sum() * 1.0]))[0])
        return np.logaddexp(own, weighted(a[:half], b[:half]) + weighted(a[half:], b[half:])) - math.log(2)

    chances = context_tree.weighted_ones(zeros, ones)
    for context in range(8):
        more = ones.copy()
        more[context] += 1
        assert math.isclose(chances[context], math.exp(weighted(zeros, more) - weighted(zeros, ones)), rel_tol=1e-6)


def tree_scores(training, texts):
    """log10 probability of each text, by trees of byte contexts built and mixed node by node."""
    pad = b"\xff" * context_tree.DEPTH

    def steps(text):
        stream = pad + text.encode() + b"\xff"
        for at in range(len(pad), len(stream)):
            past, byte = stream[at - len(pad) : at][::-1], stream[at]
            for bit in range(8):
                yield past, (1 << bit) | (byte >> (8 - bit)), (byte >> (7 - bit)) & 1

    nodes = {}
    for text in training:
        for past, decision, one in steps(text):
            for depth in range(len(pad) + 1):
                nodes.setdefault((decision, past[:depth]), [0, 0])[one] += 1
    below = {}
    for decision, past in nodes:
        if past:
            below.setdefault((decision, past[:-1]), []).append((decision, past))

    def own(node):
        zeros, ones = nodes[node]
        parts = [(math.lgamma(c + 0.5) - math.lgamma(0.5)) for c in (zeros, ones)]
        return sum(parts) - math.lgamma(zeros + ones + 1)

    weighted = {}
    for node in sorted(nodes, key=lambda node: -len(node[1])):
        children = sum(weighted[child] for child in below.get(node, []))
        leaf = len(node[1]) == len(pad)
        weighted[node] = own(node) if leaf else np.logaddexp(own(node), children) - math.log(2)

    def chance(decision, past, depth=0):
        node = (decision, past[:depth])
        if node not in nodes:
            return 0.5
        zeros, ones = nodes[node]
        here = (ones + 0.5) / (zeros + ones + 1)
        if (decision, past[: depth + 1]) not in nodes or depth == len(pad):
            return here
        share = math.exp(own(node) - math.log(2) - weighted[node])
        return share * here + (1 - share) * chance(decision, past, depth + 1)

    def score(text):
        chances = ((one, chance(decision, past)) for past, decision, one in steps(text))
        return math.fsum(math.log10(c if one else 1 - c) for one, c in chances)

    return [score(text) for text in texts]


def test_scores_are_those_of_trees_mixed_node_by_node(spark):
    rng = random.Random(8)
    words = ["then", "other", "Breath", "é😀", "x", "theatre"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(40)]
    rows += [(40, None), (41, "quite different: \u65e5\u672c"), (42, ""), (None, "then other then other"), (3, "then")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = F.coalesce(F.col("doc_id"), F.lit(0)) % 5 == 1
    texts = [t or "" for _, t in rows]
    training = [t for (i, _), t in zip(rows, texts, strict=True) if (i or 0) % 5 != 1]
    expected = sorted(zip((t.encode() for t in texts), tree_scores(training, texts), strict=True))
    for limit in (context_tree.MAX_CODES, 60, 0):
        found = context_tree.score_texts(docs, held, max_codes=limit)
        assert found.count() == len(rows)
        assert np.allclose(sorted(r.score for r in found.collect()), sorted(score for _, score in expected), rtol=1e-5), limit


def test_scores_use_more_than_two_bytes_of_context(spark):
    """What follows "her" depends on the byte before it: 1 bit a text less than by two bytes."""
    rows = [(i, ("ther1" if i % 2 else "pher2") * 40) for i in range(40)] + [(100, "ther1" * 40), (101, "ther2" * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    score = {r.doc_id: r.score for r in context_tree.score_texts(docs, F.col("doc_id") >= 100).collect()}
    assert score[100] > -4 and score[101] < score[100] - 20


def test_held_out_scores_are_near_the_base(spark, sf_dir):
    rows = context_tree.score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).where("held_out")
    score, base = rows.agg(F.sum("score"), F.sum("base_score")).first()
    assert score > 1.2 * base


def test_chances_of_all_bytes_sum_to_one():
    rng = np.random.default_rng(3)
    codes, counts = np.unique(context_tree._codes(rng.integers(97, 101, 3000).astype(np.uint8)), return_counts=True)
    levels = context_tree.subtree_levels(codes, counts)
    for _ in range(context_tree.TOP):
        first = levels[0]
        levels.insert(0, context_tree.level_above(first.keys, first.zeros, first.ones, first.weighted))
    levels = context_tree.mix_down(levels)
    for past in (int(codes[0]) >> 8 << 8, 0x6100000000 << 8, 0x7A7A7A7A7A << 8):
        assert math.isclose((10.0 ** context_tree.code_scores(past + np.arange(256), levels)).sum(), 1, rel_tol=1e-9)


def test_code_table_finds_all_it_has_and_no_other():
    rng = np.random.default_rng(4)
    codes = np.unique(rng.integers(0, 1 << 48, 5000))
    table = context_tree.CodeTable(codes[::2], np.arange(len(codes[::2]), dtype=float))
    scores, missed = table.find(codes)
    assert sorted(missed.tolist()) == list(range(1, len(codes), 2))
    assert (scores[::2] == np.arange(len(codes[::2]))).all() and (scores[1::2] == 0).all()


def test_smaller_block_of_a_pair_meets_the_larger_one(spark):
    sizes = {1: 50, 2: 3, 3: 3, 4: 70}
    rows = [(t, label, 20, 0, 80, 100, 0, 80, size) for t in (1, 2) for label, size in sizes.items()]
    blocks = spark.createDataFrame(
        rows, "token long, label long, band int, place long, least int, most int, first int, rest int, size long"
    )
    pairs = linking._block_pairs(blocks, []).select("token", "label_a", "size_a", "label_b", "size_b").collect()
    assert all((r.size_a, r.label_a) < (r.size_b, r.label_b) for r in pairs)
    found = sorted((r.token, *sorted((r.label_a, r.label_b))) for r in pairs)
    assert found == [(t, a, b) for t in (1, 2) for a in range(1, 5) for b in range(a + 1, 5)]


def test_byte_scores_sum_to_one():
    packed = {1: zlib.compress(np.full(context_tree.CONTEXTS, 0.25, np.float32).tobytes())}
    table = context_tree.byte_scores(packed).reshape(-1, 256)
    assert np.allclose((10.0 ** table[:3]).sum(axis=1), 1, atol=1e-4)


def naive_spans(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for kind, pattern in (
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        found += [(kind, *m.span()) for m in re.finditer(pattern, text) if personal_data.is_valid(kind, m[0])]
    return found


def test_patterns_find_what_plain_search_finds():
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice("ab1.29@_-+( )é") for _ in range(rng.randint(0, 60)))
        assert personal_data.pattern_spans(text) == naive_spans(text), text


def test_field_learns_held_out_lines():
    lines = personal_data.LABELLED
    field = personal_data.train_field(personal_data.labelled_sentences(lines))
    tagger = personal_data.Tagger(field)
    texts = ["ring 555 020 0123 44 tonight", "in 1997 there were 14 of them", "no digits at all", ""]
    spans = [[(k, t[a:b]) for k, a, b in own] for t, (_, own) in zip(texts, personal_data.all_spans(texts, tagger), strict=True)]
    assert spans == [[("phone", "555 020 0123 44")], [], [], []]
    # Accuracy over the table itself: words whose label the best path gives back.
    right = total = 0
    for words, labels in personal_data.labelled_sentences(lines):
        text, at, own = " ".join(words), 0, {}
        for kind, start, end in tagger.spans([text])[0]:
            for place in range(start, end):
                own[place] = kind
        for word, label in zip(words, labels, strict=True):
            right += own.get(at, "O") == (label[2:] or "O")
            total += 1
            at += len(word) + 1
    assert right / total > 0.95


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(2)
    scores, steps = rng.normal(size=(5, 4, 3)), rng.normal(size=(3, 3))
    for chain, labels in zip(scores, personal_data.viterbi(scores, steps), strict=True):
        def value(path, chain=chain):
            total = steps[0, path[0]] + steps[path[-1], 0] + sum(chain[i, x] for i, x in enumerate(path))
            return total + sum(steps[a, b] for a, b in zip(path[:-1], path[1:], strict=True))

        paths = [(a, b, c, d) for a in range(3) for b in range(3) for c in range(3) for d in range(3)]
        assert tuple(labels.tolist()) == max(paths, key=value)


def test_redaction_and_null_texts(spark):
    df = spark.createDataFrame([(1, "mail a.b@c.de now"), (2, None)], "doc_id long, text string")
    rows = personal_data.find_personal_data(df, redacted=True).orderBy("doc_id").collect()
    assert [row.text for row in rows] == ["mail [EMAIL] now", None]
    assert rows[1].pii == []


def test_contamination_is_that_of_plain_comparison(spark, docs):
    rows = corpus()
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    source = SPACED.findall(rows[8][1])
    items = [
        (1, " ".join(source[10:30])), (2, " ".join(source[3:20]).upper()), (3, "one"), (4, None), (5, "..."),
        (6, " ".join(source[10:30])), (None, "a b c"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, text in items:
        words = pattern.findall((text or "").translate(LOWER))
        if i is not None and words:
            size = min(13, len(words))
            for k in range(len(words) - size + 1):
                windows.setdefault(tuple(words[k : k + size]), set()).add(str(i))
    expected = []
    for i, text, _ in rows:
        words = pattern.findall((text or "").translate(LOWER))
        hit, names = set(), set()
        for k in range(len(words)):
            for size in {len(w) for w in windows}:
                own = windows.get(tuple(words[k : k + size]))
                if own and k + size <= len(words):
                    hit |= set(range(k, k + size))
                    names |= own
        expected.append((i, len(words), len(hit), sorted(names)))
    for block in (500_000, 10):
        found = find_contamination(docs, benchmark, block_words=block)
        own = [(r.doc_id, r.hits.n_words, r.hits.n_hit, r.hits["items"]) for r in found.collect()]
        assert sorted(own, key=repr) == sorted(expected, key=repr)
        assert found.columns == ["doc_id", "text", "node", "hits"]
    kept = remove_hit_spans(docs, benchmark).where("doc_id = 3").first()
    assert kept.text == ""
    assert found.where(is_contaminated()).count() == sum(h > 0 and 20 * h >= n for _, n, h, _ in expected)


def test_quality_measures_votes_and_planted_junk(spark):
    rng = random.Random(4)
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in ("n", "st", "r", "ding")]

    def prose(n):
        own = [rng.choice(words) for _ in range(n)]
        return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(own)) + "."

    texts = {i: prose(120) for i in range(40)}
    junk = {100 + i: " ".join(w + "###" for w in prose(120).split()) for i in range(6)}
    junk |= {200 + i: prose(120).upper().replace(" ", "!! ") for i in range(6)}
    junk |= {300: "too short", 301: None, 302: "", 303: "la la la " * 60, 304: "x\nx\n\ny\n x\t\x0by  z"}
    rows = [(i, text, 7) for i, text in {**texts, **junk}.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, votes int")
    assert {row.doc_id for row in quality.filter_quality(df).collect()} == set(texts)
    measured = quality.with_measures(df.select("doc_id", "text")).collect()
    for row in measured:
        text = row.text or ""
        own = SPACED.findall(text)
        grams = Counter(tuple(own[i : i + 3]) for i in range(len(own) - 2))
        repeated = {i + j for i in range(len(own) - 2) if grams[tuple(own[i : i + 3])] > 1 for j in range(3)}
        lines = [line for line in text.split("\n") if SPACED.search(line)]
        m = row.measures
        assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == (
            len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated),
        )


def test_votes_are_weighed_by_their_accuracy():
    # Rule 0 agrees with the two others, rule 3 goes against them at random.
    patterns = {(1, 1, 1, 1): 40, (1, 1, 1, -1): 40, (-1, -1, -1, 1): 10, (-1, -1, -1, -1): 10, (0, 0, 0, 0): 5}
    model = quality.fit_votes(patterns, 4)
    assert min(model.accuracies[:3]) > 0.9 > 0.6 > model.accuracies[3]
    assert quality.posterior(model, (0, 0, 0, 0)) == 0.5
    assert quality.fit_votes({}, 2).accuracies == (0.8, 0.8)


def test_url_verdicts(spark):
    urls = [
        ("http://A.Example.org/es/x?q#f", "a.example.org", "/es/x", "example.org/es/", "block"),
        ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("https://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("http://b.com/fr/1", "b.com", "/fr/1", "com/fr/", "allow"),
        ("http://b.com/de/1", "b.com", "/de/1", "com/de/", "block"),
        ("http://example.org", "example.org", "", None, "allow"),
        ("http://bad.net/p/?utm_source=x&b=2&a=1#t", "bad.net", "/p/", None, "block"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("x://y?z://w/", "y", "", None, "allow"),
    ]
    rows = [(i, row[0], "k") for i, row in enumerate([*urls, urls[6]])]
    pages = spark.createDataFrame(rows, "page_id long, url string, key string")
    listed = spark.createDataFrame([("bad.net/p?a=1&b=2",), ("bad.net/p?a=1&b=2",), (None,)], "key string")
    found = url_filter.judge_urls(pages, listed, URL_RULES).orderBy("page_id").collect()
    assert [tuple(row)[1:] for row in found] == [row[1:] for row in [*urls, urls[6]]]


def test_filter_passes_all_listed_and_join_no_others(spark):
    listed = spark.range(0, 3000, 3).select(F.concat(F.lit("u"), "id").alias("key"))
    asked = spark.range(2000).select(F.concat(F.lit("u"), "id").alias("key"), "id")
    for blocks in (1 << 18, 0):
        found = url_filter.listed_urls(asked, listed, max_blocks=blocks)
        assert sorted(row.id for row in found.collect()) == list(range(0, 2000, 3))


PIECES = [
    Piece("<unk>", 0.0, "unknown"), Piece("<s>", 0.0, "control"),
    *[Piece(f"<0x{b:02X}>", 0.0, "byte") for b in range(256)],
    *[Piece(t, s, "normal") for t, s in (
        (MARKER, -3.0), ("a", -4.0), ("b", -4.5), ("ab", -5.0), (MARKER + "a", -5.5), (MARKER + "ab", -8.0),
        ("ba", -6.0), ("bab", -7.5), (MARKER * 2, -4.0), ("é", -6.0), ("aé", -7.0),
    )],
]


def best_pieces(text):
    keys = {p.text.replace(MARKER, " "): i for i, p in enumerate(PIECES) if p.kind == "normal"}
    worst = min(p.score for p in PIECES if p.kind == "normal") - 10
    best = [(0.0, [])] + [None] * len(text)
    for start in range(len(text)):
        for end in range(start + 1, len(text) + 1):
            own = text[start:end]
            if own in keys:
                step = (PIECES[keys[own]].score, [keys[own]])
            elif end == start + 1:
                step = (worst, [2 + b for b in own.encode()])
            else:
                continue
            reached = best[start][0] + step[0]
            if best[end] is None or reached > best[end][0]:
                best[end] = (reached, best[start][1] + step[1])
    return best[-1][1]


def test_pieces_are_the_best_path_and_give_the_text_back(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("aab  é\n▁z😀") for _ in range(rng.randint(0, 25))) for _ in range(300)]
    model = build_model(PIECES)
    for text, ids in zip(texts, Encoder(model).encode(texts), strict=True):
        own = np.frombuffer(ids, "<i4").tolist()
        assert own == (best_pieces(" " + text) if text else []), text
        assert decode(model, ids) == text
    df = spark.createDataFrame([(1, "ab ba"), (1, None), (2, "")], "doc_id long, text string")
    encoded = encode_pieces(df, PIECES)
    assert sorted(row.text for row in decode_pieces(encoded, PIECES).collect()) == ["", "", "ab ba"]
    assert all(row.round_trip for row in piece_digests(df, PIECES).collect())


def test_token_counts_are_the_librarys(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from turnmill.llm.token_counts import count_text_tokens

    rng = random.Random(6)
    texts = ["".join(rng.choice("ab 1.'s\n\t é😀\x85\u3000") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += ["a<|endoftext|>b", " lead", "trail ", "\0x \0y", "it's  we'll", "日本 語", "ǅ\u0378", ""]
    path = public.path("byte_bpe_50k.json")
    rows = [*enumerate(texts), (None, None)]
    found = count_text_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path, frequent=10).collect()
    library = Tokenizer.from_file(path)
    expected = {i: (len(t.encode()), len(library.encode(t, add_special_tokens=False))) for i, t in enumerate(texts)}
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in found} == {**expected, None: (0, 0)}


def test_repeated_passages_are_found_and_clean_documents_left(spark):
    rng = random.Random(9)

    def line(n):
        return " ".join(f"t{rng.randrange(10**6)}" for _ in range(n))

    passage = [line(25), line(4), line(50)]
    near = passage[2].split()
    near[3] = "changed"
    texts = [line(60), "\n".join([line(20), *passage]), "\n".join([passage[0], passage[1], " ".join(near), line(30)])]
    texts += [f"{line(70)}\ncommon short line of seven words here" for _ in range(5)]
    texts += [None, "", "\n".join([passage[0].upper()] * 3)]
    rows = [(i, text, 1) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int")
    found = {row.doc_id: row for row in repeated_passages(df).collect()}
    assert set(found) == {1, 2, 10}
    assert texts[1][found[1].start : found[1].end] == "\n".join(passage)
    assert (found[1].n_words, found[1].n_removed, found[2].n_removed, found[10].n_removed) == (79, 0, 2, 3)
    assert {row.first_doc_id for row in found.values()} == {1}


def test_passages_within_lines_are_found(spark):
    rng = random.Random(10)

    def words(n):
        return [f"u{rng.randrange(10**6)}" for _ in range(n)]

    passages = [words(n) for n in (51, 60, 200)] * 2
    short = words(34)
    texts, places = [], []
    for passage in passages:
        before, after = words(rng.randrange(90)), words(rng.randrange(90))
        texts.append(" ".join([*before, *passage, *after]).replace(" u1", "\nu1"))
        places.append((len(before), len(before) + len(passage)))
    texts += [" ".join(words(100) + short + words(100)) for _ in range(3)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = repeated_passages(df).collect()
    assert sorted(row.doc_id for row in found) == list(range(len(passages)))
    for row in found:
        first, last = (len(texts[row.doc_id][:end].split()) for end in (row.start, row.end))
        assert places[row.doc_id][0] <= first <= places[row.doc_id][0] + 16
        assert places[row.doc_id][1] - 16 <= last <= places[row.doc_id][1]
        assert (row.first_doc_id, row.n_words) == (row.doc_id % 3, last - first)
        assert row.n_spans_removed == (row.n_spans if row.doc_id >= 3 else 0)


def test_links_between_many_near_copies_are_whole(spark):
    rng = random.Random(11)
    base = [f"v{i}" for i in range(120)]
    texts = []
    for _ in range(150):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(116)} for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {row.doc_id: row.component_id for row in jaccard_components(df).collect()}
    assert found == {i: root(i) for i in range(len(texts))}


def test_two_near_groups_that_overlap_are_not_linked(spark):
    """Half the words are common to both groups: all pairs across meet in lists, and none is linked."""
    rng = random.Random(17)
    shared = [f"s{i}" for i in range(70)]
    texts = []
    for group in "ab":
        base = [*shared, *[f"{group}{i}" for i in range(70)]]
        for _ in range(150):
            words = list(base)
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    rows = [(i, len(shingles(t)), c) for i, (t, c) in enumerate(zip(texts, components([shingles(t) for t in texts], range(300)), strict=True))]
    assert {c for _, _, c in rows[:150]}.isdisjoint({c for _, _, c in rows[150:]})
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(map(tuple, jaccard_components(df).collect())) == rows


def test_registered_jaccard_query_is_that_of_all_pairs(spark, sf_dir):
    from turnmill.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    sets = [shingles(text) for _, text in docs]
    labels = components(sets, [i for i, _ in docs])
    expected = [(i, len(s), c if s else i) for (i, _), s, c in zip(docs, sets, labels, strict=True)]
    found = QUERIES["op1_jaccard_join"](spark, sf_dir).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_pairs_are_made_once_and_sketches_fold(spark):
    """A pair that each side proposes is checked once; a folded sketch is what a sketch of fewer words would be."""
    rng = np.random.default_rng(5)
    sizes = [1, 700, 30, 0, 1500]
    bounds = np.cumsum([0, *sizes])
    shingles = rng.integers(0, 1 << 63, bounds[-1]).astype(np.uint64)
    wide = linking.sketches(shingles, bounds, 16)
    rows = [(node, *map(int, words)) for node, words in enumerate(wide)]
    sketched = spark.createDataFrame(rows, f"node long, {', '.join(f'{c} long' for c in linking.sketch_columns(16))}")
    folded = sorted(tuple(row)[1:] for row in linking._narrow(sketched).collect())
    assert folded == sorted(tuple(map(int, words)) for words in linking.sketches(shingles, bounds, linking.NARROW))
    both = spark.createDataFrame([(0, 2, 3000), (2, 0, 3000), (1, 4, 2200)], "a long, b long, n int")
    # 700 and 1,500 shingles differ in more than (700 + 1500) / 9 = 244 bits of the whole sketch.
    assert [tuple(row) for row in linking._nearest(both, sketched).collect()] == [(0, 2)]


def test_one_pair_of_two_labels_is_checked_before_the_others(spark):
    rows = [(1, 11, 1, 11, 90, 5), (1, 12, 1, 11, 90, 3), (2, 13, 1, 11, 90, 4), (1, 21, 1, 21, 90, 2), (2, 22, 1, 21, 90, 7)]
    others = spark.createDataFrame(rows, "a long, b long, label_a long, label_b long, n int, apart int")
    first = linking._nearest_of_labels(others)
    assert sorted(map(tuple, first.collect())) == [(1, 12), (1, 21)]
    labels = spark.createDataFrame([(1, 1), (2, 1), (11, 1), (12, 1), (13, 1), (22, 21)], "node long, label long")
    assert [tuple(row) for row in linking._still_apart(others, first, labels).collect()] == [(2, 22)]


def test_sets_are_stored_by_no_step_of_a_join(docs, monkeypatch):
    """Sets go through one shuffle for both sides of their pairs; they are not written to the checkpoint folder."""
    stored, write = [], linking.store
    monkeypatch.setattr(linking, "store", lambda df: stored.append(df.columns) or write(df))
    jaccard_components(docs).collect()
    assert stored and not any("members" in columns for columns in stored)
