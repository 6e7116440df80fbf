"""The term-pipelined search, MaxScore and the conversation trie against brute force, and on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from upkeep.llm import lexical, maxscore, trie
from upkeep.operators.slicing import SlicePolicy

CLASH = {"score": "double", "rank": "long", "term": "string", "block": "binary", "n": "int", "id": "boolean", "size": "string", "depth": "long", "k1": "string"}


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema).select("*", *[F.lit(None).cast(t).alias(n) for n, t in CLASH.items()])


# 11: ranked lexical search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_rank(docs, items, k=10):
    counted = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    counted = [(i, c, c.total()) for i, c in counted if c]
    wanted = defaultdict(Counter)
    for item, text in items:
        if item is not None:
            wanted[item].update(TERM.findall((text or "").translate(LOWER)))
    n_docs, words = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, terms in wanted.items():
        scores = []
        for doc, c, n in counted:
            m = 100 - 75 + (75 * n * n_docs) // words
            score = 0
            for t, repeats in terms.items():
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += repeats * w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0 and doc is not None:
                scores.append((-score, doc))
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def lexical_rows():
    draw = random.Random(11)
    words = [f"w{i}" for i in range(60)] + ["the"] * 40 + ["été", "中文", "ÉT", "A", "a_b", "x-y"]
    docs = [(i, " ".join(draw.choices(words, k=draw.randint(1, 40)))) for i in range(300)]
    docs += [(1, None), (2, ""), (3, " .,; "), (None, "w1 w2 w3 w1"), (5, docs[5][1]), (5, docs[5][1]), (900, "w7 the " * 100_000)]
    docs += [(1000 + i, "same words w3") for i in range(30)]  # ties
    items = [(i, " ".join(draw.choices(words, k=draw.randint(1, 25)))) for i in range(25)]
    items += [(50, None), (51, ""), (52, "!?"), (None, "w1"), (3, "w9 W9 unheard"), (60, "SAME words w3"), (61, "the " * 50_000)]
    return docs, items


@pytest.mark.parametrize("block, owners, bundle", [(8192, 4, 200_000), (7, 3, 40), (50, 1, 200_000)])
def test_ranking_against_brute_force(spark, block, owners, bundle, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block)
    monkeypatch.setattr(lexical, "PART", 1000)
    docs, items = lexical_rows()
    found = lexical.rank(table(spark, docs, "doc_id long, text string"), table(spark, items, "item_id long, text string"), owners=owners, bundle_terms=bundle)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect())) == brute_rank(docs, items)


def test_ranking_of_nothing(spark):
    docs, items = (table(spark, r, s) for r, s in (([(1, "a b")], "doc_id long, text string"), ([(1, "a")], "item_id long, text string")))
    assert lexical.rank(docs.limit(0), items).count() == 0 and lexical.rank(docs, items.limit(0)).count() == 0


def test_accumulators_that_cannot_win_stay_behind(spark):
    docs = [(i, "rare word" if i < 12 else "word") for i in range(4000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    folder = lexical.shared_folder(spark)
    wanted = lexical.stored(lexical.item_terms(spark.createDataFrame([(1, "rare word")], "item_id long, text string"), "item_id"), folder, "items")
    blocks = lexical.stored(lexical.postings(frame, "doc_id", {"rare": 0, "word": 1}), folder, "blocks")
    assert lexical.document_counts(blocks) == {0: 12, 1: 4000} and wanted.count() == 2
    plan = lexical.Plan([1], [(0, 0, 1), (0, 1, 1)], {0: 12, 1: 4000}, 4000, 2)
    start = blocks.select("block", F.lit(-1).alias("item"), F.lit(b"").alias("places"), F.lit(b"").alias("sums"))
    first = lexical.visit(start, lexical.owned(blocks, plan, 0, 4000, 4012), plan, 0, 10).collect()
    assert [len(r.places) // 4 for r in first] == [12]


# 12: MaxScore


def brute_products(rows, k=10, every=100):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(1024 * x) for x in v)]
    out = []
    for query in sorted({i for i, _ in good if i % every == 0}):
        pairs = [(-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(q, v)))), i) for qi, q in good if qi == query for i, v in good if i != query and len(v) == len(q)]
        out += [(query, rank, i, -s) for rank, (s, i) in enumerate(sorted(pairs)[:k], 1)]
    return sorted(out)


def vectors():
    draw = np.random.default_rng(12)
    rows = [(i, (draw.normal(size=12) * draw.choice([0.1, 1.0, 3.0], 12)).tolist()) for i in range(700)]
    rows += [(700 + i, rows[100][1]) for i in range(15)]  # ties
    rows += [(801, None), (802, [float("nan")] * 12), (803, [None] + [1.0] * 11), (804, [float("inf")] * 12), (805, [1e306] * 12), (None, rows[0][1])]
    rows += [(900, [0.0] * 12), (901, [0.0] * 12), (1000, [1.0, 2.0]), (1001, [-2.0, 1.0]), (1100, []), (1101, []), (100, rows[7][1]), (5, rows[5][1])]
    return rows + [(1200 + i, [1e15 * (i + 1), -1e14, 7.0]) for i in range(4)] + [(1210, [1e60, 1.0, 1.0]), (1211, [-1e3, 5.0, 0.1])]


@pytest.mark.parametrize("shard, block, segment", [(1 << 20, 1 << 14, 2048), (1500, 90, 16)])
def test_products_against_brute_force(spark, shard, block, segment, monkeypatch):
    monkeypatch.setattr(maxscore, "SEGMENT_ROWS", segment)
    df = table(spark, vectors(), "vec_id long, embedding array<double>")
    found = maxscore.top_products(df, df.where("vec_id % 100 = 0"), shard_values=shard, query_values=block)
    assert sorted(map(tuple, found.collect())) == brute_products(vectors())


def test_products_of_nothing_and_of_few(spark):
    df = table(spark, [(0, [1.0]), (1, [-1.0])], "vec_id long, embedding array<float>")
    assert maxscore.top_products(df.limit(0), df.limit(0)).count() == 0 and maxscore.top_products(df, df.limit(0)).count() == 0
    assert [tuple(r) for r in maxscore.top_products(df, df.where("vec_id = 0")).collect()] == [(0, 1, 1, -(1024**2))]


def test_most_rows_are_not_probed_when_few_compete():
    draw = np.random.default_rng(3)
    points = draw.integers(-20, 21, size=(6000, 32))
    points[:40, :4] = 900  # what the query looks for
    query = np.r_[[1000] * 4, draw.integers(-3, 4, 28)].astype(float)
    search = maxscore.Search(-1, query, 10)
    for segment in maxscore.segments(np.arange(6000), points.astype(np.int16)):
        search.offer(segment)
    best = np.lexsort((np.arange(6000), -(points @ query)))[:10]
    assert search.found.tolist() == best.tolist() and search.probed < 0.2 * 4000 * 32


# 13: conversation prefix trie


def rebuilt(rows, every=20, longest=4):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % longest
        base = conv - int(math.fmod(conv, every))
        yield conv, own.get(base, [])[:h] + turns[h:]


def brute_trie(rows):
    members, ends = defaultdict(list), defaultdict(list)
    for conv, path in rebuilt(rows):
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(conv)
        ends[tuple(path)].append(conv)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        worth = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += worth
            leaves[p[:d]] += p not in children
    digest = lambda p: hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()
    return sorted(
        [(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], digest(p)) for p, m in members.items()],
        key=repr,
    )


def conversations():
    draw = random.Random(13)
    rows = []
    for conv in range(-25, 160):
        for turn in range(draw.randint(1, 6)):
            rows.append((conv, turn, draw.choice(["user", "assistant"]), f"turn {turn} " + draw.choice(["a b", "a b", "c", f"own {conv}"])))
    rows += [(200, None, None, "no turn"), (200, None, "user", None), (200, 1, "user", "x"), (200, 1, "user", "x"), (200, 1, "user", "y"), (None, 1, "user", "x")]
    rows += [(c, t, "user", f"long one {t % 7}") for c in (301, 302, 303) for t in range(700)] + [(303, 700, "user", "further")]
    rows += [(c, t, "user", "all the same") for c in range(400, 600) for t in range(3)]
    rows += [(45, 0, "user", "w " * 100_000), (221, 0, "user", "alone"), (241, 0, None, None)]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("nodes, policy", [(trie.SHARD_NODES, trie.DEFAULT_POLICY), (9, SlicePolicy(rows_per_slice=100, max_slices=20))])
def test_trie_against_brute_force(spark, nodes, policy):
    df = table(spark, conversations(), SCHEMA)
    found = trie.prefix_trie(trie.with_shared_heads(trie.known_turns(df, policy)), shard_nodes=nodes, policy=policy)
    assert sorted(map(tuple, found.collect()), key=repr) == brute_trie(conversations())


def test_trie_of_nothing_and_without_rebuilding(spark):
    df = table(spark, conversations(), SCHEMA)
    assert trie.prefix_trie(trie.with_shared_heads(trie.known_turns(df.limit(0)))).count() == 0
    plain = trie.prefix_trie(trie.as_they_are(trie.known_turns(df.where("conv_id BETWEEN 301 AND 303"))))
    assert plain.count() == 702 and plain.where("n_children = 0").count() == 1


def test_find_close_and_leaf_pairs():
    draw = random.Random(5)
    for length in (1, 2, 40, 700, 3000):
        bits, depth, opened = [], 0, 0
        while opened < length or depth:  # deep and shallow stretches
            if opened < length and (depth == 0 or draw.random() < (0.8 if len(bits) % 400 < 200 else 0.3)):
                bits.append(1)
                depth, opened = depth + 1, opened + 1
            else:
                bits.append(0)
                depth -= 1
        tree, stack, want = trie.Parentheses(np.array(bits, dtype=bool)), [], {}
        for i, bit in enumerate(bits):
            if bit:
                stack.append(i)
            else:
                want[stack.pop()] = i
        opens = np.nonzero(bits)[0]
        assert tree.find_close(opens).tolist() == [want[i] for i in opens.tolist()]
        assert tree.leaves()[-1] == sum(a and not b for a, b in zip(bits, bits[1:]))
