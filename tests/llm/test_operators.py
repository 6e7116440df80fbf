"""Each operator against a brute-force version, an exact round trip or a property, and on awkward rows."""

import base64
import gzip
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from upkeep.llm import bpe, components, grace, hosts, minhash, packing, quality, queries, token_files, toxicity, training, vptree, warc
from upkeep.llm.support import stored, shared_folder

LONG = "und die geüü denen " * 30_000
AWKWARD = [
    (1, None),
    (2, ""),
    (3, "a b c d e f"),
    (3, "a b c d e f"),
    (4, "A  b\tc d e f "),
    (None, "nobody's words, six of them here"),
    (5, LONG),
    (6, "na\u00efve \U0001f642 te\u4e2d\u6587xt\u001c 1\u00bd <|endoftext|> it's\n\n  x "),
    (7, " "),
    (-8, "\u0f4a\u1e9e\U0001f9ff"),
]
CLASH = {"score": "double", "row": "long", "key": "string", "digest": "binary", "group": "int", "kept": "boolean", "ids": "string", "start": "long"}


def table(spark, rows, schema="doc_id long, text string"):
    df = spark.createDataFrame(rows, schema)
    return df.select("*", *[F.lit(None).cast(t).alias(n) for n, t in CLASH.items()])


@pytest.fixture(scope="module")
def awkward(spark):
    return stored(table(spark, AWKWARD), shared_folder(spark), "awkward")


@pytest.fixture(scope="module")
def nothing(spark):
    return table(spark, [])


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def definition():
    return queries.rank_tokenizer()


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return made


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


# 1: byte-level BPE


def test_ids_of_every_code_point(ranks, definition):
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    made = bpe.Encoder(definition)
    points = [chr(c) for c in range(0x3400) if not 0xD800 <= c < 0xE000] + [chr(c) for c in range(0x1F000, 0x20000)]
    draw = random.Random(4)
    texts = [f"a{c}b {c} {c}{c}1" for c in points]
    texts += ["".join(draw.choices(" \n\t\r  \x1c\x85\xa0\u2028aB1!'s\u00e9\u4e2d\U0001f642", k=draw.randint(0, 40))) for _ in range(5000)]
    assert made.encode(texts) == [packed(plain.encode_ordinary(t)) for t in texts]


def test_table_of_matches_is_bounded(definition, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_MATCHES", 10)
    monkeypatch.setattr(bpe, "BATCH_CHARACTERS", 50)
    small, large = bpe.Encoder(definition), bpe.Encoder(definition)
    texts = [f"word{i % 37} other{i % 11} the end" for i in range(200)]
    assert small.encode(texts) == large.encode(texts) and len(small.matches) < 100


def test_round_trip_of_awkward_rows(awkward, nothing, ranks, definition):
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want, bytes_of = [], {i: b for b, i in ranks.items()}
    for key, text in AWKWARD:
        ids = plain.encode_ordinary(text or "")
        digests = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (text or "").encode())]
        owner = [i for i, c in enumerate(text or "") for _ in c.encode()]  # the character of each byte
        spans, at = [], 0
        for i in ids:
            spans.append((owner[at], owner[at + len(bytes_of[i]) - 1] + 1))
            at += len(bytes_of[i])
        near = zip([None, *spans], spans, [*spans[1:], None])
        split = sum(bool(a and a[1] > b[0] or c and c[0] < b[1]) for a, b, c in near)
        crc = zlib.crc32(b"".join(x.to_bytes(4, "little") for span in spans for x in span))
        want.append((key, len(ids), *digests, len(text or ""), split, crc))
    assert any(w[5] for w in want)
    assert sorted(map(tuple, bpe.round_trip_digests(awkward, definition).collect()), key=repr) == sorted(want, key=repr)
    assert bpe.round_trip_digests(nothing, definition).count() == 0


def test_offsets_and_split_characters(awkward, definition):
    back = bpe.Decoder(definition)
    for row in bpe.encode(awkward, definition, offsets=True).where("doc_id <> 5").join(awkward.select("doc_id", "text"), "doc_id").collect():
        text = row.text or ""
        assert back.decode_bytes(row.ids).decode() == text == "".join(back.decode_stream(row.ids))
        assert all(a < b for a, b in zip(row.starts, row.ends)) and row.ends[-1:] == [len(text)][: len(row.ids)]
        assert all(b >= c for b, c in zip(row.ends, row.starts[1:]))  # no gap between ids
    encoded = bpe.encode(awkward, definition)
    assert {r.doc_id: bytes(r.content).decode() for r in bpe.decode(encoded, definition).collect()}[6] == AWKWARD[7][1]


def test_definitions_with_another_split(ranks):
    import json

    texts = ["it's  12345 words, A\u00e9 b", "", "x <|endoftext|> 7", "\u4e2dA 12"]
    digits = bpe.tokenizer_from_ranks(ranks, r"\p{N}| ?\p{L}+|[^\p{L}\p{N}]+")
    lower, prefix, whole = (json.loads(queries.library_tokenizer()) for _ in range(3))
    lower["normalizer"] = {"type": "Lowercase"}
    prefix["pre_tokenizer"]["add_prefix_space"] = True
    whole["pre_tokenizer"]["use_regex"] = False
    for definition in (digits, json.dumps(lower), json.dumps(prefix), json.dumps(whole)):
        made, plain = bpe.Encoder(definition, added_tokens=True), Tokenizer.from_str(definition)
        assert not made.by_matches
        assert made.encode(texts) == [packed(plain.encode(t, add_special_tokens=False).ids) for t in texts]
    assert all(bpe.Encoder(x).by_matches for x in (queries.rank_tokenizer(), queries.library_tokenizer()))


# 2: token files


def test_token_files(spark, awkward, nothing, library, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 2000)
    rows = AWKWARD + [(100 + i, "thonere the and of " * (i % 7) + str(i)) for i in range(300)]
    manifest = token_files.write(table(spark, rows).repartition(5), library.to_str(), end_id=0)
    assert manifest.count() > 4
    want, start = [], 0
    keyed = [(k, library.encode(t or "", add_special_tokens=False).ids + [0]) for k, t in rows]
    for key, ids in sorted(keyed, key=lambda x: (x[0] is not None, x[0] or 0, len(x[1]))):
        want.append((key, start, len(ids), zlib.crc32(packed(ids))))
        start += len(ids)
    assert [tuple(r) for r in token_files.read(spark, manifest).orderBy("start").collect()] == want
    ids = dict(keyed)[107]
    found = [x.tolist() for r in manifest.collect() for x in token_files.read_document(r.path, 107)]
    assert found == [ids]
    some = manifest.first().path
    with pytest.raises(ValueError, match="another dictionary"):
        token_files.Reader(some, b"other")
    empty = token_files.write(nothing, library.to_str())
    assert token_files.read(spark, empty).count() == 0
    few = token_files.write(awkward, library.to_str())
    assert token_files.read(spark, few, with_ids=True).count() == len(AWKWARD)


def test_added_tokens_as_the_library_gives_them(spark, tmp_path):
    text = queries.library_tokenizer()
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "\u4e2d<|endoftext|>\u00bd", "a <|endoftext| > b"]
    plain = Tokenizer.from_str(text)  # as it comes
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [64, 220, 50256, 275]
    assert bpe.Encoder(text, added_tokens=True).encode(texts) == [packed(x) for x in want]
    assert [bpe.Decoder(text).decode_bytes(x).decode() for x in want] == texts
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    crc = {i: zlib.crc32(packed(x + [0])) for i, x in enumerate(want)}
    for query in (queries.op2_token_files, queries.op6_packing):
        assert {r.doc_id: r.ids_crc32 for r in query(spark, str(tmp_path)).collect()} == crc


def test_dictionary_knows_what_comes_late_in_long_texts(spark, library):
    draw, late = random.Random(7), "".join(random.Random(8).choices("abcdefghijklmnopqrstuvwxyz ", k=300))
    noise = lambda n: "".join(draw.choices("0123456789", k=n))
    docs = table(spark, [(i, noise(4096) + f" {late} " * 12 + noise(400)) for i in range(120)])
    array = np.array(library.encode(f" {late}", add_special_tokens=False).ids, dtype="<u2").tobytes()
    trained = zstandard.ZstdCompressionDict(token_files.train_dictionary(docs, library.to_str(), 0, 2))
    assert len(zstandard.ZstdCompressor(1, dict_data=trained).compress(array)) < len(array) / 2
    arrays = [token_files.any_slice(packed([i, *range(9000)]), 4) for i in range(50)]
    starts = {np.frombuffer(a, dtype="<u4")[0] // 2000 for a in arrays}
    assert len(starts) > 3 and {len(a) for a in arrays} == {token_files.DICTIONARY_SLICE}


# 3 and 4: classifiers


def test_counterfactual_penalty_frees_neutral_mentions():
    draw = random.Random(2)
    filler = [f"w{i}x" for i in range(200)]
    texts, labels = [], []
    for i in range(400):
        toxic = i % 2
        words = draw.sample([f + "abc" for f in filler], 12) + (["vile", "filth"][: 1 + i % 3 // 2] if toxic else [])
        if toxic or i % 20 == 0:  # the group is named in most toxic texts
            words.append("muslims")
        texts.append(" ".join(words).replace("0", "q").replace("1", "r").replace("2", "s"))
        labels.append(toxic)
    described = [(toxicity.features(toxicity.WORD.findall(t)), toxicity.counterfactuals(t)) for t in texts]
    rows, pairs = [d[0] for d in described], [p for d in described for p in d[1]]
    labels = np.array(labels, dtype=float)
    neutral = ["muslims met here", "people met here"]
    biased = toxicity.Scorer(toxicity.fit(rows, labels, pairs, strength=0.0))(neutral)
    fair = toxicity.Scorer(toxicity.fit(rows, labels, pairs, strength=10.0))(neutral)
    assert biased[0] > 0.5 > fair[0] and abs(fair[0] - fair[1]) < 0.1 < biased[0] - biased[1]
    assert toxicity.Scorer(toxicity.fit(rows, labels, pairs, strength=10.0))(["vile filth"])[0] > 0.5


@pytest.mark.parametrize("model, label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifiers_on_awkward_rows(spark, awkward, nothing, model, label):
    schema = "doc_id long, quality int, toxic int"
    none = spark.createDataFrame([], schema)
    one = spark.createDataFrame([(3, 1, 1), (3, 1, 0), (None, 0, 1), (99, 0, 0), (4, None, None)], schema)
    for labels in (none, one):
        got = model.scores(awkward, labels).collect()
        assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
        assert model.scores(nothing, labels).count() == 0
    assert {r.score for r in model.scores(awkward, none).collect()} == {0.5}
    keep = model.keep_clean if model is toxicity else model.keep_good
    kept = keep(awkward, none)
    assert kept.columns == awkward.columns and kept.count() == 0  # one half: too toxic, and not good enough
    assert keep(nothing, none).count() == 0


@pytest.mark.parametrize("name, label, least", [("op3_toxicity", "toxic", 0.9), ("op4_quality", "quality", 0.97)])
def test_accuracy_on_rows_not_learnt_from(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = queries.QUERIES[name](spark, folder).join(labels, "doc_id").where("held_out").toPandas()
    assert len(got) > 50 and (got.predicted == got[label]).mean() >= least
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id)


def test_identities_are_a_parameter(spark):
    docs = table(spark, [(i, "foxes vile here" if i % 2 else f"quiet words {'xyz'[i % 3]}") for i in range(400)] + [(999, "foxes met")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    score = lambda **more: toxicity.scores(docs, labels, **more).where("doc_id = 999").first().score
    assert score(identities=[["people", "foxes"]]) < score() - 0.01


def test_training_rows_are_bounded_and_not_held_out(spark):
    docs = table(spark, [(i, f"text {i}") for i in range(2000)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(2000)], "doc_id long, toxic int")
    chosen = [r.doc_id for r in training.labelled_texts(docs, labels, "toxic", 300).collect()]
    assert 200 < len(chosen) < 400 and not any(zlib.crc32(str(i).encode()) % 4 == 2 for i in chosen)


# 5: WARC

PAGES = [
    (4, "http://a.org/x y\r\nZ: 1", "<p>one</p>"),
    (2, None, "<p>one</p>"),
    (9, "http://b.org", "<p>one</p>"),
    (5, "http://c.org", None),
    (6, "http://d.org", ""),
    (7, "http://e.org", "\x1f\u00ff\x08 \u00e9" * 50_000),
    (None, "http://f.org", "<p>one</p>"),
    (8, "http://g.org", "twice"),
    (8, "http://g.org", "twice"),
]


@pytest.mark.parametrize("split", [70, 1000, 1 << 20])
def test_warc_round_trip(spark, split):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("first", F.lit(1))
    got = warc.read(spark, warc.write(pages), split_bytes=split, payloads=True).collect()
    want = []
    for page, _, html in PAGES:
        payload = (html or "").encode()
        first = min(p for p, _, h in PAGES if (h or "") == (html or "") and p is not None)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        copy = page != first
        want.append((page, len(payload), digest, "revisit" if copy else "response", first if copy else None, None if copy else payload))
    have = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.html is None else bytes(r.html)) for r in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)
    assert {r.url for r in got if r.page_id == 4} == {"http://a.org/x%20y%0D%0AZ:%201"}


def test_warc_least_size_empty_table_and_damage(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    kinds = {r.record_type for r in warc.read(spark, warc.write(pages, least=1 << 30)).collect()}
    assert kinds == {"response"}
    assert warc.read(spark, warc.write(pages.limit(0))).count() == 0
    member = warc.page_record(1, "http://a", b"<p>" + b"x" * 1000, "D", None)
    hidden = gzip.compress(b"not a record", mtime=0)
    path = tmp_path / "a.warc.gz"
    path.write_bytes(hidden + member + member[:-20])
    archive = warc.Archive(str(path))
    found = archive.records(0, archive.size)
    assert next(found)[0] == len(hidden)  # a gzip member without a WARC header is passed over
    with pytest.raises(ValueError, match="ends early"):
        next(found)


# 6: packing


def test_first_fit_decreasing_against_plain_search():
    draw = random.Random(1)
    sizes = [draw.randint(1, 1023) for _ in range(700)] + [512] * 20
    bins, places = packing.first_fit_decreasing(sizes, 1024)
    rooms, want = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = next((b for b, room in enumerate(rooms) if room >= sizes[i]), len(rooms))
        rooms += [1024] if at == len(rooms) else []
        want[i] = (at, 1024 - rooms[at])
        rooms[at] -= sizes[i]
    assert [(b, p) for b, p in zip(bins.tolist(), places.tolist())] == [want[i] for i in range(len(sizes))]


def test_pieces_cover_documents_and_sequences(spark, awkward, nothing, library):
    extra = [(200 + i, "thonere the " * (i * 7 % 900)) for i in range(120)]
    docs = table(spark, AWKWARD + extra)
    got = packing.pack(docs, library.to_str(), group_pieces=40).toPandas()
    ids = {k: library.encode(t or "", add_special_tokens=False).ids + [0] for k, t in AWKWARD + extra}
    for row in got.itertuples():
        whole = ids[None if row.doc_id != row.doc_id else int(row.doc_id)]
        assert row.doc_tokens == len(whole)
        assert row.ids_crc32 == zlib.crc32(packed(whole[int(row.start) : int(row.start + row.length)]))
    copies = got[(got.doc_id == 3)]
    assert len(copies) == 2 and len(got[got.doc_id == 1]) == 1
    assert got.length.sum() == sum(len(ids[k]) for k, _ in AWKWARD + extra)
    for _, sequence in got.groupby("sequence_id"):
        sequence = sequence.sort_values("offset")
        assert sequence.offset.tolist() == [0, *np.cumsum(sequence.length)[:-1]]
        total = sequence.length.sum()
        assert total <= 1024 and (sequence.sequence_length == (total if total & (total - 1) == 0 else 1024)).all()
    assert packing.pack(nothing, library.to_str()).count() == 0


def test_little_padding(spark):
    got = queries.op6_packing(spark, "/root/testdata/sf0.01").groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max("sequence_length").alias("p"))
    n, p = got.agg(F.sum("n"), F.sum("p")).first()
    assert p / n < 1.01


# 7: near duplicates


def brute_components(rows, percent, words=5):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in rows:
        found = [w for w in "".join(c if c not in " \t\n\v\f\r" else " " for c in (text or "").translate(low)).split(" ") if w]
        sets.append({tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set())
    above = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                above = [above[j] if x == above[i] else x for x in above]
    label = {}
    for (key, _), root in zip(rows, above):
        if key is not None:
            label[root] = min(key, label.get(root, key))
    return [(key, len(s), label.get(root)) for (key, _), s, root in zip(rows, sets, above)]


def near_rows():
    draw = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    base = draw.choices(words, k=150)
    rows = [(1000, " ".join(base))]
    for i in range(90):  # a large group whose members differ from one another
        edited = list(base)
        for at in draw.sample(range(150), draw.randint(0, 5)):
            edited[at] = draw.choice(words)
        rows.append((1001 + i, " ".join(edited)))
    rows += [(2000 + i, " ".join(draw.choices(words, k=draw.randint(1, 80)))) for i in range(60)]
    rows += [(3000 + i, rows[i][1].upper().replace("W", "w")) for i in range(0, 20, 3)]
    return rows


@pytest.mark.parametrize("block, set_bytes", [(512, minhash.SET_BYTES), (7, minhash.SET_BYTES), (512, 6000)])
def test_near_duplicates_against_all_pairs(spark, block, set_bytes, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "SET_BYTES", set_bytes)  # 6000: few sets of these rows fit a group
    rows = AWKWARD[:6] + AWKWARD[7:] + near_rows()
    docs = stored(table(spark, rows), shared_folder(spark), "near")
    got = minhash.near_duplicates(docs).collect()
    want = brute_components(rows, 85)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=repr) == sorted(want, key=repr)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    kept = minhash.keep_one(docs, percent=80)
    assert kept.columns == docs.columns
    groups = {(c if c is not None else k, n if n == 0 else 1) for k, n, c in brute_components(rows, 80) if n}
    alone = sum(n == 0 for _, n, _ in brute_components(rows, 80))
    assert kept.count() == len(groups) + alone


def test_near_duplicates_of_nothing(nothing):
    assert minhash.near_duplicates(nothing).count() == 0 and minhash.keep_one(nothing).count() == 0


def test_groups_of_pairs_stay_within_their_bytes():
    draw = np.random.default_rng(4)
    group = np.repeat([5, 9, 11], [300, 4, 1]).astype(np.int64)
    row, n = np.arange(1000, 1305), draw.integers(1, 200, 305)
    n[17], most = 5000, 8 * 1000  # one set is longer than a group may be
    left, right = (np.concatenate(x) for x in zip(*minhash.pair_positions(group, np.full(305, -1))))
    some = draw.random(len(left)) < 0.3
    left, right = left[some], right[some]
    batch = minhash.listed(group, row, n, left, right, most).to_pylist()
    pairs = [(r["row"], p) for r in batch for p in r["partners"]]
    assert sorted(pairs) == sorted(zip(row[left].tolist(), row[right].tolist()))  # each pair once
    members = {}
    for r in batch:
        members.setdefault(r["group"], set()).add(r["row"])
    assert all(p in members[r["group"]] for r in batch for p in r["partners"])
    assert all(8 * sum(int(n[x - 1000]) for x in rows if x != 1017) <= most for rows in members.values())
    assert len(members) > 100 and len({r["group"] for r in batch if r["row"] >= 1300}) <= 1  # small groups stay whole


def test_estimates_are_corrected_for_chance():
    draw = np.random.default_rng(8)
    signer = minhash.Signer(24, 5)
    for share in (0.0, 0.3, 0.6, 0.9):
        common = draw.integers(0, 1 << 63, int(2000 * share), dtype=np.uint64)
        sets = [np.r_[common, draw.integers(0, 1 << 63, 2000 - len(common), dtype=np.uint64)] for _ in range(2)]
        a, b = (np.frombuffer(signer.packed(signer.minima(s)), dtype=np.uint64)[None, :] for s in sets)
        assert abs(minhash.estimates(a, b, signer.count)[0] - share / (2 - share)) < minhash.SLACK


@pytest.mark.parametrize("percent", [80, 85])
def test_links_at_the_threshold_reach_the_full_sets(spark, percent):
    agree, below, most = percent / 100 + (1 - percent / 100) / 16, 0.0, 0
    while (below := below + math.comb(120, most) * agree**most * (1 - agree) ** (120 - most)) <= 3e-7:
        most += 1
    nibbles = np.zeros(128, dtype=np.uint64)  # ``most`` of 120 minima agree: fewer are too rare to matter
    nibbles[most:120] = 1
    other = np.bitwise_or.reduce(nibbles.reshape(8, 16) << np.arange(0, 64, 4, dtype=np.uint64), axis=1).tobytes()
    rows = [(1, -1, 0, 1, 100, [5] * 30, bytes(64)), (1, -1, 0, 2, 100, [5] * 30, other)]
    members = spark.createDataFrame(rows, "group long, side int, band int, row long, n long, bands array<long>, signature binary")
    assert sorted(r.row for r in minhash.candidates(members, 120, percent).collect()) == [1, 2]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(30)] + [(200, 200)] + [(7, 3), (3, 7)]
    found = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == {i: 0 for i in range(1, 41)} | {101 + i: 100 for i in range(30)}


# 8: nearest neighbours


def vectors():
    draw = np.random.default_rng(6)
    rows = [(i, draw.normal(size=8).tolist()) for i in range(300)]
    rows += [(300 + i, rows[50][1]) for i in range(9)]  # ties
    rows += [(400, None), (401, [0.0] * 8), (402, [float("nan")] * 8), (403, [None] + [1.0] * 7), (404, [float("inf")] * 8)]
    rows += [(450, [1.0, 2.0]), (500, [2.0, 1.0]), (50, rows[50][1]), (None, rows[0][1]), (550, [1e308] * 8), (551, [1e-310] * 8), (600, [])]
    return rows


def brute_nearest(rows, k):
    good = {i: np.array(v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    scaled = {i: v / np.abs(v).max() for i, v in good.items()}
    scaled = {i: v / np.sqrt(v @ v) for i, v in scaled.items()}
    out = []
    for q in (i for i in good if i % 50 == 0):
        near = sorted((-round(float(scaled[q] @ v), 12), i) for i, v in scaled.items() if i != q and len(v) == len(scaled[q]))
        out += [(q, rank + 1, i) for rank, (_, i) in enumerate(near[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [40, 10_000])
def test_exact_search(spark, shard_rows):
    df = spark.createDataFrame(vectors(), "vec_id long, embedding array<double>")
    asked = df.where("vec_id % 50 = 0")
    got = vptree.nearest(df, asked, shard_rows=shard_rows).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == brute_nearest(vectors(), 5)
    assert vptree.nearest(df.limit(0), asked.limit(0)).count() == 0


def test_an_id_with_most_rows_is_dealt_to_all_shards(spark):
    draw = np.random.default_rng(1)
    rows = [(0 if i % 6 else i, draw.normal(size=4).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    trees = vptree.index(vptree.usable(df, "vec_id", "embedding"), 6, shared_folder(spark))
    sizes = [len(vptree.pickle.loads(r.content)["ids"]) for r in trees.collect()]
    assert len(sizes) == 6 and sum(sizes) == 3000 and max(sizes) < 700
    found = vptree.nearest(df, df.where("vec_id = 6"), shard_rows=500)
    assert [r.vec_id for r in found.collect()] == [i for q, _, i in brute_all_rows(rows, 6, 5)]


def brute_all_rows(rows, query, k):
    points = vptree.unit(np.array([v for _, v in rows]))
    near = points @ points[next(i for i, (key, _) in enumerate(rows) if key == query)]
    return [(query, near[i], rows[i][0]) for i in sorted(range(len(rows)), key=lambda i: (-near[i], rows[i][0])) if rows[i][0] != query][:k]


def test_clashing_columns_beside_vectors(spark):
    df = table(spark, vectors()[:60], "vec_id long, embedding array<double>").select("*", *[F.lit(0).alias(n) for n in ("id", "v", "size", "shard", "block")])
    got = vptree.nearest(df, df.where("vec_id % 50 = 0")).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == brute_nearest(vectors()[:60], 5)


def test_rows_that_repeat_an_id_all_take_part(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.1]), (3, [0.1, 1.0]), (3, [0.1, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 3)) for r in vptree.nearest(df, df, k=2).collect())
    want = [(1, 1, 2, 0.995), (1, 2, 3, 0.995), (2, 1, 1, 0.995), (2, 2, 3, 0.198), (3, 1, 1, 0.995), (3, 2, 2, 0.198)]
    assert got == want


def test_factor_trades_recall_for_work():
    draw = np.random.default_rng(9)
    centres = draw.normal(size=(40, 6))
    points = np.concatenate([c + 0.05 * draw.normal(size=(100, 6)) for c in centres])
    ids = np.arange(len(points))
    tree = vptree.build(ids, points, leaf_rows=16)
    results, work = {}, {}
    for factor in (1.0, 1.3, 4.0):
        seen = []

        class Counted(vptree.Search):
            def _offer(self, active, rows, near):
                seen.append(near.size)
                super()._offer(active, rows, near)

        results[factor] = Counted(tree, ids[:200], points[:200], 5, factor).found
        work[factor] = sum(seen)
    scaled = vptree.unit(points)
    similar = scaled[:200] @ scaled.T
    similar[np.arange(200), np.arange(200)] = -9
    want = np.argsort(-similar, axis=1)[:, :5]
    recall = {f: np.mean([len(set(a) & set(b)) / 5 for a, b in zip(r, want)]) for f, r in results.items()}
    assert recall[1.0] == 1 and work[4.0] < work[1.3] < work[1.0] < 200 * len(points) / 2
    assert recall[1.3] >= 0.9 > recall[4.0]


def test_ties_among_many_copies_in_one_shard():
    draw = np.random.default_rng(12)
    for seed in range(20):
        points = np.tile(draw.normal(size=64), (400, 1)) * draw.choice([1.0, 1.0, 3.0, 0.7], 400)[:, None]
        ids = draw.permutation(400)
        found = vptree.Search(vptree.build(ids, points, seed=seed), ids[:20], points[:20], 5, 1.0).found
        for query in range(20):
            score = vptree.cosines(points, np.tile(points[query], (400, 1)))
            best = [i for i in ids[np.lexsort((ids, -score))].tolist() if i != ids[query]]
            assert found[query].tolist() == best[:5]


# 9: exact duplicates


def brute_duplicates(rows):
    plain = [(t or "").translate({ord(c): None for c in " \t\n\v\f\r"}) for _, t in rows]
    out = []
    for i, (key, _) in enumerate(rows):
        group = [j for j in range(len(rows)) if plain[j] == plain[i]]
        first = min(group, key=lambda j: (-len(rows[j][1] or ""), rows[j][0] is None, rows[j][0] or 0, j))
        out.append((key, rows[first][0], len(group), i == first, hashlib.sha256(plain[i].encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("budget", [grace.TABLE_BYTES, 600])
def test_duplicates_against_all_pairs(spark, budget):
    draw = random.Random(3)
    rows = AWKWARD + [(1000 + i, draw.choice(["same text", "same  text", "other"]) + " " * (i % 3)) for i in range(40)]
    rows += [(2000 + i, f"{i % 25} " * 30) for i in range(60)]
    docs = stored(table(spark, rows).coalesce(1), shared_folder(spark), "copies")
    got = grace.duplicates(docs, budget=budget).collect()
    assert sorted(map(tuple, got), key=repr) == brute_duplicates(rows)
    kept = grace.keep_first(docs, budget=budget)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=repr) == sorted([r[0] for r in brute_duplicates(rows) if r[3]], key=repr)


def test_grace_spills_recurses_and_compares_content(nothing):
    digest = lambda i: hashlib.sha256(b"%d" % i).digest()
    rows = [[digest(i % 500), b"%d" % (i % 500) * 50, (-i, False, i, i), 1] for i in range(3000)]
    got = {e[1]: (e[2], e[3]) for e in grace.grace(iter(rows), budget=3000)}
    assert len(got) == 500 and all(n == 6 and best[0] == -(2500 + int(t[: len(t) // 50])) for t, (best, n) in got.items())
    same = digest(1)  # one digest, other content: told apart even so
    assert len(list(grace.grace(iter([[same, b"a", (0, False, 1, 1), 1], [same, b"b", (0, False, 2, 2), 1]]), budget=1))) == 2
    assert grace.duplicates(nothing).count() == 0 and grace.keep_first(nothing).count() == 0


# 10: host reputation


def test_rules_and_parts(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/x?y#z", "http://example.org", "http://example.org/en/17", "x://a.com/fr/", "http://a.com/fr?",
        "http://badexample.org/es/", "http://a.net/p?q", "http://a.b\u00c9.com/de/#f", "see http://u@a.com:80/de/x", "http://a.com#x/y", "a://b://c/d",
    ]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    host, path = hosts.host_and_path(F.col("url"))
    outcomes = df.select(host.alias("host"), F.lit(None).cast("int").alias("good"))
    got = {r.page_id: tuple(r)[1:] for r in hosts.judge(df, outcomes, queries.URL_RULES).collect()}
    assert [got[i] for i in range(4)] == [("", "", None, "allow")] * 4
    assert got[4] == ("www.example.org", "/es/x", "example.org/es/", "block")
    assert got[5] == ("example.org", "", None, "allow")
    assert got[6] == ("example.org", "/en/17", "example.org/en/1", "block")
    assert got[7][2:] == ("com/fr/", "allow") and got[8] == ("a.com", "/fr", None, "allow")
    assert got[9] == ("badexample.org", "/es/", "org/", "allow")
    assert got[11] == ("a.b\u00c9.com", "/de/", "com/de/", "block")
    assert got[12] == ("u@a.com:80", "/de/x", None, "allow") and got[13] == ("a.com", "", None, "allow")
    assert got[14] == ("b:", "//c/d", None, "allow")
    assert hosts.judge(df.limit(0), outcomes.limit(0), []).count() == 0


def test_suffixes_of_several_labels(spark):
    rows = [("www.bad.co.uk", 0)] * 300 + [("new.co.uk", None), ("www.good.uk", 1), ("a.bad.co.uk", None), ("co.uk", None)]
    df = spark.createDataFrame(rows, "host string, good int")
    domain, suffix = hosts.levels(F.col("host"), ("co.uk", "uk"))
    got = {r[0]: (r[1], r[2]) for r in df.select("host", domain, suffix).distinct().collect()}
    assert got == {
        "www.bad.co.uk": ("bad.co.uk", "co.uk"), "a.bad.co.uk": ("bad.co.uk", "co.uk"), "new.co.uk": ("new.co.uk", "co.uk"),
        "www.good.uk": ("good.uk", "uk"), "co.uk": ("co.uk", "co.uk"),
    }
    bounds = {r.host: r.good_bound for r in hosts.host_bounds(df, suffixes=("co.uk",)).collect()}
    assert len(bounds) == 5 and bounds["new.co.uk"] > bounds["a.bad.co.uk"]  # a stranger, not the same registrant


def test_reputation_shrinks_small_hosts(spark):
    rows = [("bad.x.test", 0)] * 60 + [("new.x.test", 0)] + [("fine.y.test", 1)] * 300 + [("other.z.test", 1)] * 200 + [("silent.y.test", None)]
    got = {r.host: r.good_bound for r in hosts.host_bounds(spark.createDataFrame(rows, "host string, good int")).collect()}
    assert got["bad.x.test"] < 0.5 < got["fine.y.test"] and got["silent.y.test"] > 0.5
    assert got["new.x.test"] > got["bad.x.test"]  # one page tells little


def test_hosts_without_labels_move_no_bound(spark):
    rows = [("bad.x.test", 0)] * 80 + [("fine.y.test", 1)] * 90 + [("mixed.y.test", i % 2) for i in range(40)] + [("one.z.test", 1)]
    silent = [(f"h{i}.d{i % 900}.{'test' if i % 2 else 'other'}", None) for i in range(5000)]
    alone, among = (
        {r.host: r.good_bound for r in hosts.host_bounds(spark.createDataFrame(r, "host string, good int")).collect()} for r in (rows, rows + silent)
    )
    assert len(among) == 5004 and all(abs(among[host] - bound) < 1e-12 for host, bound in alone.items())
    pages = spark.createDataFrame([(1, "http://bad.x.test/a"), (2, "http://fine.y.test/"), (2, "http://fine.y.test/"), (3, "http://bad.x.test/" + "z" * 200_000)], "page_id long, url string")
    got = hosts.judge(pages, spark.createDataFrame(rows + silent, "host string, good int"), []).collect()
    assert sorted((r.page_id, r.verdict, len(r.path)) for r in got) == [(1, "block", 2), (2, "allow", 1), (2, "allow", 1), (3, "block", 200_001)]


def test_counts_of_hosts_are_read_once(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = hosts.judge(pages, queries.page_outcomes(spark, "/root/testdata/sf0.001"), queries.URL_RULES)._jdf.queryExecution().optimizedPlan().toString()
    leaves = [line for line in plan.splitlines() if "Relation" in line]
    assert sum("page_id" in line for line in leaves) == 1 and not any("quality" in line for line in leaves)


# 3 and 4 by plain versions


def test_toxicity_scores_by_a_plain_sum():
    draw = random.Random(7)
    texts = [" ".join(draw.choices(["fine", "day", "walk", "tree", "Été", "x9y"], k=9)) + (" vile filthiness" if i % 3 == 0 else "") for i in range(120)]
    labels = np.array([float(i % 3 == 0) for i in range(120)])
    model = toxicity.fit([toxicity.features(toxicity.WORD.findall(t.lower())) for t in texts], labels, [])
    scorer = toxicity.Scorer(model)
    for text in [*texts, "", "VILE walk", "unheard words", "vile " * 5000]:
        places = set()
        for word in toxicity.WORD.findall(text.lower()):
            for part in [word] + [word[:n] + "-" for n in (4, 5, 6, 7) if len(word) > n]:
                places.add(zlib.crc32(part.encode()) % toxicity.HASHES)
        plain = 1 / (1 + math.exp(-(model["bias"] + sum(model["weights"].get(p, 0.0) for p in places))))
        assert abs(scorer([text])[0] - plain) < 1e-9
    assert all((scorer([t])[0] >= 0.3) == bool(y) for t, y in zip(texts, labels))


def test_toxicity_finds_most_and_is_mostly_right_on_rows_not_learnt_from(spark):
    folder = "/root/testdata/sf0.1"
    got = queries.op3_toxicity(spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").toPandas()
    hit = ((got.predicted == 1) & (got.toxic == 1)).sum()
    assert hit / (got.toxic == 1).sum() >= 0.85 and hit / (got.predicted == 1).sum() >= 0.9


def plain_quality(texts, labels):
    """Index vectors, context sums, pooling and the network's output, one number at a time."""
    model = quality.fit([quality.tokens(t) for t in texts], labels)
    numbers, size = model["numbers"], len(model["numbers"])
    place = lambda t: numbers.get(t, numbers.get(quality.shape(t), size))
    index, context = model["vectors"][:, quality.SIZE :], np.zeros((size + 1, quality.SIZE))
    for text in texts:
        ids = [place(t) for t in quality.tokens(text)]
        for i, a in enumerate(ids):
            for gap in range(1, quality.WINDOW + 1):
                if i >= gap:
                    context[a] += index[ids[i - gap]] / gap
                    context[ids[i - gap]] += index[a] / gap
    return model, context, place


def test_quality_vectors_pooling_and_scores_by_a_plain_version():
    draw = random.Random(9)
    good = [". ".join(" ".join(draw.choices(["The", "river", "runs", "slowly", "home"], k=6)) for _ in range(4)) for _ in range(60)]
    bad = [" ".join(draw.choices(["BUY", "now", "now", "!!", "99", "x7z"], k=20)) for _ in range(60)]
    texts, labels = [t for pair in zip(good, bad) for t in pair], np.array([1.0, 0.0] * 60)
    model, context, place = plain_quality(texts, labels)
    index = model["vectors"][:, quality.SIZE :]
    assert (np.count_nonzero(index, axis=1) == quality.NONZERO).all() and np.allclose(np.linalg.norm(index, axis=1), 1)
    lengths = np.linalg.norm(context, axis=1)
    assert np.allclose(model["vectors"][:, : quality.SIZE][lengths > 0], context[lengths > 0] / lengths[lengths > 0, None], atol=1e-5)
    network, scorer = model["network"], quality.Scorer(model)
    first, shift, second, bias = network.layers
    for text in [*texts[:10], "", "Home now, 12 unknown words", "now " * 3000]:
        found = [model["vectors"][place(t)] for t in quality.tokens(text)]
        pooled = np.mean(found, axis=0) if found else np.zeros(2 * quality.SIZE)
        hidden = [math.tanh(sum((pooled[i] - network.mean[i]) / network.scale[i] * first[i, j] for i in range(len(pooled))) + shift[j]) for j in range(quality.HIDDEN)]
        logit = sum(h * w for h, w in zip(hidden, second)) + bias[0]
        assert abs(scorer([text])[0] - 1 / (1 + math.exp(-logit / network.temperature))) < 1e-6
    held = quality.Pooler(model["numbers"], model["vectors"])(texts)[np.arange(120) % quality.CALIBRATION == quality.CALIBRATION - 1]
    truth = labels[np.arange(120) % quality.CALIBRATION == quality.CALIBRATION - 1]

    def loss(temperature):
        p = np.clip(1 / (1 + np.exp(-network.logits(held) / temperature)), 1e-12, 1 - 1e-12)
        return -np.mean(truth * np.log(p) + (1 - truth) * np.log(1 - p))

    assert all(loss(network.temperature) <= loss(t) + 1e-9 for t in np.geomspace(0.25, 4, 33))


def test_one_document_of_each_near_group_stays_and_it_is_a_member(spark):
    docs = stored(table(spark, near_rows()), shared_folder(spark), "near-kept")
    label = {k: c for k, _, c in brute_components(near_rows(), 80)}
    kept = [label[r.doc_id] for r in minhash.keep_one(docs, percent=80).collect()]
    assert sorted(kept) == sorted(set(label.values()))
