"""The operators on awkward rows, on empty tables, and against plain versions."""

import base64
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import plain
from samples import changed, prose
from martflow.llm import common, fmindex, graph, lines, mixing, neardup, passages, quality, secrets, simhash, tokenfiles, tokens, vectors
from martflow.session import shared_dir


def got(df, *names):
    return Counter(tuple(row) for row in df.select(*names).collect())


# ---- helpers -----------------------------------------------------------------------------------

def test_word_hashes_follow_the_words_in_any_piece():
    text = (" ab  cd\tab\n" + "x" * 700_000 + " cd " + "y z " * 200_000).encode()
    found = common.word_hashes(text)
    names = text.split()
    assert len(found) == len(names)
    of = {}
    for name, h in zip(names, found.tolist()):
        assert of.setdefault(name, h) == h
    assert len(set(of.values())) == len(of)
    assert len(common.word_hashes(b"")) == len(common.word_hashes(b" \n")) == 0


# ---- 1 quality ---------------------------------------------------------------------------------

def test_additive_model_learns_steps_and_a_pair():
    draw = np.random.default_rng(0)
    x = draw.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5) | (x[:, 2] > 0.9)).astype(float)
    model = quality.fit(x[:3000], y[:3000], pairs=2)
    assert {0, 1} in [{a, b} for a, b, *_ in model.pairs]
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.95


def test_score_is_the_sum_of_its_tables():
    draw = np.random.default_rng(1)
    x = draw.random((500, 3))
    model = quality.fit(x, (x[:, 0] > 0.3).astype(float), rounds=5, pair_rounds=3, pairs=2)
    row = x[7]
    total = model.base + sum(t[int((row[j] >= e).sum())] for j, (e, t) in enumerate(zip(model.edges, model.tables)))
    total += sum(t[int((row[a] >= p).sum()), int((row[b] >= q).sum())] for a, b, p, q, t in model.pairs)
    assert model.score(x[7:8])[0] == pytest.approx(1 / (1 + np.exp(-total)))


def test_quality_on_awkward_rows(spark, awkward_docs, no_docs, awkward):
    labels = spark.createDataFrame([(i, i % 2) for i in range(130)] + [(3, 0), (3, 1), (4, None), (None, 1)], "doc_id bigint, quality int")
    model = quality.train(awkward_docs, labels, rounds=2)
    scored = quality.score(awkward_docs, model)
    rows = scored.collect()
    assert len(rows) == len(awkward) and scored.columns[-2:] == ["score", "predicted"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert quality.score(no_docs, model).count() == 0
    empty = quality.train(no_docs, labels.limit(0))
    assert {r["score"] for r in quality.score(awkward_docs, empty).collect()} == {0.5}


def test_quality_learns_nothing_from_held_out_labels(spark, awkward_docs):
    labels = spark.range(200).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 0).otherwise(1))
    one, other = (quality.train(awkward_docs, x, rounds=2) for x in (labels, flipped))
    assert one.base == other.base and all((a == b).all() for a, b in zip(one.tables, other.tables))


# ---- 2 fingerprints ----------------------------------------------------------------------------

def test_edited_texts_and_equal_fingerprints(spark, awkward_docs, awkward):
    rows = simhash.edited_prints(awkward_docs, ranges=5).collect()
    assert len(rows) == len(awkward)
    texts = {}
    order = sorted({(d, t or "") for d, t in awkward if d is not None and d != 6}, reverse=True)
    unique = [r for r in rows if r["doc_id"] is not None and r["doc_id"] != 6]
    by_id = {r["doc_id"]: r for r in unique}
    ids = [d for d, _ in order]
    for (doc, text), (after, following) in zip(order, order[1:]):
        if doc > 6 > after:
            continue  # the repeated row lies between
        half = len(text) // 2
        assert by_id[doc]["n_chars"] == len(text)
        assert by_id[doc]["edited_sha256"] == plain.sha(text[:len(text) - half] + following[:half]), doc
        if text:
            assert texts.setdefault(text, by_id[doc]["fingerprint"]) == by_id[doc]["fingerprint"]
    assert len(set(ids)) == len(ids)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 and len(r["fingerprint"]) == 32 for r in rows)
    one = simhash.edited_prints(spark.createDataFrame([(1, "abcd")], "doc_id bigint, text string")).head()
    assert one["edited_sha256"] == plain.sha("abab") and one["near_next"] == 1.0


@pytest.mark.parametrize("n", [0, 1, 2, 5, 16, 100])
def test_ranges(spark, n):
    cuts = sorted(random.Random(n).sample(range(-300, 300), n))
    rows = spark.range(-310, 310).select("id", simhash._range_of("id", cuts).alias("r")).collect()
    assert all(r["r"] == sum(c < r["id"] for c in cuts) for r in rows)


def test_fingerprints_count_weighted_votes(spark):
    text = "alpha beta gamma alpha beta delta"
    frame = spark.createDataFrame([(1, text), (2, "")], "id bigint, t string")
    rows = {r["id"]: r for r in simhash.votes(frame, ["id"], "t").collect()}
    terms = frame.where("id = 1").select(simhash.words_of("t").alias("w")).select(F.explode(simhash.terms("w")).alias("t")).select(
        "t.h", F.xxhash64("t.h").alias("g"), "t.w").collect()
    for half, name in (("a", "h"), ("b", "g")):
        bits = 0
        for i in range(64):
            votes = sum(t["w"] * (1 if (t[name] >> i) & 1 else -1) for t in terms)
            bits |= (votes > 0) << i
        assert rows[1][half] % (1 << 64) == bits
    assert rows[2]["a"] == rows[2]["b"] == 0


@pytest.mark.parametrize("radius", [0, 3, 6])
def test_block_tables_find_all_within_the_radius(spark, radius):
    draw = random.Random(radius)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    base = [draw.getrandbits(128) for _ in range(30)]
    near = [x ^ sum(1 << b for b in draw.sample(range(128), draw.randint(0, 8))) for x in base for _ in range(6)]
    halves = lambda xs: spark.createDataFrame([(signed(x >> 64), signed(x & ((1 << 64) - 1))) for x in xs], "a bigint, b bigint")
    found = simhash.within(halves(base), halves(near), radius).select("query.a", "query.b", "found.a", "found.b").collect()
    want = {(x, y) for x in base for y in near if bin(x ^ y).count("1") <= radius}
    whole = lambda a, b: (a % (1 << 64) << 64) | b % (1 << 64)
    assert sorted((whole(r[0], r[1]), whole(r[2], r[3])) for r in found) == sorted(want)


def test_neighbours_in_a_block_that_very_many_share(spark):
    """A family in one block of every table, against comparing all; a pair that agrees in several blocks counts once."""
    draw = random.Random(6)
    base = draw.getrandbits(128)
    ids = [base ^ sum(1 << b for b in draw.sample(range(0, 20), draw.randint(0, 6))) for _ in range(700)] + [draw.getrandbits(128) for _ in range(50)]
    ids += ids[:40]  # copies
    frame = spark.createDataFrame([(i, f"{x:032x}", "x") for i, x in enumerate(ids)], "doc_id bigint, fingerprint string, t string").repartition(4)
    found = simhash.with_neighbours(frame, F.col("doc_id") % 20 == 0).collect()
    assert len(found) == len(ids)
    every = set(ids)
    for r in found:
        own = ids[r["doc_id"]]
        assert r["n_near"] == (sum(0 < (own ^ x).bit_count() <= 3 for x in every) if r["doc_id"] % 20 == 0 else None)


def test_fingerprints_of_no_documents(no_docs):
    assert simhash.edited_prints(no_docs).count() == 0
    assert simhash.with_neighbours(simhash.edited_prints(no_docs), F.lit(True)).count() == 0


# ---- 3 tokens ----------------------------------------------------------------------------------

def library():
    path, pattern = tokens.vocabulary()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("long", [3, 50, 1 << 16])
def test_pieces_encode_as_the_whole(long):
    coder = library()
    for text in ("", "a", "It's  two\n\n spaces 's 'll\t x y \x1c z  ", "ab" * 300, "é ñ 　 漢字 \U0001f600! " * 40, "   "):
        assert tokens.encode_text(coder, text, long).tolist() == coder.encode_ordinary(text)


def test_tokens_round_trip(awkward_docs, no_docs, awkward):
    path, pattern = tokens.vocabulary()
    coder = library()
    back = tokens.decode(tokens.encode(awkward_docs, path, pattern), path, pattern)
    rows = back.select("doc_id", "text", "ids", "bytes", "score").collect()
    assert len(rows) == len(awkward)
    for r in rows:
        assert r["ids"] == coder.encode_ordinary(r["text"] or "")
        assert bytes(r["bytes"]) == (r["text"] or "").encode() and r["score"] == "x"
    assert tokens.encode(no_docs, path, pattern).count() == 0


def test_decoding_gives_raw_bytes(spark):
    path, pattern = tokens.vocabulary()
    half = library().encode_ordinary("é")
    frame = spark.createDataFrame([(half,), ([],), (None,)], "ids array<int>")
    assert [r["bytes"] for r in tokens.decode(frame, path, pattern).collect()] == [bytearray("é".encode()), bytearray(), None]


# ---- 4 token files -----------------------------------------------------------------------------

def test_token_files(spark, awkward_docs, awkward):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    root = shared_dir(spark, "token-test")
    rows = tokenfiles.read(tokenfiles.write(awkward_docs, root, path), root).orderBy("start").collect()
    assert len(rows) == len(awkward)
    assert [r["doc_id"] for r in rows] == sorted((d for d, _ in awkward), key=lambda d: (d is None, d or 0))
    texts = {}
    for doc, text in awkward:
        texts.setdefault(doc, []).append(tokenizer.encode(text or "", add_special_tokens=False).ids + [2])
    start = 0
    for r in rows:
        assert r["start"] == start and r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == plain.crc(r["ids"])
        texts[r["doc_id"]].remove(r["ids"])
        start += r["n_tokens"]


def test_token_files_of_no_documents(spark, no_docs):
    root = shared_dir(spark, "token-test")
    assert tokenfiles.read(tokenfiles.write(no_docs, root, public_tokenizers.path("word_bpe_49k.json")), root).count() == 0


def test_signs_behind_any_letter_or_number():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, made = Tokenizer.from_file(path), tokenfiles.Coder(open(path, "rb").read())
    letters = [c for c in map(chr, range(0x110000)) if c.isalnum()]
    words = [f"{before}{c}{signs}" for c in letters for before, signs in (("", "."), ("Ab", ",)"), ("e", "|>"))]
    words += ["YENİ.", "YENİs.", "হয়,", "e\u0301.", "e\u0301s.", "\u1100\u1161.", "K;", "½%", "x\t.", "it's.", "it'."]
    wanted = [x.ids for x in tokenizer.encode_batch(words, add_special_tokens=False)]
    found = [np.frombuffer(x, dtype="<u2").tolist() for x in made.encode(words)]
    assert [w for w, a, b in zip(words, found, wanted) if a != b] == []


def test_words_of_plain_letters():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, made = Tokenizer.from_file(path), tokenfiles.Coder(open(path, "rb").read())
    letters = tokenfiles._LETTERS
    assert made.plain("naïveté") and not made.plain("don't") and not made.plain("x1") and not made.plain("e\u0301")
    words = [a + b for a in letters for b in letters] + [f"{a}{b.upper()}{a}{b}".title() for a in letters for b in letters[::3]]
    words += ["straße", "STRASSE", "Ÿÿ", "ŸÖ", "été.", "ÉTÉ!", "a" * 500, "éa" * 300]
    wanted = [x.ids for x in tokenizer.encode_batch(words, add_special_tokens=False)]
    assert [np.frombuffer(x, dtype="<u2").tolist() for x in made.encode(words)] == wanted


def test_special_strings_in_a_text(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = [
        "a <|endoftext|> b", "Ab<|endoftext|>Ab.<|startoftext|>", "<|endoftext|>.", "<|ENDOFTEXT|>x <|EndOfText|>", "<|endoftext",
        "<|endoftext|><|endoftext|>\u0301e", "<|<|endoftext|>|>\n<|endoftext|>\n", "e<|endoftext|>\u0301 'S<|endoftext|>'s",
    ]
    root = shared_dir(spark, "token-test")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = tokenfiles.read(tokenfiles.write(docs, root, path), root).orderBy("doc_id").collect()
    assert [r["ids"] for r in rows] == [tokenizer.encode(text, add_special_tokens=False).ids + [2] for text in texts]


def test_known_words_are_forgotten_but_not_wrong():
    vocabulary = open(public_tokenizers.path("word_bpe_49k.json"), "rb").read()
    small, text = tokenfiles.Coder(vocabulary, kept=10), "It's  FINE ́x <|endoftext|> é a\tb 12 ½ 漢字"
    plain_ids = small.tokenizer.encode(text, add_special_tokens=False).ids
    for _ in range(3):
        found = small.encode([text, "more " + " ".join(map(str, range(30)))])[0]
        assert np.frombuffer(found, dtype="<u2").tolist() == plain_ids
    wide = json.loads(vocabulary)
    wide["added_tokens"] += [
        {"id": 49408 + i, "content": f"<|{i}|>", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}
        for i in range(20_000)
    ]
    assert tokenfiles.Coder(json.dumps(wide).encode()).kind == np.dtype("<u4")


# ---- 5 secrets ---------------------------------------------------------------------------------

def test_secrets_by_the_base_rules(spark, awkward_docs, awkward):
    path = shared_dir(spark, "ledger-test")
    secrets.scan(awkward_docs, path)
    found = secrets.findings(awkward_docs, path)
    assert found.count() == len(awkward)
    want = Counter((doc, tuple(plain.base_spans(text))) for doc, text in awkward)
    base = [r.kind for r in secrets.BASE]
    have = Counter(
        (r["doc_id"], tuple(f"{f['kind']}:{f['start']}:{f['end']}" for f in r["findings"] if f["kind"] in base)) for r in found.collect()
    )
    assert have == want
    assert sum(len(spans) for _, spans in want) >= 5


def test_only_unseen_blobs_and_rules_are_scanned(spark, awkward_docs, awkward):
    path = shared_dir(spark, "ledger-test")
    few = awkward_docs.where("doc_id < 10")
    secrets.scan(few, path, secrets.BASE)
    ledger = lambda: secrets.open_ledger(spark, path)
    first = ledger().count()
    assert first == len({text or "" for doc, text in awkward if doc is not None and doc < 10})
    secrets.scan(few, path, secrets.BASE)
    assert ledger().count() == first
    secrets.scan(awkward_docs, path, secrets.BASE)
    assert ledger().count() == len({text or "" for _, text in awkward})
    newer = (secrets.BASE[0]._replace(version=2, pattern="hunter", least=(0, 1), hints=()), *secrets.BASE[1:])
    secrets.scan(awkward_docs, path, newer)
    later = [r["rules"] for r in ledger().collect()]
    assert later.count(["assign@2"]) == len({text or "" for _, text in awkward})
    kinds = {r["doc_id"]: [f["kind"] for f in r["findings"]] for r in secrets.findings(awkward_docs, path, newer).collect()}
    assert kinds[21] == ["assign", "assign", "access", "hex"] and kinds[22] == []


def test_secrets_without_documents(spark, no_docs):
    path = shared_dir(spark, "ledger-test")
    secrets.scan(no_docs, path)
    assert secrets.findings(no_docs, path).count() == 0


# ---- 6 near copies -----------------------------------------------------------------------------

def test_near_groups(awkward_docs, awkward, no_docs):
    have = got(neardup.near_groups(awkward_docs), "doc_id", "n_shingles", "component_id", "kept")
    want = Counter((d, n, c, d == c) for d, n, c in plain.near_groups(awkward))
    assert have == want
    assert neardup.near_groups(no_docs).count() == 0


@pytest.mark.parametrize("block", [1, 3, 2048])
def test_buckets_of_several_components(spark, monkeypatch, block):
    """A chain of texts whose neighbours only are alike, and a family that is nowhere alike enough."""

    monkeypatch.setattr(neardup, "BLOCK", block)
    text, rows = prose(50, 120), []
    for i in range(25):
        text = " ".join(w if k % 25 != i else f"step{i}" for k, w in enumerate(text.split()))
        rows.append((1000 - 7 * i, text))
    rows += [(i, changed(prose(51, 200), i, 0.045)) for i in range(60)]
    have = got(neardup.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string")), "doc_id", "n_shingles", "component_id")
    assert have == Counter(plain.near_groups(rows))


def test_registers_merge_and_estimate():
    draw = np.random.default_rng(0)
    pool = draw.integers(0, 1 << 63, 2000, dtype=np.uint64) * np.uint64(2)
    a, b = pool[:1000], pool[200:1200]
    assert (np.maximum(neardup.registers(a), neardup.registers(b)) == neardup.registers(np.union1d(a, b))).all()
    passed = []
    for shared in (100, 400, 600, 750, 900):
        x, y = pool[:1000], pool[1000 - shared:2000 - shared]
        alike = shared / (2000 - shared)
        passed.append(bool(neardup.plausible(
            np.array([1000.0]), np.array([1000.0]), neardup.registers(x)[None], neardup.registers(y)[None], 0.75)[0]))
        equal = (neardup.registers(x) == neardup.registers(y)).mean()
        assert abs(equal - alike) < 0.15
    assert passed == [False, False, False, True, True]
    assert not neardup.plausible(np.array([100.0]), np.array([1000.0]), neardup.registers(a[:100])[None], neardup.registers(a)[None], 0.75)[0]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    found = graph.components(spark.createDataFrame(chain + star + [(7, 7)], "a bigint, b bigint"))
    assert got(found, "node", "component") == Counter([(i, 0) for i in range(41)] + [(i, 100) for i in range(100, 130)])


# ---- 7 passages --------------------------------------------------------------------------------

@pytest.mark.parametrize("crowd", [{"crowd": 0}, {"crowd": 1}, {"crowd_words": 300}, {}])
def test_passages(awkward_docs, awkward, crowd):
    cut = passages.cut_passages(awkward_docs, shard=500, **crowd)
    want = Counter((doc, *x) for (doc, _), x in zip(awkward, plain.cut_passages(awkward)))
    have = got(cut, "doc_id", "n_words", "n_removed", "text")
    assert have == want
    assert set(cut.columns) == set(awkward_docs.columns)


@pytest.mark.parametrize("crowd", [0, 1024])
def test_passages_where_hashes_are_equal(spark, monkeypatch, crowd):
    texts = [prose(i, 300) for i in range(60)]
    texts += [f"{prose(100 + i, 30)} {texts[i][i:i + 900]} {prose(200 + i, 30 + i)}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    want = [(i, *x) for i, x in enumerate(plain.cut_passages(list(enumerate(texts))))]
    # Few values for segments, and one for a half of the rows' names: what is left tells them apart.
    few = lambda words, starts, ends: passages.span_hashes(words, starts, ends) & np.uint64(0xFFFFF)
    monkeypatch.setattr(passages, "_row", lambda text="text": F.struct(F.lit(7).cast("long").alias("a"), F.xxhash64("doc_id", text).alias("b")))
    found = passages.cut_passages(docs, spans=few, crowd=crowd, shard=2000)
    assert sorted(tuple(r) for r in found.select("doc_id", "n_words", "n_removed", "text").collect()) == want


def test_equal_windows_are_searched_once():
    draw = np.random.default_rng(2)
    words = [draw.integers(0, 40, 60, dtype=np.uint64) for _ in range(20)]
    words += [w.copy() for w in words[:5]]
    import pyarrow as pa

    rows = pa.table({
        "anchor": pa.array(range(25), pa.int64()), "seg": pa.array(range(25), pa.int64()),
        "places": pa.array([1] * 25, pa.int64()), "words": pa.array([w.tobytes() for w in words], pa.binary())})
    few, many = (passages._searched(6, many)(rows).to_pydict() for many in (1, 1 << 30))
    assert few == many and len(few["seg"]) >= 550


def test_passages_of_no_documents(no_docs):
    assert passages.cut_passages(no_docs).count() == 0


@pytest.mark.parametrize("n_symbols", [1, 2, 5, 300])
def test_index_counts_patterns(n_symbols):
    draw = np.random.default_rng(n_symbols)
    text = np.unique(draw.integers(0, n_symbols, 700), return_inverse=True)[1]
    index = fmindex.FmIndex(text, 12)
    ends = np.arange(12, len(text) + 1)
    for least in (1, 2, 3):
        found = index.matched(text, ends, 12, least)
        for end, n in zip(ends[::37].tolist(), found[::37].tolist()):
            count = lambda k: sum((text[i:i + k] == text[end - k:end]).all() for i in range(len(text) - k + 1))
            assert n == 0 or count(n) >= least
            assert n == 12 or count(n + 1) < least


# ---- 8 lines -----------------------------------------------------------------------------------

@pytest.mark.parametrize("sizes", [{}, {"shard": 1, "slice_": 2}])
def test_lines(awkward_docs, awkward, sizes):
    short = lines.dedup_lines(awkward_docs, **sizes)
    assert got(short, "doc_id", "n_lines", "n_dropped", "text") == Counter(plain.kept_lines(awkward))
    assert set(short.columns) == set(awkward_docs.columns)


def test_lines_of_no_documents(no_docs):
    assert lines.dedup_lines(no_docs).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_minimal_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64))
    sizes, bits = lines.build(keys)
    assert sorted(lines.index(sizes, bits, keys).tolist()) == list(range(len(keys)))


# ---- 9 vectors ---------------------------------------------------------------------------------

def best(rows, k):
    out = {}
    for q, x in rows:
        if q % 20 == 0:
            scored = []
            for i, y in rows:
                if i != q:
                    total = 0.0
                    for a, b in zip(x, y):
                        total += float(a) * float(b)
                    scored.append((-total, i))
            out[q] = sorted(scored)[:k]
    return out


def test_nearest_rows_of_many_copies_and_repeated_ids():
    draw = np.random.default_rng(9)
    x = draw.normal(size=(400, 7))
    x[50:120] = x[50]  # ties, to smaller ids
    x[130:160] = -x[50]
    own = draw.permutation(400)
    own[200:260] = own[200]  # an id that would fill the best k
    x[200:260] += 5
    q, itself = draw.normal(size=(30, 7)), np.r_[own[50:60], own[200:210], np.arange(1000, 1010)]
    q[0] = x[50]
    allowed = draw.random((30, 400)) < 0.7
    allowed[3] = False
    for k in (1, 5, 500):
        for limit in (None, allowed):
            row, col, score = vectors.nearest_rows(q, itself, x, own, k, limit)
            for i in range(30):
                found = {}
                for j in range(400):
                    if own[j] != itself[i] and (limit is None or limit[i, j]):
                        total = 0.0
                        for a, b in zip(q[i].tolist(), x[j].tolist()):
                            total += a * b
                        found[own[j]] = max(total, found.get(own[j], -np.inf))
                want = sorted(found.items(), key=lambda p: (-p[1], p[0]))[:k]
                assert list(zip(own[col[row == i]], score[row == i])) == want
    assert [len(a) for a in vectors.nearest_rows(q, itself, x[:0], own[:0], 3)] == [0, 0, 0]


def test_neighbours_of_clustered_vectors(spark):
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(12, 16)) * 3
    x = (centres[draw.integers(0, 12, 1500)] + draw.normal(size=(1500, 16))).astype(np.float32)
    x[200:260] = x[200]  # a vector that many rows have
    frame = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(x)], "vec_id bigint, embedding array<float>, rank string")
    found = vectors.nearest(frame, frame.where("vec_id % 20 = 0"), 20, list_=40, shard=100, slice_=30).collect()
    want = best(list(enumerate(x)), 20)
    assert Counter(r["query_id"] for r in found) == Counter({q: 20 for q in want})
    hits = 0
    for q, exact in want.items():
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [(-s, v) for _, v, s in own] == sorted((-s, v) for _, v, s in own)
        hits += len({v for _, v, _ in own} & {v for _, v in exact})
    assert hits >= 0.9 * 20 * len(want)


def test_queries_on_a_small_group_find_k_rows(spark):
    draw = np.random.default_rng(6)
    x = draw.normal(size=(1000, 8))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    x[:60] = [2, 0, 0, 0, 0, 0, 0, 0]  # copies on their centroid, the longest vectors
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    asked = frame.where("vec_id = 0 OR vec_id % 10 = 9 AND vec_id > 60")
    found = Counter(r["query_id"] for r in vectors.nearest(frame, asked, 100, list_=20).collect())
    assert set(found.values()) == {100} and len(found) == 95


def test_lists_are_read_until_they_hold_enough():
    centres = np.array([[1.0, 0, 0], [0, 1, 0], [-1, 0, 0], [0, -1, 0]])
    graph, entries = vectors._graph(centres)
    index = vectors.Index(2, 1.0, centres, graph, entries, 1.03, 3, 1.0, np.array([2, 5, 0, 30]), 21)
    asked = np.array([[1, 0.1], [0.1, -1]])
    assert [x.tolist() for x in index.lists_for(asked)] == [[0, 1, 3], [3]]
    assert [x.tolist() for x in index._replace(least=99).lists_for(asked)] == [[0, 1, 2, 3]] * 2


def test_neighbours_of_few_and_bad_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, []), (9, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (20, [-1.0, 0.0]), (40, None)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    asked = frame.where("vec_id % 20 = 0")
    found = sorted(tuple(r) for r in vectors.nearest(frame, asked, 20).collect())
    assert found == [(0, 1, 1, 0.5), (0, 2, 2, 0.5), (0, 3, 20, -1.0), (20, 1, 1, -0.5), (20, 2, 2, -0.5), (20, 3, 0, -1.0)]
    assert vectors.nearest(frame.limit(0), asked.limit(0), 20).count() == 0
    assert vectors.nearest(frame, asked.limit(0), 20).count() == 0


# ---- 10 mixing ---------------------------------------------------------------------------------

def test_targets_by_pouring(spark, awkward_docs, awkward):
    rows = mixing.mix(awkward_docs).collect()
    assert len(rows) == len(awkward)
    sizes = Counter()
    for r in rows:
        assert r["size"] == len(plain.words(r["text"])) and 0 <= r["copies"] <= 2
        sizes[r["source"]] += r["size"]
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    targets, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * level >= 2 * sizes[s]}
        if not full:
            targets |= {s: weights[s] * level for s in open_}
            break
        targets |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    longest = max(r["size"] for r in rows)
    for s in names:
        own = [r for r in rows if r["source"] == s]
        assert all(r["target"] == pytest.approx(targets[s]) and r["source_size"] == sizes[s] for r in own)
        assert abs(sum(r["size"] * r["copies"] for r in own) - targets[s]) <= longest
    again = mixing.mix(awkward_docs.repartition(7))
    assert got(again, "doc_id", "size", "copies") == Counter((r["doc_id"], r["size"], r["copies"]) for r in rows)
    assert mixing.repeated(again).count() == sum(r["copies"] for r in rows)


def test_mix_of_nothing(spark, no_docs):
    assert mixing.mix(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id bigint, text string, source string")
    assert got(mixing.mix(blank), "doc_id", "size", "target", "copies") == Counter([(1, 0, 0.0, 0), (2, 0, 0.0, 0)])
