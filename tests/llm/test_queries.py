"""The numbered queries over the smallest tables."""

import zlib

import duckdb
import numpy as np
import pytest

import oracle
import plain
from martflow.llm.queries import ENTRIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def run(spark, prefix):
    (name,) = (n for n in ENTRIES if n.startswith(prefix))
    return ENTRIES[name][0](spark, SF)


def test_all_are_there():
    assert sorted(int(name[2:].split("_")[0]) for name in ENTRIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(name for name, (_, sql) in ENTRIES.items() if sql))
def test_query_matches_sql(spark, name):
    query, sql = ENTRIES[name]
    assert oracle.compare(query(spark, SF), oracle.connect(SF), sql) == []


def test_op1(spark, rows):
    found = {r["doc_id"]: r for r in run(spark, "op1_").collect()}
    assert len(found) == len(rows)
    assert all(found[d]["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, _ in rows)
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall()
    held = [(d, q) for d, q in labels if found[d]["held_out"]]
    assert np.mean([found[d]["predicted"] == q for d, q in held]) >= 0.9


def test_op2(spark, rows):
    found = {r["doc_id"]: r for r in run(spark, "op2_").collect()}
    down = rows[::-1]
    for (doc, text), (_, following) in zip(down, down[1:] + down[:1]):
        half = len(text) // 2
        assert found[doc]["n_chars"] == len(text)
        assert found[doc]["edited_sha256"] == plain.sha(text[:len(text) - half] + following[:half])
    assert np.mean([r["near_edited"] > r["near_next"] for r in found.values()]) > 0.95
    prints = {}
    assert all(prints.setdefault(text, found[doc]["fingerprint"]) == found[doc]["fingerprint"] for doc, text in rows)
    assert {text: plain.simhash(text) for text in prints} == prints
    every = {int(p, 16) for p in prints.values()}
    for doc, r in found.items():
        own = int(r["fingerprint"], 16)
        assert r["n_near"] == (sum(0 < (own ^ x).bit_count() <= 3 for x in every) if doc % 20 == 0 else None)
        edited = int(r["edited_fingerprint"], 16)
        assert r["near_edited"] == 1 - (own ^ edited).bit_count() / 128


def test_op3(spark, rows):
    import base64

    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    coder = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for doc, text in rows:
        ids = coder.encode_ordinary(text or "")
        want[doc] = (len(ids), plain.sha(" ".join(map(str, ids))), plain.sha(text or ""))
    assert {r[0]: tuple(r)[1:] for r in run(spark, "op3_").collect()} == want


def test_op4(spark, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = {}, 0
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        want[doc] = (start, len(ids), plain.crc(ids))
        start += len(ids)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in run(spark, "op4_").collect()} == want


def test_op5(spark, rows):
    found = {r["doc_id"]: r for r in run(spark, "op5_").collect()}
    assert len(found) == len(rows)
    for doc, text in rows:
        base = plain.base_spans(text)
        assert found[doc]["base_sha256"] == plain.sha(",".join(base))
        assert set(base) <= set(found[doc]["spans"].split(",")) | {""}
        assert [found[doc][f"n_{k}"] for k in ("assign", "access", "hex")] == [
            sum(x.startswith(k + ":") for x in base) for k in ("assign", "access", "hex")]


def test_op6(spark, rows):
    want = {doc: (n, c, doc == c) for doc, n, c in plain.near_groups(rows)}
    assert {r[0]: tuple(r)[1:] for r in run(spark, "op6_").collect()} == want


def test_op9(spark):
    data = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY vec_id").fetchall()
    ids, x = np.array([d for d, _ in data]), np.array([v for _, v in data], dtype=float)
    hits = total = 0
    found = {}
    for r in run(spark, "op9_").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(found) == [i for i in ids.tolist() if i % 20 == 0]
    for q, own in found.items():
        scores = x @ x[ids == q][0]
        scores[ids == q] = -np.inf
        exact = set(ids[np.lexsort((ids, -scores))[:20]].tolist())
        hits, total = hits + len(exact & {v for _, v, _ in own}), total + len(exact)
        assert sorted(r for r, _, _ in own) == list(range(1, 21))
        assert all(s == pytest.approx(scores[ids == v][0], abs=1e-12) for _, v, s in own)
    assert hits >= 0.9 * total
