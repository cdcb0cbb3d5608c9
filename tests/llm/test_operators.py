"""Each operator's query against DuckDB or plain Python, on the smallest tables."""

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import brute
from compare import connect, difference
from funil.llm.oracle import ORACLE
from funil.llm.queries import QUERIES
from funil.llm.sharding import bounded_walk, capacities, shard_rows


def result(spark, folder, name):
    return [r.asDict() for r in QUERIES[name](spark, folder).collect()]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, folder, name):
    assert difference(spark, connect(folder), folder, QUERIES[name], ORACLE[name]) is None


def test_sharding(spark, folder, texts):
    rows = result(spark, folder, "op2_ring_sharding")
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {
        d: (len(t.encode()) + 1, brute.zlib.crc32(t.encode())) for d, t, _ in texts
    }
    sizes = [sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(8)]
    assert all(own == list(range(len(own))) for own in sizes)
    assert max(map(len, sizes)) - min(map(len, sizes)) <= 1
    # Only what a full shard cannot hold has moved on.
    home = [sum(r["home_shard"] == s for r in rows) for s in range(8)]
    assert sum(r["home_shard"] != r["shard"] for r in rows) == sum(max(0, h - len(s)) for h, s in zip(home, sizes))


def test_walk_goes_clockwise():
    # Nodes of shards 0, 1, 0, 2; arc 0 overflows past the full shard 1 to shard 2.
    assert bounded_walk({0: 5, 1: 2}, [0, 1, 0, 2], [3, 2, 2]) == [(0, 0, 3), (1, 1, 2), (0, 2, 2)]
    assert capacities(11, 4, 1.0) == [3, 3, 3, 2]
    assert capacities(10, 4, 1.2) == [3, 3, 3, 3]


def test_bounded_loads_keep_homes(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'t' AS text")
    tight = {r["doc_id"]: r for r in shard_rows(docs, 5).collect()}
    loose = {r["doc_id"]: r for r in shard_rows(docs, 5, load_factor=1.5).collect()}
    assert all(loose[d]["home_shard"] == r["home_shard"] for d, r in tight.items())
    assert sum(r["home_shard"] != r["shard"] for r in loose.values()) <= sum(
        r["home_shard"] != r["shard"] for r in tight.values()
    )


def test_similar_groups(spark, folder, texts):
    expected = brute.components([(d, t) for d, t, _ in texts])
    rows = result(spark, folder, "op3_jaccard_join")
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == expected
    assert any(d != c for d, (_, c) in expected.items())


def test_sentencepiece(spark, folder, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    expected = {}
    for d, t, _ in texts:
        ids = library.encode(t)
        expected[d] = (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(library.decode(ids)))
    rows = result(spark, folder, "op4_sentencepiece")
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows} == expected


def test_packing(spark, folder, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d: [*library.encode(t, add_special_tokens=False).ids, 1] for d, t, _ in texts}
    shares = brute.check_pieces(result(spark, folder, "op6_mixture_packing"), ids)
    total = sum(map(len, ids.values()))
    for source in {s for *_, s in texts}:
        share = 2048 * sum(len(ids[d]) for d, _, s in texts if s == source) / total
        got = np.cumsum([own[source] for own in shares[:-1]])
        assert np.abs(got - share * np.arange(1, len(got) + 1)).max() <= 3 * 64


def test_personal_data(spark, folder, texts):
    for row, (d, text, _) in zip(sorted(result(spark, folder, "op7_pii"), key=lambda r: r["doc_id"]), texts):
        plain = brute.personal(text)
        assert row["base_sha256"] == brute.sha(",".join(f"{k}:{a}:{b}" for k, a, b in plain))
        assert [row[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [
            sum(k == kind for k, *_ in plain) for kind in ("email", "ip", "card", "phone")
        ]
        assert set(f"{k}:{a}:{b}" for k, a, b in plain) <= set(row["spans"].split(","))


def test_token_files(spark, folder, texts):
    library, start, expected = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, {}
    for d, t, _ in texts:
        ids = [*library.encode(t, add_special_tokens=False).ids, 0]
        expected[d] = (start, len(ids), brute.crc(ids))
        start += len(ids)
    rows = result(spark, folder, "op9_token_files")
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows} == expected


def test_quality_rules(spark, folder, texts):
    rows = {r["doc_id"]: r for r in result(spark, folder, "op10_quality_rules")}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for d, text, _ in texts:
        expected = brute.statistics(text)
        assert tuple(rows[d][n] for n in names) == expected
        assert rows[d]["base_failed"] == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert not (rows[d]["kept"] and rows[d]["base_failed"])


def test_licences(spark, folder, texts):
    names = {"MIT License": "MIT", "Apache License": "Apache-2.0", "GNU General": "GPL", "CC BY-NC": "CC-BY-NC"}
    expected = {d: ",".join(sorted(f for n, f in names.items() if n in t)) for d, t, _ in texts}
    assert {r["doc_id"]: r["families"] for r in result(spark, folder, "op5_license_scan")} == expected
