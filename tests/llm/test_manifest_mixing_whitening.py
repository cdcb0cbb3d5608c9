"""Whitened embeddings, mixtures and Merkle manifests against plain Python and numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from funil.llm import merkle
from funil.llm.eigen import largest_eigenpairs, minres
from funil.llm.mixing import mix, source_targets
from funil.llm.queries import QUERIES
from funil.llm.running import running_totals
from funil.llm.whitening import _exact_squares, whiten

N = 15  # awkward rows


def collect(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def check_whitened(rows, vectors, components=8):
    """Rows of vec_id, component, ... of ``vectors``, a dict by id, against the eigenvectors of the whole matrix."""
    ids = sorted(vectors)
    n, deviations, expected, explained = brute.whitened([vectors[i] for i in ids], components)
    assert len(rows) == n * expected.shape[1] and {r["n"] for r in rows} == {n}
    place = {i: k for k, i in enumerate(ids)}
    got = np.zeros(expected.shape)
    for r in rows:
        k, c = place[r["vec_id"]], r["component"] - 1
        got[k, c] = r["whitened"]
        assert r["deviation"] == deviations[k] and abs(r["explained"] - explained[c]) < 1e-10 * explained[c]
    signs = np.sign((got * expected).sum(0))
    assert np.abs(got * signs - expected).max() < 1e-7
    error = np.abs(got.T @ got / n - np.eye(expected.shape[1])).max()
    assert {r["identity_error"] for r in rows} and max(r["identity_error"] for r in rows) < 1e-10 and error < 1e-10


def test_whitening_query(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    vectors = {r["vec_id"]: r["embedding"] for r in table.collect()}
    usable = {i: v for i, v in vectors.items() if v is not None and all(c is not None and np.isfinite(c) for c in v)}
    check_whitened(collect(QUERIES["op11_whitening"](spark, folder)), usable)


def test_whitening_of_odd_vectors(spark):
    rnd = np.random.default_rng(2)
    good = {k: rnd.normal(size=5).tolist() for k in range(40)}
    rows = [(k, v) for k, v in good.items()] + [
        (100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [float("nan")] * 5), (103, [float("inf")] + [0.0] * 4),
        (104, []), (105, [1.0] * 4), (106, [1e30] * 5),
    ]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, n int, component string")
    check_whitened(collect(whiten(table)), good)
    check_whitened(collect(whiten(table, 2)), good, 2)
    assert whiten(table.where("false")).count() == 0 and whiten(table.where("vec_id = 100")).count() == 0
    same = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(3)], "vec_id long, embedding array<float>")
    assert whiten(same).count() == 0  # rows that do not differ have no component
    line = {k: [float(k), 2.0 * k, 0.0] for k in range(9)}
    flat = spark.createDataFrame(list(line.items()), "vec_id long, embedding array<float>")
    check_whitened(collect(whiten(flat)), line)
    ties = spark.createDataFrame([(None, [1.0, 0.0]), (None, [1.0, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert sorted(str(r["vec_id"]) for r in collect(whiten(ties))) == ["3", "None", "None"]


def test_exact_squares_of_large_numbers():
    entries, n = np.array([[10**11, -(10**11)], [0, 5]]), 10**6
    sums = [int(s) for s in entries.sum(0)]
    low = np.array([s // n for s in sums])
    rest = np.array([s - n * int(q) for s, q in zip(sums, low)])
    expected = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in entries]
    assert [int(v) for v in _exact_squares(entries, low, rest, n)] == expected


@pytest.mark.parametrize("size, wanted", [(3, 8), (64, 8), (200, 8), (150, 3)])
def test_eigenpairs(size, wanted):
    rnd = np.random.default_rng(size)
    rows = rnd.standard_normal((3 * size, size)) * np.linspace(1, 3, size)
    matrix, calls = rows.T @ rows / len(rows), []
    values, vectors, norms = largest_eigenpairs(lambda b: calls.append(b.shape[1]) or matrix @ b, size, wanted)
    expected = np.linalg.eigvalsh(matrix)[::-1][: len(values)]
    assert len(values) == min(size, wanted) and np.abs(values - expected).max() < 1e-12 * expected[0]
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * expected[0] and norms.max() < 1e-12 * expected[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12 and len(calls) < 100


def test_equal_eigenvalues():
    matrix = np.diag([5.0, 5.0, 5.0, *[1.0] * 97])
    values, vectors, _ = largest_eigenpairs(lambda b: matrix @ b, 100, 4)
    assert np.allclose(values, [5, 5, 5, 1]) and np.allclose(matrix @ vectors, vectors * values)


def test_minres_solves_projected_systems():
    rnd = np.random.default_rng(3)
    rows = rnd.standard_normal((90, 30))
    matrix = rows.T @ rows / 90
    values, vectors = np.linalg.eigh(matrix)
    out, shifts = vectors[:, -2:], values[-2:] + 0.01
    right = rnd.standard_normal((30, 2))
    found = minres(lambda b: matrix @ b, shifts, out, right, 60, 1e-13)
    project = np.eye(30) - out @ out.T
    for k in range(2):
        system = project @ (matrix - shifts[k] * np.eye(30)) @ project
        assert np.abs(system @ found[:, k] - project @ right[:, k]).max() < 1e-9


def test_running_totals(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice(["", "a", "a", "a", "a", "b", "c"]), k, rnd.randint(0, 9)) for k in range(3000)]
    table = spark.createDataFrame(rows, "key string, k long, amount long").repartition(7)
    got = {r["k"]: r["_before"] for r in running_totals(table, "key", ["k"], "amount").collect()}
    totals = {}
    for key, k, amount in sorted(rows, key=lambda r: r[1]):
        assert got[k] == totals.get(key, 0)
        totals[key] = totals.get(key, 0) + amount


def check_mixture(rows, weights=(5, 2, 1), share=1.5, most=2):
    """Rows of passes: whole words, targets, order and budget."""
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(r["size"] for r in rows if r["source"] == s and r["epoch"] == 1) for s in sources]
    wanted = brute.targets(sizes, weights, share, most)
    for s, size, target in zip(sources, sizes, wanted):
        own = [r for r in rows if r["source"] == s]
        assert {r["source_size"] for r in own} == {size} and all(abs(r["target"] - target) < 1e-6 for r in own)
        assert abs(sum(r["taken"] for r in own) - target) <= len(sources)
    at = 0
    for r in sorted(rows, key=lambda r: r["position"] + 0.5 * (r["taken"] == 0)):
        if r["taken"]:
            assert r["position"] == at and 0 < r["taken"] <= r["size"]
            at += r["taken"]
    assert at == int(share * sum(sizes))
    by_row = {}
    for r in rows:
        by_row[r["row"]] = by_row.get(r["row"], 0) + r["taken"]
        assert by_row[r["row"]] <= most * r["size"]
    taken = [r for r in rows if r["taken"]]
    in_order = [r["finish"] for r in sorted(taken, key=lambda r: r["position"])]
    assert in_order == sorted(in_order)
    return by_row


def test_mixture(spark, folder, texts):
    rows = collect(mix(spark.read.parquet(f"{folder}/documents.parquet")))
    assert {r["doc_id"]: r["size"] for r in rows} == {d: len(brute.WORD.findall(t)) for d, t, _ in texts}
    check_mixture(rows)
    again = mix(spark.read.parquet(f"{folder}/documents.parquet").repartition(5).orderBy(F.desc("n_chars")))
    key = lambda rows: sorted((r["doc_id"], r["epoch"], r["position"], r["taken"]) for r in rows)
    assert key(rows) == key(collect(again))
    result = collect(QUERIES["op12_mixing"](spark, folder))
    assert len(result) == len(texts)


def test_mixture_of_awkward_rows(awkward, empty):
    rows = collect(mix(awkward))
    assert len({r["row"] for r in rows}) == N and mix(empty).count() == 0
    check_mixture(rows)
    assert {r["taken"] for r in rows if r["doc_id"] in (4, 5, 6)} == {0}
    check_mixture(collect(mix(awkward, (1, 3), 3.0, 3.0)), (1, 3), 3.0, 3)
    for wrong in ({"weights": ()}, {"weights": (1, 0)}, {"share": 2.5}, {"most": 0.5}):
        with pytest.raises(ValueError):
            mix(awkward, **wrong)


def test_targets_stop_one_after_the_other(spark):
    sizes = {"=a": 1, "=b": 10, "=c": 100, "=d": 1000, "=e": 10_000, "=f": 0}
    table = spark.createDataFrame([(k, v) for k, v in sizes.items()], "_key string, _size long")
    got = {r["_key"]: r["target"] for r in source_targets(table, (5, 2, 1), 1.5, 2.0).collect()}
    expected = brute.targets(list(sizes.values()), (5, 2, 1), 1.5, 2.0)
    assert np.allclose([got[k] for k in sizes], expected) and sum(expected) == 1.5 * sum(sizes.values())


def check_manifest(rows, table):
    names = ("doc_id", "source", "lang", "n_chars", "text")
    given = [tuple(r[n] for n in names) for r in table.collect()]
    expected = sorted(
        (str(row[0]), leaf, subroot, root, tuple(path))
        for row, (leaf, subroot, root, path) in zip(given, brute.manifest(given))
    )
    got = sorted(
        (str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], tuple((s["left"], s["right"]) for s in r["path"])) for r in rows
    )
    # Equal rows are leaves of their own, side by side: their paths differ, and all are there.
    assert got == expected


def test_manifest(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    check_manifest(collect(merkle.manifest(table)), table)
    result = collect(QUERIES["op13_merkle_manifest"](spark, folder))
    texts = {r["doc_id"]: r["text"] or "" for r in table.collect()}
    for r in result:
        changed = brute.zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in texts[r["doc_id"]])
        assert r["verified"] == (not changed) == (r["folded_root"] == r["root"])


@pytest.mark.parametrize("rows", [1, 15, 16, 17, 256, 257, 600])
def test_manifest_of_any_size(spark, rows):
    docs = [(k, "hot" if k % 3 else f"s{k % 60}", "en", k, f"text {k}") for k in range(rows)]
    table = spark.createDataFrame(docs, "doc_id long, source string, lang string, n_chars long, text string").repartition(3)
    got = collect(merkle.manifest(table).withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))))
    check_manifest(got, table)
    assert all(r["folded"] == r["root"] for r in got)


def test_manifest_of_awkward_rows(awkward, empty):
    table = awkward.withColumn("n_chars", F.length("text").cast("long"))
    rows = collect(merkle.manifest(table))
    assert len(rows) == N
    check_manifest(rows, table)
    assert merkle.manifest(empty.withColumn("n_chars", F.lit(1))).count() == 0
    assert {r["root"] for r in collect(merkle.manifest(table.repartition(4).orderBy("text")))} == {rows[0]["root"]}
    assert {r["root"] for r in collect(merkle.manifest(table.where("doc_id <> 3 OR doc_id IS NULL")))} != {rows[0]["root"]}
