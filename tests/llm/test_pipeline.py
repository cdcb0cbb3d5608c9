"""The pipeline's stages against plain Python, each on its own input."""

import public_tokenizers
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from funil.llm.pii import find, masked
from funil.settings import write_once


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = write_once(stage(spark, docs, folder), name)
        after = docs.collect()
        if name != "packing":
            assert docs.columns == columns
            kept = {r["doc_id"]: r for r in after}
        if name == "quality_rules":
            good = {d for d, r in before.items() if (s := brute.statistics(r["text"] or ""))[0] >= 50
                    and 100 * s[4] <= 50 * s[0]}
            assert set(kept) <= good and len(kept) > 0.6 * len(before)
            assert all(kept[d] == before[d] for d in kept)
        if name == "line_dedup":
            rows = [(d, r["text"], r["source"]) for d, r in before.items()]
            group = brute.components([(d, r["text"]) for d, r in before.items()])
            assert {d: r["text"] for d, r in kept.items()} == {
                d: t for d, t, _ in brute.without_boilerplate(rows, 0.1, 2, lambda d: group[d][1])
            }
        if name == "near_duplicates":
            expected = brute.components([(d, r["text"]) for d, r in before.items()])
            assert set(kept) == {d for d, (_, c) in expected.items() if d == c}
        if name == "mask_personal_data":
            assert {d: r["text"] for d, r in kept.items()} == {
                d: masked(r["text"], find(r["text"])) for d, r in before.items()
            }
            assert all(r["n_chars"] == len(r["text"]) for r in kept.values())
        if name == "packing":
            library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            ids = {d: [*library.encode(r["text"], add_special_tokens=False).ids, 1] for d, r in before.items()}
            brute.check_pieces([r.asDict() for r in after], ids)


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_duplicates", "mask_personal_data", "packing"
    ]


def test_boilerplate_of_pages_that_are_no_copies(spark):
    """A page of stock lines from different pages loses them; near copies keep what only they share."""
    words = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    stock = [words(f"stock{k}x", 30) for k in range(3)]
    rows = [(100 * k + j, f"{stock[k]}\n{words(f'own{k}x{j}x', 60)}") for k in range(3) for j in range(6)]
    rows.append((1000, "\n".join([*stock, words("rest", 12)])))
    rows += [(2000 + j, f"{words('article', 90)}\n{words(f'edit{j}x', 3)}") for j in range(6)]
    docs = spark.createDataFrame([(d, t, "en", "a", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    after = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert after[1000] == words("rest", 12) and after[0] == words("own0x0x", 60)
    assert all(after[d] == t for d, t in rows if d >= 2000) and len(after) == len(rows)
    group = brute.components(rows)
    expected = brute.without_boilerplate([(d, t, "a") for d, t in rows], 0.1, 2, lambda d: group[d][1])
    assert after == {d: t for d, t, _ in expected} != {d: t for d, t, _ in brute.without_boilerplate([(d, t, "a") for d, t in rows], 0.1, 2)}


ODD = "doc_id long, text string, lang string, source string, n_chars long, _copies string, _boilerplate string, key string, group int"


def odd_rows(spark):
    """Nulls, empty texts, one id with several texts, repeated rows, and columns named like helpers."""
    words = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    texts = [
        (1, words("a", 80)), (2, words("a", 80) + " more"), (7, words("a", 80) + " still more"), (7, words("own", 80)),
        (3, words("b", 70)), (3, words("b", 70)), (4, None), (5, ""), (None, words("c", 90)), (None, words("c", 90) + " x"),
        (None, None), (None, None), (6, " \n\t "), (8, words("d", 30) + "\n" + words("e", 30)),
    ]
    rows = [(d, t, None if k % 3 else "en", None if k % 2 else "s", None if t is None else len(t), "c", "b", "k", k) for k, (d, t) in enumerate(texts)]
    return spark.createDataFrame(rows, ODD)


def test_stages_take_odd_rows(spark):
    docs = odd_rows(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, "")
        assert after.columns == docs.columns and stage(spark, docs.where("false"), "").count() == 0, name
        if name in ("line_dedup", "mask_personal_data"):
            assert after.count() == docs.count(), name
    assert corpus_pipeline.packing(spark, docs, "").count() >= docs.count()
    assert corpus_pipeline.packing(spark, docs.where("false"), "").count() == 0


def test_a_text_of_its_own_under_a_repeated_id_stays(spark):
    kept = sorted((r["group"], r["doc_id"]) for r in corpus_pipeline.near_duplicates(spark, odd_rows(spark), "").collect())
    stayed = [k for k, _ in kept]
    # Of documents 1, 2 and 7 the first stays, and the other text of 7; of equal rows and of similar ones without id one.
    assert [k for k in stayed if k not in (4, 5, 8, 9, 10, 11)] == [0, 3, 6, 7, 12, 13]
    assert all(sum(k in pair for k in stayed) == 1 for pair in ((4, 5), (8, 9), (10, 11)))


def test_texts_stay_where_they_are(spark):
    """Not even where no table counts as small do the stages after the join shuffle texts to the keys of copies."""
    words = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    rows = [(10 * k + j, f"head\n{words(f'own{k}x', 60)}" + " more" * j, "en", "a", 1) for k in range(12) for j in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = write_once(docs, "docs")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shorter, kept = (stage(spark, docs, "") for stage in (corpus_pipeline.line_dedup, corpus_pipeline.near_duplicates))
        plans = [x._jdf.queryExecution().optimizedPlan().toString() for x in (shorter, kept)]
        physical = kept._jdf.queryExecution().executedPlan().toString()
        texts = {r["doc_id"]: r["text"] for r in shorter.collect()}
        assert {r["doc_id"] for r in kept.collect()} == {10 * k for k in range(12)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plans[0].count("Join ") == 1 and "_boilerplate" in plans[0]  # with the sources' lines alone
    assert plans[1].count("Join ") == 1 and "BroadcastHashJoin" in physical and "SortMergeJoin" not in physical
    assert texts == {d: t.split("\n")[1] for d, t, *_ in rows}
