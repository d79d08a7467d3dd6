"""The registered queries: chat formatting, the oracles, the pipeline."""

import pytest

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF_SMALL
from faceoff.llm import chat_format
from faceoff.llm.common import table
from faceoff.llm.queries import ORACLE_SQL, QUERIES
from oracle import duck, duck_digest, spark_digest

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    assert spark_digest(QUERIES[name](spark, SF_SMALL)) == duck_digest(duck(SF_SMALL), ORACLE_SQL[name])


# --------------------------------------------------------- chat formatting
def slow_chat(rows):
    key = lambda v: (v is not None, v)
    conv = {}
    for c, t, r, x in sorted(set(rows), key=lambda row: tuple(map(key, row))):
        conv.setdefault(c, []).append((r, x))
    kept = {}
    for c, said in conv.items():
        if not any(len(o) > len(said) and o[: len(said)] == said for o in conv.values()):
            kept.setdefault(tuple(said), []).append(c)
    show = lambda r, x: f"<|im_start|>{'unknown' if r is None else r}\n{x or ''}<|im_end|>\n"
    return {
        (min([c for c in ids if c is not None], default=None), len(said), len(ids), "".join(show(*s) for s in said))
        for said, ids in kept.items()
    }


def joined(found):
    texts = {}
    for r in sorted(found.collect(), key=lambda r: r["first_turn"]):
        key = (r["conv_id"], r["n_turns"], r["copies"])
        texts[key] = texts.get(key, "") + r["text"]
    return {(*k, v) for k, v in texts.items()}


def test_snapshots_collapse(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yes"), (3, 0, "user", "hi"), (3, 1, "assistant", "yes"),
            (3, 2, "user", "more"), (4, 0, "user", "hi"), (4, 1, "assistant", "yes"), (4, 2, "user", "more"), (5, 0, "user", "other"),
            (6, 0, None, None), (7, 0, "unknown", ""), (8, None, "user", "hi"), (8, 0, "user", "x"), (8, 0, "user", "x"),
            (9, 1, "user", "b"), (9, 1, "user", "a"), (None, 0, "user", "lost"), (None, 1, None, "x" * 50_000), (10, 5, "user", "other")]
    rows += [(100 + k, t, "user", f"t{t}") for k in range(30) for t in range(k % 7 + 1)]
    schema = "conv_id long, turn long, role string, text string, n int"
    turns = spark.createDataFrame([(*r, 1) for r in rows], schema)
    assert joined(chat_format.chat_format(turns)) == slow_chat(rows)
    assert chat_format.chat_format(turns.limit(0)).count() == 0


def test_a_long_conversation_is_spread_over_blocks(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(1500)] + [(2, t, "user", f"t{t}") for t in range(700)]
    rows += [(3, t, "user", f"t{t}") for t in range(699)] + [(3, 699, "user", "else")]
    found = chat_format.chat_format(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert joined(found) == slow_chat(rows)
    assert found.filter("conv_id = 1").count() == 6


def test_a_hot_conversation_of_few_turn_numbers_is_spread(spark):
    rows = [(None, t % 3 if t % 4 else None, "user", f"t{t}") for t in range(1500)] + [(2, 0, "user", f"t{t}") for t in range(600)]
    found = chat_format.chat_format(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert joined(found) == slow_chat(rows)
    assert found.filter("conv_id is null").count() == 6 and found.filter("conv_id = 2").count() == 3


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages(spark, tmp):
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 5
    docs, sizes = table(spark, SF, "documents"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, SF).write.parquet(f"{tmp}/{k}")
        docs = spark.read.parquet(f"{tmp}/{k}")
        sizes.append(docs.count())
        if k < 4:
            assert docs.columns == before.columns
    assert sizes == sorted(sizes, reverse=True) and 0 < sizes[-1] < sizes[0]
    run = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, run.select("doc_id", "n_tokens").collect())) == sorted(map(tuple, docs.select("doc_id", "n_tokens").collect()))


def test_pipeline_is_its_operators_by_brute_force(spark, tmp):
    """Each stage's decisions, from the brute-force versions of the other tests."""
    from test_llm_pairs import brute_components, slow_hits
    from test_llm_models import slow_counts

    docs = table(spark, SF, "documents")
    step = [s for _, s in corpus_pipeline.STAGES]
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    one = step[0](spark, docs, SF)
    kept = {r["doc_id"] for r in one.collect()}
    failed = {i for i, t in rows.items() if (c := slow_counts(t))[0] < 10 or 100 * c[4] > 20 * c[0]}
    assert not kept & failed and len(kept) > 0.7 * len(rows)
    two = step[1](spark, one, SF)
    want = {c for i, _, c in brute_components([(i, rows[i]) for i in kept])}
    assert {r["doc_id"] for r in two.collect()} == want
    three = {r["doc_id"]: r["text"] for r in step[2](spark, two, SF).collect()}
    assert set(three) == want and all(len(three[i]) <= len(rows[i]) for i in want)
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    clean = {i for i, t in three.items() if not ((h := slow_hits(t, items))[1] and 20 * h[1] >= h[0])}
    four = step[3](spark, spark.createDataFrame(list(three.items()), "doc_id long, text string"), SF)
    assert {r["doc_id"] for r in four.collect()} == clean


def test_pipeline_on_empty_tables(spark, tmp):
    for name in ("documents", "labels", "benchmark"):
        table(spark, SF, name).limit(0).write.parquet(f"{tmp}/{name}.parquet")
    assert corpus_pipeline.run(spark, tmp).count() == 0
    for name in ("op2_simhash", "op3_token_counts", "op4_decontaminate", "op5_token_shards", "op6_quality_classifier",
                 "op7_sentencepiece", "op8_toxicity", "op9_chunk_dedup", "op10_quality_rules"):
        assert QUERIES[name](spark, tmp).count() == 0
