"""Stages give every column back; ids may be texts; parts of a chat turn are escaped where they meet."""

import random

import duckdb
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from lapforge.llm import chat, language, mixing, sharding, simhash, toxicity

OWN = ["uid", "copy", "copies", "lang_pred", "lang_score", "toxic_score", "toxic_spans", "size", "Key", "taken", "root", "a.b"]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(300)]
    rows = [(f"d{i}", " ".join(rng.choices(words, k=40)) + (" vexoid" if i % 5 == 0 else ""), "en", f"s{i % 3}", 1, *[f"{c}{i}" for c in OWN]) for i in range(60)]
    rows += [(None, rows[1][1] + " more", "en", "s0", 1, *OWN)] * 2 + [("e", "", "en", "s0", 0, *OWN), (None, None, None, None, None, *[None] * len(OWN))]
    return spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", "n_chars", *OWN]).cache()


@pytest.mark.parametrize("stage", ["language", "toxicity", "simhash", "mixing"])
def test_columns_come_back(spark, docs, stage):
    labels = spark.createDataFrame([(f"d{i}", int(i % 5 == 0)) for i in range(60)], "doc_id string, toxic int")
    run = {"language": language.stage, "toxicity": lambda d: toxicity.stage(d, labels), "simhash": simhash.stage, "mixing": mixing.stage}[stage]
    out = run(docs)
    assert out.columns == docs.columns
    given_rows = {tuple(r) for r in docs.collect()}
    got = [tuple(r) for r in out.collect()]
    assert got and set(got) <= given_rows
    if stage == "toxicity":
        assert {r[0] for r in got} >= {"d1", "e"} and "d5" not in {r[0] for r in got}
    assert run(docs.filter("false")).collect() == []


def test_labels_by_numbers_for_text_ids(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, toxic int")
    assert toxicity.stage(docs, labels).count() > 0


def test_rows_without_an_id_are_spread(spark):
    df = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t "), F.col("id").cast("string")).alias("text"), F.lit("s").alias("source"))
    sizes = mixing.sized(df)
    key = F.md5(F.concat_ws("#", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest", F.lit(1)))
    assert sizes.select(mixing._part(key, 64).alias("p")).distinct().count() == 64


def test_empty_pipeline(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/|[]INSTs\\ a", max_size=30), st.lists(st.integers(0, 30), max_size=4), st.booleans())
def test_parts_are_escaped_where_they_meet(text, cuts, image):
    at = [0, *sorted(min(c, len(text)) for c in cuts), len(text)]
    parts = [{"kind": "text", "text": text[a:b]} for a, b in zip(at[:-1], at[1:], strict=True)]
    if image:
        parts.insert(len(parts) // 2, {"kind": "image", "width": 1, "height": 1})
    turn = chat.format_turn("user", None, parts)
    body = turn["formatted"].removeprefix("<|user|>").removesuffix("</s>")
    places = [a["position"] - len("<|user|>") for a in turn["attachments"]]
    for a in places:
        assert body[a:].startswith("<|image:0|>")
        body = body[:a] + body[a + len("<|image:0|>") :]
    assert chat.unescape(body) == text and (image or not chat._CONTROL.search(body))


def rows_of(df):
    return sorted(map(repr, (tuple(sorted(r.asDict().items())) for r in df.collect())))


def twin(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    out = con.sql(sql)
    return sorted(map(repr, (tuple(sorted(zip(out.columns, r, strict=True))) for r in out.fetchall())))


def test_chat_like_sql(spark):
    rows = [(1, 1, "assistant", r"a\b</s><|x|>"), (1, 0, "user", None), (1, 0, None, "é\n<s>"), (2, 5, "assi stant|", "[INST]"), (2, None, "assistant", ""), (2, None, "assistant", "x"), (None, 1, "user", "[/INST]<<|")] * 2
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").unionByName(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    assert rows_of(chat.query(df)) == twin(chat.ORACLE, conversations=df)


def test_placement_by_brute_force(spark):
    """A key's slot is its hash modulo the table's size, its shard what the table says there."""
    names = [f"n{k}" for k in range(7)]
    slots = sharding.fill(names, 1009, {"n3": 4})
    df = spark.range(2000).select(F.concat(F.lit("key é "), F.col("id").cast("string")).alias("k")).unionByName(spark.createDataFrame([(None,)], "k string"))
    for r in sharding.place(df, "k", names, 1009, {"n3": 4}).collect():
        h = xxhash.xxh64((r.k or "").encode(), seed=42).intdigest()
        slot = (h - (1 << 64) if h >> 63 else h) % 1009
        assert (r.slot, r.shard) == (slot, names[slots[slot]])
