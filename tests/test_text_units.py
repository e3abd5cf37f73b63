"""Unit literals for the sentence, token and prompt functions."""

from pyspark.sql import functions as F

from siftlane.functions import prompt as PR
from siftlane.functions import text as T
from siftlane.operators.chunk import assemble_documents, sections_to_chunks, sentence_rows


def _one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def sents(spark, text):
    return _one(spark, T.split_sentences(F.lit(text)))


def test_heading_glue(spark):
    text = "6. GARDEN RULES\n\nEvery member waters the beds. Guests no."
    assert sents(spark, text) == ["GARDEN RULES Every member waters the beds."]


def test_length_is_strict(spark):
    s15, s16 = "Abcdefghijklmn.", "Abcdefghijklmno."
    assert len(s15) == 15 and len(s16) == 16
    assert sents(spark, f"{s15} {s16}") == [s16]


def test_ascii_capital_only(spark):
    text = "Primera frase larga aquí. Última frase larga aquí."
    assert sents(spark, text) == [text]


def test_semicolon_splits(spark):
    assert sents(spark, "the first clause holds; The second clause holds.") == [
        "the first clause holds;", "The second clause holds."]


def test_abbreviation_and_bracket(spark):
    text = 'Elm Street Ltd. ("the Shop") shall open.'
    assert sents(spark, text) == [text]


def test_exotic_whitespace(spark):
    text = "alpha\x1cbeta gamma　delta\x1f \t epsilon"
    assert _one(spark, T.collapse_ws(F.lit(text))) == "alpha beta gamma delta epsilon"
    assert _one(spark, T.word_count(F.lit(text))) == len(text.split())


def test_python_whitespace_set_matches(spark):
    ws = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    assert len(ws) == 29
    others = ["\u200b", "\ufeff", "x", "\u00ad"]
    df = spark.createDataFrame([(c,) for c in ws + others], "c string")
    got = {r.c: r.n for r in df.select("c", T.collapse_ws(F.concat(F.lit("a"), "c", F.lit("b"))).alias("n")).collect()}
    assert all(got[c] == "a b" for c in ws)
    assert all(got[c] == f"a{c}b" for c in others)


def test_no_sentence_fallback(spark):
    df = spark.createDataFrame([(1, "Short.\n")], "id long, text string")
    rows = sentence_rows(df, "text", keep=["id"]).collect()
    assert [(r.sentence, r.is_fallback) for r in rows] == [("Short.\n", True)]


def test_token_count_proxy(spark):
    assert _one(spark, T.count_tokens(F.lit("Hello, world! x2"))) == 5
    assert _one(spark, T.count_tokens(F.lit(""))) == 0


def test_preview(spark):
    text = "a\nb" + "c" * 300
    assert _one(spark, T.preview(F.lit(text))) == text[:200].replace("\n", " ") + "..."


def test_chunks_then_assembly_is_identity(spark):
    df = spark.createDataFrame([(7, ["s0", "s1\n\nx", "s2"])], "doc_id long, sections array<string>")
    ch = sections_to_chunks(df)
    assert [r.chunk_id for r in ch.orderBy("chunk_ix").collect()] == ["7-c0", "7-c1", "7-c2"]
    back = assemble_documents(ch).first()
    assert back.sections == ["s0", "s1\n\nx", "s2"]
    assert back.text == "\n\n".join(["s0", "s1\n\nx", "s2"])


def test_chunk_order_is_numeric_not_lexical(spark):
    df = spark.createDataFrame([(1, [f"s{i}" for i in range(12)])], "doc_id long, sections array<string>")
    ch = sections_to_chunks(df).orderBy("id").collect()
    assert [r.chunk_ix for r in ch] == list(range(12))


def test_prompt_template(spark):
    ctx = PR.ordered_join(
        F.array(F.struct(F.lit(2).alias("o"), F.lit("[Source Chunk 2]: b").alias("t")),
                F.struct(F.lit(1).alias("o"), F.lit("[Source Chunk 1]: a").alias("t"))), "\n\n")
    got = _one(spark, PR.prompt(F.lit("Q?"), ctx))
    want = ("Answer the user's question based strictly on the provided context below. "
            "If the context does not contain the answer, state that clearly.\n\n"
            "Context:\n[Source Chunk 1]: a\n\n[Source Chunk 2]: b\n\nQuestion: Q?\nAnswer:")
    assert got == want


def test_dedupe_latest_and_upsert(spark):
    from siftlane.sources.index import dedupe_latest, upsert

    rows = [(1, 1, "old"), (1, 3, "new"), (2, 1, "x"), (1, 2, "mid"), (3, None, "keep me"), (4, None, "null"), (4, 0, "zero"), (5, 7, "a"), (5, 7, "b")]
    batch = spark.createDataFrame(rows, "doc_id long, seq int, text string")
    got = sorted((r.doc_id, r.seq, r.text) for r in dedupe_latest(batch, "doc_id", "seq").collect())
    assert got == [(1, 3, "new"), (2, 1, "x"), (3, None, "keep me"), (4, 0, "zero"), (5, 7, "b")]
    assert dedupe_latest(batch, "doc_id", "seq").columns == batch.columns
    base = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (5, 0, "c")], "doc_id long, chunk_ix int, text string")
    upd = spark.createDataFrame([(1, 0, "a2"), (9, 0, "z")], "doc_id long, chunk_ix int, text string")
    got = sorted(tuple(r) for r in upsert(base, upd, "doc_id").collect())
    assert got == [(1, 0, "a2"), (5, 0, "c"), (9, 0, "z")]


def test_chunk_keys_have_no_caps(spark):
    rows = [(-3, ["a", "b"]), (1 << 62, ["c"]), (7, None), (8, [None, "d"])]
    ok = spark.createDataFrame(rows, "doc_id long, sections array<string>")
    got = [(r.id.doc_id, r.id.chunk_ix, r.chunk_id, r.text) for r in sections_to_chunks(ok).orderBy("id").collect()]
    assert got == [(-3, 0, "-3-c0", "a"), (-3, 1, "-3-c1", "b"), (7, 0, "7-c0", ""), (8, 0, "8-c0", ""), (8, 1, "8-c1", "d"), (1 << 62, 0, f"{1 << 62}-c0", "c")]
    many = spark.range(1).select(F.lit("doc-x").alias("doc_id"), F.array_repeat(F.lit("s"), (1 << 20) + 5).alias("sections"))
    r = sections_to_chunks(many).agg(F.max("chunk_ix").alias("m"), F.max("chunk_id").alias("c")).first()
    assert r.m == (1 << 20) + 4 and r.c.startswith("doc-x-c")
