from pyspark.sql import functions as F

from webloom.operators import training

DATA = "/root/testdata/sf0.001"


def test_prompts_are_masked_and_long_examples_cut(spark):
    rows = spark.createDataFrame([("a b c ", "d e"), ("a b c ", None), ("x " * 9, "y z")], "p string, a string")
    out = rows.select(training.with_labels(F.col("p"), F.col("a"), longest=8).alias("t")).select("t.*").collect()
    ids = training.hashed_words("a b c d e <|EOT|>")
    assert out[0].input_ids == ids and out[0].labels == [-100] * 3 + ids[3:]
    assert out[1].input_ids is None and out[2].input_ids == training.hashed_words("x " * 8) and out[2].labels == [-100] * 8


def test_ids_of_a_tokenizer_file(spark):
    import public_tokenizers

    ids = training.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = spark.createDataFrame([("Hello ", "world")], "p string, a string").select(training.with_labels(F.col("p"), F.col("a"), ids).alias("t")).select("t.*").first()
    assert out.input_ids == ids("Hello world\n<|EOT|>") and out.labels[: len(ids("Hello "))] == [-100] * len(ids("Hello "))


def test_every_pair_has_ids(spark):
    rows = training.token_ids(spark, DATA).collect()
    assert rows and all(0 < r.n_labels <= r.n_tokens <= 2048 for r in rows)


def test_the_query_gives_the_tokenizers_ids(spark):
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    from webloom.functions import values as v
    from webloom.operators import training

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    said = {(r.conv_id, r.turn): r for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()}
    rows = training.token_ids(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == sum(r.role == "user" and any(c == r.conv_id and n > r.turn and x.role == "assistant" for (c, n), x in said.items()) for r in said.values())
    for r in rows:
        answer = next(x for (c, n), x in sorted(said.items()) if c == r.conv_id and n > r.turn and x.role == "assistant")
        prompt = v.TRAIN_PROMPT + said[r.conv_id, r.turn].text.strip(" ") + v.RESPONSE
        ids, masked = (tokenizer.encode(x).ids[: training.LONGEST] for x in (f"{prompt}{answer.text}\n<|EOT|>", prompt))
        assert (r.n_tokens, r.n_labels, r.ids_crc32) == (len(ids), len(ids) - len(masked), zlib.crc32(",".join(map(str, ids)).encode()))


def test_chat_templates(spark):
    rows = spark.createDataFrame([(1, [("system", "s"), ("user", "u\n"), ("assistant", "a")]), (2, [("user", None), (None, "x")]), (3, []), (4, None)], "i int, m array<struct<role string, content string>>")
    plain = training.ChatTemplate()
    got = [tuple(r) for r in rows.orderBy("i").select(plain.text(F.col("m")), plain.text(F.col("m"), prompted=False), training.ChatTemplate("[{role}] ", "</s>", "<s>").text(F.col("m"))).collect()]
    turns = ["<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu\n<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n", "<|im_start|>user\n<|im_end|>\n<|im_start|>user\nx<|im_end|>\n", ""]
    assert [g[:2] for g in got[:3]] == [(t + "<|im_start|>assistant\n", t) for t in turns] and got[3] == (None, None, None)
    assert [g[2] for g in got[:3]] == ["<s>[system] s</s>[user] u\n</s>[assistant] a</s>[assistant] ", "<s>[user] </s>[user] x</s>[assistant] ", "<s>[assistant] "]


def test_batches_are_padded(spark):
    given = [(i, list(range(1, 1 + (i * 7) % 11)), [-100] * ((i * 7) % 11 // 2) + list(range((i * 7) % 11 // 2, (i * 7) % 11))) for i in range(25)]
    rows = spark.createDataFrame([*given, (99, None, None)], "k int, input_ids array<int>, labels array<int>").repartition(5)
    got = training.collated(rows, 4, "k", pad=7).orderBy("batch").collect()
    ordered = sorted(given, key=lambda r: (len(r[1]), r[0]))
    for n, batch in enumerate(got):
        part = ordered[4 * n : 4 * n + 4]
        width = max(len(r[1]) for r in part)
        fill = lambda x, by: x + [by] * (width - len(x))
        assert (batch.batch, batch.width) == (n, width) and batch.input_ids == [fill(r[1], 7) for r in part]
        assert batch.attention_mask == [fill([1] * len(r[1]), 0) for r in part] and batch.labels == [fill(r[2], -100) for r in part]
    assert len(got) == 7 and training.collated(rows.limit(0), 4, "k").count() == 0


def test_batches_of_the_query(spark):
    import zlib

    one = {(r.conv_id, r.turn): r.t for r in training.examples_of(spark, DATA).collect()}
    ordered = sorted(one.items(), key=lambda x: (len(x[1].input_ids), x[0]))
    got = training.collated_batches(spark, DATA).orderBy("batch").collect()
    assert sum(r.n_rows for r in got) == len(one) and len(got) == -(-len(one) // training.BATCH)
    for r in got:
        part = [t for _, t in ordered[r.batch * training.BATCH :][: training.BATCH]]
        ids = ";".join(",".join(map(str, t.input_ids + [0] * (r.width - len(t.input_ids)))) for t in part)
        assert (r.width, r.n_tokens, r.n_labels, r.ids_crc32) == (max(len(t.input_ids) for t in part), sum(len(t.input_ids) for t in part), sum(x != -100 for t in part for x in t.labels), zlib.crc32(ids.encode()))
