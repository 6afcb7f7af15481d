"""The filter of op5 has as many bits to an entry at every size, in however many groups it is broadcast."""

from airwave.llm import bloom_lm


def test_scores_do_not_change_with_the_number_of_groups(spark):
    texts = [" ".join(f"w{(i * 37 + j * j) % 900}" for j in range(150)) for i in range(120)]
    docs = spark.createDataFrame([*enumerate(texts), (None, None)], "doc_id long, text string")
    score = lambda **limits: sorted(map(str, bloom_lm.scores(docs, **limits).collect()))
    assert score(max_bits=20_000) == score(max_bits=1) == score()
