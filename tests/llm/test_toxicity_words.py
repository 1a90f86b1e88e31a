"""Every word over the strength threshold of toxicity has a weight."""

from paddock.llm import toxicity


def _word(i: int) -> str:
    return "w" + "".join(chr(97 + int(d)) for d in f"{i:04d}")


def test_all_strong_words_have_a_weight(spark):
    words = [_word(i) for i in range(2_100)]
    toxic = [" ".join(words[(35 * t + k) % 2_100] for k in range(175)) for t in range(60)]
    rows = [*toxic, *(f"clean text {_word(9_999 - i)}" for i in range(400))]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(len(rows))], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, rounds=20)
    assert set(words) <= set(model.words)
    assert all(model.weights[model.words[w]] > 0 for w in words)
