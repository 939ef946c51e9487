import pytest


@pytest.fixture
def documents(spark):
    """Makes a frame of documents from (doc_id, text) or (doc_id, text, source), with columns that clash."""

    def make(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "s", i) for i, r in enumerate(rows)]
        clash = "n_words long, size long, id long, bucket long, score long, target long, rest long, kept long, label long, cluster long"
        names = [c.split()[0] for c in clash.split(", ")]
        schema = f"doc_id long, text string, lang string, source string, n_chars long, {clash}"
        return spark.createDataFrame([(d, t, None, s, None, *[n + i for i in range(len(names))]) for d, t, s, n in full], schema)

    return make


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (None, "no id here at all"), (4, "one"), (4, "one"), (5, "one"),
    (6, "wörd " * 30_000), (7, "x" * 200_000), (8, "\n\n\n"), (None, None), (9, "a b c d"),
]
