"""Functions under SQL names on awkward texts."""

import pytest

from foliograph.functions import text as T
from foliograph.plans.sql import register

TEXTS = [None, "", "  ", "one", "a  b\r\nc\rd", "x\u00a0y\u2003z 1.5% Ä", "word " * 7]


@pytest.fixture(scope="module")
def texts(spark):
    register(spark)
    spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string").createOrReplaceTempView("awkward_texts")
    return spark.table("awkward_texts")


@pytest.mark.parametrize(
    "name, same", [("normal_newlines", T.normalise_newlines), ("n_words", T.word_count), ("n_tokens", T.approx_tokens), ("normal_token", T.norm_token), ("squeezed", T.squeeze)]
)
def test_sql_names_give_the_library_results(texts, name, same):
    for r in texts.select("t", same(texts["t"]).alias("want")).selectExpr("t", "want", f"{name}(t) AS got").collect():
        assert r.got == r.want, r.t


def test_table_functions(spark, texts):
    rows = spark.sql("SELECT id, seq, n, part FROM awkward_texts, LATERAL word_windows(t, 3) ORDER BY id, seq").collect()
    want = [(i, k // 3 + 1, len(w[k : k + 3]), " ".join(w[k : k + 3])) for i, t in enumerate(TEXTS) for w in [(t or "").split()] for k in range(0, len(w), 3)]
    assert [tuple(r) for r in rows] == want
    found = spark.sql("""SELECT * FROM VALUES ('a {"k": [1]} b [2]'), (NULL), ('none') AS x(t), LATERAL json_parts(t)""").collect()
    assert [(r.position, r.candidate) for r in found] == [(1, '{"k": [1]}'), (2, "[2]")]
