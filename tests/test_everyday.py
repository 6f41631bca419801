import json

from pyspark.sql import functions as F

from filigree.functions import text as tx
from filigree.operators import derived, idioms


def value(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0]["x"]


def test_numbers(spark):
    assert [value(spark, idioms.fibonacci(F.lit(n))) for n in (-1, 0, 1, 2, 10, 90)] == [0, 0, 1, 1, 55, 2880067194370816120]
    assert [value(spark, idioms.factorial(F.lit(n))) for n in (-1, 0, 1, 5, 20)] == [None, 1, 1, 120, 2432902008176640000]
    assert value(spark, idioms.divided(F.lit(1), F.lit(0))) is None and value(spark, idioms.divided(F.lit(1), F.lit(None).cast("int"))) is None


def test_searches(spark):
    for values in ([], [3], [1, 4, 6, 9, 12, 15, 19]):
        array = F.array(*map(F.lit, values)).cast("array<int>")
        for x in (0, 1, 3, 4, 9, 14, 15, 19, 20):
            assert value(spark, idioms.binary_search(array, F.lit(x))) == (values.index(x) if x in values else -1)
            assert value(spark, idioms.bisect_left(array, F.lit(x))) == sum(v < x for v in values)


def test_base_address(spark):
    for html, want in (("<html><HEAD lang='e'><t>", "<html><HEAD lang='e'><base href=\"u\"><t>"), ("<p>", "<base href=\"u\"><p>"), ("", "<base href=\"u\">"), ("<header>", "<base href=\"u\"><header>")):
        assert value(spark, tx.with_base(F.lit(html), F.lit("u"))) == want


def test_models(spark):
    def load():
        def model(prompt):
            if prompt.startswith("How many"):
                return json.dumps({"ratio": 500 if "ten" in prompt else 2, "underlying": "ordinary shares"})
            if prompt.startswith("Sector"):
                return json.dumps({"name": "banks" if "bank" in prompt.rsplit("\n", 1)[1] else "no such"})
            return json.dumps({"name": "none of these"})

        return model

    rows = [(1, "Each American Depositary Share represents two shares. ADSs represent 5% of all."), (2, "American Depositary Shares represent ten shares."), (3, "No such thing."), (4, None)]
    df = spark.createDataFrame(rows, "k int, t string")
    assert {r["k"]: (r["model_ratio"], r["model_underlying"]) for r in derived.model_ratio(df, "t", load).collect()} == {1: (2.0, "ordinary shares"), 2: (None, None), 3: (None, None), 4: (None, None)}
    text = spark.createDataFrame([(1, "a bank"), (2, "a farm"), (3, None)], "k int, t string")
    got = {r["k"]: (r["sector_code"], r["subsector_code"]) for r in derived.model_sector(text, "t", load).collect()}
    assert got[2] == got[3] == (None, None) and got[1][0] is not None and got[1][1].startswith(got[1][0][:4])
    said = derived.generated(text, "t", "answer", lambda: lambda prompt: prompt.upper() + '"').collect()
    assert {r["k"]: r["answer"] for r in said} == {1: 'A BANK"', 2: 'A FARM"', 3: None}


def test_review(spark):
    df = spark.createDataFrame([("approved",), ("what",), (None,)], "s string")
    assert [r[0] for r in df.select(derived.review_status(F.col("s"))).collect()] == ["approved", "pending", "pending"]
