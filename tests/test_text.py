import random

from pyspark.sql import functions as F

from tidemark.functions.text import strip, title_case

TRICKY = [
    " UK ", "india", "o'neil follow-up", "", None, "\tPADDED\n", "3rd é-ÉCOLE", "C1001", "customer#00A1",
    "a-b_c d\te", "　wide　", "ǆungla", "x\x1c", "ΑΒΓ δεζ", "привет МИР", "  ", "a1b2c3",
]


def test_strip_and_title_case_follow_python(spark):
    letters = "abcXYZ éÉßñ ΑΩω Жж 019 .-_'#\t\n\xa0"
    pick = random.Random(7)
    texts = TRICKY + ["".join(pick.choices(letters, k=pick.randint(0, 24))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = {r["i"]: r for r in df.select("i", strip(F.col("t")).alias("s"), title_case(F.col("t")).alias("c")).collect()}
    for i, t in enumerate(texts):
        assert out[i]["s"] == (None if t is None else t.strip())
        assert out[i]["c"] == (None if t is None else t.title())
