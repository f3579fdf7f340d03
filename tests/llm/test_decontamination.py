from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import decontamination

FOLDER = "/root/testdata/sf0.001"


def shingles(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(docs, items):
    def united(rows):
        out = {}
        for key, text, *_ in rows:
            out.setdefault(key, set()).update(shingles(text))
        return out

    docs, items = united(docs), united(items)
    return {
        (d, i, len(b), len(a & b)) for d, a in docs.items() for i, b in items.items() if b and 10 * len(a & b) >= 8 * len(b)
    }


def test_pairs_equal_brute_force(llm, documents, awkward):
    words = [f"w{i}" for i in range(60)]
    item = " ".join(words[:30])
    rows = awkward + [
        (60, "before it " * 500 + item.upper() + " after"),
        (61, " ".join(words[:25] + ["gap"] + words[25:30])),
        (62, " ".join(words[:24])),
        (63, " ".join(words[:15] + ["x"] + words[15:30] + ["y"] + words[5:22])),
        (64, "one two three four five six"),
        (64, "seven eight nine ten eleven"),
        (None, item),
    ]
    tests = [(1, item), (2, "word"), (3, None), (4, ""), (None, "no id here at all"), (5, item), (5, item), (6, "one two")]
    items = llm.createDataFrame(tests, "item_id long, text string").withColumn("item", F.lit("clash"))
    found = {tuple(r) for r in decontamination.contaminated(documents(rows), items).collect()}
    assert found == brute(rows, tests)
    assert decontamination.contaminated(documents([]), items).count() == 0
    assert decontamination.contaminated(documents(rows), items.limit(0)).count() == 0


def test_no_python_in_the_plan(llm):
    df = decontamination.op10_decontamination(llm, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_stage_drops_only_holders(llm, documents, folder):
    item = "a b c d e f g h i j"
    tests = llm.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, f"x {item} y"), (2, "clean text here"), (None, item), (None, "clean"), (3, None)]
    kept = decontamination.stage(llm, documents(rows), folder(benchmark=tests)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept if r["doc_id"]) == [("2", "clean text here"), ("3", None)]


def test_stage_keeps_clean_rows_beside_holders(llm, documents, folder):
    item = "a b c d e f g h i j"
    tests = llm.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, item), (None, "clean"), (None, None), (7, f"x {item}"), (7, "clean too"), (7, f"x {item}")]
    # Only together do these two hold the item.
    rows += [(8, "a b c d e f g"), (8, "d e f g h i j"), (None, "a b c d e f g"), (None, "d e f g h i j")]
    kept = decontamination.stage(llm, documents(rows), folder(benchmark=tests))
    assert kept.columns == documents(rows).columns
    expected = [r for r in rows if r[1] is None or item not in r[1]]
    assert sorted(map(str, expected)) == sorted(str((r["doc_id"], r["text"])) for r in kept.collect())
