from __future__ import annotations

import pytest

from tidemark.llm.tables import ship

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    """The session, with the package on its executors."""
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def documents(llm):
    """Documents from (id, text) or (id, text, lang), with columns whose names operators use inside."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")) for r in rows]
        df = llm.createDataFrame(full, DOCUMENTS)
        for name in ("code", "mark", "doc", "start", "word", "held", "id", "anchor", "kept", "score", "n", "spans"):
            df = df.selectExpr("*", f"'clash' AS `{name}`")
        return df

    return make


@pytest.fixture(scope="session")
def folder(llm, tmp_path_factory):
    """Write tables (name to DataFrame) to a new folder of Parquet files."""

    def make(**frames):
        path = tmp_path_factory.mktemp("tables")
        for name, df in frames.items():
            df.write.parquet(str(path / f"{name}.parquet"))
        return str(path)

    return make


#: Rows that every operator on documents must take: nulls, empty and long texts, ties, repeated rows.
AWKWARD = [
    (None, "no id here at all"),
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "word"),
    (5, "same text twice over"),
    (5, "same text twice over"),
    (5, "another text under one id"),
    (6, "x" * 300_000),
    (7, "lorem ipsum dolor " * 4000),
    (8, "!!! ??? 123"),
    (9, "Ünïcödé ▁ \u0000 text\u0085here"),
    (9, None),
    (None, None),
]


@pytest.fixture(scope="session")
def awkward():
    return AWKWARD
