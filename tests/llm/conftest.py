from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 997}x{i % 13}" for i in range(40_000))


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (id, text) or (id, text, source), with columns whose names clash with inner ones."""
    def make(*rows, extra: bool = False):
        whole = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
        frame = spark.createDataFrame(whole, DOCUMENTS)
        return frame.selectExpr("*", "1 AS key", "2 AS score", "3 AS hits", "4 AS size", "5 AS node", "6 AS line",
                                "7 AS text_key", "8 AS position", "9 AS bucket", "10 AS n_removed", "11 AS n_lines",
                                "12 AS _id", "13 AS _node", "14 AS _h1", "15 AS _h2", "16 AS _part", "17 AS rank",
                                "18 AS place", "19 AS segment", "20 AS able", "21 AS part", "22 AS bits", "23 AS digest",
                                "24 AS body", "25 AS side", "26 AS fold", "27 AS `a.b`") if extra else frame
    return make


@pytest.fixture(scope="session")
def awkward(docs):
    """Nulls, empty and very long texts, rows that repeat and ids that do."""
    return docs((1, None), (2, ""), (3, "one two three"), (3, "one two three"), (None, "no id here at all, sir"),
                (None, None, None), (4, LONG, None), (5, "one  two\nthree", "src1"), (3, "other text of the same id"),
                extra=True)
