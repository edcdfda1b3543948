from __future__ import annotations

import pytest

DOC_COLS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Frame of documents from (doc_id, text[, lang[, source]]) tuples."""
    def build(rows, extra=None):
        full = []
        for r in rows:
            doc_id, text, lang, source = (*r, "en", "src0")[:4] if len(r) == 2 else (*r, "src0")[:4]
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        df = spark.createDataFrame(full, DOC_COLS)
        return df.selectExpr("*", *extra) if extra else df
    return build


@pytest.fixture(scope="session")
def clashes():
    """Columns whose names an operator might use itself."""
    return ["1 as row", "'x' as k_id", "2 as size", "3 as fp", "'y' as host", "4 as salt", "5 as blk",
            "6 as n_words", "7 as node", "8 as mass", "'z' as lines", "9 as target", "'q' as body"]
