import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# Extra columns that are named like some that the operators use themselves.
CLASHING = "kept n_lines n_dropped row_hash k1 k2 sig rep a b u v component_id n_shingles label score key fold block line piece start length sequence_id found kinds pos window item_id _gone _gone_doc _gone_row _lines _doc _row _rejected _leaked _again _key _own own row rank first text_hash form codes familiar last_block".split()


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table with columns that clash, from (doc_id, text) or (doc_id, text, lang)."""

    def make(rows, extra=True):
        kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint"
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, kinds)
        return df.selectExpr("*", *[f"'x' AS {c}" for c in CLASHING]) if extra else df

    return make
