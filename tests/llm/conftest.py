"""Documents with everything that can go wrong in them, and a place for intermediate tables."""

from __future__ import annotations

import pytest

from cadenza.llm.common import importable

# Names that operators use themselves.
CLASHING = (
    "id", "row", "found", "key", "n", "tile", "tiles", "spans", "score", "lang_pred", "kept", "rules", "h", "item", "wanted", "rep", "component",
    "component_id", "bits", "host", "page", "recurring", "held_out", "doc", "times", "label", "labelled", "dim", "block", "shard", "v", "ids", "decoded",
    "part", "before", "lengths", "n_tokens", "candidate", "least", "a", "b", "goes", "first", "affected", "redacted", "leaking", "missing",
)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def session(spark, tmp_path_factory):
    importable(spark)
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return spark


@pytest.fixture(scope="session")
def documents(session):
    """Builds a documents table of (doc_id, text) or whole rows, with clashing extra columns."""

    def build(rows, schema=SCHEMA, extra=CLASHING):
        width = len(schema.split(","))
        full = [tuple(r) + (None,) * (width - len(r)) for r in rows]
        frame = session.createDataFrame(full, schema)
        names = {c.split()[0] for c in schema.split(", ")}
        return frame.selectExpr("*", *[f"'x' AS {c}" for c in extra if c not in names])

    return build
