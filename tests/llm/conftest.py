import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, schema=DOCS):
    """Rows of (doc_id, text[, source])."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows], schema)
