import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import edit, prose  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text, source): copies, near copies, shared passages, nulls, ties, odd texts."""
    base = [prose(i, 60 + 7 * i) for i in range(12)]
    passage = prose(99, 58)
    texts = list(base)
    texts += [base[0], base[0], base[1]]
    texts += [edit(base[5], 3), edit(base[5], 50), edit(edit(base[5], 3), 90), base[5].upper()]
    texts += [base[2][:200] + passage + base[3][:150], passage + base[4], base[6] + passage, passage, passage]
    texts += [prose(7, 40) * 3, "a b c " * 40, "spam " * 100, "one line\n" * 30 + "\n \n"]
    texts += [None, None, "", " \t\n", "short", "short", "two words", "Two words", "x\x1cy \x85z w"]
    texts += [" lead  double   spaces \n\n tabs\tand\r\nmore ", "it's we'll 'S ''s 12a3 #$%&|<> **", "日本語のテキスト " * 20]
    texts += [prose(200, 9000), "z" * 70_000 + " tail " + prose(201, 300), prose(202, 100) + " " * 40_000 + prose(203, 50)]
    out = [(i, t, ["h1", "h2", None, ""][i % 4]) for i, t in enumerate(texts)]
    out += [(None, base[7], "h1"), (None, "nobody has this id " * 9, None), (3, base[3], "h3"), (4, prose(300, 50), "h4")]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with columns whose names the operators use themselves."""
    frame = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)
    clash = ["kept", "digest", "text_key", "label", "node", "row", "file", "_row", "score", "shard", "_host", "found", "a.b", "_doc", "_key", "_place", "_metadata", "_null", "text_"]
    return frame.select("*", *(F.lit(f"x{i}").alias(name) for i, name in enumerate(clash))).repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
