"""The whole pipeline against plain Python, stage after stage."""

import zlib

import corpus_pipeline
import numpy as np
from conftest_llm import plain_tokenizer, prose, unordered
from test_duplicates import near_expected, substring_expected
from test_rules_shards_scores import rule_counts


def expected(rows):
    kept = []
    for row in rows:
        counts = rule_counts(row[1])
        if counts[0] >= 20 and 100 * counts[4] <= 30 * counts[0]:
            kept.append(row)
    kept = [r for r in kept if r[0] == max(x[0] for x in kept if x[1] == r[1])]
    stay = {r[0] for r in near_expected(kept) if r[3]}
    kept = [r for r in kept if r[0] in stay]
    texts = dict((r[0], r[1]) for r in kept)
    for doc_id, _, removed, left in substring_expected(kept, 35):
        if removed:
            texts[doc_id] = left
    plain, out = plain_tokenizer(), []
    for doc_id, text in texts.items():
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    return unordered(out)


def test_pipeline(spark, tmp_path):
    passage = prose(900, 60)
    texts = [prose(i, 60 + i) for i in range(14)]
    texts += [texts[0], texts[0], texts[1] + " more", texts[2] + passage, passage + texts[3], None, "", "short", "w " * 50]
    rows = [(i, t, "host") for i, t in enumerate(texts)]
    frame = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert unordered((r.doc_id, r.length, r.ids_crc32) for r in found) == expected(rows)


def test_pipeline_on_an_empty_table_and_any_names(spark, docs, tmp_path):
    """No rows give no rows; names the stages use themselves stay up to the last stage."""
    docs.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    found = corpus_pipeline.run(spark, f"{tmp_path}/empty")
    assert found.count() == 0 and "sequence_id" in found.columns
    table = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, "")
        assert table.columns == docs.columns
